"""Counts against a plain version, trees: held-out accuracy, monotony, flat scoring; odd rows."""

import random
import re

import numpy as np
from pyspark.sql import functions as F

from siltbed.llm import quality as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    seen, twice = {}, set()
    for i in range(len(words) - 4):
        seen.setdefault(tuple(words[i:i + 5]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            for i in places:
                twice |= set(range(i, i + 5))
    lines, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in lines
            lines.add(line)
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(twice)]


def test_counts_match_a_plain_version(sample_docs):
    r = random.Random(4)
    texts = [x.text for x in sample_docs.select("text").collect()]
    texts += [None, "", "\n\n", "a\xa0b \x1c c\x85d", "a a a a a a a", "a b c d e " * 3] + [
        "".join(r.choice(["a", "b", " ", " ", "\n", "#", "é", "\x0b"]) for _ in range(r.randint(0, 80))) for _ in range(300)]
    for t in texts:
        assert Q.statistics(t)[0] == plain(t)


def test_judgement_of_odd_rows(odd, none):
    got = {(r.doc_id, r.n_words): r for r in Q.judge(odd, None).collect()}
    assert got[2, 0].base_failed and not got[2, 0].kept and got[4, 0].n_dup_lines == 0
    assert got[1, 10].kept and got[5, 10].kept and got[7, 30000].n_repeat_words == 30000
    assert Q.judge(none, None).collect() == []
    kept = Q.keep_good(odd, odd.select("doc_id", F.lit(1).alias("quality")))
    assert kept.columns == odd.columns and sorted(r.doc_id for r in kept.collect()) == [1, 5, 5]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    part = F.xxhash64("doc_id") % 2 == 0
    judged = Q.judge(docs, Q.train(docs, labels.where(part))).join(labels.where(~part), "doc_id")
    n = {(r.quality, r.kept): r.n for r in judged.groupBy("quality", "kept").agg(F.count("*").alias("n")).collect()}
    good = n.get((1, True), 0) / (n.get((1, True), 0) + n.get((1, False), 0))
    bad = n.get((0, False), 0) / (n.get((0, True), 0) + n.get((0, False), 0))
    assert good > 0.93 and bad > 0.9


def test_trees_are_monotone_and_flat_scoring_is_a_walk():
    rng = np.random.default_rng(1)
    x = rng.random((2000, 3))
    y = ((x[:, 0] + 0.3 * np.sin(9 * x[:, 0]) + 0.5 * x[:, 1] + 0.3 * rng.random(2000)) > 0.9).astype(float)
    m = Q.fit(x, y, trees=30, monotone={0: 1})
    grid = np.linspace(0, 1, 101)
    for other in rng.random((20, 2)):
        s = m.score(np.column_stack([grid, np.tile(other, (101, 1))]))
        assert (np.diff(s) >= -1e-12).all()

    def walk(row):
        total = m.base
        for at in m.roots:
            while m.left[at] != at:
                at = m.left[at] if row[m.feature[at]] <= m.threshold[at] else m.right[at]
            total += m.value[at]
        return total

    assert np.allclose(m.raw(x[:50]), [walk(r) for r in x[:50]])
    assert ((m.score(x) > 0.5) == y).mean() > 0.85
