"""The pipeline against a plain version of its stages; the registered queries."""

import hashlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from siltbed.llm import mixing, quality, simhash
from siltbed.llm.common import table

from test_line_dedup import plain as plain_lines
from test_mixing import plain as plain_rake
from test_packing import check as check_pieces
from test_simhash import plain_components, plain_print

SF = "/root/testdata/sf0.001"


def form(text):
    import re

    if " | " in text:
        return "table"
    if re.search("[0-9a-f]{32}|AKIA|@[a-z0-9]+[.]", text):
        return "record"
    return "shout" if "!! " in text else "note" if len(text) < 600 else "article" if len(text) < 4000 else "long read"


def test_stages_and_run_match_a_plain_version(spark):
    docs = table(spark, SF, "documents")
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()]
    model = quality.train(docs, table(spark, SF, "labels"))
    good = []
    for row in rows:
        c, x = quality.statistics(row[1])
        if c[0] >= 10 and 100 * c[4] <= 20 * c[0] and model.score(np.array([x]))[0] >= 0.5:
            good.append(row)
    texts = dict(plain_lines([(i, t) for i, t, *_ in good]))
    good = sorted((i, texts[i], lang, s) for i, _, lang, s in good)
    label = plain_components([plain_print(t) for _, t, *_ in good])
    good = [row for k, row in enumerate(good) if label[k] == k]
    cells = [(s, lang, form(t), len(t.split())) for _, t, lang, s in good]
    p = plain_rake(cells, (0.5, 0.7, 0.9), 0.5, mixing.ROUNDS)
    kept = [row for row, c in zip(good, cells, strict=True) if int(hashlib.md5(f"mix-{row[0]}".encode()).hexdigest()[:12], 16) / 2**48 < p[c[:3]]]

    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, SF)
        assert now.columns == docs.columns, name
    assert sorted((r.doc_id, r.text, r.lang, r.source) for r in now.collect()) == kept
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    check_pieces(corpus_pipeline.run(spark, SF).collect(), [(i, t) for i, t, *_ in kept], tokenizer, 2048)


def test_queries_are_registered():
    names = entry.queries()
    assert [n for n in names if n.startswith("op")] and "pipeline" in names
    assert {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{i}" for i in range(1, 11)}
    assert len(corpus_pipeline.STAGES) == 5 and simhash.HALF == 32


def test_sql_matches(spark):
    from tools.oracle_check import digest, duck

    con = duck(SF)
    for name in ("op1_mixing", "op10_line_dedup"):
        df = entry.queries()[name](spark, SF)
        rel = con.sql(entry.oracle_sql()[name])
        assert sorted(df.columns) == sorted(rel.columns)
        assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(rel.columns, rel.fetchall())[0], name
