"""Decoding, held-out accuracy, scores of odd rows."""

import itertools
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltbed.llm import toxicity as X


@pytest.fixture(scope="module")
def channel(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("text")
    return X.Channel.train(X.count_trigrams(docs))


@pytest.mark.parametrize("seen", ["stup1d", "1d10t", "m0r0n", "p@thetic", "$cum", "s.t.u.p.i.d", "s t u p i d", "stuuuupid", "l-o-s-e-r", "cl0wn", "tr@sh", "d1sgust1ng", "STUP1D"])
def test_obfuscated_words_are_restored(channel, seen):
    want = {"1d10t": "idiot", "m0r0n": "moron", "p@thetic": "pathetic", "$cum": "scum", "l-o-s-e-r": "loser", "cl0wn": "clown", "tr@sh": "trash", "d1sgust1ng": "disgusting"}.get(seen, "stupid")
    assert X.restore(f"you {seen} there", channel) == f"you {want} there"


def test_plain_words_are_left_alone(channel):
    text = "a plain line, with 3 numbers: 1234 and 5.6! also e-mail"
    assert X.Reader(channel).words(text) >= {"a", "plain", "line", "with", "numbers", "and", "also"}
    assert X.restore("nothing to see here", channel) == "nothing to see here"


def test_viterbi_finds_the_cheapest_reading(channel):
    for text in ("st1p", "b00k$", "a1!e", "x|y0"):
        best = None
        for path in itertools.product(*channel.readings(text)):
            a = b = 0
            cost = 0.0
            for letter, spent in path:
                cost += spent
                if letter:
                    cost += channel.cost[a, b, letter]
                    a, b = b, letter
            cost += channel.cost[a, b, 0]
            word = "".join(chr(96 + x) for x, _ in path if x)
            if best is None or cost < best[0]:
                best = (cost, word)
        assert channel.decode(text) == best[1]


def test_viterbi_reads_gaps_as_nothing_or_as_ends_of_words(channel):
    for text in ("s t u", "a b  c", "i.d.i", "oo k", "x 1 d"):
        for end in (-5.0, 0.0, 50.0):
            found = []
            for path in itertools.product(*channel.readings(text)):
                a = b = 0
                cost, word = 0.0, ""
                for letter, spent in path:
                    if letter == X.BREAK:
                        if not b:
                            break
                        cost, a, b, word = cost + spent + end + channel.cost[a, b, 0], b, 0, word + " "
                    elif letter:
                        cost, a, b, word = cost + spent + channel.cost[a, b, letter], b, letter, word + chr(96 + letter)
                    else:
                        cost += spent
                else:
                    found.append((cost + (channel.cost[a, b, 0] if b else 0.0), word.strip()))
            assert channel.decode(text, end) == min(found)[1]


@pytest.fixture(scope="module")
def classifier(spark, channel):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    return X.train(docs, spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), channel)


SIGNS = {"o": "0", "i": "1", "e": "3", "a": "@", "s": "$", "t": "7", "l": "1", "g": "9"}
ALIKE = {"a": "а", "e": "е", "o": "о", "c": "с", "p": "р", "i": "і"}


def signs(w):
    at = [i for i, c in enumerate(w) if c in SIGNS]
    return "".join(SIGNS[c] if i in at[:2] else c for i, c in enumerate(w))


CHANNEL = {
    "signs": signs,
    "spaces": lambda w: " ".join(w),
    "wide spaces": lambda w: "  ".join(w),
    "dots": lambda w: "..".join(w),
    "dashes": lambda w: "-".join(w),
    "after a word": lambda w: "a " + " ".join(w),
    "signs apart": lambda w: " ".join(signs(w)),
    "doubled": lambda w: "".join(c + c for c in w),
    "drawn out": lambda w: w[:2] + w[2] * 4 + w[3:],
    "one doubled": lambda w: w[:2] + w[2] + w[2:],
    "split": lambda w: w[:2] + " " + w[2:],
    "split late": lambda w: w[:-2] + " " + w[-2:],
    "look-alikes": lambda w: "".join(ALIKE.get(c, c) for c in w),
    "capitals": lambda w: signs(w).upper(),
}


def test_obfuscated_words_are_found_whatever_the_channel_did(channel, classifier):
    scorer = X.Scorer(channel, classifier)
    words = [w for w in sorted(classifier.weights, key=classifier.weights.get, reverse=True) if w.isascii() and w.isalpha() and len(w) >= 5 and classifier.weights[w] > 0.3]
    groups = [g for g in itertools.combinations(words[:12], 3) if scorer.score(f"report {g[0]} window {g[1]} paper {g[2]}") >= 0.5]
    assert len(words) >= 6 and len(groups) >= 20
    rates = {}
    for name, change in CHANNEL.items():
        rates[name] = float(np.mean([scorer.score(f"report {change(a)} window {change(b)} paper {change(c)}") >= 0.5 for a, b, c in groups]))
    print(words[:12], len(groups), {k: round(v, 3) for k, v in rates.items()})
    assert np.mean(list(rates.values())) >= 0.9 and min(rates.values()) >= 0.75


def test_clean_words_stay_clean_in_the_channel(channel, classifier):
    scorer = X.Scorer(channel, classifier)
    words = "window letter committee report paper river mountain garden kitchen table planet doctor bridge market".split()
    flagged = [f(w) for f in CHANNEL.values() for w in words if scorer.score(f"report {f(w)} window") >= 0.5]
    assert flagged == []


def plain_score(text, channel, classifier):
    """All forms of all words and all stretches, without gates and memory."""
    text = (text or "").lower()
    reader, words = X.Reader(channel), X.WORD.findall(text)
    forms = set()
    for w in words:
        folded = w.translate(X.FOLD)
        forms |= {w, folded}
        if any(a == b for a, b in itertools.pairwise(folded)):
            forms |= set(channel.decode(folded).split())
    for m in X.SUSPECT.finditer(text):
        forms |= {w for t, end in reader.readings(m.group()) for w in channel.decode(t, end).split()}
    for a, b in itertools.pairwise(words):
        if min(len(a), len(b)) <= X.PIECE and any(f in classifier.weights for f in X.features({a + b})):
            forms |= set(channel.decode(f"{a} {b}").split())
    z = classifier.constant + sum(classifier.weights[f] for f in X.features(forms) if f in classifier.weights)
    return 1 / (1 + np.exp(-min(30, max(-30, z))))


def test_the_query_scores_as_the_plain_scorer_does(spark, channel, classifier):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: r for r in X.score(docs, channel, classifier).collect()}
    rows = docs.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for r in rows[::24] + [x for x in rows if got[x.doc_id].predicted]:
        want = plain_score(r.text, channel, classifier)
        assert abs(got[r.doc_id].score - want) < 1e-9 and got[r.doc_id].predicted == int(got[r.doc_id].score >= 0.5)


def test_a_long_text_is_read_in_linear_time(channel):
    scorer = X.Scorer(channel, X.Classifier({"stupid": 1.0}, 0.0))
    spent = []
    for n in (20_000, 40_000):
        best = 9e9
        for _ in range(3):
            t0 = time.perf_counter()
            scorer.score("s t u p 1 d " * n)
            best = min(best, time.perf_counter() - t0)
        spent.append(best)
    assert spent[1] < 3.5 * spent[0]


def test_rows_of_one_id_are_learned_from_once(make, channel):
    docs = make([(i, "good day to you", "en", "s") for i in range(40)] + [(100, f"bad word {i}", "en", "s") for i in range(50)])
    labels = docs.select("doc_id").distinct().withColumn("toxic", (F.col("doc_id") == 100).cast("int"))
    labels = labels.unionByName(labels.where("doc_id = 100").withColumn("toxic", F.lit(0)))  # clashes: toxic
    a, b = (X.train(d, labels, channel, least=1) for d in (docs, docs.repartition(7)))
    assert a == b


def test_counts_are_over_whole_texts(make):
    got = X.count_trigrams(make([(1, "ab" * 20_000, "en", "s"), (2, None, "en", "s"), (3, "É", "en", "s")]))
    assert got[1, 2, 1] == 19_999 and got[0, 0, 5] == 1


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    scored = X.judge(docs, labels).join(labels, "doc_id").where("held_out")
    n = {(r.toxic, r.predicted): r.n for r in scored.groupBy("toxic", "predicted").agg(F.count("*").alias("n")).collect()}
    assert n[1, 1] / (n[1, 1] + n.get((1, 0), 0)) > 0.85
    assert n.get((0, 1), 0) / (n[0, 0] + n.get((0, 1), 0)) < 0.01


def test_odd_rows(odd, none):
    labels = odd.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    got = X.judge(odd, labels).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r.score)
    assert by[2] == by[3] == by[4] and by[1] * 2 == by[5]
    assert [r.held_out for r in got if r.doc_id is None] == [True]
    assert X.judge(none, labels).collect() == []
    assert all(r.score < 1e-6 for r in X.judge(odd, none.select("doc_id", F.lit(1).alias("toxic"))).collect())
    bare = X.Classifier({}, 0.0)
    assert bare.score(set()) == 0.5 and np.isfinite(bare.score({"x"}))
