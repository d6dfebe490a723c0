"""Likeness against true generalised Jaccard similarity, edited texts, odd rows."""

import hashlib
from collections import Counter

from pyspark.sql import functions as F

from siltbed.llm import fingerprints as P


def jaccard(a, b, scale=1.0):
    a, b = (Counter(t.encode().split()) for t in (a, b))
    top = sum(max(a[w], b[w]) for w in {*a, *b})
    return sum(min(a[w], b[w]) for w in {*a, *b}) / top if top else 1.0


def test_matches_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("doc_id < 300")
    got = {r.doc_id: r for r in P.edited_and_next(docs).collect()}
    rows = sorted(((r.doc_id, r.text) for r in docs.collect()), reverse=True)
    off = []
    for k, (i, t) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        half = len(t) // 2
        edited = t[:len(t) - half] + following[:half]
        r = got[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        off += [r.near_edited - jaccard(t, edited), r.near_next - jaccard(t, following)]
        assert len(r.fingerprint) == 2 * P.BINS
    assert abs(sum(off) / len(off)) < 0.01 and sum(map(abs, off)) / len(off) < 0.04


def test_fractional_weights_have_the_same_collision_rate(spark):
    a = " ".join(f"w{i}" for i in range(900) for _ in range(1 + i % 5))
    b = " ".join(f"w{i}" for i in range(450, 1350) for _ in range(1 + (i * 7) % 4))
    df = spark.createDataFrame([(0, a), (1, b)], "k int, t string")
    ca, cb = (Counter(t.split()) for t in (a, b))
    for scale in (1.0, 0.3, 1.7):
        codes = {r.k: r.codes for r in P.signatures(df, ["k"], "t", scale=scale).collect()}
        pair = spark.createDataFrame([(codes[0], codes[1])], "a array<int>, b array<int>").select(P.likeness(F.col("a"), F.col("b"))).first()[0]
        true = sum(min(ca[w], cb[w]) for w in {*ca, *cb}) / sum(max(ca[w], cb[w]) for w in {*ca, *cb})
        assert abs(pair - true) < 0.13, (scale, pair, true)


def test_odd_rows(odd, none):
    rows = P.edited_and_next(odd).collect()
    assert len(rows) == odd.count()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert by[1][0].fingerprint == by[5][0].fingerprint == by[5][1].fingerprint
    assert by[2][0].n_chars == 0 and by[2][0].fingerprint == "00" * P.BINS and by[2][0].edited_sha256 == hashlib.sha256(b"").hexdigest()
    assert by[4][0].near_next == 1.0 and by[3][0].near_next == 1.0  # no words on either side
    assert len(by[9]) == 2 and len(by[None]) == 1
    assert P.edited_and_next(none).collect() == []
    only = P.edited_and_next(odd.where("doc_id = 1")).first()
    assert only.near_next == 1.0  # its own next document


def test_samples_follow_whole_counts(spark):
    """A word once and the same word twice draw equal samples half the time, as 1 / 2 of their weights is shared."""
    df = spark.createDataFrame([(k, n, " ".join([f"word{k}"] * n)) for k in range(600) for n in (1, 2)], "k int, n int, t string")
    codes = {(r.k, r.n): [c for c in r.codes if c] for r in P.signatures(df, ["k", "n"], "t").collect()}
    assert all(len(c) == 1 for c in codes.values())  # one slice, so one bin
    same = sum(codes[k, 1] == codes[k, 2] for k in range(600)) / 600
    assert abs(same - 0.5) < 0.08, same


def test_parts_are_bounded_and_change_nothing(spark, sample_docs):
    docs = sample_docs.where("doc_id < 60")
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    few, many = P.edited_and_next(docs, task_chars=1, tasks=2), P.edited_and_next(docs)
    assert rows(few) == rows(many)
