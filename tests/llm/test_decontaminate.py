"""Decontamination against a plain scan in Python: short items, copies, both joins, removal, odd rows."""

import hashlib
import random
import re
import string

import pytest
from pyspark.sql import functions as F

from siltbed.llm import decontaminate as D

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def plain(docs, bench, size=10):
    """[(doc_id, n_words, n_hit, n_items, items_sha256)]"""
    grams = {}
    for item, text in bench:
        w = words(text)
        k = min(size, len(w))
        for i in range(len(w) - k + 1) if w else ():
            grams.setdefault(tuple(w[i:i + k]), set()).add("" if item is None else str(item))
    lengths = {len(g) for g in grams}
    out = []
    for doc_id, text in docs:
        w, hit, items = words(text), set(), set()
        for i in range(len(w)):
            for k in lengths:
                if (own := grams.get(tuple(w[i:i + k]))) and i + k <= len(w):
                    hit.update(range(i, i + k))
                    items |= own
        out.append((doc_id, len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()))
    return out


def held(spark, docs, bench, **kw):
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame(bench, "item_id long, text string")
    got = [tuple(r)[:5] for r in D.scan(frame, items, **kw).collect()]
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(got, key=key) == sorted(plain(docs, bench, kw.get("size", 10)), key=key)
    return got


def random_case(seed, n_docs=60):
    """Few words, so that windows hit often; short items; copies of items; hits that overlap and touch the ends."""
    r = random.Random(seed)
    vocabulary = ["a", "B", "c", "dé", "É", "字", "7", "x"]
    text = lambda n: r.choice(["", "--"]) + "".join(r.choice(vocabulary) + r.choice([" ", ", ", "\n", "_"]) for _ in range(n))
    bench = [(i, text(r.choice([0, 1, 2, 3, 5, 9]))) for i in range(6)] + [(100 + i, text(r.choice([12, 20]))) for i in range(6)]
    bench += [(900, bench[3][1].upper()), (901, bench[8][1]), (8, text(4)), (8, text(11)), (None, text(5)), (None, None)]
    docs = [(i, text(r.randrange(40))) for i in range(n_docs)]
    for i in range(20):
        docs.append((1000 + i, text(3) + r.choice(bench)[1:][0].__str__() + " " + text(2)))
    return docs, bench


def test_random_texts_against_a_plain_scan_by_both_joins(spark):
    docs, bench = random_case(1)
    by_broadcast = held(spark, docs, bench)
    assert sum(1 for r in by_broadcast if r[2]) > 10
    assert sorted(held(spark, docs, bench, broadcast_bytes=0)) == sorted(by_broadcast)
    held(spark, docs, bench, size=3)


def test_windows_of_one_length_only(spark):
    docs, bench = random_case(2)
    held(spark, docs, [b for b in bench if len(words(b[1])) >= 10])


def test_odd_rows_and_empty_tables(spark, make, odd, none):
    bench = spark.createDataFrame([(1, "three four five six seven EIGHT nine ten one two three"), (2, "no ID here"), (3, None), (4, "")], "item_id long, text string").withColumn("k", F.lit("extra"))
    got = D.scan(odd, bench).collect()
    assert len(got) == odd.count()
    want = plain([(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()], [tuple(r)[:2] for r in bench.collect()])
    assert sorted((tuple(r)[:5] for r in got), key=lambda r: (r[0] or -1, r[1:])) == sorted(want, key=lambda r: (r[0] or -1, r[1:]))
    assert D.scan(none, bench).count() == 0
    assert not D.scan(odd, bench.limit(0)).where("contaminated").count()
    kept = D.remove(odd, bench)
    assert kept.columns == odd.columns and kept.count() == odd.count()
    assert D.remove(none, bench).count() == 0


def test_lower_case_is_that_of_ascii_only(spark):
    """Every code point: lower_ascii changes A-Z alone, whatever Spark's lower would do."""
    rows = spark.range(1, 0x20000).where("id not between 55296 and 57343").select(F.col("id"), F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32").alias("c"))
    wrong = rows.withColumn("got", D.lower_ascii(F.concat(F.lit("Aß"), "c"))).withColumn(
        "want", F.concat(F.lit("aß"), F.when(F.col("id").between(65, 90), F.lower("c")).otherwise(F.col("c")))).where("got <> want")
    assert wrong.count() == 0


def test_spans_and_documents_go(spark):
    item = "the quick brown fox jumps over the lazy dog again and again"
    docs = spark.createDataFrame([(1, f"Before it. {item.title()}! After.", 0), (2, "All clean here", 14), (3, item, 0), (None, item + "?", 0), (1, "Before", 6)],
                                 "doc_id long, text string, n_chars long")
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    got = {(r.doc_id, r.text, r.n_chars) for r in D.remove(docs, bench).collect()}
    assert got == {(1, "Before it! After.", 17), (2, "All clean here", 14), (3, "", 0), (None, "?", 1), (1, "Before", 6)}
    assert {(r.doc_id, r.text) for r in D.remove(docs, bench, "documents").collect()} == {(2, "All clean here"), (1, "Before")}
    assert D.remove(docs, bench, "documents", share=0.9).count() == 3  # 12 of 15 words are under the share
    again = D.scan(D.remove(docs, bench), bench)
    assert again.where("contaminated").count() == 0
    with pytest.raises(ValueError):
        D.remove(docs, bench, "lines")


def test_query_against_its_sql(spark):
    import __spark_entry__ as E
    from tools.oracle_check import digest, duck

    sf = "/root/testdata/sf0.001"
    df = E.queries()["op12_decontaminate"](spark, sf)
    rel = duck(sf).sql(E.oracle_sql()["op12_decontaminate"])
    rows = [tuple(r) for r in df.collect()]
    assert sorted(df.columns) == sorted(rel.columns) and sum(r[2] for r in rows) > 0
    assert digest(df.columns, rows)[0] == digest(rel.columns, rel.fetchall())[0]
