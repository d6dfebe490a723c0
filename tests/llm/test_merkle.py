"""Merkle manifest against a plain tree in Python: proofs, tampering, many rounds, odd rows."""

import hashlib
import random
import zlib

from pyspark.sql import functions as F

from siltbed.llm import merkle as M


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(r):
    parts = []
    for c in M.FIELDS:
        v = r[c]
        parts.append("-" if v is None else f"{len(str(v).encode())}:{v}")
    return sha("".join(parts))


def way(hashes, at):
    """(siblings level by level, root) of the node ``at`` of a plain tree; siblings as (left, right)."""
    path = []
    while len(hashes) > 1:
        first = at // 16 * 16
        run = hashes[first:first + 16]
        path.append(("".join(run[:at - first]), "".join(run[at - first + 1:])))
        hashes = [sha("".join(hashes[i:i + 16])) for i in range(0, len(hashes), 16)]
        at //= 16
    return path, hashes[0]


def plain(rows):
    """{(doc_id, leaf): (subroot, root, proof, folded, verified)} for rows of distinct (doc_id, leaf)."""
    trees = {}
    for r in rows:
        trees.setdefault(r["source"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r), r))
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    subroots = []
    for s in order:
        trees[s].sort(key=lambda x: x[:3])
        subroots.append(way([x[2] for x in trees[s]], 0)[1])
    out = {}
    for k, s in enumerate(order):
        upper, root = way(subroots, k)
        hashes = [x[2] for x in trees[s]]
        for i, (_, _, h, r) in enumerate(trees[s]):
            path = way(hashes, i)[0] + upper
            node = h
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and r["text"] is not None:
                node = leaf({**r, "text": "".join(c.lower() if "A" <= c <= "Z" else c for c in r["text"])})
            for left, right in path:
                node = sha(left + node + right)
            out[(r["doc_id"], h)] = (subroots[k], root, sha("".join(a + b for a, b in path)), node, node == root)
    return out


def held(docs):
    want = plain([r.asDict() for r in docs.select(*M.FIELDS).collect()])
    got = M.audit(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        assert want[(r.doc_id, r.leaf)] == (r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified), r
    return got


def test_whole_table_against_a_plain_tree(sample_docs):
    got = held(sample_docs)
    assert any(not r.verified for r in got) and any(r.verified for r in got)


def test_many_sources_and_many_rounds(spark):
    """300 sources (their tree has two rounds), one of them with a third of the rows (over 256 leaves), one with one leaf."""
    r = random.Random(4)
    rows = [(i, f"Text {i}", "en", "hot" if i % 3 == 0 else f"s{r.randrange(299)}é", 5) for i in range(1800)]
    rows.append((5000, "Alone", "en", "single", 5))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    held(docs)


def test_sizes_at_the_edges_of_runs_and_blocks(spark):
    """A source of each size: runs and blocks that are just full, just over, and a lone leaf."""
    sizes = [1, 2, 16, 17, 256, 257, 4097]
    docs = spark.createDataFrame([(i, f"Doc {i}", "de", f"of {n}", 7) for n in sizes for i in range(n)], "doc_id long, text string, lang string, source string, n_chars int")
    held(docs.withColumn("doc_id", F.col("doc_id") + 10_000 * F.length("source")))


def test_odd_rows(odd):
    """Nulls in any column, an empty text, a very long one, rows that share an id; equal rows may take either place."""
    got = held(odd.dropDuplicates(list(M.FIELDS)))
    assert [r.verified for r in got if r.doc_id is None] == [True]
    twice = M.audit(odd).collect()
    assert len(twice) == odd.count() and len({r.root for r in twice}) == 1
    assert len([r for r in twice if r.doc_id == 5]) == 2 and len({r.leaf for r in twice if r.doc_id == 5}) == 1


def test_empty_table(none):
    made = M.manifest(none)
    assert made.root is None and made.proofs.count() == 0 and made.sources.count() == 0
    assert M.audit(none).count() == 0


def test_a_changed_field_changes_the_root_and_the_manifest_counts_rows(sample_docs):
    made = M.manifest(sample_docs, rows_per_part=20)
    again = M.manifest(sample_docs.repartition(7))
    assert made.root == again.root  # whatever way the rows are dealt
    assert made.sources.agg(F.sum("n")).first()[0] == sample_docs.count()
    other = M.manifest(sample_docs.withColumn("lang", F.when(F.col("doc_id") == 3, F.lit("xx")).otherwise(F.col("lang"))))
    assert other.root != made.root
    changed = other.sources.join(made.sources.withColumnRenamed("subroot", "was"), "source").where("subroot <> was")
    assert changed.count() == 1


def test_query_against_its_sql(spark):
    import __spark_entry__ as E
    from tools.oracle_check import digest, duck

    sf = "/root/testdata/sf0.001"
    df = E.queries()["op13_merkle"](spark, sf)
    rel = duck(sf).sql(E.oracle_sql()["op13_merkle"])
    assert sorted(df.columns) == sorted(rel.columns)
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(rel.columns, rel.fetchall())[0]
