"""Fingerprints and components against plain versions; the walk through the trie; odd rows."""

import numpy as np
import xxhash

from siltbed.llm import simhash as S
from siltbed.llm.common import connected


def plain_print(text, k=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, bits=4):
    """Least index reachable, for each."""
    x = np.array(prints, np.uint64)
    label = np.arange(len(x))
    near = np.bitwise_count(x[:, None] ^ x[None, :]) <= bits
    while True:
        new = np.array([label[near[i]].min() for i in range(len(x))])
        if (new == label).all():
            return label
        label = new


def test_matches_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    got = {r.doc_id: r for r in S.components(docs).collect()}
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    prints = [plain_print(t) for _, t in rows]
    label = plain_components(prints)
    for (i, _), f, k in zip(rows, prints, label, strict=True):
        assert got[i].fp & (2**64 - 1) == f
        assert got[i].component_id == rows[k][0]
    assert len(set(label)) < len(rows)


def clusters(n=3000, seed=0):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**64, n, dtype=np.uint64)
    near = [base]
    for k in range(n):
        v = base[k % 7]
        for b in rng.choice(64, rng.integers(1, 7), replace=False):
            v ^= np.uint64(1) << np.uint64(b)
        near.append(np.array([v]))
    return np.unique(np.concatenate(near))


def test_trie_join_splits_large_nodes_and_loses_no_link(spark):
    x = clusters(600)
    fps = spark.createDataFrame([(int(v),) for v in x.view(np.int64)], "fp long")
    edges = S.links(fps, 4, most=150)
    roots = {r.node: r.root for r in connected(edges).collect()}
    want = plain_components(x)
    same = {}
    for v, k in zip(x.view(np.int64).tolist(), want, strict=True):
        assert same.setdefault(roots.get(v, v), k) == k
    assert len(same) == len(set(want))


def test_walk_alone_links_what_is_near():
    x = clusters(400, seed=3)
    a, b = S.walk(x, x[:0], np.array([], np.int64), 0, 4)
    turned = (x << np.uint64(32)) | (x >> np.uint64(32))
    c, d = S.walk(turned, x[:0], np.array([], np.int64), 0, 4)
    back = lambda v: (v << np.uint64(32)) | (v >> np.uint64(32))
    at = {int(v): i for i, v in enumerate(x)}
    forest = S.Forest(len(x))
    forest.link(np.array([at[int(v)] for v in [*a, *back(c)]]), np.array([at[int(v)] for v in [*b, *back(d)]]))
    assert (forest.label == plain_components(x)).all()


def test_odd_rows(odd, none):
    got = [(r.doc_id, r.fp, r.component_id) for r in S.components(odd).collect()]
    assert len(got) == odd.count()
    by = {}
    for i, f, c in got:
        by.setdefault(i, set()).add((f, c))
    assert by[2] == by[3] == by[4] == {(0, 2)} and by[1] == {(f, 1) for f, _ in by[5]} and len(by[9]) == 2
    kept = S.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 2, 6, 7, 8, 9, 9] and ids.count(None) == 1
    assert S.components(none).collect() == [] and S.drop_near_duplicates(none).collect() == []
