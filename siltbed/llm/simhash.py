"""SimHash near-duplicates by a binary trie self-join (operator 7).

Every distinct 64-bit fingerprint is a leaf of a binary trie. Pairs of nodes are visited together from the
root down; the differing bits of their paths add up, and a pair is pruned once they exceed the
budget. The upper levels are walked as rows of a DataFrame, four bits a step: a row is a fingerprint in
the node it belongs to (home) or visits (a smaller node within the budget). Nodes with few rows are finished
inside a task; larger ones go four bits deeper, so no group grows with the data or with a cluster.
Two fingerprints that differ in k bits differ in at most k // 2 of them in one half, so two tries are
walked, one from each half, with that smaller budget over the first 32 bits.

Only the edges of a spanning forest leave a task; components follow by star rounds.

Defined cases: a null or empty text has fingerprint zero and is linked like any other; repeated rows and ties
share a fingerprint, hence a component; a null doc_id gets a component but never names one (a component
of null ids only has a null id); an empty table gives no rows; extra columns are ignored by
:func:`components` and kept by :func:`drop_near_duplicates`.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltbed.llm.common import connected, materialize, private, slices

HALF, STEP = 32, 4


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """SimHash of the word shingles: a bit is set if it is in over half of their XXH64 hashes (seed 42)."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = memoryview(b" ".join(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, len(words))
    spans = zip(starts[: len(words) - k + 1].tolist(), ends[k - 1:].tolist(), strict=True)
    hashes = np.fromiter((xxhash.xxh64_intdigest(joined[a:b], 42) for a, b in spans), np.uint64, len(words) - k + 1)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 4096):
        counts += np.unpackbits(hashes[at:at + 4096].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 4, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns and fp, the fingerprint's 64 bits as a signed long."""
    keep = ["doc_id"] if keep is None else keep

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                fps = np.array([fingerprint(t, shingle) for t in part.column(part.num_columns - 1).to_pylist()], np.uint64)
                yield pa.record_batch([*(part.column(i) for i in range(len(keep))), pa.array(fps.view(np.int64))], names=[*keep, "fp"])

    kinds = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema), "fp long"])
    return docs.select(*keep, F.col("text").alias(private("text"))).mapInArrow(run, kinds)


def _turned(fp):
    """The halves of the 64 bits exchanged (its own inverse)."""
    return F.shiftleft(fp, 32).bitwiseOR(F.shiftrightunsigned(fp, 32))


def _down(rows: DataFrame, depth: int, bits: int) -> DataFrame:
    """Rows of nodes at ``depth``, in the nodes STEP bits deeper that they belong to or visit.

    A home row stays home in its own child and visits the smaller ones, so that a pair meets once;
    a visitor visits every child. Beyond the budget nothing is emitted.
    """
    budget = bits // 2 if depth + STEP <= HALF else bits
    own = F.shiftrightunsigned("fp", 64 - STEP - depth).bitwiseAND(15)
    apart = lambda c: F.bit_count(c.bitwiseXOR(F.col("own")))
    met = F.filter(F.sequence(F.lit(0).cast("long"), F.lit(15).cast("long")),
                   lambda c: (F.col("diff") + apart(c) <= budget) & (~F.col("home") | (c <= F.col("own"))))
    rows = rows.withColumn("own", own)
    rows = rows.withColumn("child", F.explode(met))
    return rows.select("trie", F.shiftleft("node", STEP).bitwiseOR(F.col("child")).alias("node"), "fp", (F.col("home") & (F.col("child") == F.col("own"))).alias("home"),
                       (F.col("diff") + apart(F.col("child"))).cast("int").alias("diff"))


class Forest:
    """Union-find over 0..n-1 whose labels are updated for whole arrays of links."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.label[a], self.label[b]
            apart = x != y
            if not apart.any():
                return
            lo, hi = np.minimum(x[apart], y[apart]), np.maximum(x[apart], y[apart])
            np.minimum.at(self.label, hi, lo)
            while True:
                up = self.label[self.label]
                if (up == self.label).all():
                    break
                self.label = up


def walk(homes: np.ndarray, visitors: np.ndarray, spent: np.ndarray, depth: int, bits: int, block: int = 100_000):
    """Spanning links (i, root) among ``homes`` followed by ``visitors`` (uint64), both below one pair of nodes.

    Links join homes with homes and homes with visitors that differ in at most ``bits`` bits. ``spent``: the bits in
    which a visitor's path differs from the node's so far. A stack of blocks of node pairs bounds memory.
    """
    a = np.sort(homes)
    # visitors come from several nodes: they are sorted by the bits below the node alone
    order = np.lexsort((visitors & np.uint64(2 ** (64 - depth) - 1), spent))
    b, cost = visitors[order], spent[order]
    n = len(a)
    values = np.concatenate([a, b])
    forest = Forest(len(values))
    near = lambda i, j: np.bitwise_count(values[i] ^ values[j]) <= bits
    at = np.arange(n - 1)
    close = near(at, at + 1)
    forest.link(at[close], at[close] + 1)
    # node pairs: [la, ha) of the homes with [lb, hb) of all values, and the bits spent
    stack = [(depth, np.array([[0, n, 0, n, 0]], np.int64))] if n else []
    for c in np.unique(cost):
        lo, hi = np.searchsorted(cost, [c, c + 1])
        if n:
            stack.append((depth, np.array([[0, n, n + lo, n + hi, c]], np.int64)))
    zeros: dict[int, np.ndarray] = {}
    while stack:
        d, pairs = stack.pop()
        if len(pairs) > block:
            stack.append((d, pairs[block:]))
            pairs = pairs[:block]
        label = forest.label
        change = np.concatenate([[0, 0], np.cumsum(label[1:] != label[:-1])])  # change[h] - change[l + 1]: label changes in [l, h)
        la, ha, lb, hb, diff = pairs.T
        same = (label[la] == label[lb]) & (change[ha] == change[la + 1]) & (change[hb] == change[lb + 1])
        pairs = pairs[~same]  # all of it is linked already
        la, ha, lb, hb, diff = pairs.T
        leaf = (ha - la) * (hb - lb) <= 1
        one = pairs[leaf]
        one = one[near(one[:, 0], one[:, 2])]
        forest.link(one[:, 0], one[:, 2])
        pairs = pairs[~leaf]
        if not len(pairs):
            continue
        if d >= 64:  # a home, and visitors that differ in their paths only
            many = pairs[:, 3] - pairs[:, 2]
            i = np.repeat(pairs[:, 0], many)
            j = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(pairs[:, 2], many)
            close = near(i, j)
            forest.link(i[close], j[close])
            continue
        if d not in zeros:
            zeros[d] = np.concatenate([[0], np.cumsum((values >> np.uint64(63 - d)) & np.uint64(1) == 0)])
        z = zeros[d]
        la, ha, lb, hb, diff = pairs.T
        ma, mb = la + z[ha] - z[la], lb + z[hb] - z[lb]
        itself = (la == lb) & (ha == hb)
        budget = bits // 2 if d < HALF else bits
        made = [np.stack([la, ma, lb, mb, diff], 1), np.stack([ma, ha, mb, hb, diff], 1), np.stack([la, ma, mb, hb, diff + 1], 1),
                np.stack([ma, ha, lb, mb, diff + 1], 1)[~itself]]
        made = np.concatenate(made)
        made = made[(made[:, 0] < made[:, 1]) & (made[:, 2] < made[:, 3]) & (made[:, 4] <= budget)]
        if len(made):
            stack.append((d + 1, made))
    root = forest.label
    moved = np.flatnonzero(root != np.arange(len(root)))
    return values[moved], values[root[moved]]


def links(fps: DataFrame, bits: int = 4, most: int = 4096, tasks: int = 20_000) -> DataFrame:
    """Edges (a, b) of a spanning forest of all pairs of distinct ``fp`` values that differ in at most ``bits`` bits.

    ``most``: rows of a node that one task finishes; a larger node is always split further. ``tasks``: the
    greatest number of parts that the first expansion is dealt to. The budget of the first half needs bits < 32.
    """
    n = fps.count()
    # the table is small, its walk is not: parts that follow it, which adaptive plans don't merge
    fps = fps.repartition(min(tasks, n // most + 1), "fp")
    rows = fps.select(F.explode(F.array(F.struct(F.lit(0).alias("trie"), F.col("fp")), F.struct(F.lit(1).alias("trie"), _turned(F.col("fp")).alias("fp")))).alias("x"))
    rows = rows.select("x.trie", F.lit(0).cast("long").alias("node"), "x.fp", F.lit(True).alias("home"), F.lit(0).alias("diff"))
    depth = 0
    while depth < HALF and n * (1 + depth) / 2**depth > most / 4:  # the first guess; larger nodes go on below
        rows = _down(rows, depth, bits)
        depth += STEP
    done = None
    kinds = "a long, b long"
    while True:
        rows = materialize(rows, f"trie-{depth}")
        here = rows
        large = rows.groupBy("trie", "node").agg(F.count("*").alias("n")).where(F.col("n") > most).select("trie", "node")
        large = materialize(large, f"large-{depth}")
        left = large.count() if depth < 64 else 0
        if left:
            here = rows.join(large, ["trie", "node"], "left_anti")
        edges = here.groupBy("trie", "node").applyInArrow(_finish(depth, bits), kinds)
        done = edges if done is None else done.unionByName(edges)
        if not left:
            return done
        rows = _down(rows.join(large, ["trie", "node"], "left_semi"), depth, bits)
        depth += STEP


def _finish(depth: int, bits: int):
    def run(group: pa.Table) -> pa.Table:
        fp = group.column("fp").to_numpy().view(np.uint64)
        home = group.column("home").to_numpy(zero_copy_only=False).astype(bool)
        a, b = walk(fp[home], fp[~home], group.column("diff").to_numpy()[~home].astype(np.int64), depth, bits)
        if len(a) and group.column("trie")[0].as_py():
            a, b = ((x << np.uint64(32)) | (x >> np.uint64(32)) for x in (a, b))
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)}, schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    return run


def components(docs: DataFrame, shingle: int = 4, bits: int = 4, keep: list[str] | None = None) -> DataFrame:
    """Rows of ``docs`` as (``keep`` columns, fp, root, component_id): root is the component's smallest fp."""
    keep = ["doc_id"] if keep is None else keep
    owned = materialize(fingerprints(docs, shingle, keep=[*keep, *([] if "doc_id" in keep else ["doc_id"])]), "fingerprints")
    distinct = materialize(owned.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = connected(links(distinct.select("fp"), bits))
    named = distinct.join(roots, distinct.fp == roots.node, "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")
    named = materialize(named, "roots")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(least, "root").select("fp", "root", "component_id")
    return owned.join(named, "fp").select(*keep, "fp", "root", "component_id")


def hexed(fp):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def drop_near_duplicates(docs: DataFrame, shingle: int = 4, bits: int = 4) -> DataFrame:
    """One row of each component stays, with all its columns: that of the smallest doc_id.

    Where rows repeat that id, the one whose text has the least hash stays (equal rows: either).
    """
    row, a, b = private("row"), private("a"), private("b")
    who = [F.xxhash64("doc_id", "text").alias(a), F.hash("doc_id", "text").alias(b)]
    marked = components(docs.select("doc_id", "text", *who), shingle, bits, keep=["doc_id", a, b])
    first = F.struct(a, b)
    chosen = marked.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root").agg(F.min(first).alias("x"))
    packed = docs.select(F.struct("*").alias(row), *who)
    kept = packed.join(chosen.select(f"x.{a}", f"x.{b}"), [a, b], "left_semi")
    return kept.dropDuplicates([a, b]).select(f"{row}.*")
