"""Merkle manifest of a dataset by concatenated-level strings (operator 13), DataFrame operations only.

Each row of a table is a leaf, the SHA-256 of its fields. The leaves of a source, by doc_id, are the bottom of a tree
in which every 16 neighbouring nodes become the hash of their hex digests; the sources' roots are the leaves of one more tree.

An aligned block of 16^``LEVELS`` neighbouring nodes holds each of its levels as one string, the nodes' digests end to end.
Substrings of 16 * 64 digits are hashed to give the next level (:func:`parents`), the substrings to the left and right of a node
inside its run are its siblings (:func:`segments`). The blocks' top nodes are the nodes of the next round, until a tree has one
node; the same rounds then run over the sources' roots. A block has at most 256 nodes whatever the input, so no group grows;
the number of rounds grows with the logarithm of the rows. On the way back each block gets its node's way to the
root from the round above, once for all its nodes.

A leaf's place comes from range partitions by (source, doc_id, leaf): rows are sorted and written with the number of their
partition and their place in it, and counts per (source, partition) say how many come before. No task sees a whole source.

Defined cases: a null field is hashed as ``-``; rows of equal doc_id are ordered by leaf, and rows equal in all fields have leaves of
their own with equal digests, in either order; a null doc_id
comes first in its source and is never tampered with; a null source is a source, before all others; an empty text is ``0:``; very long texts
are hashed whole; an empty table has no rows and no root (None); extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siltbed.llm.common import materialize

FANOUT = 16
LEVELS = 2                    # levels that a block holds below its top node
BLOCK = FANOUT ** LEVELS
HEX = 64                      # digits of a digest
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<l:string,r:string>>"


def sha(x: Column) -> Column:
    return F.sha2(x.cast("binary"), 256)


def field(value: Column) -> Column:
    """A field as it goes into the leaf: its length in bytes before it, so that no two rows give the same string."""
    s = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf(values: dict[str, Column]) -> Column:
    return sha(F.concat(*(field(values[c]) for c in FIELDS)))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def parents(level: Column) -> Column:
    """The level above one: the hashes of its runs of 16 digests, as one string."""
    last = F.floor((F.length(level) / HEX - 1) / FANOUT).cast("int")
    wide = FANOUT * HEX
    return F.array_join(F.transform(F.sequence(F.lit(0), last), lambda i: sha(F.substring(level, i * wide + 1, F.lit(wide)))), "")


def segments(level: Column, at: Column) -> Column:
    """(l, r): the digests left and right of the node ``at`` in its run."""
    first = (F.floor(at / FANOUT) * FANOUT).cast("int")
    return F.struct(F.substring(level, first * HEX + 1, (at - first) * HEX).alias("l"),
                    F.substring(level, (at + 1) * HEX + 1, (first + FANOUT - 1 - at) * HEX).alias("r"))


def fold(start: Column, path: Column) -> Column:
    """The root that a node and its siblings, level by level, lead to."""
    return F.aggregate(path, start, lambda h, s: sha(F.concat(s["l"], h, s["r"])))


def siblings(path: Column) -> Column:
    """All siblings on the way up as one string."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["l"], s["r"])), "")


def placed(nodes: DataFrame, order: list[str], rows_per_part: int) -> DataFrame:
    """``nodes`` with ``pos``, their place in their tree by ``order``, and ``n``, the tree's number of nodes."""
    spark = nodes.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), nodes.count() // rows_per_part)
    dealt = nodes.repartitionByRange(parts, "tree", *order).sortWithinPartitions("tree", *order)
    inside = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    dealt = materialize(dealt.withColumn("part", F.spark_partition_id()).withColumn("inside", inside), "merkle-dealt")
    runs = dealt.groupBy("tree", "part").agg(F.min("inside").alias("first"), F.count("*").alias("rows"))
    tree = W.partitionBy("tree")  # a row for each partition that holds some of the tree
    runs = runs.select("tree", "part", (F.coalesce(F.sum("rows").over(tree.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
                                        - F.col("first")).alias("shift"), F.sum("rows").over(tree).alias("n"))
    return dealt.join(runs, ["tree", "part"]).withColumn("pos", F.col("inside") + F.col("shift")).drop("part", "inside", "shift")


def blocks_of(nodes: DataFrame, carried: list[str]) -> DataFrame:
    """A row for each block: its levels ``l0`` and ``l1``, its ``top`` node, its ``entries`` (place in the block, carried columns)."""
    at = (F.col("pos") % BLOCK).cast("int").alias("at")
    entries = F.sort_array(F.collect_list(F.struct(at, "h", *carried)))  # at most 256
    rows = nodes.groupBy("tree", "n", F.floor(F.col("pos") / BLOCK).alias("block")).agg(entries.alias("entries"))
    rows = rows.withColumn("l0", F.array_join(F.transform("entries", lambda e: e["h"]), ""))
    rows = rows.withColumn("l1", F.when(F.col("n") > 1, parents(F.col("l0"))))
    top = F.when(F.col("n") <= 1, F.col("l0")).when(F.col("n") <= FANOUT, F.col("l1")).otherwise(parents(F.col("l1")))
    return rows.select("tree", "n", "block", "l0", "l1", top.alias("top"),
                       F.transform("entries", lambda e: F.struct(e["at"].alias("at"), *(e[c].alias(c) for c in carried))).alias("entries"))


def climb(nodes: DataFrame, carried: list[str]) -> tuple[list[DataFrame], DataFrame]:
    """Rounds of blocks, bottom first, over all trees at once, and (tree, root) of each tree."""
    rounds = [materialize(blocks_of(nodes, carried), "merkle-blocks")]
    roots = rounds[0].where(F.col("n") <= BLOCK).select("tree", F.col("top").alias("root"))
    most = rounds[0].agg(F.max("n")).first()[0] or 0
    while most > BLOCK:
        up = rounds[-1].where(F.col("n") > BLOCK)
        up = up.select("tree", F.ceil(F.col("n") / BLOCK).cast("long").alias("n"), F.col("block").alias("pos"), F.col("top").alias("h"))
        rounds.append(materialize(blocks_of(up, []), "merkle-blocks"))
        roots = roots.unionByName(rounds[-1].where(F.col("n") <= BLOCK).select("tree", F.col("top").alias("root")))
        most = -(-most // BLOCK)
    return rounds, roots


def descend(rounds: list[DataFrame], above: DataFrame | None) -> DataFrame:
    """The nodes of the bottom round, each with its ``path``: its siblings level by level up to the last root.

    ``above``: (tree, up, ...), the way from a tree's root onwards; its other columns come along. None: the tree's root is the last.
    """
    if above is None:
        above = rounds[-1].select("tree").distinct().withColumn("up", F.array().cast(PATH))
    kept = [c for c in above.columns if c not in ("tree", "up")]
    nodes = None
    for rows in reversed(rounds):
        ways = rows.where(F.col("n") <= BLOCK).join(above, "tree")
        if nodes is not None:  # blocks whose top node is a node of the round above
            tops = nodes.select("tree", F.col("at").alias("block"), F.col("path").alias("up"), *kept)
            ways = ways.unionByName(rows.where(F.col("n") > BLOCK).join(tops, ["tree", "block"]).select(*ways.columns))
        each = ways.select("tree", "block", "n", "l0", "l1", "up", *kept, F.explode("entries").alias("e"))
        at = F.col("e.at")
        own = F.array(F.when(F.col("n") > 1, segments(F.col("l0"), at)),
                      F.when(F.col("n") > FANOUT, segments(F.col("l1"), F.floor(at / FANOUT).cast("int"))))
        path = F.concat(F.filter(own, lambda s: s.isNotNull()), F.col("up"))
        nodes = each.select("tree", (F.col("block") * BLOCK + at).alias("at"), path.alias("path"), *kept, "e")
        if rows is not rounds[0]:
            nodes = materialize(nodes.drop("e"), "merkle-paths")
    carried = [f.name for f in nodes.schema["e"].dataType.fields if f.name != "at"]
    return nodes.select("tree", "at", "path", *kept, *(f"e.{c}" for c in carried))


@dataclass
class Manifest:
    """root: the dataset's digest, None without rows. sources: (source, n, subroot). proofs: a row for each leaf with its way to the root."""

    root: str | None
    sources: DataFrame
    proofs: DataFrame


def manifest(docs: DataFrame, rows_per_part: int = 1_000_000, **extra: Column) -> Manifest:
    """The trees over ``docs``; ``extra``: columns made of a document's fields that stay beside its leaf.

    ``proofs`` has (doc_id, source, leaf, subroot, start, path, extra): ``start``, the leaf's place in its source, and ``path``,
    (l, r) digests left and right, level by level through the source's root to the last.
    """
    spark = docs.sparkSession
    # a null source goes before all others: keys begin with n or s
    tree = F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n"))
    rows = docs.select(tree.alias("tree"), "doc_id", leaf({c: F.col(c) for c in FIELDS}).alias("h"), *(v.alias(k) for k, v in extra.items()))
    rows = placed(materialize(rows, "merkle-leaves"), ["doc_id", "h"], rows_per_part)
    rounds, subroots = climb(rows.withColumn("leaf", F.col("h")), ["doc_id", "leaf", *extra])
    sizes = rounds[0].groupBy("tree").agg(F.max("n").alias("size"))
    subroots = materialize(subroots.join(sizes, "tree"), "merkle-subroots")
    top = subroots.select(F.lit("all").alias("tree"), F.col("tree").alias("source"), "root", "size")
    top = placed(top, ["source"], rows_per_part).withColumnRenamed("root", "h")
    upper, roots = climb(top.withColumn("subroot", F.col("h")), ["source", "subroot", "size"])
    root = (roots.first() or {"root": None})["root"]
    name = lambda c: F.when(F.substring(c, 1, 1) == "s", F.substring(c, 2, 2**31 - 1))
    above = materialize(descend(upper, None).select(F.col("source").alias("tree"), F.col("path").alias("up"), "subroot", "size"), "merkle-sources")
    proofs = descend(rounds, above.drop("size"))
    proofs = proofs.select("doc_id", name(F.col("tree")).alias("source"), "leaf", "subroot", F.col("at").alias("start"), "path", *extra)
    return Manifest(root, above.select(name(F.col("tree")).alias("source"), F.col("size").alias("n"), "subroot"), proofs)


def audit(docs: DataFrame) -> DataFrame:
    """Each document's proof, and the root that it gives after a tampering of every document whose id's crc32 divides by 5."""
    values = {c: F.col(c) for c in FIELDS}
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    changed = F.when(hit, leaf(values | {"text": lower_ascii(F.col("text"))}))
    made = manifest(docs, changed=changed)
    folded = fold(F.coalesce("changed", "leaf"), F.col("path"))
    got = made.proofs.select("doc_id", "leaf", "subroot", F.lit(made.root).alias("root"), sha(siblings(F.col("path"))).alias("proof_sha256"), folded.alias("folded_root"))
    return got.withColumn("verified", F.col("folded_root") == F.col("root"))


#: The same rows in DuckDB's SQL: levels by recursion, siblings and folds from the table of all nodes.
#: crc32 is computed bit by bit; 3988292384 is its polynomial.
ORACLE = r"""
WITH RECURSIVE parts AS MATERIALIZED (
  SELECT doc_id, source, CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(doc_id::VARCHAR) || ':' || doc_id END
    || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END
    || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END
    || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(n_chars::VARCHAR) || ':' || n_chars END AS head, text,
    list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
      lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
        lambda x, z: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::BIGINT) ELSE x // 2 END)) AS crc
  FROM documents),
leaves AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM (
    SELECT doc_id, source, sha256(head || CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END) AS leaf,
      CASE WHEN xor(crc, 4294967295::BIGINT) % 5 = 0 THEN
        sha256(head || CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':'
          || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') END) END AS changed
    FROM parts)),
nodes AS (
  SELECT coalesce('s' || source, 'n') AS tree, 0 AS lvl, pos, leaf AS h, count(*) OVER (PARTITION BY source) AS n FROM leaves
  UNION ALL
  SELECT tree, any_value(lvl) + 1, pos // 16, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 15) // 16
  FROM nodes WHERE n > 1 GROUP BY tree, pos // 16),
subroots AS MATERIALIZED (SELECT tree, lvl, h, row_number() OVER (ORDER BY tree) - 1 AS pos FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS lvl, pos, h, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT any_value(lvl) + 1, pos // 16, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 15) // 16
  FROM tops WHERE n > 1 GROUP BY pos // 16),
steps AS MATERIALIZED (
  SELECT tree, lvl, pos, h, false AS top FROM nodes WHERE n > 1
  UNION ALL SELECT NULL, lvl, pos, h, true FROM tops WHERE n > 1),
runs AS MATERIALIZED (SELECT tree, top, lvl, pos // 16 AS run, list(h ORDER BY pos) AS hs FROM steps GROUP BY ALL),
ways AS MATERIALIZED (
  SELECT coalesce('s' || l.source, 'n') AS tree, l.pos AS leaf_pos, l.doc_id, l.leaf, coalesce(l.changed, l.leaf) AS begun,
    s.h AS subroot, s.pos AS spot, s.lvl AS depth FROM leaves l JOIN subroots s ON s.tree = coalesce('s' || l.source, 'n')),
climbed AS (
  SELECT tree, leaf_pos, 0 AS step, begun AS h, '' AS proof FROM ways
  UNION ALL
  SELECT c.tree, c.leaf_pos, c.step + 1,
    sha256(array_to_string(r.hs[:p.at], '') || c.h || array_to_string(r.hs[p.at + 2:], '')),
    c.proof || array_to_string(r.hs[:p.at], '') || array_to_string(r.hs[p.at + 2:], '')
  FROM climbed c JOIN ways w ON c.tree = w.tree AND c.leaf_pos = w.leaf_pos,
    LATERAL (SELECT CASE WHEN c.step < w.depth THEN c.step ELSE c.step - w.depth END AS lvl, c.step >= w.depth AS top,
      (CASE WHEN c.step < w.depth THEN w.leaf_pos ELSE w.spot END) // CAST(16 ** (CASE WHEN c.step < w.depth THEN c.step ELSE c.step - w.depth END) AS BIGINT) AS pos) q,
    LATERAL (SELECT q.pos % 16 AS at) p,
    runs r WHERE r.top = q.top AND r.tree IS NOT DISTINCT FROM (CASE WHEN q.top THEN NULL ELSE c.tree END) AND r.lvl = q.lvl AND r.run = q.pos // 16),
ends AS (SELECT tree, leaf_pos, arg_max(h, step) AS h, arg_max(proof, step) AS proof FROM climbed GROUP BY ALL)
SELECT w.doc_id, w.leaf, w.subroot, t.h AS root, sha256(e.proof) AS proof_sha256, e.h AS folded_root, e.h = t.h AS verified
FROM ways w JOIN ends e ON w.tree = e.tree AND w.leaf_pos = e.leaf_pos, (SELECT h FROM tops WHERE n = 1) t
"""
