"""Benchmark decontamination by a broadcast hash set of test n-grams (operator 12), DataFrame operations only.

Texts are lower-cased (A-Z) and cut into words. The windows of the benchmark are its items' runs of ``size`` words (a shorter item is one
window). Their distinct word lists are numbered and hashed; the set is broadcast if its measured bytes are below a bound,
else Spark shuffles both sides by the hash. The training texts are scanned once: each word starts one window for each length that the
benchmark has, hashed as a row of words, looked up by its hash, and verified on the words themselves. What is kept of the
scan is a row for each document and one for each true hit; texts are never shuffled.

A hit covers its words; a document's covered words are counted from the sorted hits. Documents that hit the same windows share
one set, whose items are looked up once: a passage that many documents and many items share costs a row for each, not for each pair.
Items of equal words are one class, so copies in the benchmark don't multiply windows.

:func:`scan` reports each document, :func:`remove` takes out the spans or the documents.

Defined cases: a null or empty text, or one without a word, has no words and no hits; an item without a word has no window; an item without an id
counts under the id ''; items that share an id are one item with the windows of both; repeated rows and rows that share an id or have none get a result each; very long
texts are scanned whole, in one row's array of words; an empty benchmark hits nothing; an empty table gives no rows; extra columns are kept by
:func:`remove` and ignored by :func:`scan`, whatever their names.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltbed.llm.common import materialize, private

SIZE = 10
#: Broadcast the windows up to so many bytes of text and hashes; a hash table of them takes some three times as much.
BROADCAST_BYTES = 64 << 20
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"              # between words, once lower-cased
RAW_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # the same in the text as it is
RAW_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Letters other than A-Z that lower() would change, and code points that Java knows no letter for, as lower() may be newer.
OTHER_CAPITALS = r"[\p{javaUpperCase}\p{javaTitleCase}\p{Cn}&&[^\x00-\x7F]]"


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is; ``lower`` does it (and fast) where there are no other capitals."""
    return F.when(text.rlike(OTHER_CAPITALS), F.translate(text, string.ascii_uppercase, string.ascii_lowercase)).otherwise(F.lower(text))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), GAP, -1), "")


def benchmark_windows(bench: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """(window, gram, k) of the distinct windows, and (window, item) of the items that have them."""
    items = bench.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
    texts = materialize(items.groupBy("words").agg(F.min("item").alias("first")).withColumn("text", F.monotonically_increasing_id()), "bench-texts")
    n, k = F.size("words"), F.least(F.size("words"), F.lit(size))
    grams = texts.select("text", F.explode(F.transform(F.sequence(F.lit(1), n - k + 1), lambda i: F.slice("words", i, k))).alias("gram")).distinct()
    grams = materialize(grams, "bench-grams")
    windows = grams.select("gram").distinct().select(F.monotonically_increasing_id().alias("window"), "gram", F.size("gram").alias("k"))
    windows = materialize(windows, "bench-windows")
    owners = grams.join(windows.select("window", "gram"), "gram").select("window", "text")
    of_text = items.join(texts.select("words", "text"), "words").select("text", "item").distinct()
    return windows, materialize(owners.join(of_text, "text").select("window", "item").distinct(), "bench-owners")


def hits(docs: DataFrame, windows: DataFrame, kept: dict[str, Column], broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """A row (uid, kept, n_words) for each document, with a null window or its first word's, and (uid, at, k, window) for each hit.

    ``first`` marks the document's own row. uid numbers the documents of this scan; the result is written, so it holds.
    """
    sizes = [r[0] for r in windows.select("k").distinct().orderBy("k").collect()] or [1]  # at most ``size`` numbers
    most = max(sizes)
    words = docs.select(F.monotonically_increasing_id().alias("uid"), *(v.alias(c) for c, v in kept.items()), words_of(F.col("text")).alias("words"))
    words = words.withColumn("n_words", F.size("words").cast("long"))
    shifted = F.arrays_zip(F.col("words").alias("w0"), *(F.slice("words", i + 1, F.size("words")).alias(f"w{i}") for i in range(1, most)))
    rows = words.select("uid", *kept, "n_words", F.posexplode_outer(shifted).alias("at", "w"))
    rows = rows.withColumn("at", F.coalesce("at", F.lit(0)))
    word = lambda i: F.col(f"w.w{i}")
    key = lambda k: F.when(word(k - 1).isNotNull(), F.xxhash64(F.lit(k), *(word(i) for i in range(k))))
    run = F.array(*(word(i) for i in range(most)))
    if len(sizes) == 1:
        rows = rows.select("uid", *kept, "n_words", "at", F.lit(sizes[0]).alias("k"), key(sizes[0]).alias("h"), run.alias("run"))
    else:
        rows = rows.select("uid", *kept, "n_words", "at", run.alias("run"), F.explode(F.array(*(F.struct(F.lit(k).alias("k"), key(k).alias("h")) for k in sizes))).alias("x"))
        rows = rows.select("uid", *kept, "n_words", "at", "x.k", "x.h", "run")
    known = _hashed(windows.select("window", "gram", F.col("k").alias("length")), sizes)
    if _bytes(windows) <= broadcast_bytes:
        known = F.broadcast(known)
    same = (rows["h"] == known["hash"]) & (rows["k"] == known["length"]) & (F.slice(rows["run"], F.lit(1), known["length"]) == known["gram"])
    found = rows.join(known, same, "left").withColumn("first", (F.col("at") == 0) & (F.col("k") == sizes[0]))
    return materialize(found.where("window is not null or first").select("uid", *kept, "n_words", "first", "at", "k", "window"), "bench-hits")


def _hashed(windows: DataFrame, sizes: list[int]) -> DataFrame:
    """The windows with the hash of their words, as the scan hashes its own."""
    h = F.lit(None).cast("long")
    for k in sizes:
        h = F.when(F.col("length") == k, F.xxhash64(F.lit(k), *(F.element_at("gram", i + 1) for i in range(k)))).otherwise(h)
    return windows.withColumn("hash", h)


def _bytes(windows: DataFrame) -> int:
    return windows.agg(F.sum(F.octet_length(F.array_join("gram", " ")) + 64)).first()[0] or 0


def scan(docs: DataFrame, bench: DataFrame, size: int = SIZE, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of each document."""
    windows, owners = benchmark_windows(bench, size)
    rows = hits(docs, windows, {"doc_id": F.col("doc_id")}, broadcast_bytes)
    found = rows.where("window is not null")
    per_doc = covered(found, ["uid"]).join(found.groupBy("uid").agg(F.sort_array(F.collect_set("window")).alias("hit")), "uid")  # a text's own windows
    per_doc = materialize(per_doc, "bench-sets")
    sets = materialize(per_doc.select("hit").distinct().withColumn("set", F.monotonically_increasing_id()), "bench-distinct-sets")
    items = sets.select("set", F.explode("hit").alias("window")).join(owners, "window").select("set", "item").distinct()
    items = items.groupBy("set").agg(F.count("*").alias("n_items"), F.array_join(F.sort_array(F.collect_list("item")), ",").alias("ids"))
    items = items.select("set", "n_items", F.sha2(F.col("ids").cast("binary"), 256).alias("items_sha256"))
    per_doc = per_doc.join(sets, "hit").join(items, "set").select("uid", "n_hit", "n_items", "items_sha256")
    out = rows.where("first").select("uid", "doc_id", "n_words").join(per_doc, "uid", "left")
    none = F.sha2(F.lit("").cast("binary"), 256)
    return out.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
                      F.coalesce("items_sha256", none).alias("items_sha256"), F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"))


def covered(found: DataFrame, doc: list[str]) -> DataFrame:
    """n_hit of each document: how many words lie in a hit, each counted once."""
    end = F.col("at") + F.col("k")
    before = W.partitionBy(*doc).orderBy("at", "k").rowsBetween(W.unboundedPreceding, -1)  # a text's own hits
    new = found.select(*doc, F.greatest(end - F.greatest(F.coalesce(F.max(end).over(before), F.lit(0)), F.col("at")), F.lit(0)).alias("new"))
    return new.groupBy(*doc).agg(F.sum("new").cast("long").alias("n_hit"))


def hit_runs(found: DataFrame, doc: list[str]) -> DataFrame:
    """``runs`` of each document: the covered words as (low, high) without overlap, in order; high is the number after the last."""
    end = F.col("at") + F.col("k")
    before = W.partitionBy(*doc).orderBy("at", "k").rowsBetween(W.unboundedPreceding, -1)
    upto = W.partitionBy(*doc).orderBy("at", "k").rowsBetween(W.unboundedPreceding, 0)
    opened = found.select(*doc, "at", "k", end.alias("high"), F.coalesce(F.max(end).over(before) < F.col("at"), F.lit(True)).cast("int").alias("new"))
    runs = opened.withColumn("run", F.sum("new").over(upto)).groupBy(*doc, "run").agg(F.min("at").alias("low"), F.max("high").alias("high"))
    return runs.groupBy(*doc).agg(F.sort_array(F.collect_list(F.struct("low", "high"))).alias("runs"))


def remove(docs: DataFrame, bench: DataFrame, what: str = "spans", share: float = 0.0, size: int = SIZE, length: str | None = "n_chars",
           broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``docs`` without what the benchmark holds.

    ``what``: "documents" drops every document of which more than ``share`` of the words is hit; "spans" takes the hit words and the gaps before
    them out of ``text``. ``length``: a column to set to the new length, if there.
    """
    if what not in ("spans", "documents"):
        raise ValueError(f"what must be 'spans' or 'documents', got {what!r}")
    windows, _ = benchmark_windows(bench, size)
    doc = {"doc": F.col("doc_id").cast("string"), "whole": F.md5(F.col("text").cast("binary"))}
    found = hits(docs, windows, doc, broadcast_bytes).where("window is not null").dropDuplicates(["doc", "whole", "at", "k"])
    row, id_, text, low = (private(x) for x in ("row", "id", "text", "runs"))
    packed = docs.select(F.struct("*").alias(row), doc["doc"].alias(id_), doc["whole"].alias(text))
    runs = hit_runs(found, ["doc", "whole"])
    joined = packed.join(runs.select(F.col("doc").alias("_d"), F.col("whole").alias("_w"), F.col("runs").alias(low)),
                         F.col(id_).eqNullSafe(F.col("_d")) & (F.col(text) == F.col("_w")), "left").drop("_d", "_w")
    own = F.col(f"{row}.text")
    if what == "documents":
        hit = F.aggregate(F.col(low), F.lit(0), lambda n, r: n + r["high"] - r["low"])
        joined = joined.where(F.col(low).isNull() | (hit <= F.size(F.regexp_extract_all(own, F.lit(RAW_WORD), F.lit(0))) * F.lit(share)))
        return joined.select(*(F.col(f"{row}.`{c}`").alias(c) for c in docs.columns))
    new, pieces, gaps = (private(x) for x in ("new", "pieces", "gaps"))
    joined = joined.withColumn(gaps, F.when(F.col(low).isNotNull(), F.split(own, RAW_WORD, -1)))
    joined = joined.withColumn(pieces, F.when(F.col(low).isNotNull(), F.zip_with(
        F.slice(F.col(gaps), 1, F.size(gaps) - 1), F.regexp_extract_all(own, F.lit(RAW_WORD), F.lit(0)), lambda a, b: F.concat(a, b))))
    # what stays lies between the end of a run and the beginning of the next
    ends = F.concat(F.array(F.lit(0)), F.transform(low, lambda r: r["high"]))
    begins = F.concat(F.transform(low, lambda r: r["low"]), F.array(F.size(pieces)))
    stay = F.flatten(F.zip_with(ends, begins, lambda a, b: F.slice(F.col(pieces), a + 1, b - a)))
    joined = joined.withColumn(new, F.when(F.col(low).isNotNull(), F.concat(F.array_join(stay, ""), F.element_at(gaps, -1))))
    fields = []
    for f in docs.schema.fields:
        value = F.col(f"{row}.`{f.name}`")
        if f.name == "text":
            value = F.coalesce(new, value)
        elif f.name == length and f.dataType in (T.LongType(), T.IntegerType()):
            value = F.when(F.col(new).isNull(), value).otherwise(F.length(new).cast(f.dataType))
        fields.append(value.alias(f.name))
    return joined.select(*fields)


#: The same rows in DuckDB's SQL; 10 is the size of a window.
ORACLE = r"""
WITH spoken AS MATERIALIZED (
  SELECT row_number() OVER () AS uid, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
items AS MATERIALIZED (
  SELECT item_id, words, least(len(words), 10) AS k FROM (
    SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark) WHERE len(words) > 0),
grams AS MATERIALIZED (
  SELECT DISTINCT item_id, k, array_to_string(words[i:i + k - 1], ' ') AS gram
  FROM (SELECT *, unnest(range(1, len(words) - k + 2)) AS i FROM items)),
runs AS MATERIALIZED (
  SELECT s.uid, s.i, l.k, array_to_string(s.words[s.i:s.i + l.k - 1], ' ') AS gram
  FROM (SELECT uid, words, unnest(range(1, len(words) + 1)) AS i FROM spoken) s, (SELECT DISTINCT k FROM grams) l
  WHERE s.i + l.k - 1 <= len(s.words)),
found AS MATERIALIZED (SELECT DISTINCT r.uid, r.i, r.k, g.item_id FROM runs r JOIN grams g USING (gram, k)),
covered AS (SELECT uid, count(DISTINCT w) AS n_hit FROM (SELECT DISTINCT uid, unnest(range(i, i + k)) AS w FROM found) GROUP BY uid),
listed AS (
  SELECT uid, count(*) AS n_items, sha256(string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR)) AS items_sha256
  FROM (SELECT DISTINCT uid, item_id FROM found) GROUP BY uid)
SELECT s.doc_id, coalesce(len(s.words), 0) AS n_words, coalesce(c.n_hit, 0) AS n_hit, coalesce(l.n_items, 0) AS n_items,
  coalesce(l.items_sha256, sha256('')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AS contaminated
FROM spoken s LEFT JOIN covered c USING (uid) LEFT JOIN listed l USING (uid)
"""
