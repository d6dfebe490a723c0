"""Document fingerprints by consistent weighted sampling (operator 4), DataFrame operations only.

A text is a set of words weighted by their counts. A word draws r and c from Gamma(2, 1) and b from [0, 1) by its
hash; with weight w, t = floor(ln w / r + b), and ln a = ln c - r (t - b) - r. The word of least a is a sample, written as a
code of (word, t): two texts draw equal samples with a probability of their generalised Jaccard similarity
(the sum of the lesser weights over the sum of the greater). A weight is cut into slices of ``width`` at most (its sums of
lesser and greater parts stay the same), each drawn for by its own weight: t changes as it grows. Slices are dealt to 128 bins by
hash, each of which gives one sample: so a slice is drawn for once however long the signature, and frequent words count in as many bins as their weight asks. A code has 8 bits (00: no word in
the bin), and the chance of equal codes for unequal samples, 1 in 255, is taken out of the likeness.

Words are exploded and counted, drawn for and reduced to the least of each bin by aggregates over the keys that the
rows are partitioned by already, so that making a fingerprint shuffles nothing and runs as generated code.

Defined cases: a null text is an empty one, whose signature has no words; two texts without words have likeness 1; rows
that repeat doc_id and text are one document (each gives a row); repeated ids with different
texts are ordered by a hash of the text; a null doc_id comes last in descending order; an only document is its
own next one; an empty table gives no rows; extra columns are ignored; a very long text is counted whole, its counts spill if they must.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siltbed.llm.common import materialize, range_buckets, settings, word_list

BINS, CODES, WIDTH = 128, 255, 2.0
LEAST = -(2**63)


def _uniform(bits: Column, shift: int) -> Column:
    return (F.shiftrightunsigned(bits, shift).bitwiseAND(2**21 - 1) + F.lit(0.5)) / F.lit(float(2**21))


def signatures(texts: DataFrame, keys: list[str], text: str, scale: float = 1.0, copies: str | None = None, width: float = WIDTH) -> DataFrame:
    """``keys`` and ``codes``, the codes of the bins, for every row that has a word; a word weighs ``scale`` times its count.

    ``keys`` identify a text; where rows repeat them, ``copies`` is the column with their number. Slices wider than the usual
    weight are fewer but make bins of unequal weight, so that frequent words count for too little in the likeness.
    """
    extra = [copies] if copies else []
    words = texts.select(*keys, *extra, F.explode(word_list(F.col(text))).alias("word"))
    words = words.select(*keys, *extra, F.xxhash64("word").alias("word"))
    times = F.count("*") / F.first(copies) if copies else F.count("*")
    weights = words.groupBy(*keys, "word").agg((times * F.lit(float(scale))).alias("weight"))
    slices = weights.withColumn("slice", F.explode(F.sequence(F.lit(0), F.ceil(F.col("weight") / F.lit(width)).cast("int") - 1)))
    part = F.least(F.col("weight") - F.col("slice") * F.lit(width), F.lit(width))
    drawn = slices.select(*keys, part.alias("weight"), F.xxhash64("word", "slice").alias("word"))
    drawn = drawn.withColumn("more", F.xxhash64("word"))
    drawn = drawn.withColumn("r", -F.log(_uniform(F.col("word"), 0) * _uniform(F.col("word"), 21)))
    drawn = drawn.withColumn("b", _uniform(F.col("more"), 42)).withColumn("c", F.log(-F.log(_uniform(F.col("more"), 0) * _uniform(F.col("more"), 21))))
    drawn = drawn.withColumn("t", F.floor(F.log("weight") / F.col("r") + F.col("b")))
    level = F.col("c") - F.col("r") * (F.col("t") - F.col("b")) - F.col("r")  # ln a, between -64 and 8
    code = F.pmod(F.xxhash64("word", "t"), F.lit(CODES)) + 1
    drawn = drawn.select(*keys, F.shiftrightunsigned("word", 57).alias("bin"), (F.shiftleft(F.round((level + 64) * 2**24).cast("long"), 8) + code).alias("sample"))
    least = drawn.groupBy(*keys, "bin").agg(F.min("sample").alias("sample"))
    packed = (F.shiftleft("bin", 40) + F.col("sample")).alias("packed")
    rows = least.select(*keys, packed).groupBy(*keys).agg(F.collect_list("packed").alias("found"))  # a long for each bin
    return rows.select(*keys, _filled(F.col("found")).alias("codes"))


def _filled(found: Column) -> Column:
    """The codes by bin, 0 for the bins without a word: each bin has an empty sample, after all others."""
    none = F.lit([(b << 40) + ((2**32 - 1) << 8) for b in range(BINS)]).cast("array<bigint>")
    bin_of = lambda x: F.shiftright(x, 40)
    first = F.transform(F.array(F.sort_array(F.concat(found, none))), lambda p: F.filter(
        p, lambda x, i: (i == 0) | (bin_of(x) != bin_of(F.get(p, i - 1)))))[0]
    return F.transform(first, lambda x: x.bitwiseAND(255).cast("int"))


def no_words() -> Column:
    return F.array_repeat(F.lit(0), BINS)


def written(signature: Column) -> Column:
    """Two hex digits a bin."""
    return F.array_join(F.transform(signature, lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")


def read(fingerprint: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda i: F.conv(F.substring(fingerprint, i * 2 + 1, F.lit(2)), 16, 10).cast("int"))


def likeness(a: Column, b: Column) -> Column:
    """The estimated generalised Jaccard similarity of two signatures: equal codes among the bins that either has a word in."""
    votes = F.zip_with(a, b, lambda x, y: F.when((x == 0) & (y == 0), 0).when(x == y, 1001).otherwise(1000))
    total = F.aggregate(votes, F.lit(0), lambda s, v: s + v)
    used, same = F.floor(total / 1000), total % 1000
    rate = (same / used - F.lit(1 / CODES)) / F.lit(1 - 1 / CODES)
    return F.when(used == 0, 1.0).when(used == same, 1.0).otherwise(F.greatest(rate, F.lit(0.0)))


def next_documents(docs: DataFrame) -> DataFrame:
    """(id, mark, n, copies, next_id, next_mark) for each distinct (id, mark): the one that follows by descending id, around the end."""
    keys = materialize(docs.groupBy("id", "mark").agg(F.first("n").alias("n"), F.count("*").alias("copies")), "ids")
    keys = keys.withColumn("bucket", range_buckets(keys, "id"))
    one = F.struct("id", "mark")
    firsts = keys.groupBy("bucket").agg(F.max(one).alias("first"))
    down = W.orderBy(F.desc("bucket"))  # a row for each bucket only
    everything = down.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    firsts = materialize(firsts.select("bucket", F.coalesce(F.lead("first").over(down), F.first("first").over(everything)).alias("over")), "firsts")
    inside = W.partitionBy("bucket").orderBy(F.desc("id"), F.desc("mark"))
    keys = keys.withColumn("follow", F.lead(one).over(inside)).join(firsts, "bucket")
    follow = F.coalesce("follow", "over")
    return materialize(keys.select("id", "mark", "n", "copies", follow["id"].alias("next_id"), follow["mark"].alias("next_mark")), "next")


def edited_and_next(docs: DataFrame, task_chars: int = 3_000_000, tasks: int = 20_000) -> DataFrame:
    """doc_id, n_chars, edited_sha256, both fingerprints, and the likeness to the edited text and to the next document.

    Texts are shuffled once, by id, into parts of about ``task_chars`` characters, whose words a task counts in memory (about 100 bytes
    for each distinct word of a text); the one exchange serves all uses. There are at most ``tasks`` parts: beyond them a part
    holds more texts, and its counts and lists are sorted on disk where they outgrow the memory.
    """
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST)).alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("id", F.xxhash64("text").alias("mark"), "text")
    follow = next_documents(rows.select("id", "mark", F.length("text").alias("n")))
    chars = follow.agg(F.sum(F.col("n").cast("long") * F.col("copies"))).first()[0] or 0
    wanted = follow.select(F.col("next_id").alias("id"), F.col("next_mark").alias("mark"), F.col("id").alias("to_id"), F.col("mark").alias("to_mark"), "n", "copies")
    half = F.floor(F.col("n") / 2).cast("int")
    heads = rows.join(wanted, ["id", "mark"]).select(F.col("to_id").alias("id"), F.col("to_mark").alias("mark"), "copies", F.substring("text", F.lit(1), half).alias("head"))
    heads = heads.dropDuplicates(["id", "mark"])
    n = F.length("text")
    both = rows.join(heads, ["id", "mark"]).select("id", "mark", "copies", "text", F.concat(
        F.substring("text", F.lit(1), n - F.floor(n / 2).cast("int")), F.col("head")).alias("edited"))
    each = both.select("id", "mark", "copies", F.explode(F.array(F.struct(F.lit(0).alias("which"), F.col("text").alias("t")), F.struct(F.lit(1).alias("which"), F.col("edited").alias("t")))).alias("x"))
    found = signatures(each.select("id", "mark", "copies", "x.which", "x.t"), ["id", "mark", "which"], "t", copies="copies")
    found = found.groupBy("id", "mark").agg(*(F.first(F.when(F.col("which") == i, F.col("codes")), ignorenulls=True).alias(f"codes{i}") for i in (0, 1)))
    about = both.select("id", "mark", "copies", n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"))
    own, other = (F.coalesce(f"codes{i}", no_words()) for i in (0, 1))
    done = about.join(found, ["id", "mark"], "left").select(
        "id", "mark", "copies", "n_chars", "edited_sha256", F.unhex(written(own)).alias("fingerprint"), F.unhex(written(other)).alias("edited_fingerprint"), likeness(own, other).alias("near_edited"))
    # planned at once, all uses of an exchange share it; a task's lists of bins stay in memory (128 longs a text)
    with settings(docs.sparkSession, spark__sql__adaptive__enabled="false", spark__sql__shuffle__partitions=str(min(tasks, max(8, chars // task_chars))),
                  spark__sql__objectHashAggregate__sortBased__fallbackThreshold="100000"):
        done = materialize(done, "fingerprints")
    after = follow.select("id", "mark", "next_id", "next_mark")
    beside = done.select(F.col("id").alias("next_id"), F.col("mark").alias("next_mark"), F.col("fingerprint").alias("beside")).dropDuplicates(["next_id", "next_mark"])
    beside = beside.join(after, ["next_id", "next_mark"]).select("id", "mark", "beside")
    done = done.join(beside, ["id", "mark"]).withColumn("near_next", likeness(read(F.hex("fingerprint")), read(F.hex("beside"))))
    hexed = [F.lower(F.hex(c)).alias(c) for c in ("fingerprint", "edited_fingerprint")]
    return done.select(F.when(F.col("id") != LEAST, F.col("id")).alias("doc_id"), "n_chars", "edited_sha256", *hexed, "near_edited", "near_next")
