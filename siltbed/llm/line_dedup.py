"""Line dedup by a deletion-neighbourhood join (operator 10), DataFrame operations only.

A line that equals an earlier one, or is within one word edit (a word put in, left out or changed) of an
earlier one, goes. Two lines are within one edit exactly if deleting one word at the same place makes them
equal, or deleting one word of the longer makes the shorter. So lines emit their variants, themselves and the line
without one of its words, as hashed keys; equal keys meet, and the earliest line of a key is all that has to be
known of it: no pairs are made, however many lines share a key. Each edit is then verified on the words.

Variants that can have no partner are not emitted. An edit changes one place only, so two lines within one share their first or
their last words, nearly half of them: lines that share neither with another line are out (:func:`with_ends`). Cut into segments,
they share all but one segment: a word is deleted only in a segment whose rest another line has too (:func:`_rests`).

"Earlier" is by (doc_id, hash of the text, line number). Short lines (under ``near_words`` words) go only if equal to an earlier one.
Whether the earlier line itself goes doesn't matter, so the result depends on no order of work.

Defined cases: a null text stays null and an empty one empty; lines without a word always stay; rows that share a doc_id, or
have none, are documents of their own if their texts differ, in the order of the texts' hashes (rows equal in both are ties, whose lines
of equal number both stay); a null doc_id comes after all others; an empty table gives no rows; extra columns are kept, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltbed.llm.common import materialize, private, word_list

LAST = 2**63 - 1


def _lines(docs: DataFrame) -> DataFrame:
    """One row per line with a word: place (doc_id, hash of the text, line number), the line and its hash h."""
    lines = docs.select("doc_id", F.xxhash64("text").alias("whole"), F.posexplode(F.split("text", "\n", -1)).alias("no", "line"))
    lines = lines.where(F.col("line").rlike(r"[^\x20\x09-\x0D]"))
    return lines.select(F.struct(F.coalesce("doc_id", F.lit(LAST)).alias("doc"), "whole", "no").alias("place"), "line", F.xxhash64("line").alias("h"))


def with_ends(lines: DataFrame, near_words: int) -> DataFrame:
    """``lines`` with ``ends``: hashes of the first and of the last words, up to half of them; null for short lines.

    Their number is the same for lines of nearly equal length: a power of 1.25 below half of n or of n - 1
    words, the shorter line's; mostly these two agree and there are two keys. Words are cut off as strings, single spaces between them.
    """
    plain, n, most, fewer = (private(x) for x in ("plain", "n", "most", "fewer"))
    line = F.col("line")
    spaced = line.contains("  ") | line.startswith(" ") | line.endswith(" ")
    for c in "\t\x0b\x0c\r":
        spaced = spaced | line.contains(c)
    lines = lines.withColumn(plain, F.when(spaced, F.array_join(word_list(F.col("line")), " ")).otherwise(F.col("line")))
    lines = lines.withColumn(n, F.length(plain) - F.length(F.replace(F.col(plain), F.lit(" "), F.lit(""))) + 1)

    def count(words):
        half = F.greatest(F.floor(words / 2), F.lit(1)).cast("double")
        return F.floor(F.pow(F.lit(1.25), F.floor(F.log(half) / F.log(F.lit(1.25)) + 1e-9)) + 1e-9).cast("int")

    lines = lines.withColumn(most, count(F.col(n))).withColumn(fewer, count(F.col(n) - 1))
    cut = lambda q: F.call_function("substring_index", F.col(plain), F.lit(" "), q)
    keys = [F.xxhash64(F.lit(side), F.col(q), cut(F.col(q) * sign)) for q in (most, fewer) for side, sign in (("first", 1), ("last", -1))]
    return lines.withColumn("ends", F.when(F.col(n) >= max(2, near_words - 1), F.array_distinct(F.array(*keys)))).drop(plain, n, most, fewer)


def _rests(words: Column, size: Column) -> Column:
    """(size, low, high, key) for each segment of a line of ``size`` words, after an edit or before: the hash of the words around it.

    ``low`` and ``high`` are the numbers of the words that may go to leave ``size - 1`` (n = size) or ``size`` words (n = size + 1).
    There are 8 segments, or the root of the number of words if that is more, so that the work on a long line stays small.
    """
    n = F.size(words)

    def cut(parts):
        edge = lambda j: F.floor(size * j / parts).cast("int")
        return F.transform(F.sequence(F.lit(0), parts - 1), lambda j: F.struct(
            size.alias("size"), (edge(j) + 1).alias("low"), (edge(j + 1) + (n - size)).alias("high"),
            F.xxhash64(size, j, F.slice(words, F.lit(1), edge(j)), F.slice(words, edge(j + 1) + (n - size) + 1, size - edge(j + 1))).alias("key")))

    return F.transform(F.array(F.greatest(F.lit(8), F.floor(F.sqrt(size))).cast("int")), cut)[0]


def _shared(keys: DataFrame) -> DataFrame:
    """The rows of ``keys`` whose key another line has too (a line has a key once)."""
    several = keys.groupBy("key").agg(F.count("*").alias("lines")).where("lines > 1").select("key")
    return keys.join(several, "key", "left_semi")


def _without(words, i):
    """The words without the i-th (0: all)."""
    return F.when(i == 0, words).otherwise(F.concat(F.slice(words, 1, F.greatest(i - 1, F.lit(0))), F.slice(words, i + 1, F.size(words))))


def near_lines(docs: DataFrame, first: DataFrame, near_words: int) -> DataFrame:
    """Hashes of the distinct lines that are within an edit of an earlier one; first: (h, place, ends) of each distinct line."""
    alike = _shared(first.where("ends is not null").select("h", F.explode("ends").alias("key"))).select("h").distinct()
    chosen = materialize(first.select("h", "place").join(alike, "h", "left_semi"), "chosen")
    # hash tables of the few chosen lines; the many lines need not be sorted
    lines = _lines(docs).join(chosen.hint("shuffle_hash"), ["h", "place"], "left_semi").dropDuplicates(["h"])
    lines = materialize(lines.select("h", "place", word_list(F.col("line")).alias("words")), "candidates")
    n = F.size("words")
    rests = lines.select("h", F.explode(F.concat(_rests(F.col("words"), n), _rests(F.col("words"), n - 1))).alias("x")).select("h", "x.*")
    rests = materialize(_shared(rests).select("h", "size", "low", "high"), "rests")

    spots = rests.join(lines, "h")
    gaps = spots.withColumn("i", F.explode(F.sequence("low", "high"))).where(F.col("low") <= F.col("high"))
    gaps = gaps.select("h", "place", "i", n.alias("n"), "size", F.xxhash64(n - 1, _without(F.col("words"), F.col("i"))).alias("key"))
    gaps = materialize(gaps.distinct(), "gaps")
    mate = F.struct("place", "h", "i").alias("mate")
    # a changed word: both lines lack the word of the same number
    same = gaps.where("n = size").withColumn("key", F.xxhash64("key", "i")).select("h", "place", "i", "key")
    changed = same.join(same.groupBy("key").agg(F.min(mate).alias("mate")), "key")
    # a word more: the longer line without it is the shorter one, each distinct line once
    longer = gaps.where("n > size").select("h", "place", "i", "key")
    shorter = spots.where(n == F.col("size")).select("h", "place", F.lit(0).alias("i"), F.xxhash64(n, "words").alias("key")).distinct()
    under = longer.join(shorter.select("key", mate), "key")
    over = shorter.join(longer.groupBy("key").agg(F.min(mate).alias("mate")), "key")
    found = [x.where("mate.place < place").select("h", "i", F.col("mate.h").alias("h2"), F.col("mate.i").alias("i2")) for x in (changed, under, over)]
    pairs = found[0].unionByName(found[1]).unionByName(found[2]).distinct()
    pairs = pairs.join(lines.select("h", F.col("words").alias("a")), "h").join(lines.select(F.col("h").alias("h2"), F.col("words").alias("b")), "h2")
    # the edit is verified on the words themselves
    near = (F.greatest(F.size("a"), F.size("b")) >= near_words) & (_without(F.col("a"), F.col("i")) == _without(F.col("b"), F.col("i2")))
    return pairs.where(near).select("h").distinct()


def dropped_lines(docs: DataFrame, near_words: int = 8, hot_lines: int = 1000) -> DataFrame:
    """The places of the lines that equal an earlier line or are within an edit of one.

    At most ``hot_lines`` lines can each hold more than 1 / ``hot_lines`` of all places: those are broadcast, and their places
    stay where they are read. The places of the others meet their line in a join, and only lines that have something to drop take part.
    """
    lines = materialize(with_ends(_lines(docs), near_words).select("place", "h", "ends"), "lines")
    first = lines.groupBy("h").agg(F.min("place").alias("place"), F.first("ends").alias("ends"), F.count("*").alias("places"))
    first = materialize(first, "first-lines")
    near = near_lines(docs, first, near_words).withColumn("near", F.lit(True))
    known = first.select("h", F.col("place").alias("first"), "places").join(near, "h", "left").where("near or places > 1")
    known = materialize(known, "known-lines")
    share = (first.agg(F.sum("places")).first()[0] or 0) / hot_lines  # one number
    hot = F.broadcast(known.where(F.col("places") > share))  # fewer than hot_lines rows
    lines, dropped = lines.select("place", "h"), F.expr("near or place > first")
    often = lines.join(hot, "h").where(dropped).select("place")
    rest = lines.join(hot.select("h"), "h", "left_anti").join(known.where(F.col("places") <= share), "h").where(dropped).select("place")
    return often.unionByName(rest)


def dedup_lines(docs: DataFrame, near_words: int = 8, length: str | None = "n_chars") -> DataFrame:
    """``docs`` with the repeated lines taken out of ``text``; ``length``: a column to set to the new length, if there."""
    gone = (dropped_lines(docs, near_words).groupBy(F.col("place.doc").alias("doc"), F.col("place.whole").alias("whole"))
            .agg(F.sort_array(F.collect_set("place.no")).alias("gone")))  # at most the lines of one text
    row, doc, whole, gap, parts, new = (private(x) for x in ("row", "doc", "whole", "gap", "parts", "new"))
    packed = docs.select(F.struct("*").alias(row), F.coalesce("doc_id", F.lit(LAST)).alias(doc), F.xxhash64("text").alias(whole))
    gone = gone.select(F.col("doc").alias(doc), F.col("whole").alias(whole), F.col("gone").alias(gap)).hint("shuffle_hash")  # numbers of lines only
    joined = packed.join(gone, [doc, whole], "left")
    # each step a column of its own, so that it is computed once: the lines, then the kept runs between two dropped ones
    joined = joined.withColumn(parts, F.when(F.col(gap).isNotNull(), F.split(f"{row}.text", "\n", -1)))
    edges = F.concat(F.array(F.lit(-1)), F.col(gap), F.array(F.size(parts)))
    runs = F.transform(F.array(edges), lambda e: F.zip_with(F.slice(e, 1, F.size(e) - 1), F.slice(e, 2, F.size(e)),
                                                            lambda a, b: F.slice(F.col(parts), a + 2, b - a - 1)))[0]
    joined = joined.withColumn(new, F.when(F.col(gap).isNotNull(), F.array_join(F.flatten(runs), "\n")))
    fields = []
    for f in docs.schema.fields:
        value = F.col(f"{row}.`{f.name}`")
        if f.name == "text":
            value = F.coalesce(new, value)
        elif f.name == length and f.dataType in (T.LongType(), T.IntegerType()):
            value = F.when(F.col(new).isNull(), value).otherwise(F.length(new).cast(f.dataType))
        fields.append(value.alias(f.name))
    return joined.select(*fields)


#: The same rows in DuckDB's SQL, by the words of every line without one of them; 8: near_words.
ORACLE = r"""
WITH lines AS MATERIALIZED (
  SELECT doc_id, no, string_split(text, chr(10))[no] AS line
  FROM (SELECT doc_id, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS no FROM documents)),
spoken AS MATERIALIZED (SELECT *, (coalesce(doc_id, 9223372036854775807), no) AS place FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
firsts AS MATERIALIZED (
  SELECT line, min(place) AS place, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS words FROM spoken GROUP BY line),
long_ones AS MATERIALIZED (SELECT *, len(words) AS n FROM firsts WHERE len(words) >= 7),
gaps AS MATERIALIZED (
  SELECT line, place, n, i, array_to_string(list_concat(words[1:i-1], words[i+1:]), ' ') AS variant
  FROM (SELECT *, unnest(range(1, n + 1)) AS i FROM long_ones)),
whole AS MATERIALIZED (SELECT line, place, n, array_to_string(words, ' ') AS variant FROM long_ones),
near AS (
  SELECT g.line FROM gaps g JOIN (SELECT i, variant, min(place) AS place FROM gaps GROUP BY ALL) m
    ON g.variant = m.variant AND g.i = m.i WHERE m.place < g.place AND g.n >= 8
  UNION SELECT g.line FROM gaps g JOIN whole w ON g.variant = w.variant WHERE w.place < g.place AND g.n >= 8
  UNION SELECT w.line FROM whole w JOIN gaps g ON g.variant = w.variant WHERE g.place < w.place AND g.n >= 8),
gone AS (
  SELECT s.doc_id, s.no FROM spoken s JOIN firsts f USING (line)
  WHERE s.place > f.place OR s.line IN (SELECT line FROM near)),
kept AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.no) AS text FROM lines l LEFT JOIN gone g
    ON l.doc_id IS NOT DISTINCT FROM g.doc_id AND l.no = g.no WHERE g.no IS NULL GROUP BY l.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
  CASE WHEN d.text IS NULL THEN d.n_chars ELSE length(coalesce(k.text, '')) END AS n_chars
FROM documents d LEFT JOIN kept k ON d.doc_id IS NOT DISTINCT FROM k.doc_id
"""
