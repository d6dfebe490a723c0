"""Spelling variant grouping by dynamic programming over sorted lists (operator 11).

Words that differ by one edit (a code point put in, left out or changed) are near; a word's form is its near word of largest
count, if that is at least ``ratio`` times its own; forms are followed to their root.

An edit lies in the second half of a word or in the first, so two near words share their first ``length // 2`` code points or, read
backwards, the rest. So the vocabulary is sorted twice, as it is and backwards, and in each list a word's partners lie in
the range that begins with its half. The list is cut into blocks of neighbours by range partitions. A word goes to the blocks that its
range touches, unless the prefix that all words of a block share already differs from it by more than one edit
(:func:`route`). In a block one scan goes through the sorted words (:class:`Scan`): the rows of the edit matrix, banded to the diagonal and its
neighbours, are kept for the prefix that adjacent words share (their LCP), and when a row holds no value below two, all
words that share that prefix are skipped.

A block has some ``block_words`` words however many share a half, and the words that visit one are dealt to several tasks if they are many, each
with a copy of the block. The directory of blocks (its first and last word) is a row per block, sent to the
tasks; it is checked against ``DIRECTORY_ROWS``, beyond which blocks grow instead. Roots come by pointer doubling: forms have ever larger counts,
so a chain is short.

Defined cases: null texts have no words; a null doc_id counts as the empty string before the colon; repeated rows count each; words of equal count tie to the
smallest by code point; very long texts are read run by run; an empty table or vocabulary gives no rows; extra columns are ignored, whatever
their names.
"""

from __future__ import annotations

import re
import string
import zlib
from bisect import bisect_left
from collections import Counter
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltbed.llm.common import materialize

LETTERS = "[A-Za-zÀ-ÿ]"
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
TYPO_MODULUS = 199
MIN_LENGTH, MIN_COUNT, RATIO = 6, 5, 5
BLOCK_WORDS = 4_000       # words of a block
VISITS = 40_000           # words that visit a block in one task
DIRECTORY_ROWS = 50_000   # blocks of a list at most: some 50 bytes each
HELD = 100_000            # distinct words a task counts before it passes them on
LONG = 1 << 20            # code points from which a text's runs are counted in parts


# ---- vocabulary -----------------------------------------------------------------------------------

def text_words(doc_id, text: str, typos: int | None, min_length: int) -> Counter:
    """Counts of a text's words: its runs in lower case (A-Z), with a code point left out where the hash of id and run says so.

    A match of at least ``min_length`` letters is a whole run: it begins where the run does and takes all of it. Shorter runs give no word.
    """
    pattern = re.compile(f"{LETTERS}{{{min_length},}}")
    if len(text) < LONG:
        runs = Counter(pattern.findall(text))
    else:
        runs, found = Counter(), (m.group() for m in pattern.finditer(text))
        while part := list(islice(found, HELD)):
            runs.update(part)
    words: Counter = Counter()
    for run, n in runs.items():
        words[run.lower() if run.isascii() else run.translate(LOWER)] += n
    out: Counter = Counter()
    head = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for word, n in words.items():
        if typos:
            h = zlib.crc32(word.encode(), head)
            if h % typos == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1:]
        if len(word) >= min_length:
            out[word] += n
    return out


def vocabulary(docs: DataFrame, typos: int | None = TYPO_MODULUS, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words of at least ``min_length`` code points that occur ``min_count`` times over all texts."""

    def count(batches):
        held: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                if text.is_valid:
                    held.update(text_words(doc_id.as_py(), text.as_py(), typos, min_length))
                    if len(held) > HELD:
                        yield counted(held)
                        held = Counter()
        yield counted(held)

    def counted(held):
        return pa.RecordBatch.from_pydict({"word": pa.array(list(held), pa.string()), "n": pa.array(list(held.values()), pa.int64())})

    parts = docs.select("doc_id", "text").mapInArrow(count, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# ---- the sorted list ------------------------------------------------------------------------------

def common_prefix(a: str, b: str) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n - 1  # a[:low] is shared, a[:high + 1] isn't
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[:mid] == b[:mid] else (low, mid - 1)
    return low


def next_row(word: str, row: tuple, depth: int, c: str) -> tuple:
    """The row of the banded edit matrix below ``row`` (of the prefix of ``depth`` code points), for one code point more.

    A row has the distances of a prefix of d code points to the first d - 1, d and d + 1 of ``word``; 2 stands for all above 1.
    """
    n, d = len(word), depth + 1
    low, mid, high = row
    # the cell (d, k) comes from (d - 1, k - 1) by a match or a change, (d - 1, k) and (d, k - 1) by a gap
    a = 2
    if 0 <= d - 1 <= n:
        a = mid + 1
        if d >= 2:
            a = min(a, low + (word[d - 2] != c))
    b = 2
    if d <= n:
        b = min(mid + (word[d - 1] != c), high + 1, a + 1)
    e = 2
    if d + 1 <= n:
        e = min(high + (word[d] != c), b + 1)
    return (a if a < 2 else 2, b if b < 2 else 2, e if e < 2 else 2)


START = (2, 0, 1)  # of the empty prefix


class Scan:
    """A sorted list of words with the LCPs of neighbours, scanned for the words near a given one."""

    def __init__(self, words: list[str]):
        self.words = words
        n = len(words)
        self.lcp = [0] * n  # with the word before
        for i in range(1, n):
            self.lcp[i] = common_prefix(words[i - 1], words[i])
        self.shorter = [n] * n  # the next place whose LCP is smaller
        stack: list[int] = []
        for i in range(n):
            while stack and self.lcp[stack[-1]] > self.lcp[i]:
                self.shorter[stack.pop()] = i
            stack.append(i)

    def near(self, word: str, shared: int) -> list[int]:
        """Places of the words that begin with the first ``shared`` code points of ``word`` and differ from it by one edit."""
        words, lcp, n, m = self.words, self.lcp, len(self.words), len(word)
        prefix = word[:shared]
        at = bisect_left(words, prefix)
        found: list[int] = []
        # rows[d - shared] is the row of a prefix of d code points; along the shared prefix the distance is 0
        rows = [(1, 0, 1 if shared < m else 2)]
        while at < n and words[at].startswith(prefix):
            other = words[at]
            depth, row = shared + len(rows) - 1, rows[-1]
            size = len(other)
            while depth < size and (row[0] < 2 or row[1] < 2 or row[2] < 2):
                row = next_row(word, row, depth, other[depth])
                depth += 1
                rows.append(row)
            if row[0] < 2 or row[1] < 2 or row[2] < 2:
                k = m - size + 1  # the cell of the whole word in the last row
                if 0 <= k <= 2 and row[k] == 1:
                    found.append(at)
                at += 1
            else:  # nothing with these ``depth`` code points can be near: on to the first word that shares fewer
                at += 1
                while at < n and lcp[at] >= depth:
                    at = self.shorter[at]
            if at < n:
                if lcp[at] < shared:
                    break
                del rows[lcp[at] - shared + 1:]
        return found


def within_one(word: str, prefix: str) -> bool:
    """Whether some word that begins with ``prefix`` can be within one edit of ``word``."""
    row = START
    for depth, c in enumerate(prefix):
        row = next_row(word, row, depth, c)
        if min(row) > 1:
            return False
    return True


# ---- distributed search ---------------------------------------------------------------------------

def shared_part(word: str, backwards: bool) -> int:
    """How many code points a near word has in common with ``word`` at the list's end if the edit lies beyond them."""
    half = len(word) // 2
    return len(word) - half if backwards else half


def route(word: str, shared: int, firsts: list[str], lasts: list[str]) -> list[int]:
    """The blocks that words with the first ``shared`` code points of ``word`` lie in, but for those that can't be near."""
    prefix = word[:shared]
    b = bisect_left(lasts, prefix)
    out = []
    while b < len(firsts) and (firsts[b] < prefix or firsts[b].startswith(prefix)):
        if lasts[b] >= prefix and within_one(word, firsts[b][:common_prefix(firsts[b], lasts[b])]):
            out.append(b)
        b += 1
    return out


def sorted_blocks(words: DataFrame, block_words: int) -> DataFrame:
    """(word, n, key, block): range partitions by ``key``; written with the number of their partition."""
    blocks = min(DIRECTORY_ROWS, max(1, words.count() // block_words))
    dealt = words.repartitionByRange(blocks, "key").withColumn("block", F.spark_partition_id())
    return materialize(dealt, "spelling-blocks")


def near_in_list(words: DataFrame, backwards: bool, block_words: int, visits: int) -> DataFrame:
    """(word, n, near, near_n) of the near pairs that share the list's half, in both directions."""
    key = F.reverse("word") if backwards else F.col("word")
    listed = sorted_blocks(words.select("word", "n", key.alias("key")), block_words)
    directory = listed.groupBy("block").agg(F.min("key").alias("low"), F.max("key").alias("high")).orderBy("low").collect()  # at most DIRECTORY_ROWS
    numbers, firsts, lasts = ([r[c] for r in directory] for c in ("block", "low", "high"))

    def visit(batches):
        for batch in batches:
            rows, to = [], []
            for i, w in enumerate(batch.column("key").to_pylist()):
                for b in route(w, shared_part(w, backwards), firsts, lasts):
                    rows.append(i)
                    to.append(numbers[b])
            got = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([got.column("key"), got.column("n"), pa.array(to, pa.int32())], ["key", "n", "block"])

    visitors = materialize(listed.select("key", "n").mapInArrow(visit, "key string, n long, block int"), "spelling-visits")
    shares = materialize(visitors.groupBy("block").agg(F.ceil(F.count("*") / visits).cast("int").alias("shares")), "spelling-shares")
    asked = visitors.join(shares, "block").select("block", F.pmod(F.xxhash64("key"), F.col("shares")).cast("int").alias("share"), F.lit(1).alias("asks"), "key", "n")
    known = listed.join(shares, "block").select("block", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), F.lit(0).alias("asks"), "key", "n")
    # the rows are small, their search is not: a task for two blocks or shares, on average
    tasks = -(-(shares.agg(F.sum("shares")).first()[0] or 1) // 2)
    both = known.unionByName(asked).repartition(tasks, "block", "share").sortWithinPartitions("block", "share", "asks", "key")

    def search(batches):
        """Rows come by (block, share), the block's words before those that visit it."""
        place, keys, counts, scan = None, [], [], None
        for batch in batches:
            found: dict = {"key": [], "n": [], "near": [], "near_n": []}
            columns = [batch.column(c).to_pylist() for c in ("block", "share", "asks", "key", "n")]
            for block, share, asks, k, n in zip(*columns):
                if place != (block, share):
                    place, keys, counts, scan = (block, share), [], [], None
                if not asks:
                    keys.append(k)
                    counts.append(n)
                    continue
                if scan is None:
                    scan = Scan(keys)
                # a pair that shares the forward half is found in the forward list already
                half = k[-(len(k) // 2):] if backwards else None
                for i in scan.near(k, shared_part(k, backwards)):
                    if backwards and keys[i].endswith(half):
                        continue
                    found["key"].append(k)
                    found["n"].append(n)
                    found["near"].append(keys[i])
                    found["near_n"].append(counts[i])
            yield pa.RecordBatch.from_pydict(found, pa.schema([("key", pa.string()), ("n", pa.int64()), ("near", pa.string()), ("near_n", pa.int64())]))

    pairs = both.mapInArrow(search, "key string, n long, near string, near_n long")
    plain = lambda c: F.reverse(c) if backwards else F.col(c)
    return pairs.select(plain("key").alias("word"), "n", plain("near").alias("near"), "near_n")


def near_words(words: DataFrame, block_words: int = BLOCK_WORDS, visits: int = VISITS) -> DataFrame:
    """All ordered pairs (word, n, near, near_n) of words that differ by one edit, each once; words: (word, n), distinct."""
    words = materialize(words.select("word", "n"), "spelling-words")
    return near_in_list(words, False, block_words, visits).unionByName(near_in_list(words, True, block_words, visits))


def forms(words: DataFrame, ratio: int = RATIO, block_words: int = BLOCK_WORDS, visits: int = VISITS) -> DataFrame:
    """word, form, root, n, n_near, form_n of each word."""
    words = materialize(words.select("word", "n"), "spelling-vocabulary")
    best = near_words(words, block_words, visits).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    got = words.join(best, "word", "left")
    holds = -F.col("best.less") >= ratio * F.col("n")
    got = got.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(holds, F.col("best.near")).alias("form"), F.when(holds, -F.col("best.less")).alias("form_n"))
    got = materialize(got, "spelling-forms")
    return got.join(roots(got.where("form is not null").select("word", "form")), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def roots(links: DataFrame, rounds: int = 40) -> DataFrame:
    """(word, root) of the words that have a form: each word's pointer doubles until it stands on a word without one."""
    now = materialize(links.select("word", F.col("form").alias("root")), "spelling-roots")
    for _ in range(rounds):
        hop = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        stepped = materialize(now.join(hop, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "spelling-roots")
        if stepped.where("moved").isEmpty():
            return stepped.select("word", "root")
        now = stepped.select("word", "root")
    raise RuntimeError(f"forms did not end in {rounds} rounds: they are in a circle")


#: The same rows in DuckDB's SQL: crc32 bit by bit (3988292384 is its polynomial), near words by the words without one of their code points.
ORACLE = r"""
WITH RECURSIVE runs AS MATERIALIZED (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
    FROM documents) GROUP BY ALL),
hashed AS MATERIALIZED (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda crc, b:
    list_reduce(list_prepend(xor(crc, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
      lambda x, z: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::BIGINT) ELSE x // 2 END)), 4294967295::BIGINT) AS h
  FROM (SELECT run, n, flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''), lambda c:
    CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [(192 + unicode(c) // 64)::BIGINT, (128 + unicode(c) % 64)::BIGINT] END)) AS bytes FROM runs)),
words AS MATERIALIZED (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT n, CASE WHEN h % 199 = 0 THEN left(run, (h % length(run))::INTEGER) || substring(run, (h % length(run))::INTEGER + 2) ELSE run END AS word FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
gaps AS MATERIALIZED (
  SELECT word, n, i, left(word, i - 1) || substring(word, i + 1) AS rest FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS MATERIALIZED (
  SELECT DISTINCT a.word, b.word AS near, b.n AS near_n FROM gaps a JOIN gaps b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT DISTINCT a.word, b.word, b.n FROM gaps a JOIN words b ON a.rest = b.word
  UNION SELECT DISTINCT b.word, a.word, a.n FROM gaps a JOIN words b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, min((-near_n, near)) AS b FROM near GROUP BY word),
formed AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN -b.b[1] >= 5 * w.n THEN b.b[2] END AS form, CASE WHEN -b.b[1] >= 5 * w.n THEN -b.b[1] END AS form_n
  FROM words w LEFT JOIN best b USING (word)),
followed AS (
  SELECT word, word AS root, 0 AS step FROM formed
  UNION ALL SELECT f.word, g.form, f.step + 1 FROM followed f JOIN formed g ON f.root = g.word WHERE g.form IS NOT NULL),
ends AS (SELECT word, arg_max(root, step) AS root FROM followed GROUP BY word)
SELECT f.word, f.form, e.root, f.n, f.n_near, f.form_n FROM formed f JOIN ends e USING (word)
"""
