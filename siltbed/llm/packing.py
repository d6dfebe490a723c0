"""Packing along a space-filling curve (operator 3).

A document's tokens are counted in hashed cells, and the counts projected to three dimensions; the Hilbert key of that point
orders the documents, so that alike ones are neighbours. The token stream along the curve is cut into sequences of
``length`` tokens; what is left at the end is cut into powers of two, so nothing is padded. A global running total
over range buckets of the key gives each document its place; token bytes are moved once, to the rows of places.

Defined cases: a null text is an empty one, of the end token alone; equal keys are ordered by a hash of the id, so that
copies spread over buckets, and repeated rows follow each other in any order; a null doc_id stays null;
an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltbed.llm.common import materialize, private, running_total, slices

CELLS, DIMS, BITS, TIES = 1024, 3, 14, 20
_WORKER: dict[str, "WordCache"] = {}


class _Numbers(dict):
    """Numbers words as they are first asked for, and lists those not yet encoded."""

    def __init__(self):
        super().__init__({b"": 0})
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self.new.append(word)
        self[word] = n = len(self)
        return n


class WordCache:
    """Token ids word by word: the tokenizer drops white space, so a text's ids are those of its words in turn.

    A word of letters and one full stop or comma after it are encoded apart, as the tokenizer's own pattern splits them.
    ``most`` words are kept; then it starts afresh. Word 0 is the end token.
    """

    def __init__(self, path: str, end: int, most: int = 500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; more threads would only hold more memory
        from tokenizers import Tokenizer

        self.tokenizer, self.end, self.most = Tokenizer.from_file(path), end, most
        special = [(i, t.content) for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special and not (t.lstrip or t.rstrip)]
        self.mark = special[-1] if special else None  # put between words that are encoded together
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        names = self.tokenizer.get_vocab(with_added_tokens=False)
        self.last = np.zeros(1 + max([end, *self.tokenizer.get_vocab().values()]), bool)  # ids that close a word of letters
        if suffix:
            self.last[[i for t, i in names.items() if t.endswith(suffix)]] = True
        self.points = {c: self._ids([c.decode()])[0] for c in (b".", b",")}
        self.clear()

    def clear(self) -> None:
        self.index = _Numbers()
        self.flat, self.start, self.size = np.array([self.end], np.int32), np.array([0]), np.array([1])

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.int32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _marked(self, words: list[str]) -> list[np.ndarray]:
        """Ids of any words, a special token between them; words that may hold one are encoded alone."""
        alone = [i for i, w in enumerate(words) if not self.mark or "<|" in w]
        rest = sorted({*range(len(words))} - {*alone})
        out: list = [None] * len(words)
        groups = [rest[at:at + 200] for at in range(0, len(rest), 200)]
        for some, ids in zip(groups, self._ids([self.mark[1].join(words[i] for i in g) for g in groups]), strict=True):
            for i, part in zip(some, np.split(ids, np.flatnonzero(ids == self.mark[0])), strict=True):
                out[i] = part[part != self.mark[0]]
        for i, ids in zip(alone, self._ids([words[i] for i in alone]), strict=True):
            out[i] = ids
        return out

    def _letters(self, words: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(ids, how many each word has) of groups of words of letters, between spaces; a word ends where an id closes it."""
        out = []
        groups = [words[at:at + 500] for at in range(0, len(words), 500)]
        for some, ids in zip(groups, self._ids([" ".join(g) for g in groups]), strict=True):
            ends = np.flatnonzero(self.last[ids])
            if len(ends) != len(some) or ends[-1] != len(ids) - 1:  # a letter that lower case takes apart
                each = self._marked(some)
                ids, ends = np.concatenate(each), np.cumsum([len(x) for x in each]) - 1
            out.append((ids, np.diff(ends, prepend=-1)))
        return out

    def learn(self) -> None:
        words, self.index.new = self.index.new, []
        stems: dict[str, int] = {}
        odd: list[int] = []
        stem, point = np.full(len(words), -1), np.zeros(len(words), np.int32)
        for i, w in enumerate(words):
            text = w.decode("utf-8")
            if text.isalpha():
                stem[i] = stems.setdefault(text.lower() if text.isascii() else text, len(stems))
            elif text[-1] in ".," and text[:-1].lower().isalpha() and len(self.points[w[-1:]]) == 1:
                text = text[:-1]
                stem[i] = stems.setdefault(text.lower() if text.isascii() else text, len(stems))
                point[i] = self.points[w[-1:]][0]
            else:
                odd.append(i)
        got = self._letters(list(stems))
        others = self._marked([words[i].decode("utf-8") for i in odd])
        flat = np.concatenate([np.zeros(0, np.int32), *(ids for ids, _ in got), *others])
        count = np.concatenate([np.zeros(0, np.int64), *(n for _, n in got), np.array([len(x) for x in others], np.int64)])
        first = np.cumsum(count) - count
        stem[odd] = len(stems) + np.arange(len(odd))
        sizes = count[stem] + (point > 0)
        ends = np.cumsum(sizes)
        new = np.zeros(ends[-1] if len(ends) else 0, np.int32)
        own = count[stem]
        inner = np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
        new[np.repeat(ends - sizes, own) + inner] = flat[np.repeat(first[stem], own) + inner]
        new[ends[point > 0] - 1] = point[point > 0]
        self.start = np.concatenate([self.start, len(self.flat) + ends - sizes])
        self.size = np.concatenate([self.size, sizes])
        self.flat = np.concatenate([self.flat, new])

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, each text's closed by the end token, and how many each has."""
        if len(self.index) > self.most:
            self.clear()
        find = self.index.__getitem__
        at: list[int] = []
        last = []
        for t in texts:
            at += map(find, (t or "").encode("utf-8").split())
            last.append(len(at))
            at.append(0)
        if self.index.new:
            self.learn()
        at = np.array(at, np.int64)
        sizes = self.size[at]
        ends = np.cumsum(sizes)
        ids = self.flat[np.repeat(self.start[at] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)]
        return ids, np.diff(ends[last], prepend=0)


def _cache(path: str, end: int) -> WordCache:
    key = f"{path}|{end}"
    if key not in _WORKER:
        _WORKER[key] = WordCache(path, end)
    return _WORKER[key]


def projection() -> np.ndarray:
    """The fixed random directions of the cells."""
    return np.random.default_rng(20).standard_normal((CELLS, DIMS))


def place(ids: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """The point of a document: the damped counts of its hashed ids, scaled to length 1 and projected."""
    cells = np.bincount((ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(54)).astype(np.int64), minlength=CELLS)
    v = np.sqrt(cells)
    return v @ directions / max(1e-9, np.sqrt(cells.sum()))


def hilbert(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Hilbert keys of integer points (rows) with ``bits`` bits a coordinate: Skilling's transposed form, interleaved."""
    x = points.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(dims):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    gray = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        gray = np.where((x[dims - 1] & q) != 0, gray ^ (q - 1), gray)
        q >>= 1
    x ^= gray
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def tokenized(docs: DataFrame, tokenizer: str, end: int = 1) -> DataFrame:
    """(doc_id, ids, n, curve): little-endian 16-bit ids (32-bit for more than 65,536 of them), their number and the Hilbert key."""

    def run(batches):
        cache = _cache(tokenizer, end)
        kind = "<u2" if max(end, cache.tokenizer.get_vocab_size()) < 65_536 else "<u4"
        directions = projection()
        for batch in batches:
            for part in slices(batch):
                ids, sizes = cache.encode(part.column(1).to_pylist())
                if not len(sizes):
                    continue
                each = np.split(ids, np.cumsum(sizes)[:-1])
                points = np.array([place(x[:-1], directions) for x in each])
                grid = np.clip((np.tanh(points / 2) + 1) / 2 * 2**BITS, 0, 2**BITS - 1)
                yield pa.record_batch([part.column(0).cast(pa.int64()), pa.array([x.astype(kind).tobytes() for x in each], pa.binary()),
                                       pa.array(sizes.astype(np.int64)), pa.array(hilbert(grid))], names=["doc_id", "ids", "n", "curve"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").alias(private("text"))).mapInArrow(run, "doc_id long, ids binary, n long, curve long")


def tail(total: int, length: int) -> list[int]:
    """Where the sequences of the last, incomplete stretch begin: powers of two, the largest first."""
    at, out = total - total % length, []
    while at < total:
        out.append(at)
        at += 1 << ((total - at).bit_length() - 1)
    return out


def pack(docs: DataFrame, tokenizer: str, length: int = 2048, end: int = 1) -> DataFrame:
    """The pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, curve."""
    stored = materialize(tokenized(docs, tokenizer, end).withColumn("uid", F.monotonically_increasing_id()), "tokens")
    spread = F.xxhash64(F.coalesce("doc_id", "uid")).bitwiseAND(2**TIES - 1)
    keys = stored.select("uid", "n", F.shiftleft("curve", TIES).bitwiseOR(spread).alias("at"), F.coalesce("doc_id", "uid").alias("id"))
    placed = running_total(keys, "n", ["at", "id", "uid"]).select("uid", "before")
    total = stored.agg(F.sum("n")).first()[0] or 0
    ends = np.array(tail(total, length), np.int64)
    whole = total - total % length

    def cut(batches):
        for batch in batches:
            for part in slices(batch):
                rows = []
                for doc, ids, n, curve, g in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    raw = np.frombuffer(ids, "<u2" if len(ids) == 2 * n else "<u4").astype("<u4")
                    at = 0
                    while at < n:
                        p = g + at
                        if p < whole:
                            sequence, offset, room = p // length, p % length, length - p % length
                        else:
                            k = int(np.searchsorted(ends, p, side="right")) - 1
                            sequence, offset = whole // length + k, int(p - ends[k])
                            room = int((ends[k + 1] if k + 1 < len(ends) else total) - p)
                        size = min(room, n - at)
                        rows.append((doc, at, size, zlib.crc32(raw[at:at + size].tobytes()), n, sequence, offset, curve))
                        at += size
                if rows:
                    yield pa.record_batch([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], names=names)

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "curve"]
    moved = stored.join(placed, "uid").select("doc_id", "ids", "n", "curve", "before")
    return moved.mapInArrow(cut, ", ".join(f"{x} long" for x in names))
