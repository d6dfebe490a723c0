"""Toxicity by noisy-channel deobfuscation (operator 2).

A character language model (trigrams over folded letters, counted over all documents) and a channel (look-alike digits, signs
and letters, letters spaced or punctuated apart, letters repeated, words split) make a lattice of readings for each suspicious stretch
of a text: words with signs among their letters, runs of single letters or signs, words with accented, look-alike or doubled letters, and
neighbours of short pieces that may be one word. A gap is read as nothing or as the end of a word. Viterbi decoding picks the
likeliest reading. The words of the text and of its restored stretches are then scored by a logistic classifier over words and word
beginnings, learned from a bounded sample of labelled rows. Split words are tried where their pieces together have a feature that the
classifier knows; others couldn't change a score.

Defined cases: a null text scores like an empty one, at the classifier's constant; texts are scored one by one, so
repeated rows and ties get equal scores; a null doc_id is held out and never learned from; of rows that share a doc_id one is
learned from, the one of the least features, and clashing labels of one doc_id count as toxic; a very long text is read whole, in time in
proportion to its length; an empty table gives no rows; extra columns are ignored; without labels of both classes every score is the
share of label 1 (0 without any).
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltbed.llm.common import materialize, private, slices

# Letters that signs are read as, accented letters and Cyrillic look-alikes by their base letter.
LEET = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l"}
FOLDED = {"a": "àáâãäåа", "c": "çс", "e": "èéêëе", "i": "ìíîïі", "n": "ñ", "o": "òóôõöøо", "u": "ùúûü", "y": "ýÿу", "s": "ß", "p": "р", "x": "х"}
FOLD = str.maketrans({c: base for base, cs in FOLDED.items() for c in cs})
GAPS = " .-_*~'"

LETTER = r"[^\W\d_]"
SIGN = r"[0-9@$!|+(€£]"
WORD = re.compile(rf"{LETTER}+")
GAP = r"[ .*~_'-]{1,3}"
#: Letters with signs between or before them; single letters and signs apart.
SUSPECT = re.compile(rf"(?<![\w@$!|+(€£])(?:(?:{LETTER}++(?:{SIGN}|[*._~'-](?={LETTER}|{SIGN}))|{SIGN}++{LETTER})(?:{LETTER}|{SIGN}|[*._~'-](?={LETTER}|{SIGN}))*+"
                     rf"|(?:{LETTER}{GAP}(?:{LETTER}|{SIGN})|{SIGN}{GAP}{LETTER})(?:{GAP}(?:{LETTER}|{SIGN})){{2,}}(?!\w))")
APART = re.compile(rf"(?:{LETTER}|{SIGN}){GAP}")  # how a stretch of single letters and signs begins
SPACING = re.compile(r"[ .*~_'-]+")
DOUBLED = re.compile(r"(.)\1")
RUN = re.compile(r"(.)\1+")
STRETCHED = re.compile(r"(?:([a-z])\1+){3,}")
PIECE = 3  # letters of a short piece, at most

SYMBOLS = 27  # 0: between words, 1..26: letters
BREAK = 27  # a gap that ends a word
_CLASS = np.zeros(256, np.int64)
for _c in range(256):
    _s = chr(_c).lower().translate(FOLD)
    if len(_s) == 1 and "a" <= _s <= "z":
        _CLASS[_c] = ord(_s) - 96


def count_trigrams(docs: DataFrame) -> np.ndarray:
    """Counts of folded character trigrams over the whole texts of all documents, shaped 27 x 27 x 27."""

    def run(batches):
        total = np.zeros(SYMBOLS**3, np.int64)
        for batch in batches:
            for part in slices(batch):
                raw = "  ".join(t or "" for t in part.column(0).to_pylist()).encode("latin-1", "replace")
                x = _CLASS[np.frombuffer(b"  " + raw + b"  ", np.uint8)]
                total += np.bincount(x[:-2] * SYMBOLS**2 + x[1:-1] * SYMBOLS + x[2:], minlength=SYMBOLS**3)
        seen = np.flatnonzero(total)
        yield pa.record_batch([pa.array(seen), pa.array(total[seen])], names=["code", "n"])

    rows = docs.select(F.col("text").alias(private("text"))).mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(SYMBOLS**3)
    for r in rows:  # at most 27^3
        out[r.code] = r.n
    return out.reshape(SYMBOLS, SYMBOLS, SYMBOLS)


@dataclass
class Channel:
    """The language model's costs, and Viterbi decoding with the costs of the channel."""

    cost: np.ndarray

    @classmethod
    def train(cls, counts: np.ndarray, smooth: float = 0.5) -> "Channel":
        p = counts + smooth * (counts.sum(axis=0, keepdims=True) + 1) / (counts.sum() + 1)
        return cls(-np.log(p / p.sum(axis=2, keepdims=True)))

    def readings(self, text: str) -> list[list[tuple[int, float]]]:
        """For each character the letters it may stand for (0: none, BREAK: the end of a word) and the cost of each.

        A gap wider than the narrowest is likelier the end of a word.
        """
        out = []
        gaps = [m.span() for m in SPACING.finditer(text)]
        narrow = min((b - a for a, b in gaps), default=0)
        wide = {a for a, b in gaps if b - a > narrow}
        drawn = {i for m in STRETCHED.finditer(text) for i in range(*m.span())}  # every letter is repeated
        for i, c in enumerate(text):
            if "a" <= c <= "z":
                same = i > 0 and text[i - 1] == c
                often = same and (i in drawn or text[i - 2:i - 1] == c or text[i + 1:i + 2] == c)
                out.append([(ord(c) - 96, 0.0), *([(0, 0.2 if often else 4.0)] if same else [])])
            elif c in LEET:
                out.append([*((ord(x) - 96, 1.0) for x in LEET[c]), (0, 9.0 if text[i + 1:] else 1.0)])  # at the end often a plain sign
            elif c in GAPS:
                out.append([(0, 0.5), (BREAK, -2.0 if i in wide else 2.0)])
            else:
                out.append([(0, 2.0)])
        return out

    def decode(self, text: str, end: float = 0.0) -> str:
        """The likeliest letters behind a stretch of text; words are parted by spaces. ``end`` is added to the cost of a word's end."""
        best = {(0, 0): (0.0, None)}  # the last two letters: cost, and the path as linked pairs
        for options in self.readings(text.lower().translate(FOLD)):
            following: dict = {}
            for (a, b), (spent, path) in best.items():
                for letter, cost in options:
                    if letter == BREAK:
                        if not b:
                            continue
                        state, total, longer = (b, 0), spent + cost + end + self.cost[a, b, 0], (path, 0)
                    elif letter:
                        state, total, longer = (b, letter), spent + cost + self.cost[a, b, letter], (path, letter)
                    else:
                        state, total, longer = (a, b), spent + cost, path
                    if state not in following or total < following[state][0]:
                        following[state] = (total, longer)
            best = following
        _, path = min(((spent + (self.cost[a, b, 0] if b else 0.0), path) for (a, b), (spent, path) in best.items()), key=lambda x: x[0])
        out = []
        while path:
            path, letter = path
            out.append(chr(96 + letter) if letter else " ")
        return "".join(reversed(out)).strip()


class Reader:
    """Words of restored texts; decoded stretches and the forms of words are remembered, up to ``most`` of each."""

    def __init__(self, channel: Channel, most: int = 100_000):
        self.channel, self.most, self.known, self.seen = channel, most, {}, {}

    def readings(self, stretch: str) -> list[tuple[str, float]]:
        """What is decoded of a stretch, with the cost of a word's end: letters apart are read with dear, usual and cheap ends, and without
        the first, which may be a word of one letter."""
        if not (m := APART.match(stretch)):
            return [(stretch, 0.0)]
        return [(stretch, 50.0), (stretch, 0.0), (stretch, -5.0), (stretch[m.end():], 0.0), (stretch[m.end():], 50.0)]

    def decoded(self, stretch: str) -> tuple[str, ...]:
        words = self.known.get(stretch)
        if words is None:
            words = tuple(w for text, end in self.readings(stretch) for w in self.channel.decode(text, end).split())
            if len(stretch) <= 64:
                if len(self.known) >= self.most:
                    self.known.clear()
                self.known[stretch] = words
        return words

    def restored(self, text: str) -> list[str]:
        return [w for m in SUSPECT.finditer(text) for w in self.decoded(m.group())]

    def forms(self, word: str) -> set[str]:
        """A word of letters as it stands, folded, and without its repetitions."""
        plain = word if word.isascii() else word.translate(FOLD)
        return {word, plain, *(self.channel.decode(plain).split() if DOUBLED.search(plain) else ())}

    def words(self, text: str | None) -> set[str]:
        """All words and restored words of a text."""
        text = (text or "").lower()
        out = set(self.restored(text))
        for word in set(WORD.findall(text)):
            found = self.seen.get(word)
            if found is None:
                if len(self.seen) >= self.most:
                    self.seen.clear()
                found = self.seen[word] = self.forms(word)
            out |= found
        return out


def restore(text: str, channel: Channel) -> str:
    """The text with its suspicious stretches, and words that hold a letter thrice or are drawn out, replaced by their decoded letters."""
    text = SUSPECT.sub(lambda m: channel.decode(m.group()) or m.group(), text.lower())
    return WORD.sub(lambda m: channel.decode(m.group()) if re.search(r"(.)\1\1", m.group()) or STRETCHED.search(m.group()) or not m.group().isascii() else m.group(), text)


BEGINNINGS = (4, 5, 6, 7)


def features(words: set[str]) -> set[str]:
    """Words, and beginnings of longer words (marked with a star)."""
    out = set(words)
    for w in words:
        for n in BEGINNINGS:
            if len(w) > n:
                out.add(w[:n] + "*")
    return out


@dataclass
class Classifier:
    weights: dict[str, float]
    constant: float

    def hits(self, words: set[str]) -> set[str]:
        return {f for f in features(words) if f in self.weights}

    def score(self, words: set[str]) -> float:
        return self.of_hits(self.hits(words))

    def of_hits(self, hits: set[str]) -> float:
        z = self.constant + math.fsum(self.weights[x] for x in hits)  # the same in any order
        return float(1 / (1 + np.exp(-min(30.0, max(-30.0, z)))))


def collapse(word: str) -> str:
    """Each letter once where it is repeated."""
    return RUN.sub(r"\1", word)


class Scorer:
    """Scores of texts. What a word has of the classifier's features is remembered, for up to ``most`` words."""

    def __init__(self, channel: Channel, classifier: Classifier, most: int = 200_000):
        self.reader, self.classifier, self.most = Reader(channel), classifier, most
        self.seen: dict[str, frozenset] = {}
        stems = [f.rstrip("*") for f in classifier.weights]
        self.starts = {f[:4] for f in stems}  # a word with another beginning has none of the features
        self.collapsed = {collapse(f)[:3] for f in stems}

    def of_word(self, word: str) -> frozenset:
        """The features of a word's forms; repetitions are decoded where some reading of them could have one."""
        plain = word if word.isascii() else word.translate(FOLD)
        forms = {word, plain}
        if DOUBLED.search(plain) and collapse(plain)[:3] in self.collapsed:
            forms = self.reader.forms(word)
        hits = frozenset(self.classifier.hits({w for w in forms if w[:4] in self.starts}))
        if len(self.seen) >= self.most:
            self.seen.clear()
        self.seen[word] = hits
        return hits

    def split_words(self, words: list[str]) -> set[str]:
        """Restored words behind neighbours of which one is a short piece, if their letters together have a known feature."""
        out: set[str] = set()
        starts = self.starts
        before = ""
        for word in words:
            if before and (len(word) <= PIECE or len(before) <= PIECE) and (before + word)[:4] in starts:
                if self.classifier.hits({before + word}):
                    out.update(self.reader.decoded(f"{before} {word}"))
            before = word
        return out

    def hits(self, text: str | None) -> set[str]:
        text = (text or "").lower()
        words = WORD.findall(text)
        seen, out = self.seen, set()
        for word in set(words):
            found = seen.get(word)
            if found is None:
                found = self.of_word(word)
            if found:
                out |= found
        return out | self.classifier.hits({*self.reader.restored(text), *self.split_words(words)})

    def score(self, text: str | None) -> float:
        return self.classifier.of_hits(self.hits(text))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, channel: Channel, sample: int = 12_000, most: int = 600, least: int = 4) -> Classifier:
    """The classifier from at most ``sample`` labelled rows that are not held out, chosen by a hash of the id.

    Features that occur in ``least`` toxic rows and there four times as often are ranked by the log likelihood ratio, and the best
    ``most`` get weights by a logistic regression with a ridge.
    """
    chosen = (labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id"))).select("doc_id", "toxic")
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "toxic", "text")  # `sample` small rows

    def run(batches):
        reader = Reader(channel)
        for batch in batches:
            for part in slices(batch):
                found = [sorted(features(reader.words(t))) for t in part.column(2).to_pylist()]
                yield pa.record_batch([part.column(0).cast(pa.int64()), part.column(1).cast(pa.int32()), pa.array(found, pa.list_(pa.string()))], names=["doc_id", "toxic", "f"])

    read = rows.mapInArrow(run, "doc_id long, toxic int, f array<string>")
    read = materialize(read.groupBy("doc_id", "toxic").agg(F.min("f").alias("f")), "toxic")  # a row for each chosen id
    tally = {r.toxic: r.n for r in read.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    pos, neg = tally.get(1, 0), tally.get(0, 0)
    if not pos or not neg:
        share = min(1 - 1e-9, max(1e-9, pos / max(1, pos + neg)))
        return Classifier({}, float(np.log(share / (1 - share))))
    each = read.select("toxic", F.explode("f").alias("f")).groupBy("f").agg(F.sum("toxic").alias("a"), F.count("*").alias("n"))
    a, b = F.col("a"), F.col("n") - F.col("a")
    rise = ((a + 0.5) / (pos + 1)) / ((b + 0.5) / (neg + 1))
    gain = a * F.log((a + 0.5) / (F.col("n") + 1) / (pos / (pos + neg))) + b * F.log((b + 0.5) / (F.col("n") + 1) / (neg / (pos + neg)))
    top = each.where((a >= least) & (rise >= 4)).orderBy(F.desc(gain), "f").limit(most).collect()
    names = [r.f for r in top]
    used = read.select("toxic", F.array_intersect("f", F.lit(names).cast("array<string>")).alias("f")).collect()
    at = {f: i for i, f in enumerate(names)}
    x = np.zeros((len(used), len(names) + 1))
    x[:, -1] = 1
    for i, r in enumerate(used):
        x[i, [at[f] for f in r.f]] = 1
    y = np.array([r.toxic for r in used], float)
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], 0.3)
    ridge[-1] = 1e-6
    for _ in range(12):  # Newton steps
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = np.maximum(p * (1 - p), 1e-4)
        w -= np.linalg.solve((x.T * h) @ x + np.diag(ridge), x.T @ (p - y) + ridge * w)
    return Classifier({f: float(v) for f, v in zip(names, w, strict=False)}, float(w[-1]))


def score(docs: DataFrame, channel: Channel, classifier: Classifier) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""

    def run(batches):
        scorer = Scorer(channel, classifier)
        for batch in batches:
            for part in slices(batch):
                s = np.array([scorer.score(t) for t in part.column(2).to_pylist()], float)
                yield pa.record_batch([part.column(0), part.column(1), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")), F.col("text").alias(private("text")))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def judge(docs: DataFrame, labels: DataFrame, sample: int = 12_000) -> DataFrame:
    channel = Channel.train(count_trigrams(docs))
    return score(docs, channel, train(docs, labels, channel, sample))
