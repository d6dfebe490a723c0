"""Quality rules: document statistics and gradient-boosted trees (operator 9).

Statistics are counted over whole texts in Arrow batches. A classifier of boosted trees is fitted on
a bounded sample of labelled rows and flattened into numpy node arrays, which every task scores
in one vectorised walk. Chosen features are monotonic: a document never gains by more of them.

Defined cases: a null or empty text has zero in every statistic and fails the base rules; rows are judged
one by one, so ties and repeated rows get equal verdicts; an empty table gives no rows; extra columns are
ignored by :func:`judge` and kept by :func:`keep_good`; without labels of both classes the
base rules alone decide.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltbed.llm.common import private, slices

SPACES = b" \t\n\r\x0b\x0c"
SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(65, 91))
LOWER = bytes(range(97, 123))
DIGITS = b"0123456789"
ENDS = b".!?"

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = ["log_words", "word_length", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "digit_share",
            "end_share", "unique_share", "line_length", "longest_word", "bar_share", "top_word_share"]
#: -1: the score never rises with the feature.
MONOTONE = {"symbol_share": -1, "dup_line_share": -1, "repeat_share": -1}


def repeated_words(words: list[bytes], width: int = 5) -> int:
    """How many words lie in windows of ``width`` words that the text has twice or more."""
    n = len(words)
    if n <= width:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    if len(number) == n:
        return 0
    code, size = ids, len(number)
    for k in range(1, width):  # exact codes of 2, 3, ... words
        code = code[:-1] * size + ids[k:]
        if k < width - 1:
            code = np.unique(code, return_inverse=True)[1]
    _, back, count = np.unique(code, return_inverse=True, return_counts=True)
    twice = np.flatnonzero(count[back] > 1)
    if not len(twice):
        return 0
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, twice, 1)
    np.add.at(steps, twice + width, -1)
    return int((np.cumsum(steps[:-1]) > 0).sum())


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """The counts of the contract and the features of the classifier, over the whole text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    without = lambda chars: len(raw) - len(raw.translate(None, chars))
    words = raw.split()
    n = len(words)
    chars = len(text or "") - without(SPACES)
    symbols = without(SYMBOLS)
    lines = [x for x in raw.split(b"\n") if x.strip(SPACES)]
    dup = len(lines) - len(set(lines))
    repeats = repeated_words(words)
    tally: dict[bytes, int] = {}
    for w in words:
        tally[w] = tally.get(w, 0) + 1
    some, letters = max(1, n), max(1, without(UPPER) + without(LOWER))
    size = max(1, chars)
    features = [np.log1p(n), chars / some, symbols / size, dup / max(1, len(lines)), repeats / some,
                without(UPPER) / letters, without(DIGITS) / size, without(ENDS) / some, len(tally) / some,
                n / max(1, len(lines)), max(map(len, tally), default=0), raw.count(b"|") / some,
                max(tally.values(), default=0) / some]
    return [n, chars, symbols, dup, repeats], features


@dataclass
class Trees:
    """All trees as flat node arrays; a leaf points to itself. ``roots``: each tree's first node."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float
    depth: int

    def raw(self, x: np.ndarray) -> np.ndarray:
        if not len(self.roots):
            return np.full(len(x), self.base)
        node = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            node = np.where(x[rows, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
        return self.base + self.value[node].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.15, bins: int = 64,
        least: float = 3.0, ridge: float = 1.0, monotone: dict[int, int] | None = None) -> Trees:
    """Boosted trees for 0/1 labels, by histograms of gradients over quantile bins.

    ``monotone`` maps a feature to +1 or -1. A split on it must order its children that way, and the
    middle of their values bounds everything below either child, so the whole score is monotonic.
    """
    monotone = monotone or {}
    n, m = x.shape
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(m)]
    code = np.stack([np.searchsorted(cuts[j], x[:, j], side="left") for j in range(m)], axis=1)
    out = {k: [] for k in ("feature", "threshold", "left", "right", "value", "roots")}
    raw = np.full(n, base)

    def add(value: float) -> int:
        at = len(out["value"])
        for k, v in (("feature", 0), ("threshold", np.inf), ("left", at), ("right", at), ("value", value)):
            out[k].append(v)
        return at

    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        leaf = lambda rows, lo, hi: float(np.clip(-g[rows].sum() / (h[rows].sum() + ridge), lo, hi))
        root = add(0.0)
        out["roots"].append(root)
        open_nodes = [(root, np.arange(n), -np.inf, np.inf)]
        for level in range(depth + 1):
            following = []
            for at, rows, lo, hi in open_nodes:
                out["value"][at] = rate * leaf(rows, lo, hi)
                raw_gain, best = 1e-6, None
                if level < depth and len(rows) >= 2 * least:
                    gs, hs = g[rows].sum(), h[rows].sum()
                    for j in range(m):
                        k = len(cuts[j])
                        if not k:
                            continue
                        gl = np.cumsum(np.bincount(code[rows, j], g[rows], k + 1))[:-1]
                        hl = np.cumsum(np.bincount(code[rows, j], h[rows], k + 1))[:-1]
                        nl = np.cumsum(np.bincount(code[rows, j], minlength=k + 1))[:-1]
                        vl, vr = -gl / (hl + ridge), -(gs - gl) / (hs - hl + ridge)
                        gain = gl**2 / (hl + ridge) + (gs - gl) ** 2 / (hs - hl + ridge) - gs**2 / (hs + ridge)
                        fine = (nl >= least) & (len(rows) - nl >= least)
                        if monotone.get(j):
                            fine &= monotone[j] * (np.clip(vr, lo, hi) - np.clip(vl, lo, hi)) >= 0
                        gain = np.where(fine, gain, -np.inf)
                        c = int(np.argmax(gain))
                        if gain[c] > raw_gain:
                            raw_gain, best = gain[c], (j, c)
                if best is None:
                    continue
                j, c = best
                low = code[rows, j] <= c
                a, b = rows[low], rows[~low]
                bounds = [(lo, hi), (lo, hi)]
                if monotone.get(j):
                    mid = (leaf(a, lo, hi) + leaf(b, lo, hi)) / 2
                    bounds = [(lo, mid), (mid, hi)] if monotone[j] > 0 else [(mid, hi), (lo, mid)]
                out["feature"][at], out["threshold"][at] = j, cuts[j][c]
                out["left"][at], out["right"][at] = add(0.0), add(0.0)
                following += [(out["left"][at], a, *bounds[0]), (out["right"][at], b, *bounds[1])]
            open_nodes = following
        flat = Trees(*(np.array(out[k]) for k in ("feature", "threshold", "left", "right", "value")),
                     np.array(out["roots"][-1:]), 0.0, depth)
        raw = raw + flat.raw(x)
    return Trees(np.array(out["feature"]), np.array(out["threshold"]), np.array(out["left"]), np.array(out["right"]),
                 np.array(out["value"]), np.array(out["roots"]), base, depth)


def labelled_features(docs: DataFrame, labels: DataFrame, sample: int) -> tuple[np.ndarray, np.ndarray]:
    """Features and quality labels of at most ``sample`` labelled rows, chosen by a hash of the id."""
    chosen = (labels.where("doc_id is not null and quality is not null").select("doc_id", "quality")
              .dropDuplicates(["doc_id"]).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    rows = (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most `sample` small rows
            .select("quality", "text").mapInArrow(_features, "quality int, x array<double>").limit(2 * sample).collect())
    return np.array([r.x for r in rows]).reshape(-1, len(FEATURES)), np.array([r.quality for r in rows], float)


def _features(batches):
    for batch in batches:
        for part in slices(batch):
            q, t = part.columns
            yield pa.record_batch([q.cast(pa.int32()), pa.array([statistics(x)[1] for x in t.to_pylist()],
                                                               pa.list_(pa.float64()))], names=["quality", "x"])


def train(docs: DataFrame, labels: DataFrame, sample: int = 8_000) -> Trees | None:
    """The classifier, or None where the labels don't have both classes. ``sample`` bounds the rows fitted on."""
    x, y = labelled_features(docs, labels, sample)
    if len(set(y)) < 2:
        return None
    return fit(x, y, monotone={FEATURES.index(k): v for k, v in MONOTONE.items()})


def judge(docs: DataFrame, model: Trees | None, min_words: int = 10, repeat_percent: int = 20,
          threshold: float = 0.5, keep: list[str] | None = None) -> DataFrame:
    """Counts, base verdict, score and final verdict per row; ``keep``: input columns passed on as they are."""
    keep = ["doc_id"] if keep is None else keep
    names = [*keep, *COUNTS, "base_failed", "score", "kept"]

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                got = [statistics(t) for t in part.column(part.num_columns - 1).to_pylist()]
                if not got:
                    continue
                counts = np.array([c for c, _ in got], np.int64)
                failed = (counts[:, 0] < min_words) | (100 * counts[:, 4] > repeat_percent * counts[:, 0])
                score = model.score(np.array([x for _, x in got])) if model else np.ones(len(got))
                yield pa.record_batch([*(part.column(i) for i in range(len(keep))),
                                       *(pa.array(counts[:, i]) for i in range(len(COUNTS))), pa.array(failed),
                                       pa.array(score), pa.array(~failed & (score >= threshold))], names=names)

    kinds = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema),
                       *(f"{c} long" for c in COUNTS), "base_failed boolean, score double, kept boolean"])
    return docs.select(*keep, F.col("text").alias(private("text"))).mapInArrow(run, kinds)


def keep_good(docs: DataFrame, labels: DataFrame, sample: int = 8_000, **rules) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns."""
    row = private("row")
    packed = docs.select(F.struct("*").alias(row), "text")
    judged = judge(packed, train(docs, labels, sample), keep=[row], **rules)
    return judged.where("kept").select(f"{row}.*")
