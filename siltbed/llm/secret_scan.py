"""Secret scans by a battery of randomness tests (operator 5).

Besides the fixed rules for keys and passwords, every long token of one of the usual alphabets is tested for
randomness: chi-squared uniformity over its alphabet, a runs test about the alphabet's middle and a serial correlation of
neighbours. The three p-values are combined by their Cauchy mean, so that a token which any test rejects scores low.
The alphabet is the smallest that holds the token, whatever its case: hex, single-case letters, base32, base36, else base64.
What score a secret needs is a matter of false discoveries: in each class of length and alphabet the scores of ordinary tokens
(letters of one case pattern, as words have) are the null distribution, and the Benjamini-Hochberg rule over all
candidates of the class sets its threshold. Short classes, whose tests have little power, thereby need more. Letters of
one case are candidates among letters, where words with a capital or joined by signs are the null, and part of the null of the
larger alphabets. Ordinary tokens are taken too, from the score on where they are few among all that are taken.

Texts are read once, in Arrow batches, into candidates with their scores; the histogram of scores (at most
7 x 5 x 2 x 65 rows, whatever the input) gives the thresholds, and the accepted spans are chosen in SQL.

Defined cases: a null text is an empty one; empty texts have no spans; a very long text is read whole, in time in proportion to its
length; of base spans that begin at one place the kind listed first comes first; equal scores are accepted or not together; repeated rows get equal results; a null doc_id stays null; an
empty table gives no rows and thresholds that accept nothing; extra columns are ignored.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltbed.llm.common import materialize, private, slices

KINDS = ["assign", "access", "hex", "random"]
ASSIGN = re.compile(r"""(?i:(?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LONG_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
TOKEN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}")
WORDLIKE = re.compile(r"(?:[A-Z]?[a-z]+|[A-Z]+)(?:[-_/](?:[A-Z]?[a-z]+|[A-Z]+))*")

ALPHABETS = {"hex": "0123456789abcdef", "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
             "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
             "letters": "abcdefghijklmnopqrstuvwxyz", "base36": "abcdefghijklmnopqrstuvwxyz0123456789"}
ENCODINGS = list(ALPHABETS)
SINGLE_CASE = ["letters", "base32", "base36"]  # by size; letters come first in each
LENGTHS = [16, 20, 24, 32, 40, 48, 64]
SCORES = 64
_CODES = {k: {c: i for i, c in enumerate(v)} for k, v in ALPHABETS.items()}
for _name in ("hex", *SINGLE_CASE):
    _CODES[_name] = {x: i for c, i in _CODES[_name].items() for x in (c.lower(), c.upper())}
_CODES["base64"] |= {"-": 62, "_": 63}
#: Logarithms of the shares of a to z in English text, in thousandths.
COMMON = np.log([82, 15, 28, 43, 127, 22, 20, 61, 70, 1.5, 7.7, 40, 24, 67, 75, 19, 1, 60, 63, 91, 28, 9.8, 24, 1.5, 20, 0.7])


def encoding(token: str) -> str | None:
    """The smallest alphabet that holds the token; none for a number, which is no secret of these encodings."""
    body = token.rstrip("=")
    if body.isdigit():
        return None
    one_case = body in (body.lower(), body.upper())
    for name in ["hex", *(SINGLE_CASE if one_case else []), "base64"]:
        if all(c in _CODES[name] for c in body):
            return name
    return None


def _normal_tail(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def _chi2_tail(x: float, df: int) -> float:
    """Wilson and Hilferty's normal form of the upper tail."""
    z = ((x / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))
    return 0.5 * math.erfc(z / math.sqrt(2))


def battery(token: str, name: str) -> list[float]:
    """p-values, under uniform random letters of the alphabet, of uniformity, runs and serial correlation.

    The alphabet is folded to n / 4 equal cells at most, so that chi-squared holds for short tokens too.
    """
    code = np.array([_CODES[name][c] for c in token.rstrip("=")])
    n, size = len(code), len(ALPHABETS[name])
    cells = max(2, min(size, 1 << int(math.log2(max(2, n / 4)))))
    tally = np.bincount(code * cells // size, minlength=cells)
    expected = n / cells
    chi2 = float(((tally - expected) ** 2 / expected).sum())
    out = [_chi2_tail(chi2, cells - 1)]
    if name == "base64":  # character kinds: upper, lower, digit or sign
        kinds = np.bincount((code >= 26).astype(int) + (code >= 52), minlength=3)
        share = np.array([26, 26, 12]) / 64
        out[0] = min(1.0, 2 * min(out[0], _chi2_tail(float(((kinds - n * share) ** 2 / (n * share)).sum()), 2)))
    if name in SINGLE_CASE:  # the share of digits, and whether the letters are those that words have
        letters = code[code < 26]
        more = []
        if size > 26:
            share = np.array([26, size - 26]) / size
            more.append(_chi2_tail(float(((np.array([len(letters), n - len(letters)]) - n * share) ** 2 / (n * share)).sum()), 1))
        if len(letters):
            z = float((COMMON[letters] - COMMON.mean()).sum() / (COMMON.std() * math.sqrt(len(letters))))
            more.append(0.5 * math.erfc(z / math.sqrt(2)))
        out[0] = min(1.0, (1 + len(more)) * min(out[0], *more))
    high = code >= size / 2
    ups = int(high.sum())
    downs = n - ups
    if ups and downs:
        runs = 1 + int((high[1:] != high[:-1]).sum())
        mean = 1 + 2 * ups * downs / n
        var = max(1e-9, (mean - 1) * (mean - 2) / (n - 1))
        out.append(_normal_tail((runs - mean) / math.sqrt(var)))
    else:
        out.append(0.0)
    centred = code - (size - 1) / 2
    spread = (size**2 - 1) / 12
    out.append(_normal_tail(float((centred[1:] * centred[:-1]).sum()) / (spread * math.sqrt(n - 1))))
    return out


def combined(p: list[float]) -> float:
    """Cauchy combination of p-values."""
    t = sum(math.tan((0.5 - min(max(x, 1e-15), 1 - 1e-15)) * math.pi) for x in p) / len(p)
    return min(1.0, max(0.0, 0.5 - math.atan(t) / math.pi))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) by the contract's rules."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), 2, m.end()) for m in LONG_HEX.finditer(text)]  # shorter runs of the same letters fail
    return sorted(out)


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int, int, bool]]:
    """(start, end, encoding number, length class, score 0..64, ordinary) of the long tokens beside the base spans.

    ``base`` is sorted by start. Words are scored in each alphabet whose null distribution they belong to.
    """
    out = []
    ahead, reach = 0, 0  # base spans that begin before the token ends, and the furthest end of these
    for m in TOKEN.finditer(text):
        token = m.group()
        while ahead < len(base) and base[ahead][0] < m.end():
            reach = max(reach, base[ahead][2])
            ahead += 1
        if reach > m.start():
            continue
        name = encoding(token)
        if name is None:
            continue
        ordinary = bool(WORDLIKE.fullmatch(token))
        if name == "letters":
            tries = [(name, token, False), *((x, token, True) for x in ("base32", "base36", "base64") if ordinary)]
        else:
            tries = [(name, token, ordinary)]
            if ordinary and name == "base64":
                tries.append(("letters", re.sub("[-_/]", "", token), True))
        for enc, body, null in tries:
            size = sum(len(body) >= x for x in LENGTHS) - 1
            if size >= 0:
                out.append((m.start(), m.end(), ENCODINGS.index(enc), size, math.ceil(SCORES * combined(battery(body, enc))), null))
    return out


SPAN = pa.struct([("start", pa.int64()), ("k", pa.int32()), ("end", pa.int64())])
CANDIDATE = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("enc", pa.int32()), ("len", pa.int32()), ("score", pa.int32()), ("ordinary", pa.bool_())])


def _scan(batches):
    for batch in batches:
        for part in slices(batch):
            base, more = [], []
            for t in part.column(1).to_pylist():
                b = base_spans(t or "")
                base.append([dict(zip(("start", "k", "end"), x, strict=True)) for x in b])
                more.append([dict(zip(("start", "end", "enc", "len", "score", "ordinary"), x, strict=True)) for x in candidates(t or "", b)])
            yield pa.record_batch([part.column(0).cast(pa.int64()), pa.array(base, pa.list_(SPAN)), pa.array(more, pa.list_(CANDIDATE))],
                                  names=["doc_id", "base", "more"])


def thresholds(histogram: list[tuple[int, int, int, bool, int]], rate: float) -> list[list[int]]:
    """The least score that is accepted, by encoding and length class (SCORES + 1: none); after these, the same of ordinary tokens.

    ``histogram``: (encoding, class, score, ordinary, count). A candidate's p-value is the share of the class's ordinary
    tokens that score as much; where a class has few of them, its encoding's shorter classes lend theirs.
    Ordinary tokens are accepted where they are no more than ``rate`` of all that are accepted, all of them counted as false.
    """
    out = [[SCORES + 1] * len(LENGTHS) for _ in range(2 * len(ENCODINGS))]
    for e in range(len(ENCODINGS)):
        null = np.zeros(SCORES + 1)
        for c in range(len(LENGTHS)):
            own, tried = np.zeros(SCORES + 1), np.zeros(SCORES + 1)
            for enc, size, score, ordinary, n in histogram:
                if (enc, size) == (e, c):
                    (own if ordinary else tried)[score] += n
            null = own if own.sum() >= 200 else null + own
            if not tried.sum():
                continue
            above = lambda x: x[::-1].cumsum()[::-1]
            p = (1 + above(null)) / (20 + null.sum())  # a class without ordinary tokens can't go below 1 in 20
            accepted = above(tried)
            fine = np.flatnonzero((p * tried.sum() <= rate * accepted) & (accepted > 0) & (np.arange(SCORES + 1) >= 4))
            if len(fine):
                out[e][c] = int(fine[0])
                few = np.flatnonzero((above(own) <= rate * (above(own) + accepted)) & (np.arange(SCORES + 1) >= fine[0]))
                if len(few):
                    out[e + len(ENCODINGS)][c] = int(few[0])
    return out


def scan(docs: DataFrame, rate: float = 0.1) -> DataFrame:
    """doc_id, base and all spans (arrays of start, kind number k, end) per document; ``rate``: of false discoveries."""
    found = materialize(docs.select("doc_id", F.col("text").alias(private("text"))).mapInArrow(
        _scan, "doc_id long, base array<struct<start:long,k:int,end:long>>, "
               "more array<struct<start:long,end:long,enc:int,len:int,score:int,ordinary:boolean>>"), "secrets")
    each = found.select(F.explode("more").alias("x")).select("x.*").groupBy("enc", "len", "score", "ordinary").count()
    least = thresholds(sorted(tuple(r) for r in each.collect()), rate)  # bounded, see above
    table = F.lit([x for row in least for x in row])
    row = lambda x: x["enc"] + x["ordinary"].cast("int") * len(ENCODINGS)
    accepted = F.filter("more", lambda x: x["score"] >= F.get(table, row(x) * len(LENGTHS) + x["len"]))
    added = F.transform(accepted, lambda x: F.struct(x["start"].alias("start"), F.lit(3).alias("k"), x["end"].alias("end")))
    return found.select("doc_id", "base", F.array_sort(F.concat("base", F.array_distinct(added))).alias("spans"))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(F.lit(KINDS), s["k"]), s["start"], s["end"])), ",")


def digest(docs: DataFrame, rate: float = 0.1) -> DataFrame:
    """Per document: doc_id, the counts of base spans, their digest, and all spans."""
    got = scan(docs, rate)
    count = lambda k: F.size(F.filter("base", lambda s: s["k"] == k)).cast("long")
    return got.select("doc_id", *(count(i).alias(f"n_{k}") for i, k in enumerate(KINDS[:3])),
                      F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
