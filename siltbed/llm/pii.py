"""Personal data by weak-supervision aggregation (operator 8), DataFrame operations only.

Regexes propose spans: strict ones, which always stay, and looser ones (local phone numbers, spelt-out addresses, card
numbers that fail the check digit). Five labelers vote on each span, for, against or not at all: its regex, its check rule, a
gazetteer, the words before it, and what else the document holds. Expectation-maximisation over the counts of vote
patterns estimates how reliable each labeler is and how likely each pattern is personal data; a logistic span
classifier is trained on those likelihoods from span features, and looser spans that it accepts are added.

Spans are found in one row by splitting at the matches, so that the lengths of the pieces give positions. Only
matches and a few characters before them leave the texts. The driver gets the counts of vote patterns and
of feature patterns: at most 4 kinds x 3^5 and 4 kinds x 2^6 rows, whatever the input.

Defined cases: a null text is an empty one; empty texts have no spans; repeated rows get equal results, each its own row;
a null doc_id stays null; an empty table gives no rows; extra columns are ignored; without any span the classifier
accepts nothing.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siltbed.llm.common import materialize

KINDS = ["email", "ip", "card", "phone"]

# The patterns of the contract. Possessive forms and start conditions find the same matches in linear time: a
# match can only begin where a run of its first class begins, or where the one before ended.
STRICT = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{2,64}+ ?(?:\(at\)|\[at\]| at ) ?[A-Za-z0-9-]{1,63}+ ?(?:\(dot\)|\[dot\]| dot ) ?[A-Za-z]{2,12}+(?![A-Za-z])",
    "phone": r"(?<![0-9+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])",
}
#: Before a span, in the last 40 characters.
CUES = {"email": "(?i)mail|contact|write|reach|courriel|correo|kontakt", "ip": r"(?i)\bip\b|address|host|server|client|login",
        "card": "(?i)card|visa|master|amex|credit|iban|karte|carte|tarjeta", "phone": r"(?i)phone|call|tel|mobile|cell|fax|contact|ruf|appel|llam"}
COUNTER = {"email": r"(?i)look|meet", "ip": r"(?i)version|release|section|\bv\.?$", "card": r"(?i)\bid\b|order|serial|isbn|number of", "phone": r"(?i)\bid\b|order|serial|isbn|part"}
#: Gazetteers: top-level domains, first digits of card issuers, country codes.
DOMAINS = ["com", "org", "net", "edu", "gov", "info", "biz", "io", "de", "fr", "es", "uk", "eu", "us", "it", "nl", "ch", "at"]
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65|35|30|36|38)"
COUNTRIES = r"^(?:1|7|20|27|3[0-469]|4[0-13-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"


def _pieces(text: Column, pattern: str) -> Column:
    """Each match with the number of characters before it since the last one, the last 40 of them and the next one."""
    gaps, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    one = lambda g, m: F.struct(F.length(g).alias("gap"), m.alias("match"), F.right(g, F.lit(40)).alias("before"))
    n = F.size(found)
    return F.zip_with(F.slice(gaps, F.lit(1), n), found, one)


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def value(i):
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = d * 2
        return F.when((n - i) % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda s, i: s + value(i)) % 10 == 0


def _rule(kind: Column, match: Column) -> Column:
    """The contract's check of a match."""
    digits = _digits(match)
    parts = F.split(match, r"\.")
    small = F.forall(parts, lambda p: F.length(F.regexp_replace(p, "^0+(?=.)", "")) <= 3) & F.forall(
        parts, lambda p: F.right(p, F.lit(9)).cast("int") <= 255)
    return (F.when(kind == "email", True).when(kind == "ip", small)
            .when(kind == "card", F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False))
            .otherwise(F.length(digits).between(10, 15)))


def proposals(docs: DataFrame) -> DataFrame:
    """(uid, doc_id, kind, strict, start, match, before, valid): a row for each match; and one without kind for each document."""
    text = F.coalesce("text", F.lit(""))
    guard = {"email": text.contains("@"), "phone": text.contains("+"), "ip": text.rlike(r"[0-9]\.[0-9]"), "card": text.rlike("[0-9]"),
             "loose email": text.rlike(r"[ (\[]at[ )\]]"), "loose phone": text.rlike("[0-9]{3}[ .-][0-9]{4}")}
    none = F.lit(None)
    found = {k: F.when(guard[k], _pieces(text, p)).otherwise(none).alias(k) for k, p in STRICT.items()}
    found |= {f"loose {k}": F.when(guard[f"loose {k}"], _pieces(text, p)).otherwise(none).alias(f"loose {k}") for k, p in LOOSE.items()}
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "text").select("uid", "doc_id", *found.values())
    rows = materialize(rows, "matches")
    each = []
    for name in found:
        x = rows.select("uid", F.lit(name.split()[-1]).alias("kind"), F.lit(" " not in name).alias("strict"), F.posexplode(F.col(f"`{name}`")).alias("at", "x"))
        each.append(x.select("uid", "kind", "strict", "at", "x.gap", "x.match", "x.before"))
    spans = each[0]
    for x in each[1:]:
        spans = spans.unionByName(x)
    earlier = W.partitionBy("uid", "kind", "strict").orderBy("at").rowsBetween(W.unboundedPreceding, -1)  # matches of one text
    spans = spans.withColumn("start", (F.coalesce(F.sum(F.col("gap") + F.length("match")).over(earlier), F.lit(0)) + F.col("gap")).cast("long"))
    spans = spans.select("uid", "kind", "strict", "start", (F.col("start") + F.length("match")).alias("end"), "match", "before",
                         _rule(F.col("kind"), F.col("match")).alias("valid"))
    return rows.select("uid", "doc_id"), spans


def _by_kind(values: dict[str, Column]) -> Column:
    out = F.lit(None)
    for kind, value in values.items():
        out = F.when(F.col("kind") == kind, value).otherwise(out)
    return out


def _for(yes: Column, no: Column | None = None) -> Column:
    """A vote: 2 for, 0 against, 1 none."""
    vote = F.when(yes, 2)
    return (vote.when(no, 0) if no is not None else vote).otherwise(1)


def with_votes(spans: DataFrame) -> DataFrame:
    """``spans`` with the labelers' votes v0..v4 and the features f0..f5."""
    digits, match = _digits(F.col("match")), F.col("match")
    tail = F.lower(F.regexp_extract(match, r"([A-Za-z]+)[^A-Za-z]*$", 1))
    in_list = {"email": tail.isin(DOMAINS), "ip": ~match.rlike(r"^0|^[0-9]\.[0-9]\.[0-9]\.[0-9]$"), "card": digits.rlike(ISSUERS),
               "phone": F.when(F.col("strict"), digits.rlike(COUNTRIES)).otherwise(digits.rlike("^[2-9][0-9]{2}[2-9]"))}
    cue = F.coalesce(_by_kind({k: F.col("before").rlike(p) for k, p in CUES.items()}), F.lit(False))
    counter = F.coalesce(_by_kind({k: F.col("before").rlike(p) for k, p in COUNTER.items()}), F.lit(False))
    kinds = F.size(F.collect_set("kind").over(W.partitionBy("uid")))  # four at most
    distinct = F.length(F.array_join(F.array_distinct(F.split(digits, "")), ""))
    listed = _by_kind(in_list)
    votes = [_for(F.col("strict")), _for(F.col("valid"), ~F.col("valid")), _for(listed, ~listed), _for(cue, counter), _for(kinds >= 2)]
    features = [F.col("strict"), F.col("valid"), listed, cue, (F.col("kind") == "email") | (distinct >= 4), match.rlike("[ ().-]")]
    return spans.select("*", *(v.cast("int").alias(f"v{i}") for i, v in enumerate(votes)),
                        *(F.coalesce(f, F.lit(False)).cast("int").alias(f"f{i}") for i, f in enumerate(features)))


def reliabilities(patterns: list[tuple[str, tuple[int, ...], int]], rounds: int = 50) -> tuple[dict, dict]:
    """EM over counted vote patterns (kind, votes, count).

    Returns for each (kind, votes) how likely it is personal data, and for each labeler the shares of its
    votes (against, none, for) among the other spans and among personal data. It starts from the majority of votes.
    """
    size = len(patterns[0][1]) if patterns else 0
    belief = {(k, v): 1 / (1 + math.exp(-(sum(v) - size))) for k, v, _ in patterns}
    table: dict = {}
    for _ in range(rounds):
        table = {(j, c): [1.0, 1.0, 1.0] for j in range(size) for c in (0, 1)}
        prior = {k: [1.0, 1.0] for k in KINDS}
        for k, v, n in patterns:
            for c in (0, 1):
                w = n * (belief[k, v] if c else 1 - belief[k, v])
                prior[k][c] += w
                for j, vote in enumerate(v):
                    table[j, c][vote] += w
        table = {key: [x / sum(row) for x in row] for key, row in table.items()}
        for k, v, _ in patterns:
            odds = math.log(prior[k][1] / prior[k][0]) + sum(math.log(table[j, 1][x] / table[j, 0][x]) for j, x in enumerate(v))
            belief[k, v] = 1 / (1 + math.exp(-max(-30, min(30, odds))))
    return belief, table


def fit_logistic(rows: list[tuple[list[int], float, float]], rounds: int = 300, rate: float = 0.5, ridge: float = 1e-3) -> list[float]:
    """Weights (the last one constant) for feature patterns with soft labels and counts, by gradient steps on the mean loss."""
    if not rows:
        return []
    size = len(rows[0][0]) + 1
    total = sum(n for _, _, n in rows)
    w = [0.0] * size
    for _ in range(rounds):
        slope = [ridge * x for x in w]
        for f, y, n in rows:
            x = [*f, 1]
            p = 1 / (1 + math.exp(-max(-30, min(30, sum(a * b for a, b in zip(w, x, strict=True))))))
            for i in range(size):
                slope[i] += n / total * (p - y) * x[i]
        w = [a - rate * b for a, b in zip(w, slope, strict=True)]
    return w


def classified(spans: DataFrame) -> DataFrame:
    """``spans`` (with votes) with ``score``, the trained span classifier's."""
    votes, features = [f"v{i}" for i in range(5)], [f"f{i}" for i in range(6)]
    counted = spans.groupBy("kind", *votes).agg(F.count("*").alias("n")).collect()  # at most 4 x 3^5 rows
    patterns = [(r.kind, tuple(r[v] for v in votes), r.n) for r in sorted(counted, key=str)]
    belief, _ = reliabilities(patterns)
    number = sum((F.col(v) * 3**i for i, v in enumerate(votes)), F.lit(0))
    table = [0.0] * (len(KINDS) * 3**5)
    for (k, v), b in belief.items():
        table[KINDS.index(k) * 3**5 + sum(x * 3**i for i, x in enumerate(v))] = b
    kind = F.array_position(F.lit(KINDS), F.col("kind")).cast("int") - 1
    soft = F.get(F.lit(table), kind * 3**5 + number)
    trained = spans.groupBy("kind", *features).agg(F.avg(soft).alias("y"), F.count("*").alias("n")).collect()  # at most 4 x 2^6 rows
    rows = [([*(int(r.kind == k) for k in KINDS), *(r[f] for f in features)], r.y, r.n) for r in sorted(trained, key=str)]
    w = fit_logistic(rows) or [0.0] * (len(KINDS) + len(features) + 1)
    z = F.lit(w[-1]) + sum((F.col(f) * w[len(KINDS) + i] for i, f in enumerate(features)), F.lit(0.0))
    z = z + F.get(F.lit(w[: len(KINDS)]), kind)
    return spans.withColumn("score", 1 / (1 + F.exp(-z)))


def find(docs: DataFrame, threshold: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """(uid, doc_id) of every row of ``docs``, and the accepted spans: uid, kind, start, end, match, base, score.

    Base spans are the strict ones that pass their rule. Others need the classifier's score, and go if they overlap a base
    span or an earlier accepted one of their document.
    """
    ids, spans = proposals(docs)
    spans = classified(materialize(with_votes(spans), "votes"))
    spans = spans.withColumn("base", F.col("strict") & F.col("valid"))
    chosen = spans.where(F.col("base") | (F.col("score") >= threshold) & (~F.col("strict") | (F.col("kind") == "card") & F.length(_digits(F.col("match"))).between(14, 19)))
    text = W.partitionBy("uid").orderBy("start", "end", "kind")  # spans of one document
    reach = lambda keep, w: F.max(F.when(keep, F.col("end"))).over(w)
    ahead = W.partitionBy("uid").orderBy(F.desc("start"), F.desc("end"), F.desc("kind"))
    before = text.rowsBetween(W.unboundedPreceding, -1)
    chosen = chosen.withColumn("reached", reach(F.lit(True), before)).withColumn(
        "follows", F.min(F.when(F.col("base"), F.col("start"))).over(ahead.rowsBetween(W.unboundedPreceding, -1)))
    clear = F.coalesce(F.col("reached") <= F.col("start"), F.lit(True)) & F.coalesce(F.col("follows") >= F.col("end"), F.lit(True))
    return ids, chosen.where(F.col("base") | clear).select("uid", "kind", "start", "end", "match", "base", "score")


def joined(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed, comma-joined."""
    return F.array_join(F.transform(F.sort_array(spans), lambda s: F.concat_ws(":", F.get(F.lit(KINDS), s["k"]), s["start"], s["end"])), ",")


def digest(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, the counts of base spans, their digest, and all spans."""
    ids, spans = find(docs)
    one = F.struct("start", (F.array_position(F.lit(KINDS), F.col("kind")).cast("int") - 1).alias("k"), "end")
    per = spans.groupBy("uid").agg(*(F.count(F.when(F.col("base") & (F.col("kind") == k), 1)).alias(f"n_{k}") for k in KINDS),
                                   F.collect_list(F.when(F.col("base"), one)).alias("base"), F.collect_list(one).alias("all"))
    got = ids.join(per, "uid", "left")
    text = lambda c: F.coalesce(joined(F.col(c)), F.lit(""))
    return got.select("doc_id", *(F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS),
                      F.sha2(text("base"), 256).alias("base_sha256"), text("all").alias("spans"))
