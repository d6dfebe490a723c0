"""Mixing sources to target weights by iterative proportional fitting (operator 1), DataFrame operations only.

Token counts are added up by (source, language, topic) cell. Raking scales the cells in turn to the target
shares of each margin until no cell's probability moves by more than a tolerance in a round; a cell never gets more
tokens than it has. Where such caps leave a margin short, :func:`margins` names it, with what it got and what there was.
A document's probability is its cell's fitted share of the cell's tokens, and it is sampled if a hash of its id lies below.
Only the cells are iterated over; the documents are read once for the counts and once for the sample.

Defined cases: a null source, language or topic is a value of its own; a null or empty text has no tokens, and is
kept like others of its cell (a cell without tokens is kept whole); rows that repeat a doc_id are sampled together;
a null doc_id hashes as the text "null"; an empty table gives no rows; extra columns are kept, whatever their names; very long texts are counted whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltbed.llm.common import WORD, materialize, private

MARGINS = ("source", "lang", "topic")
ROUNDS = 100  # a guard
TOLERANCE = 1e-9
FEW_CELLS = 50_000  # up to so many, a round of raking is one task without a shuffle


def tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def topic(text: Column) -> Column:
    """A topic by form: tables, records with contacts or keys, shouting, notes, articles or long reads."""
    return (F.when(text.isNull(), F.lit(None).cast("string"))
            .when(text.contains(" | "), "table")
            .when(text.rlike("[0-9a-f]{32}|AKIA|@[a-z0-9]+[.]"), "record")
            .when(text.contains("!! "), "shout")
            .when(F.length(text) < 600, "note").when(F.length(text) < 4000, "article").otherwise("long read"))


def target_shares(cells: DataFrame, margin: str, wanted: dict | float) -> DataFrame:
    """(margin value, share): given weights, or the present shares raised to a power and scaled to 1 again.

    Given weights hold among the values that occur; a value that is not named has weight 0.
    """
    shares = cells.groupBy(margin).agg(F.sum("tokens").cast("double").alias("t"))
    if isinstance(wanted, dict):
        weight = F.lit(0.0)
        for value, w in wanted.items():
            weight = F.when(F.col(margin).eqNullSafe(F.lit(value)), float(w)).otherwise(weight)
    else:
        weight = F.pow("t", F.lit(float(wanted)))
    shares = shares.select(margin, F.when(F.col("t") > 0, weight).otherwise(0.0).alias("w"))
    total = shares.agg(F.sum("w")).first()[0] or 1.0  # one number
    return shares.select(margin, (F.col("w") / total).alias("share"))


def goals(cells: DataFrame, targets: dict, budget: float) -> dict[str, DataFrame]:
    """For each margin (value, goal): the tokens that each of its values should get."""
    size = float(cells.agg(F.sum("tokens")).first()[0] or 0)  # one number
    return {m: materialize(target_shares(cells, m, targets[m]).select(
        F.col(m).alias(f"{m}_"), (F.col("share") * size * budget).alias("goal")), f"goal-{m}") for m in MARGINS}


def rake(cells: DataFrame, wanted: dict[str, DataFrame], rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> DataFrame:
    """Cells with ``fit``, the tokens that they get, and ``p``, their part of the cell's tokens; ``wanted``: from :func:`goals`.

    It ends with the first round in which no ``p`` moves by more than ``tolerance``, or after ``rounds``.
    The small joins are merge joins: so many broadcasts would pile up in the driver's memory. So do the threads and plans of a round's
    shuffles: up to ``FEW_CELLS`` cells stay in one partition, which needs none; more are shuffled.
    """
    fitted = cells.withColumn("fit", F.col("tokens").cast("double"))
    for m in MARGINS:
        fitted = fitted.join(wanted[m].withColumnRenamed("goal", f"{m}_goal").hint("merge"), F.col(m).eqNullSafe(F.col(f"{m}_"))).drop(f"{m}_")
    fitted = materialize(fitted, "to-rake")
    few = fitted.count() <= FEW_CELLS
    fitted = _in_place(fitted, few)
    for _ in range(rounds):
        fitted = fitted.withColumn("was", F.col("fit"))
        for m in MARGINS:
            scale = F.coalesce(F.col(f"{m}_goal") / F.nullif("now", F.lit(0.0)), F.lit(0.0))
            fitted = _with_sums(fitted, m, few).withColumn("fit", F.least(F.col("tokens").cast("double"), F.col("fit") * scale)).drop("now", f"{m}_")
        fitted = _in_place(materialize(fitted, "raked"), few)
        moved = fitted.where("tokens > 0").agg(F.max(F.abs(F.col("fit") - F.col("was")) / F.col("tokens"))).first()[0]  # one number
        fitted = fitted.drop("was")
        if (moved or 0.0) <= tolerance:
            break
    fitted = fitted.drop(*(f"{m}_goal" for m in MARGINS))
    return fitted.withColumn("p", F.when(F.col("tokens") == 0, 1.0).otherwise(F.col("fit") / F.col("tokens")))


def _in_place(cells: DataFrame, few: bool) -> DataFrame:
    return cells.coalesce(1) if few else cells


def _with_sums(cells: DataFrame, m: str, few: bool) -> DataFrame:
    """``cells`` with ``now``, the sum of ``fit`` over their value of margin ``m``: a window in one partition, a join for many cells,
    where a value's cells may be too many for one task."""
    if few:
        return cells.withColumn("now", F.sum("fit").over(Window.partitionBy(m)))
    now = cells.groupBy(m).agg(F.sum("fit").alias("now")).select(F.col(m).alias(f"{m}_"), "now")
    return cells.join(now.hint("merge"), F.col(m).eqNullSafe(F.col(f"{m}_")))


def margins(raked: DataFrame, wanted: dict[str, DataFrame], tolerance: float = 0.01) -> DataFrame:
    """(margin, value, goal, fitted, available, reached) for every value of each margin.

    ``reached``: fitted is within ``tolerance`` of the goal, as a part of the goal. A goal is out of reach where it is greater than
    ``available``, or where the cells that it shares with other margins are held back or used up by those.
    """
    found = None
    for m in MARGINS:
        got = raked.groupBy(m).agg(F.sum("fit").alias("fitted"), F.sum("tokens").alias("available"))
        got = got.join(wanted[m], F.col(m).eqNullSafe(F.col(f"{m}_"))).select(
            F.lit(m).alias("margin"), F.col(m).alias("value"), "goal", "fitted", "available",
            (F.abs(F.col("fitted") - F.col("goal")) <= F.col("goal") * tolerance).alias("reached"))
        found = got if found is None else found.unionByName(got)
    return found


def draw(doc_id: Column) -> Column:
    """A number in [0, 1) from the id, the same on every run: 48 bits of its MD5."""
    return F.conv(F.substring(F.md5(F.concat(F.lit("mix-"), F.coalesce(doc_id.cast("string"), F.lit("null")))), 1, 12), 16, 10).cast("double") / F.lit(float(2**48))


def _labelled(docs: DataFrame, label: Column | None) -> DataFrame:
    label = topic(F.col("text")) if label is None else label
    return docs.select(F.struct("*").alias("row"), F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"),
                       label.alias("topic"), tokens(F.col("text")).alias("tokens"))


def _raked(rows: DataFrame, targets: dict | None, budget: float, rounds: int, tolerance: float) -> tuple[DataFrame, dict[str, DataFrame]]:
    cells = materialize(rows.groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens")), "cells")
    wanted = goals(cells, {"source": 0.5, "lang": 0.7, "topic": 0.9} | (targets or {}), budget)
    return rake(cells, wanted, rounds, tolerance), wanted


def with_probability(docs: DataFrame, targets: dict | None = None, budget: float = 0.5, rounds: int = ROUNDS,
                     label: Column | None = None, tolerance: float = TOLERANCE) -> DataFrame:
    """(row, doc_id, tokens, topic, p, u) per document; ``row``: all input columns.

    ``targets``: for each margin a dict of weights, or the power its present shares are raised to (below 1: evened out).
    ``budget``: the tokens wanted, as a part of all. ``label``: the topic column, by default :func:`topic`.
    """
    rows = _labelled(docs, label)
    chance = _raked(rows, targets, budget, rounds, tolerance)[0].select(*(F.col(m).alias(f"{m}_") for m in MARGINS), "p")
    same = [F.col(m).eqNullSafe(F.col(f"{m}_")) for m in MARGINS]
    return rows.join(chance, same).select("row", F.col("row.doc_id").alias("doc_id"), "source", "lang", "topic", "tokens", "p", draw(F.col("row.doc_id")).alias("u"))


def margin_report(docs: DataFrame, targets: dict | None = None, budget: float = 0.5, rounds: int = ROUNDS, label: Column | None = None,
                  tolerance: float = TOLERANCE, near: float = 0.01) -> DataFrame:
    """:func:`margins` of the mix that :func:`mix` would take from ``docs`` with the same arguments; ``near``: when a goal counts as reached."""
    return margins(*_raked(_labelled(docs, label), targets, budget, rounds, tolerance), near)


def mix(docs: DataFrame, targets: dict | None = None, budget: float = 0.5, rounds: int = ROUNDS, label: Column | None = None) -> DataFrame:
    """The sampled rows of ``docs``, with all their columns."""
    return with_probability(docs, targets, budget, rounds, label).where("u < p").select("row.*")


def oracle(rounds: int = 32, budget: float = 0.5, powers: tuple = (0.5, 0.7, 0.9)) -> str:
    """The same rows in DuckDB's SQL: each raking step is a table expression, in as many rounds as the tables need and some more."""
    topic_sql = """CASE WHEN text IS NULL THEN NULL WHEN contains(text, ' | ') THEN 'table'
      WHEN regexp_matches(text, '[0-9a-f]{32}|AKIA|@[a-z0-9]+[.]') THEN 'record' WHEN contains(text, '!! ') THEN 'shout'
      WHEN length(text) < 600 THEN 'note' WHEN length(text) < 4000 THEN 'article' ELSE 'long read' END"""
    steps = [f"""rows AS MATERIALIZED (SELECT doc_id, source, lang, {topic_sql} AS topic,
      coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS tokens,
      ('0x' || substr(md5('mix-' || coalesce(doc_id::VARCHAR, 'null')), 1, 12))::BIGINT::DOUBLE / 281474976710656.0 AS u FROM documents)""",
             "c0 AS MATERIALIZED (SELECT source, lang, topic, sum(tokens)::DOUBLE AS tokens, sum(tokens)::DOUBLE AS fit FROM rows GROUP BY ALL)"]
    for m, power in zip(MARGINS, powers, strict=True):
        steps.append(f"""w_{m} AS MATERIALIZED (SELECT {m}, CASE WHEN sum(tokens) > 0 THEN pow(sum(tokens), {power}) ELSE 0 END AS w FROM c0 GROUP BY {m})""")
        steps.append(f"""g_{m} AS MATERIALIZED (SELECT {m}, w / (SELECT nullif(sum(w), 0) FROM w_{m}) * (SELECT sum(tokens) FROM c0) * {budget} AS goal FROM w_{m})""")
    at = 0
    for _ in range(rounds):
        for m in MARGINS:
            steps.append(f"""c{at + 1} AS MATERIALIZED (SELECT c.source, c.lang, c.topic, c.tokens,
      least(c.tokens, c.fit * coalesce(g.goal / nullif(n.now, 0), 0)) AS fit FROM c{at} c
      JOIN (SELECT {m}, sum(fit) AS now FROM c{at} GROUP BY {m}) n ON c.{m} IS NOT DISTINCT FROM n.{m}
      JOIN g_{m} g ON c.{m} IS NOT DISTINCT FROM g.{m})""")
            at += 1
    return f"""WITH {', '.join(steps)},
    done AS (SELECT r.doc_id, r.topic, r.tokens, CASE WHEN c.tokens = 0 THEN 1 ELSE c.fit / c.tokens END AS p, r.u FROM rows r JOIN c{at} c
      ON r.source IS NOT DISTINCT FROM c.source AND r.lang IS NOT DISTINCT FROM c.lang AND r.topic IS NOT DISTINCT FROM c.topic)
    SELECT doc_id, topic, tokens, round(p, 6) AS probability FROM done WHERE u < p"""
