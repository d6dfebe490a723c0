"""Raking against a plain version, sampling by it, odd rows."""

import hashlib
from collections import defaultdict

from siltbed.llm import mixing


def plain(rows, targets, budget, rounds):
    cells = defaultdict(float)
    for *cell, n in rows:
        cells[tuple(cell)] += n
    fit, total = dict(cells), sum(cells.values())
    for _ in range(rounds):
        for m in range(3):
            have, now = defaultdict(float), defaultdict(float)
            for c in cells:
                have[c[m]] += cells[c]
                now[c[m]] += fit[c]
            w = {v: (h ** targets[m] if h else 0) for v, h in have.items()}
            for c in fit:
                goal = w[c[m]] / sum(w.values()) * total * budget
                fit[c] = min(cells[c], fit[c] * (goal / now[c[m]] if now[c[m]] else 0))
    return {c: (fit[c] / n if n else 1.0) for c, n in cells.items()}


def test_probabilities_and_draws_match_a_plain_version(sample_docs):
    got = mixing.with_probability(sample_docs).collect()
    want = plain([(r.source, r.lang, r.topic, r.tokens) for r in got], (0.5, 0.7, 0.9), 0.5, mixing.ROUNDS)
    for r in got:
        assert abs(r.p - want[r.source, r.lang, r.topic]) < 1e-9
        assert r.u == int(hashlib.md5(f"mix-{r.doc_id}".encode()).hexdigest()[:12], 16) / 2**48
        assert r.tokens == len(r.row.text.split())


def test_margins_reach_given_targets(make):
    rows = [(i, "w " * (5 + i % 7), "en" if i % 3 else "de", f"s{i % 4 if i % 2 else 0}") for i in range(400)]
    got = mixing.with_probability(make(rows), {"source": {"s0": 1, "s1": 1, "s2": 1, "s3": 1}, "lang": {"en": 1, "de": 1}}, budget=0.2, rounds=12).collect()
    by = defaultdict(float)
    for r in got:
        by[r.source] += r.p * r.tokens
        by[r.lang] += r.p * r.tokens
    total = sum(r.tokens for r in got) * 0.2
    for v, n in by.items():
        assert abs(n / total - (0.5 if v in ("en", "de") else 0.25 if v != "s2" else 0.0)) < 0.34
    assert abs(by["en"] - by["de"]) < 0.05 * total


def test_odd_rows_and_extra_columns(odd, none):
    kept = mixing.mix(odd, budget=1.0)
    assert kept.columns == odd.columns
    rows = kept.collect()
    assert {r.doc_id for r in rows} >= {2, 3, 4}  # cells without tokens stay whole
    assert sum(r.doc_id == 5 for r in rows) in (0, 2)
    assert mixing.mix(none).collect() == []


def cells_of(spark, rows):
    return spark.createDataFrame(rows, "source string, lang string, topic string, tokens long")


def raked(spark, rows, targets, budget):
    cells = cells_of(spark, rows)
    wanted = mixing.goals(cells, targets, budget)
    fit = mixing.rake(cells, wanted)
    return {(r.margin, r.value): r for r in mixing.margins(fit, wanted).collect()}, fit.collect()


def test_capped_cells_reach_the_margins_that_can_be_reached(spark):
    # half of a's English must go to make room, and its German is used up; another cell gives what that one lacks
    rows = [("a", "en", "t", 800), ("a", "de", "t", 60), ("b", "en", "t", 300), ("b", "de", "t", 400)]
    even = {"source": {"a": 1, "b": 1}, "lang": {"en": 1, "de": 1}, "topic": {"t": 1}}
    found, cells = raked(spark, rows, even, 0.4)
    assert all(r.reached for r in found.values())
    for r in found.values():
        assert abs(r.fitted - r.goal) < 0.01 * r.goal
    assert all(0 <= r.p <= 1 for r in cells)
    capped, cells = raked(spark, rows, even | {"source": {"a": 3, "b": 2}, "lang": {"en": 3, "de": 2}}, 0.5)
    assert all(r.reached for r in capped.values())
    assert {(r.source, r.lang) for r in cells if r.p == 1.0} <= {("a", "de")}


def test_margins_out_of_reach_are_named(spark):
    rows = [("a", "en", "t", 800), ("a", "de", "t", 10), ("b", "en", "t", 20), ("b", "de", "t", 170)]
    found, cells = raked(spark, rows, {"source": {"a": 3, "b": 2}, "lang": {"en": 11, "de": 9}, "topic": {"t": 1}}, 0.5)
    short = {k for k, r in found.items() if not r.reached}
    assert ("source", "b") in short and ("lang", "de") in short  # 200 wanted of 190, 225 of 180
    assert found["source", "b"].goal > found["source", "b"].available == 190
    assert found["lang", "de"].fitted <= found["lang", "de"].available == 180
    assert all(0 <= r.p <= 1 for r in cells)


def test_margin_report_of_the_default_mix(sample_docs, odd, none):
    rows = mixing.margin_report(sample_docs).collect()
    assert {r.margin for r in rows} == set(mixing.MARGINS) and all(r.reached for r in rows)
    for m in mixing.MARGINS:
        assert abs(sum(r.fitted for r in rows if r.margin == m) / sum(r.available for r in rows if r.margin == m) - 0.5) < 0.005
    assert {r.value for r in mixing.margin_report(odd).collect() if r.margin == "source"} == {None, "a", "b", "c"}
    assert mixing.margin_report(none).collect() == []


def test_few_cells_are_raked_without_a_shuffle_and_like_many(spark, monkeypatch):
    cells = cells_of(spark, [(f"s{i % 5}" if i % 5 else None, f"l{i % 3}", f"t{i % 4}", 10 + i * 7 % 50) for i in range(60)])
    wanted = mixing.goals(cells, {"source": 0.5, "lang": 0.7, "topic": 0.9}, 0.5)
    plans, real = [], mixing.materialize

    def seen(df, name):
        if name == "raked":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, name)

    monkeypatch.setattr(mixing, "materialize", seen)
    few = {(r.source, r.lang, r.topic): r.p for r in mixing.rake(cells, wanted).collect()}
    assert plans and not any("Exchange" in p for p in plans)
    monkeypatch.setattr(mixing, "FEW_CELLS", 59, raising=False)
    many = {(r.source, r.lang, r.topic): r.p for r in mixing.rake(cells, wanted).collect()}
    assert "Exchange" in plans[-1] and len(few) == 60 == len(many)
    assert all(abs(few[c] - many[c]) < 1e-9 for c in few)
