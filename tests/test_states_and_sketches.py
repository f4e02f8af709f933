"""Majority values, quantile states and smoothing states."""

from __future__ import annotations

from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from shelfspark.operators import columns, profile, series, sketches, smoothing, states, theta

DAY0 = date(2023, 1, 1)


def constants(spark, rows=400):
    """Columns with one value, only nulls, a majority value, a majority of nulls, an even split, a share of just 0.99."""
    data = [
        (1.5, None, "usual" if i % 150 else "odd", None if i % 200 else 7, i % 2, "x" if i % 100 else "y", -0.0 if i % 2 else 0.0, i)
        for i in range(rows)
    ]
    return spark.createDataFrame(data, "one double, void string, most string, gaps int, half int, edge string, zero double, id int").repartition(5)


def test_constant_and_near_constant_columns(spark):
    df = constants(spark)
    assert {r[0] for r in columns.constant_columns(df).collect()} == {"one", "void", "zero"}
    found = dict(map(tuple, columns.near_constant_columns(df).collect()))
    assert found == {"one": 1.0, "void": 1.0, "zero": 1.0, "most": pytest.approx(397 / 400), "gaps": pytest.approx(398 / 400)}
    by_counts = {r["column"]: r["top_share"] for r in columns.cardinalities(df).collect()}
    above = dict(map(tuple, columns.near_constant_columns(df, 0.6).collect()))
    assert above == {c: pytest.approx(v) for c, v in by_counts.items() if v > 0.6}
    assert columns.near_constant_columns(df.limit(0)).isEmpty() and columns.constant_columns(df.limit(0)).isEmpty()
    with pytest.raises(ValueError):
        columns.near_constant_columns(df, 0.4)


def test_majority_shuffles_a_row_for_each_task(spark):
    plan = columns.majority_values(constants(spark))._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan") :]
    assert "hashpartitioning" not in physical
    assert "Generate" in physical and physical.count("Exchange SinglePartition") == 1


def test_values_with_the_same_mark_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(columns, "_mark", lambda value: F.length(F.coalesce(value, F.lit("none"))).cast("bigint"))
    df = spark.createDataFrame([("aa",)] * 60 + [("bb",)] * 39 + [("c",)], "v string")
    assert columns.majority_values(df).collect()[0].asDict() == {"column": "v", "rows": 100, "held": 60}


def skewed(spark, rows=6000, seed=5):
    rng = np.random.default_rng(seed)
    kind = rng.integers(0, 3, rows)
    y = np.where(kind == 0, 0.0, np.where(kind == 1, rng.lognormal(3, 2, rows), np.round(rng.normal(50, 5, rows))))
    data = [
        (DAY0 + timedelta(days=int(d)), "AB"[i % 2], None if i % 17 == 0 else float(v))
        for i, (d, v) in enumerate(zip(rng.integers(0, 40, rows) ** 2 // 40, y, strict=True))
    ]
    return spark.createDataFrame(data, "date date, category string, v double")


def test_merged_ranks_keep_the_bound(spark):
    df = skewed(spark)
    probs = [0.0, 0.01, 0.25, 0.5, 0.9, 0.99, 1.0]
    for by in ([], ["category"]):
        made = sketches.part_states(df, ["v"], [*by, "date"])
        found = sketches.merged_quantiles(made, probs, by)
        worst = sketches.rank_errors(df, found, by).agg(F.max(F.col("rank_error") - 1 / F.col("n"))).first()[0]
        assert worst <= sketches.rank_bound()
    assert made.agg(F.sum("n")).first()[0] == df.where("v IS NOT NULL").count()


def test_days_are_added_to_kept_states(spark):
    df = skewed(spark)
    early = F.col("date") < F.lit(DAY0 + timedelta(days=9))
    kept, added = (sketches.part_states(df.where(x), ["v"]) for x in (early, ~early))
    once = sketches.merged_quantiles(sketches.part_states(df, ["v"]), [0.5, 0.95])
    twice = sketches.merged_quantiles(kept.unionByName(added), [0.5, 0.95])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    assert sketches.merged_quantiles(sketches.part_states(df.limit(0), ["v"]), [0.5]).isEmpty()


def test_signal_distribution_counts_zeros(spark):
    df = skewed(spark).withColumnRenamed("v", "replenishment_signal")
    found = profile.signal_distribution(df).select("category", "n", "zeros").distinct().collect()
    expected = df.groupBy("category").agg(F.count("replenishment_signal"), F.count_if(F.col("replenishment_signal") == 0))
    assert sorted(map(tuple, found)) == sorted(map(tuple, expected.collect()))


def weekly(spark, n=70, ids=("up", "down", "zero")):
    rng = np.random.default_rng(3)
    rows = []
    for j, name in enumerate(ids):
        for t in range(n):
            y = 40 + j + 0.3 * t * (1 - j) + (9 if t % 7 == 5 else 0) + rng.normal(0, 1)
            rows.append((name, DAY0 + timedelta(days=t), 0.0 if name == "zero" and t % 3 == 0 else float(y)))
    return spark.createDataFrame(rows, "unique_id string, ds date, y double")


def test_search_agrees_with_the_sweep(spark):
    s = weekly(spark)
    end = DAY0 + timedelta(days=62)
    found = states.forecast_states(states.fit_states(s, end, states.wide_grid()), 9)
    expected = smoothing.forecast_ahead(s.where(F.col("ds") <= F.lit(end)), end, 9)
    got = {(r["unique_id"], r["ds"]): r["yhat"] for r in found.collect()}
    want = {(r["unique_id"], r["ds"]): r["yhat"] for r in expected.collect()}
    assert got.keys() == want.keys() and len(got) == 27
    assert [got[k] for k in want] == pytest.approx(list(want.values()), rel=1e-9)


def test_short_series_have_states(spark):
    s = weekly(spark, 4, ("a",))
    found = states.fit_states(s, DAY0 + timedelta(days=9)).collect()
    assert [(r["n"], r["last_ds"]) for r in found] == [(4, DAY0 + timedelta(days=3))]


def test_added_days_equal_a_refit(spark):
    s, end = weekly(spark), DAY0 + timedelta(days=60)
    for row in (states.SMALL_GRID[3], (0.2, 0.02, 0.9, 1.0, 0.1, 1.0, 1.0)):
        earlier = states.fit_states(s, end, [row])
        refit = states.fit_states(s, end + timedelta(days=1), [row])
        days = s.where(F.col("ds") <= F.lit(end + timedelta(days=1)))
        moved = {r["unique_id"]: r for r in states.advance_states(earlier, days).collect()}
        whole = {r["unique_id"]: r for r in refit.collect()}
        assert moved.keys() == whole.keys() and ("zero" in moved) == (row[6] == 0)
        for key, r in whole.items():
            for c in ("last_ds", "n"):
                assert moved[key][c] == r[c]
            for c in ("level", "trend", "sse", "criterion", "wave"):
                assert moved[key][c] == pytest.approx(r[c])


def test_states_without_new_days_stay_and_gaps_are_errors(spark):
    s, end = weekly(spark), DAY0 + timedelta(days=40)
    earlier = states.fit_states(s, end)
    same = states.advance_states(earlier, s.where(F.col("ds") <= F.lit(end)))
    assert sorted(r["level"] for r in same.collect()) == pytest.approx(sorted(r["level"] for r in earlier.collect()))
    with pytest.raises(PySparkException):
        states.advance_states(earlier, s.where(F.col("ds") > F.lit(end + timedelta(days=2)))).collect()


def test_series_of_the_kept_states_forecast_any_horizon(spark):
    found = states.forecast_states(states.fit_states(weekly(spark), DAY0 + timedelta(days=69)), 30)
    assert found.count() == 90
    assert series.forecast_summary(found).first()["forecast_records_count"] == 90


def theta_by_force(y, grid, horizon, season=7):
    """Least squares and a loop; the last reading lies on the last day."""
    t = np.arange(len(y)) - len(y) + 1.0
    known = ~np.isnan(y)
    mean = y[known].mean() if abs(y[known].mean()) > theta.TINY else 1.0
    phase = (np.arange(len(y) + horizon) - len(y) + 1) % season
    index = np.array([y[known & (phase[: len(y)] == k)].mean() / mean if (known & (phase[: len(y)] == k)).any() else -1 for k in range(season)])
    if not (index > theta.LEAST_INDEX).all():
        index = np.ones(season)
    x, at = (y / index[phase[: len(y)]])[known], t[known]
    slope, intercept = np.polyfit(at, x, 1) if len(x) > 1 else (0.0, x[0])
    line, best = intercept + slope * at, None
    for alpha, th in grid:
        z = th * x + (1 - th) * line
        level, sse = z[0], 0.0
        for i in range(1, len(x)):
            sse += (x[i] - level / th - (1 - 1 / th) * line[i]) ** 2
            level = alpha * z[i] + (1 - alpha) * level
        if best is None or sse < best[0]:
            best = sse, alpha, th, level
    sse, alpha, th, level = best
    k = np.arange(1, horizon + 1)
    return alpha, th, (level / th + (1 - 1 / th) * (intercept + slope * k)) * index[phase[len(y) :]]


def test_theta_by_force(spark):
    rng = np.random.default_rng(8)
    days = np.arange(60)
    rows = {
        "trend": 20 + 0.5 * days + 6 * np.sin(days * 2 * np.pi / 7) + rng.normal(0, 1, 60),
        "level": 50 + np.cumsum(rng.normal(0, 3, 60)),
        "gaps": np.where(days % 9 == 4, np.nan, 30 + rng.normal(0, 2, 60)),
        "no sunday": np.where(days % 7 == 2, np.nan, 30 + rng.normal(0, 2, 60)),
        "signs": rng.normal(0, 5, 60),
        "zeros": np.zeros(60),
        "short": np.array([3.0, 5.0, 4.0]),
        "single": np.array([4.0]),
    }
    end = DAY0 + timedelta(days=59)
    data = [(u, end - timedelta(days=len(y) - 1 - i), None if np.isnan(v) else float(v)) for u, y in rows.items() for i, v in enumerate(y)]
    data += [("trend", end + timedelta(days=3), 1e6), ("void", end, None)]
    s = spark.createDataFrame(data, "unique_id string, ds date, y double").repartition(3)
    fitted = theta.fit_theta(s, end)
    found = {r.unique_id: r for r in fitted.collect()}
    assert set(found) == set(rows)
    ahead = {(r.unique_id, (r.ds - end).days): r.yhat for r in theta.forecast_theta(fitted, end, 10).collect()}
    for u, y in rows.items():
        alpha, weight, want = theta_by_force(y, theta.GRID, 10)
        assert (found[u].alpha, found[u].theta) == (alpha, weight), u
        assert [ahead[u, k] for k in range(1, 11)] == pytest.approx(want.tolist(), rel=1e-9, abs=1e-9)
    assert theta.fit_theta(s.limit(0), end).isEmpty()
    with pytest.raises(ValueError):
        theta.fit_theta(s, end, [(0.5, 0.5)])


def test_theta_plan_groups_the_days_once(spark):
    s = spark.range(100).selectExpr("string(id % 3) AS unique_id", "date_add(date'2023-01-01', int(id)) AS ds", "double(id) AS y").repartition(3)
    plan = theta.fit_theta(s, DAY0 + timedelta(days=99))._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan") :]
    assert physical.count("Exchange hashpartitioning(unique_id") == 1 and "Python" not in physical
