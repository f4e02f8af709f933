"""Series, folds, smoothing, scores, gate and boosted models."""

from __future__ import annotations

from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfspark.functions import sweeps
from shelfspark.operators import boosting, scoring, series, smoothing

DAY0 = date(2023, 1, 1)


@pytest.fixture
def master(spark):
    rows = [
        (s, c, DAY0 + timedelta(days=i), None if (s, c, i) == (1, "A", 3) else float(i))
        for s in (1, 2)
        for c in ("A", "B")
        for i in range(10)
    ]
    return spark.createDataFrame(rows, "store_id int, category string, date date, replenishment_signal double")


def test_series_are_long_filled_and_bounded(master):
    s = series.build_series(master, date(2023, 1, 10)).orderBy("unique_id", "ds").toPandas()
    assert list(s.columns) == ["unique_id", "ds", "y"]
    assert s["unique_id"].nunique() == 4 and s["unique_id"][0] == "1_A" and s["y"].notna().all()
    assert s["y"][3] == 2.0
    assert series.build_series(master, date(2023, 1, 5)).agg(F.max("ds")).first()[0] == date(2023, 1, 5)


def test_leading_gap_never_borrows_from_a_neighbour(spark):
    rows = [(1, "A", DAY0, 1.0), (1, "B", DAY0, None), (1, "B", DAY0 + timedelta(1), 5.0), (1, "C", DAY0, None)]
    df = spark.createDataFrame(rows, "store_id int, category string, date date, replenishment_signal double")
    got = {(r.unique_id, r.ds): r.y for r in series.build_series(df, date(2023, 2, 1)).collect()}
    assert got == {("1_A", DAY0): 1.0, ("1_B", DAY0): 5.0, ("1_B", DAY0 + timedelta(1)): 5.0}


def test_keyed_series_move_no_cell(spark, small):
    from registry.common import inputs
    from shelfspark.plans import training

    s = series.build_series(training.panel(inputs(spark, small)), date(2001, 10, 6), keyed=True)
    for df in (series.seasonal_naive_folds(s, date(2001, 10, 6)), series.series_vectors(s)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning(unique_id" not in plan
        assert plan.count("Exchange hashpartitioning(store_id") == 1


def test_cutoffs_of_the_published_setup():
    got = [d.isoformat()[5:] for d in series.cutoffs(date(2024, 1, 31))]
    assert got == ["12-06", "12-13", "12-20", "12-27", "01-03", "01-10", "01-17", "01-24"]


def weekly(spark, n_series=5, days=140, noise=1.0, seed=0):
    rng = np.random.default_rng(seed)
    wave = np.array([0, 4, 8, 3, -2, -6, -7.0])
    rows = []
    for k in range(n_series):
        y = 50 + 10 * k + 0.2 * np.arange(days) + wave[np.arange(days) % 7] + rng.normal(0, noise, days)
        rows += [(f"s_{k}", DAY0 + timedelta(days=i), float(v)) for i, v in enumerate(y)]
    return spark.createDataFrame(rows, "unique_id string, ds date, y double")


def test_smoothing_beats_the_seasonal_naive(spark):
    s = weekly(spark, noise=3.0)
    end = DAY0 + timedelta(days=139)
    folds = smoothing.model_folds(s, end, smoothing.MODELS).unionByName(series.seasonal_naive_folds(s, end))
    scores = scoring.score(folds)
    ranked = {r.model: r for r in scoring.ranking(scores).collect()}
    assert ranked[scoring.BASELINE].place == 3
    assert ranked["AutoETS"].beats_baseline and ranked["DynamicOptimizedTheta"].beats_baseline
    gate = scoring.gate(scores).first()
    assert gate.passes_baseline_gate and gate.savings_mxn > 0
    assert {r.n for r in scores.collect()} == {5 * 8 * 7}


def test_folds_do_not_see_the_future_or_the_partitioning(spark):
    s = weekly(spark, 3)
    end = DAY0 + timedelta(days=139)
    first_cutoff = series.cutoffs(end)[0]
    bends = [s.withColumn("y", F.when(F.col("ds") > first_cutoff, v).otherwise(F.col("y"))) for v in (1e6, 0.0, -1.0)]
    keep = ["unique_id", "model", "ds", "yhat"]

    def fold(df):
        folds = smoothing.model_folds(df, end, smoothing.MODELS).where(F.col("cutoff") == first_cutoff)
        return folds.select(keep).toPandas().sort_values(keep[:3]).reset_index(drop=True)

    base = fold(s)
    pd.testing.assert_frame_equal(base, fold(s.repartition(7)))
    for bent in bends:
        np.testing.assert_allclose(base["yhat"], fold(bent)["yhat"])


def test_series_need_one_reading_a_day(spark):
    s = weekly(spark, 2)
    end = DAY0 + timedelta(days=139)
    for odd in (s.where(F.col("ds") != DAY0 + timedelta(days=9)), s.union(s.where(F.col("ds") == DAY0 + timedelta(days=9)))):
        with pytest.raises(Exception, match="not one reading a day"):
            smoothing.model_folds(odd, end).collect()


def test_sweep_matches_a_plain_loop():
    rng = np.random.default_rng(2)
    y, m, h = 20 + rng.normal(0, 2, (1, 40)), 7, 3
    grid = sweeps.ets_grid()
    paths, _ = sweeps.sweep_ets(y, [30, 40], h, m, multiplicative=False)

    def plain(stop):
        best = None
        for p in range(len(grid["alpha"])):
            a, b, phi, t, g, s = (grid[k][p] for k in ("alpha", "beta", "phi", "trend", "gamma", "season"))
            level = y[0, :14].mean()
            slope = (y[0, 7:14].mean() - y[0, :7].mean()) / 7 * t
            wave = [(y[0, k:14:7].mean() - level) * s for k in range(7)]
            sse = 0.0
            for i in range(stop):
                e = y[0, i] - (level + phi * slope) - wave[i % 7]
                level, slope = level + phi * slope + a * e, phi * slope + b * e
                wave[i % 7] += g * e
                sse += e * e
            free = 2 + 2 * t + (phi < 1) + 8 * s
            aicc = stop * np.log(sse / stop) + 2 * free + 2 * free * (free + 1) / max(stop - free - 1, 1)
            reach = np.cumsum(phi ** np.arange(1, h + 1))
            path = [level + r * slope + wave[(stop + k) % 7] for k, r in enumerate(reach)]
            if best is None or aicc < best[0]:
                best = (aicc, path)
        return best[1]

    np.testing.assert_allclose(paths[0, 0], plain(30))
    np.testing.assert_allclose(paths[0, 1], plain(40))


def test_blind_forecast_and_summary(spark):
    s = weekly(spark, 2)
    ahead = smoothing.forecast_ahead(s, DAY0 + timedelta(days=139), 29)
    got = series.forecast_summary(ahead).first()
    assert got.forecast_records_count == 58
    assert ahead.agg(F.min("ds")).first()[0] == DAY0 + timedelta(days=140)
    assert 50 < got.min_predicted_signal < got.max_predicted_signal < 130


def test_short_series_still_forecast(spark):
    rows = [("a_b", DAY0 + timedelta(days=i), 5.0) for i in range(10)]
    s = spark.createDataFrame(rows, "unique_id string, ds date, y double")
    ahead = smoothing.forecast_ahead(s, DAY0 + timedelta(days=9), 7, smoothing.MODELS).toPandas()
    assert len(ahead) == 14
    np.testing.assert_allclose(ahead["yhat"], 5.0)


def test_sample_is_stable(spark):
    s = weekly(spark, 5, 10)
    ids = {r[0] for r in series.sample_series(s, 2).select("unique_id").distinct().collect()}
    again = {r[0] for r in series.sample_series(s.repartition(5), 2).select("unique_id").distinct().collect()}
    assert len(ids) == 2 and ids == again


def pairs(spark, y, yhat):
    rows = list(zip(map(float, y), map(float, yhat), strict=True))
    return spark.createDataFrame([("m", *r) for r in rows], "model string, y double, yhat double")


def test_metric_values(spark):
    assert scoring.score(pairs(spark, [100, 100], [110, 90])).first().wape == pytest.approx(0.1)
    zero = pairs(spark, [0, 0], [5, 5])
    assert scoring.score(zero).first().wape == 0.0
    assert scoring.score(zero, on_zero=None).first().wape is None
    assert scoring.score(pairs(spark, [0, 0], [3, 4])).first().rmse == pytest.approx(np.sqrt(12.5))
    over = scoring.score(pairs(spark, [10], [12])).first()
    under = scoring.score(pairs(spark, [10], [8])).first()
    assert (over.overstock_units, over.stockout_units) == (2.0, 0.0)
    assert over.overstock_cost_mxn == pytest.approx(45.0) and over.stockout_cost_mxn == 0.0
    assert under.total_financial_loss_mxn == pytest.approx(2 * over.total_financial_loss_mxn)


def test_gate_passes_a_tie(spark):
    df = pairs(spark, [10], [12])
    both = df.withColumn("model", F.lit("x")).unionByName(df.withColumn("model", F.lit(scoring.BASELINE)))
    assert scoring.gate(scoring.score(both)).first().passes_baseline_gate


def test_boosted_model_life_cycle(spark, tmp_path):
    rng = np.random.default_rng(0)
    x = rng.uniform(0, 10, (300, 2))
    rows = [(float(a), float(b), float(3 * a + (b > 5) * 10)) for a, b in x]
    df = spark.createDataFrame(rows, "a double, b double, replenishment_signal double")
    model = boosting.DemandRegressor("deep", {"n_trees": 5, "max_depth": 3, "learning_rate": 0.3})
    with pytest.raises(RuntimeError):
        model.predict(df)
    model.fit(df, ["a", "b"], df.limit(50))
    assert model.feature_importance().first().feature == "a"
    with pytest.raises(ValueError):
        model.predict(df.drop("b"))
    model.save(str(tmp_path / "m"))
    loaded = boosting.DemandRegressor.load(str(tmp_path / "m"))
    assert loaded.features == ["a", "b"]
    a = model.predict(df).agg(F.sum(boosting.PREDICTION)).first()[0]
    assert loaded.predict(df).agg(F.sum(boosting.PREDICTION)).first()[0] == pytest.approx(a)


def test_early_stop_waits():
    assert boosting.rounds_kept([5, 6, 4, 4, 4.5]) == 3
    assert boosting.rounds_kept([3.0, *[4.0] * 29, 2.0]) == 31 and boosting.rounds_kept([3.0, *[4.0] * 30, 2.0]) == 1
    assert boosting.rounds_kept([1.0]) == 1


def test_early_stop_keeps_the_best_round(spark, tmp_path):
    rng = np.random.default_rng(9)
    x = rng.uniform(0, 10, (170, 2))
    rows = [(float(a), float(b), float(3 * a + 10 * np.sin(b) + rng.normal(0, 4))) for a, b in x]
    schema = "a double, b double, replenishment_signal double"
    train, val = (spark.createDataFrame(r, schema).coalesce(1) for r in (rows[:150], rows[150:]))
    settings = {"n_trees": 20, "max_depth": 2, "learning_rate": 0.3, "least_rows": 1}
    model = boosting.DemandRegressor("deep", settings).fit(train, ["a", "b"], val)
    whole = boosting.DemandRegressor("deep", settings).fit(train, ["a", "b"])
    errors = model.val_errors
    first_rise = next(i for i in range(1, 20) if errors[i] >= errors[i - 1])
    assert whole.trees == 20 and model.trees == boosting.rounds_kept(errors) > first_rise
    y = F.col("replenishment_signal")
    error = model.predict(val).agg(F.avg((F.col(boosting.PREDICTION) - y) ** 2)).first()[0]
    assert error == pytest.approx(errors[model.trees - 1])
    assert model.feature_importance().count() == 2
    model.save(str(tmp_path / "m"))
    assert boosting.DemandRegressor.load(str(tmp_path / "m")).trees == model.trees


def test_rounds_after_the_stop_are_not_fitted(spark, monkeypatch):
    monkeypatch.setattr(boosting, "PATIENCE", 2)
    monkeypatch.setattr(boosting, "rounds_kept", lambda errors: 1)
    df = spark.createDataFrame([(float(i), float(i % 7)) for i in range(60)], "a double, replenishment_signal double").coalesce(1)
    model = boosting.DemandRegressor("deep", {"n_trees": 50, "max_depth": 2, "least_rows": 1}).fit(df, ["a"], df)
    assert len(model.val_errors) == 3 and model.trees == 1


def best_first_by_force(x, g, max_leaves, max_depth, penalty, least_rows):
    """Leaves of one tree as sets of rows, grown leaf by leaf over all cuts of all features, missing readings on either side."""

    def gain_of(rows):
        best = (1e-9, None)
        whole = g[rows].sum() ** 2 / (len(rows) + penalty)
        for f in range(x.shape[1]):
            known = np.unique(x[rows, f][~np.isnan(x[rows, f])])
            for lost_left in (False, True):
                for cut in known:
                    left = np.where(np.isnan(x[rows, f]), lost_left, x[rows, f] <= cut)
                    n = left.sum()
                    if min(n, len(rows) - n) < max(1, least_rows):
                        continue
                    gain = g[rows[left]].sum() ** 2 / (n + penalty) + g[rows[~left]].sum() ** 2 / (len(rows) - n + penalty) - whole
                    if gain > best[0] * (1 + 1e-9):
                        best = (gain, (rows[left], rows[~left]))
        return best

    leaves = [(0, np.arange(len(g)), *gain_of(np.arange(len(g))))]
    while max_leaves is None or len(leaves) < max_leaves:
        able = [i for i, leaf in enumerate(leaves) if leaf[3] is not None and leaf[0] < max_depth]
        if not able:
            break
        depth, _, _, sides = leaves.pop(max(able, key=lambda i: leaves[i][2]))
        leaves += [(depth + 1, side, *gain_of(side)) for side in sides]
    return [rows for _, rows, _, _ in leaves]


@pytest.mark.parametrize(("preset", "leaves", "depth", "rows_a_task"), [("deep", 9, 5, 50), ("deep", 31, 8, 10**6), ("shallow", None, 3, 60)])
def test_trees_by_force(spark, monkeypatch, preset, leaves, depth, rows_a_task):
    """Two rounds equal leaf-by-leaf growth over all cuts, with missing readings, on one task and on several."""
    monkeypatch.setattr(boosting, "TASK_ROWS", rows_a_task)
    rng = np.random.default_rng(7)
    x = np.round(rng.uniform(0, 9, (240, 3)), 1)
    x[rng.random((240, 3)) < 0.15] = np.nan
    y = np.nan_to_num(x[:, 0], nan=20.0) * 2 + np.nan_to_num(x[:, 1], nan=-3.0) ** 2 + rng.normal(0, 1, 240)
    plain = [(*(None if np.isnan(v) else float(v) for v in row), float(t)) for row, t in zip(x, y, strict=True)]
    df = spark.createDataFrame([*plain, (1.0, None, 2.0, None)], "a double, b double, c double, replenishment_signal double").repartition(3)
    settings = {"n_trees": 2, "max_depth": depth, "max_leaves": leaves, "learning_rate": 0.5, "least_rows": 5}
    model = boosting.DemandRegressor(preset, settings).fit(df, ["a", "b", "c"])
    s = model.settings()
    score = np.full(240, y.mean())
    for _ in range(2):
        gradient = score - y
        for rows in best_first_by_force(x, gradient, leaves, depth, s["penalty"], 5):
            score[rows] -= 0.5 * gradient[rows].sum() / (len(rows) + s["penalty"])
    got = {tuple(r)[:4]: r[4] for r in model.predict(df.dropna(subset=["replenishment_signal"])).collect()}
    assert [got[r] for r in plain] == pytest.approx(score.tolist(), rel=1e-9)
    assert model.predict(df).where(F.col(boosting.PREDICTION).isNull()).isEmpty()


def test_gaps_are_worth_rows(spark):
    """Rows with planted gaps are kept, and the side that each split learned for them beats the mean."""
    rows = [(None if i % 3 == 0 else float(i % 50), 100.0 if i % 3 == 0 else float(i % 50)) for i in range(600)]
    df = spark.createDataFrame(rows, "a double, replenishment_signal double")
    model = boosting.DemandRegressor("shallow", {"n_trees": 20, "learning_rate": 0.3}).fit(df, ["a"])
    lost = model.predict(df).where("a IS NULL").agg(F.min(boosting.PREDICTION)).first()[0]
    assert lost == pytest.approx(100, abs=2)


def test_importance_of_splits_and_of_gain(spark):
    rng = np.random.default_rng(1)
    rows = [(float(a), float(b), float(50 * (a > 0.5) + np.sin(9 * b))) for a, b in rng.uniform(0, 1, (400, 2))]
    df = spark.createDataFrame(rows, "a double, b double, replenishment_signal double")
    model = boosting.DemandRegressor("deep", {"n_trees": 10, "learning_rate": 0.5}).fit(df, ["a", "b"])
    by_splits, by_gain = (dict(map(tuple, model.feature_importance(kind=k).collect())) for k in ("splits", "gain"))
    assert sum(by_splits.values()) == pytest.approx(1) and sum(by_gain.values()) == pytest.approx(1)
    assert by_gain["a"] > 0.9 and by_splits["b"] > by_splits["a"]


def test_vectors_come_from_facts_and_equal_the_long_series(spark):
    """The kernel's vectors equal those of the unfolded panel (leading gaps, series without values, days after the end, stores
    that share an id text), no cell is sorted or windowed for them, and the same folds, samples and rankings come of both."""
    from shelfspark import contract as C
    from shelfspark.plans import challenge, training

    rng = np.random.default_rng(8)
    day = [DAY0 + timedelta(days=i) for i in range(120)]
    end = day[109]
    rows = [
        (d, s, c, 10, 4, 6, 9.0, 4.0, 5.0, None if rng.random() < 0.2 else 3.0, 1.0, 0, None if rng.random() < 0.2 else float(rng.integers(1, 60)))
        for s in ("x", "x_A", "late", "gone")
        for c in ("A", "A_A")
        for d in day[40 if s == "late" else 0 :]
        if rng.random() < 0.4
    ]
    rows += [(d, "never", "A", 1, 1, 0, 1.0, 1.0, 0.0, 1.0, 1.0, 0, None if d <= end else 7.0) for d in day[::7]]
    stores = [(s, "Express", "r", 5, 1, 2000, "C", True, False) for s in ("x", "x_A", "late", "never")]
    from shelfspark.sources.calendar import build_calendar

    i = training.Inputs(
        spark.createDataFrame(rows, C.TRANSACTIONS),
        spark.createDataFrame(stores, C.STORES),
        build_calendar(spark, day[0], day[-1]),
        C.Splits(day[0], day[60], day[61], end, day[110], day[-1]),
    )
    panel, vectors = training.panel(i), training.panel_vectors(i, end)
    plan = vectors._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode" not in plan and "Window" not in plan

    def rows_of(df):
        return sorted(map(str, df.collect()))

    long = series.build_series(panel, end, keyed=True)
    assert rows_of(series.series_vectors(vectors)) == rows_of(series.series_vectors(long)) and vectors.count() == 6
    assert rows_of(series.rolling_folds(vectors, end)) == rows_of(series.rolling_folds(long, end))
    options = {"horizon": 14, "step": 7, "windows": 3}
    assert rows_of(series.rolling_folds(vectors, end, **options)) == rows_of(series.rolling_folds(long, end, **options))
    assert rows_of(smoothing.model_folds(vectors, end)) == rows_of(smoothing.model_folds(long, end))
    for plan_of in (lambda s: training.rolling_forecasts(s, i.splits), lambda s: training.blind_forecast(s, i.splits)):
        assert rows_of(plan_of(vectors)) == rows_of(plan_of(panel))
    ranked = [challenge.challenge(s, end, 3).orderBy("stage", "place").toPandas() for s in (vectors, panel)]
    pd.testing.assert_frame_equal(*ranked)


@pytest.mark.parametrize("preset", ["deep", "shallow"])
def test_rows_of_one_task_are_grown_without_a_job_a_depth(spark, monkeypatch, preset):
    """One task gives the trees and errors of many, stops at the same round, and needs a job for many trees."""
    rng = np.random.default_rng(4)
    x = np.round(rng.uniform(0, 9, (400, 3)), 1)
    x[rng.random((400, 3)) < 0.1] = np.nan
    rows = [(*(None if np.isnan(v) else float(v) for v in r), float(np.nan_to_num(r[0]) * 3 + np.nan_to_num(r[1]) ** 2 + rng.normal(0, 20))) for r in x]
    schema = "a double, b double, c double, replenishment_signal double"
    train, val = (spark.createDataFrame(r, schema).coalesce(1) for r in (rows[:250], rows[250:]))
    settings = {"n_trees": 9, "max_depth": 3, "learning_rate": 0.9, "least_rows": 3}
    monkeypatch.setattr(boosting, "PATIENCE", 3)
    tracker, fitted = spark.sparkContext.statusTracker(), []
    for room in (10**6, 0):
        monkeypatch.setattr(boosting, "ONE_TASK", room)
        spark.sparkContext.setJobGroup(f"fit {preset} {room}", "")
        fitted.append(boosting.DemandRegressor(preset, settings).fit(train, ["a", "b", "c"], val))
    one, many = fitted
    pd.testing.assert_frame_equal(one.nodes, many.nodes)
    assert one.trees == many.trees and one.val_errors == pytest.approx(many.val_errors, rel=1e-12)
    jobs = [len(tracker.getJobIdsForGroup(f"fit {preset} {room}")) for room in (10**6, 0)]
    assert jobs[0] < 12 < jobs[1]
    monkeypatch.setattr(boosting, "ONE_TASK", 10**6)
    monkeypatch.setattr(boosting, "TREES_AT_ONCE", 2)
    pd.testing.assert_frame_equal(boosting.DemandRegressor(preset, settings).fit(train, ["a", "b", "c"], val).nodes, one.nodes)
