"""Grid, repairs, features: toy frames with known answers and brute-force comparisons."""

from __future__ import annotations

from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfspark import contract as C
from shelfspark.operators import encoders, features, grid, impute
from shelfspark.sources.calendar import build_calendar, easter_sunday

DAY0 = date(2023, 1, 1)


def days(n, start=DAY0):
    return [start + timedelta(days=i) for i in range(n)]


@pytest.fixture
def toy(spark):
    rows = [(1, "A", d, float(i), float(i)) for i, d in enumerate(days(20))]
    return spark.createDataFrame(
        rows, "store_id int, category string, date date, units_sold double, replenishment_signal double"
    )


def by_date(df):
    return df.orderBy("date").toPandas()


def test_lags_are_shifted(toy):
    out = by_date(features.add_lags(toy, ("replenishment_signal", "absent"), (1, 7)))
    assert out["replenishment_signal_lag_1d"][5] == out["replenishment_signal"][4]
    assert out["replenishment_signal_lag_7d"][10] == out["replenishment_signal"][3]
    assert pd.isna(out["replenishment_signal_lag_1d"][0])
    assert not [c for c in out.columns if c.startswith("absent")]


def test_rolling_excludes_today_and_matches_pandas(toy):
    spiked = toy.withColumn(
        "units_sold",
        F.when(F.dayofmonth("date") == 11, 999.0).when(F.dayofmonth("date") % 4 != 0, F.col("units_sold")),
    )
    out = by_date(features.add_rolling(spiked, ("units_sold",), (3, 7)))
    assert out["units_sold_roll_mean_3d"][10] < 100
    shifted = out["units_sold"].shift(1)
    for w in (3, 7):
        frame = shifted.rolling(w, min_periods=1)
        np.testing.assert_allclose(out[f"units_sold_roll_mean_{w}d"], frame.mean(), atol=1e-9)
        np.testing.assert_allclose(out[f"units_sold_roll_std_{w}d"], frame.std(), atol=1e-9)


def test_unseen_category_gets_global_train_mean(spark, toy):
    train = toy.withColumn("category", F.when(F.dayofmonth("date") <= 10, "A").otherwise("B"))
    means = encoders.fit_target_means(train)
    probe = spark.createDataFrame([("Z",), ("A",), (None,)], "category string")
    out = {r.category: r.category_target_enc for r in encoders.apply_target_means(probe, means).collect()}
    assert out == {"Z": pytest.approx(9.5), "A": pytest.approx(4.5), None: pytest.approx(9.5)}


def test_ordinal_ranks(spark):
    df = spark.createDataFrame([("C",), ("C+",), ("B",), ("A/B",), ("?",), (None,)], "socioeconomic_level string")
    got = [r[1] for r in encoders.with_socioeconomic_rank(df).collect()]
    assert got == [0, 1, 2, 3, 0, 0]


@pytest.fixture
def pos_toy(spark):
    rows = []
    for i, d in enumerate(days(20)):
        units = None if i == 15 else (1_000_000.0 if i > 15 else float(i))
        rows.append((d, "1", "A", 100.0, 40.0, 60.0, 1000.0, 400.0, 600.0, units, 10.0))
    return spark.createDataFrame(
        rows,
        """date date, store_id string, category string, total_transactions double, cash_transactions double,
        card_transactions double, amount_total double, amount_cash double, amount_card double,
        units_sold double, avg_ticket double""",
    )


def test_medians_come_only_from_the_training_window(pos_toy):
    out = by_date(impute.repair_readings(pos_toy, date(2023, 1, 10)))
    assert out["units_sold"][15] < 100


def test_identities_need_the_card_side(spark, pos_toy):
    holes = pos_toy.withColumns(
        {
            "cash_transactions": F.lit(None).cast("double"),
            "amount_cash": F.lit(None).cast("double"),
            "amount_card": F.when(F.dayofmonth("date") > 1, F.col("amount_card")),
            "avg_ticket": F.lit(None).cast("double"),
        }
    )
    out = by_date(impute.apply_identities(holes))
    assert (out["cash_transactions"] == 40).all()
    assert pd.isna(out["amount_cash"][0]) and (out["amount_cash"][1:] == 400).all()
    assert (out["avg_ticket"] == 10).all()


def test_weekday_then_category_median_against_pandas(spark):
    rng = np.random.default_rng(3)
    rows = [
        (d, s, c, 10, 4, 6, 100.0, 40.0, 60.0, None if rng.random() < 0.4 else float(rng.integers(1, 50)), 10.0)
        for s in ("1", "2")
        for c in ("A", "B")
        for d in days(30)
    ]
    columns = [
        "date", "store_id", "category", "total_transactions", "cash_transactions", "card_transactions",
        "amount_total", "amount_cash", "amount_card", "units_sold", "avg_ticket",
    ]
    df = spark.createDataFrame(
        rows,
        "date date, store_id string, category string, total_transactions int, cash_transactions int, "
        "card_transactions int, amount_total double, amount_cash double, amount_card double, units_sold double, "
        "avg_ticket double",
    )
    for bound in (date(2023, 1, 12), None):
        want = pd.DataFrame(rows, columns=columns)
        want["w"] = pd.to_datetime(want["date"]).dt.dayofweek
        ref = want if bound is None else want[want["date"] <= bound]
        week = ref.groupby(["store_id", "category", "w"])["units_sold"].median()
        filled = want["units_sold"].fillna(
            pd.Series([week.get((r.store_id, r.category, r.w), np.nan) for r in want.itertuples()])
        )
        basis = filled if bound is None else ref["units_sold"]
        fallback = basis.groupby(ref["category"]).median()
        want["units_sold"] = filled.fillna(want["category"].map(fallback))
        order = ["store_id", "category", "date"]
        got = impute.repair_readings(df, bound).toPandas().sort_values(order)["units_sold"]
        np.testing.assert_allclose(got, want.sort_values(order)["units_sold"])


def test_grid_equals_cross_join(spark):
    facts = spark.createDataFrame(
        [
            (DAY0, "s1", "A", 1.0), (DAY0 + timedelta(3), "s1", "A", 2.0), (DAY0 + timedelta(3), "s1", "A", 3.0),
            (DAY0 + timedelta(5), "s2", "B", None), (DAY0 + timedelta(1), "gone", "A", 9.0),
            (DAY0 + timedelta(2), "s1", None, 9.0), (DAY0 - timedelta(1), "s1", "A", 9.0),
            (DAY0 + timedelta(4), "s2", "A", 4.0), (DAY0 + timedelta(40), "s2", "A", 9.0),
        ],
        "date date, store_id string, category string, amount_total double",
    )
    stores = spark.createDataFrame([("s1", "Express"), ("s2", "Bodega"), ("s3", None)], "store_id string, fmt string")
    calendar = spark.createDataFrame([(d,) for d in days(7) if d != DAY0 + timedelta(4)], "date date")
    cells = calendar.crossJoin(stores.select("store_id")).crossJoin(
        facts.select("category").where("category IS NOT NULL").distinct()
    )
    want = cells.join(facts, ["date", "store_id", "category"], "left").join(stores, "store_id", "left")
    got = grid.flag_outages(grid.densify(facts, stores, calendar))
    columns = ["date", "store_id", "category", "amount_total", "fmt"]
    assert sorted(map(str, got.select(columns).collect())) == sorted(map(str, want.select(columns).collect()))
    assert got.where("amount_total IS NULL").count() == got.agg(F.sum("pos_outage_flag")).first()[0]


def test_grid_moves_facts_once_and_never_crosses(spark, small):
    from registry.common import inputs
    from shelfspark.plans import training

    i = inputs(spark, small)
    grown = features.engineer_features(
        grid.repaired_grid(i.facts, i.stores, i.calendar, i.splits.train_end), i.calendar
    )
    plan = grown._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("Subquery")] if "Subquery" in plan else plan
    assert "Cartesian" not in plan and "BroadcastNestedLoop" not in plan
    assert plan.count("hashpartitioning(store_id") == 1
    assert "SortMergeJoin" not in above
    assert training.split_counts(training.panel(i), i.splits).count() == 3


def test_master_leaves_units_of_empty_cells_unknown(spark, small):
    from registry.common import inputs
    from shelfspark.plans import training

    empty = training.panel(inputs(spark, small, "region")).where("pos_outage_flag = 1")
    row = empty.agg(
        F.count("units_sold"), F.count("avg_ticket"), F.sum("amount_total"), F.count("*"), F.count("region")
    ).first()
    assert row[:3] == (0, 0, 0.0) and row[3] == row[4] > 0


def test_splits_are_chronological():
    for s in (C.RETAIL_SPLITS,):
        assert s.train_end < s.val_start <= s.val_end < s.holdout_start <= s.holdout_end
        assert s.holdout_days == 29


def test_splits_cover_every_day_once(spark):
    s = C.RETAIL_SPLITS
    calendar = build_calendar(spark, s.start, s.holdout_end)
    counts = {r[0]: r[1] for r in features.with_split(calendar, s).groupBy("split").count().collect()}
    assert counts == {"TRAIN": 334, "VAL": 62, "HOLDOUT": 29}


def test_gap_safe_selection():
    columns = [
        "replenishment_signal_lag_1d", "replenishment_signal_lag_7d", "replenishment_signal_lag_14d",
        "units_sold_roll_mean_7d", "cash_ratio_roll_30d", "size_sqm",
    ]
    safe = features.gap_safe_columns(columns)
    assert safe[:14] == list(C.STATIC_FEATURES)
    assert safe[14:] == ["replenishment_signal_lag_7d", "replenishment_signal_lag_14d"]
    assert [c for c in columns if features.leak_reason(c)] == [columns[0], columns[3], columns[4]]


def test_calendar_rules(spark):
    assert [easter_sunday(y).strftime("%m-%d") for y in range(1995, 2002)] == [
        "04-16", "04-07", "03-30", "04-12", "04-04", "04-23", "04-15",
    ]
    calendar = build_calendar(spark, date(2023, 1, 1), date(2024, 2, 29)).toPandas().set_index("date")
    assert len(calendar) == 425
    assert calendar.loc[date(2023, 1, 15), "is_payday"] and calendar.loc[date(2024, 2, 29), "is_payday"]
    assert calendar.loc[date(2023, 1, 1), "day_of_week"] == 6
    assert list(calendar.index[calendar["is_buen_fin"]]) == [date(2023, 11, d) for d in (17, 18, 19, 20)]
    assert calendar["is_navidad_season"].sum() == 6 + 17 + 6


def test_rolling_columns_come_from_kernels_and_equal_frames(spark):
    """No sliding frame is left in the plan; the kernels on cells and on finished panels equal the frames of plain SQL, with
    unknown readings, several facts on a day, days the calendar skips and a store outside the dimension."""
    rng = np.random.default_rng(5)
    rows = [
        (d, s, c, None if rng.random() < 0.1 else float(rng.integers(0, 9)), float(rng.integers(0, 5)), None if rng.random() < 0.3 else float(rng.integers(1, 50)))
        for s in ("s1", "s2", "gone")
        for c in ("A", "B")
        for d in days(60)
        if rng.random() < 0.5
    ]
    facts = spark.createDataFrame([*rows, (days(60)[7], "s1", "A", 1.0, 1.0, 2.0), (days(60)[7], "s1", "A", 9.0, 1.0, 2.0), (days(60)[7], "s1", None, 1.0, 1.0, 2.0)],
                                  "date date, store_id string, category string, amount_total double, amount_cash double, units_sold double")
    stores = spark.createDataFrame([("s1", 5), ("s2", None), ("s3", 7)], "store_id string, size_sqm int")
    calendar = spark.createDataFrame([(d,) for d in days(60) if d.day != 11], "date date")
    wanted = features.window_features(facts.columns)
    zeros = ("amount_total", "amount_cash")
    measures = ["amount_total", "amount_cash", "units_sold"]
    opened = grid.open_series(facts, stores, calendar)
    made = grid.unfold_with_history(opened, calendar, measures, wanted, zeros=zeros)
    plain = grid.flag_outages(grid.densify(facts, stores, calendar)).fillna(0, list(zeros))
    assert "Window" not in (plan := features.add_window_features(plain)._jdf.queryExecution().optimizedPlan().toString())[: plan.index("Generate")]
    frame = "OVER (PARTITION BY store_id, category ORDER BY date ROWS BETWEEN {} PRECEDING AND 1 PRECEDING)"
    columns = [f"lag({t}, {k}) OVER (PARTITION BY store_id, category ORDER BY date) AS {name}" for name, (t, k) in wanted.lags.items()]
    columns += [f"{'avg' if kind == 'mean' else 'stddev_samp'}({t}) {frame.format(w)} AS {name}" for name, (t, kind, w) in wanted.rolling.items()]
    share = "sum({}) " + frame.format(30)
    ratio = f"{share.format('amount_cash')} / ({share.format('amount_total')} + 1e-5)"
    columns.append(f"if({ratio} IS NULL, NULL, least(1.0, {ratio})) AS cash_ratio_roll_30d")
    # The doubled day has no order of its own, so the series that has it is compared cell by cell without windows.
    once = "NOT (store_id = 's1' AND category = 'A')"
    names = ["store_id", "category", "date", "size_sqm", *measures, "pos_outage_flag"]

    def table(df, keep):
        return df.select(keep).toPandas().sort_values(names[:3] + ["amount_total"]).reset_index(drop=True)

    want = plain.selectExpr("*", *columns)
    assert made.count() == plain.count() > 58 * 6
    pd.testing.assert_frame_equal(table(made, names), table(want, names))
    for got in (made, features.add_window_features(plain)):
        pd.testing.assert_frame_equal(table(got.where(once), names + wanted.names), table(want.where(once), names + wanted.names))
    few = grid.unfold_with_history(opened, calendar, measures, features.rolling_features(["units_sold"], (7,)), ["size_sqm"], zeros)
    assert few.columns == ["date", "store_id", "category", "size_sqm", "units_sold_roll_mean_7d", "units_sold_roll_std_7d"]
    assert few.count() == plain.count()
