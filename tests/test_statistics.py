"""Quantiles, moments, profiles, anomalies, audit and documents."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfspark.functions import forest
from shelfspark.functions.moments import sample_kurtosis, sample_skewness
from shelfspark.operators import anomaly, audit, columns, overview, profile, quality, quantiles
from shelfspark.sources import retail_csv
from shelfspark.sources.documents import flatten, read_metrics, write_metrics


@pytest.mark.parametrize("parts", [1, 40])
def test_exact_quantiles_on_a_hot_group(spark, parts):
    rng = np.random.default_rng(1)
    frame = pd.DataFrame(
        {
            "g": np.where(rng.random(20_000) < 0.9, "hot", "cold"),
            "a": rng.lognormal(3, 1, 20_000),
            "b": rng.integers(0, 5, 20_000).astype(float),
        }
    )
    frame.loc[rng.random(20_000) < 0.1, "a"] = np.nan
    df = spark.createDataFrame(frame).withColumn("a", F.nanvl("a", F.lit(None).cast("double")))
    probs = [0.0, 0.01, 0.25, 0.5, 0.99, 1.0]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = quantiles.exact_quantiles(df, ["a", "b"], probs, ["g"]).toPandas()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(got) == 24
    for r in got.itertuples():
        values = frame.loc[frame["g"] == r.g, r.column].dropna()
        assert r.n == len(values)
        assert r.q == pytest.approx(np.quantile(values, r.p), abs=1e-9)


def test_quantiles_of_tiny_groups(spark):
    df = spark.createDataFrame([("x", 1.0), ("y", 1.0), ("y", 4.0), ("z", None)], "g string, v double")
    got = {r.g: r.q for r in quantiles.exact_quantiles(df, ["v"], [0.5], ["g"]).collect()}
    assert got == {"x": 1.0, "y": 2.5}


def test_shape_statistics_match_pandas(spark):
    values = [1.0, 2.0, 2.5, 9.0, 4.0, 4.0, 30.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    row = df.agg(sample_skewness(F.col("v")), sample_kurtosis(F.col("v"))).first()
    assert row[0] == pytest.approx(pd.Series(values).skew())
    assert row[1] == pytest.approx(pd.Series(values).kurt())
    short = df.limit(2).agg(sample_skewness(F.col("v")), sample_kurtosis(F.col("v"))).first()
    assert list(short) == [None, None]


def test_shares_of_nothing_are_null(spark):
    empty = spark.sql(
        """SELECT date'2024-01-01' AS date, 's' AS store_id, 'A' AS category, 1.0D AS amount_total,
        cast(null AS double) AS amount_cash, 1.0D AS amount_card, 0 AS total_transactions, 0 AS cash_transactions,
        0 AS card_transactions, cast(null AS double) AS units_sold, cast(null AS double) AS avg_ticket,
        0 AS has_promotion, cast(null AS double) AS replenishment_signal"""
    )
    shares = profile.payment_shares(empty).first()
    assert shares.total_amount_cash is None and shares.cash_tx_share_pct is None
    assert profile.zero_inflation(empty).first().zero_inflation_pct is None
    assert profile.promotion_split(empty).first().mean_units_sold is None
    assert profile.promotion_lift(empty).first().sales_lift_pct is None
    assert columns.null_totals(empty.limit(0)).first().global_null_percentage is None


def test_null_is_a_value_for_cardinality(spark):
    df = spark.createDataFrame([("a", 1), (None, 1), ("a", 1)], "c string, d int")
    got = {r.column: r.cardinality for r in columns.cardinalities(df).collect()}
    assert got == {"c": 2, "d": 1}
    assert [r[0] for r in columns.constant_columns(df).collect()] == ["d"]
    assert columns.duplicate_rows(df).first()[0] == 1


def test_whitespace_covers_tabs(spark):
    df = spark.createDataFrame([(" a",), ("b\t",), ("\n ",), ("c",), ("",)], "t string")
    assert tuple(columns.whitespace_report(df).first()) == ("t", 3, 2)


def test_histogram_keeps_every_row(spark):
    df = spark.range(100).select(F.col("id").cast("double").alias("v"), F.lit(7).alias("same"))
    got = columns.histogram(df, ["v", "same"]).toPandas()
    want, _ = np.histogram(np.arange(100), bins=15)
    assert got[got["column"] == "v"].sort_values("bin")["n"].tolist() == want.tolist()
    assert got[got["column"] == "same"]["n"].tolist() == [100]


def test_recent_window_has_eight_days(spark):
    df = spark.sql("SELECT date_add(date'2024-01-01', cast(id as int)) AS date, cast(null as double) AS s FROM range(30)")
    assert tuple(profile.recent_signal_nulls(df, target="s").first()) == (8, 100.0)


def test_blind_window_and_continuity(spark):
    df = spark.sql(
        """SELECT 's' AS store_id, 'A' AS category, date_add(date'2024-01-01', cast(id as int)) AS date,
        CASE WHEN id < 7 THEN 1.0D END AS replenishment_signal FROM range(10) WHERE id <> 4"""
    )
    assert quality.blind_windows(df).first()["blind_days"] == 3
    assert overview.store_continuity(df).first()["missing_days"] == 1


def test_forest_finds_planted_outliers(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(100, 5, (2000, 3))
    x[:10] = [900, 900, 900]
    frame = pd.DataFrame(x, columns=list(anomaly.C.FOREST_FEATURES))
    frame["store_id"], frame["category"] = [str(i) for i in range(2000)], "A"
    frame["date"] = pd.Timestamp("2024-01-01").date()
    df = spark.createDataFrame(frame)
    model = anomaly.fit_forest(df)
    scored = anomaly.score_rows(df, model)
    flagged = anomaly.flag_anomalies(scored).toPandas()
    assert len(flagged) == 20
    assert {str(i) for i in range(10)} <= set(flagged["store_id"])
    again = anomaly.fit_forest(df.repartition(7))
    assert len(model.trees) == len(again.trees) == 100
    for a, b in zip(model.trees, again.trees, strict=True):
        np.testing.assert_array_equal(a[1], b[1])


def test_forest_walk_matches_a_plain_walk():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(64, 2))
    nodes = pd.DataFrame(forest.grow_tree(x, 1), columns=forest.NODE_COLUMNS[1:]).assign(tree=0)
    packed = forest.pack(nodes)
    table = nodes.set_index("node")

    def walk(row):
        at = 0
        while table.loc[at, "feature"] >= 0:
            f = int(table.loc[at, "feature"])
            at = table.loc[at, "left" if row[f] <= table.loc[at, "threshold"] else "right"]
        return table.loc[at, "reach"]

    want = [-(2.0 ** (-walk(r) / float(forest.average_path(64)))) for r in x]
    np.testing.assert_allclose(forest.normality(x, packed, 64), want)


def test_anomaly_labels_overlap(spark):
    rows = [("2024-12-25", 0.0), ("2024-07-02", 5.0), ("2024-12-25", 5.0)]
    df = spark.createDataFrame(rows, "day string, amount_total double").select(
        F.to_date("day").alias("date"), "amount_total", F.lit(1).alias("cash_transactions"), F.lit(1).alias("units_sold")
    )
    flags = spark.createDataFrame([("2024-12-25", True)], "day string, is_holiday boolean").select(
        F.to_date("day").alias("date"), "is_holiday", *[F.lit(False).alias(c) for c in ("is_buen_fin", "is_navidad_season", "is_payday")]
    )
    got = anomaly.summarize_anomalies(anomaly.classify_anomalies(df, flags)).first()
    assert tuple(got) == (3, 2, 2)


def test_audit_wants_whole_numbers(spark, tmp_path):
    value = {"tables_overview.transactions.row_count": 203958.0, "exact_duplicates.transactions.duplicate_rows": 0.0,
             "cash_vs_card.total_amount": 1234567.891}
    metrics = spark.createDataFrame(list(value.items()), "path string, value double")
    draft = spark.createDataFrame([("203,958 rows, total $1,234,567.89, 10 stores",)], "line string")
    got = {r.fact: r.status for r in audit.audit_draft(draft, metrics).collect()}
    assert got["row count"] == got["total sales"] == audit.PASSED
    assert got["exact duplicates"] == audit.FAILED  # the zero of 10 is no match
    assert got["cash share"] == audit.MISSING
    assert audit.verdict(audit.audit_draft(draft, metrics)).first()["passed"] == 2


def test_documents_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, 2.5, "x"), ("b", 2, None, None)], "k string, n int, v double, t string")
    long = flatten(df, "quality", "p", ["k"])
    back = read_metrics(spark, write_metrics(long, str(tmp_path / "doc")))
    got = {(r.path, r.value, r.text) for r in back.collect()}
    assert {("p.a.n", 1.0, None), ("p.a.v", 2.5, None), ("p.a.t", None, "x"), ("p.b.n", 2.0, None)} <= got


def test_csv_scan_and_text_dates(spark, tmp_path):
    (tmp_path / "stores.csv").write_text(
        "store_id,store_format,region,size_sqm,num_checkouts,opening_year,socioeconomic_level,has_pharmacy,has_fuel_station\n"
        "S1,Express,Norte,100,2,2001,C+,True,False\n"
    )
    header = ",".join(f.name for f in retail_csv.C.TRANSACTIONS)
    (tmp_path / "transactions.csv").write_text(f"{header}\n2023-01-02,S1,Ropa,3,,1,10.5,,4.5,7,,1,\n")
    (tmp_path / "calendar.csv").write_text(",".join(f.name for f in retail_csv.C.CALENDAR) + "\n")
    facts, stores, calendar = retail_csv.read_retail(spark, str(tmp_path))
    row = facts.first()
    assert str(row.date) == "2023-01-02" and row.cash_transactions is None and row.units_sold == 7.0
    assert stores.first().has_pharmacy is True and calendar.count() == 0
    text = retail_csv.read_text_dates(spark, str(tmp_path / "transactions.csv"), retail_csv.C.TRANSACTIONS)
    assert text.first().date == "2023-01-02"
    assert dict(retail_csv.parse_dates(text).dtypes)["date"] == "date"


def test_bad_csv_lines_are_kept_apart(spark, tmp_path):
    head = "date,store_id,category,total_transactions,cash_transactions,card_transactions,amount_total,amount_cash,amount_card,units_sold,avg_ticket,has_promotion,replenishment_signal"
    good = ["2023-01-01,S1,A,3,1,2,10.5,,7.0,2.0,3.5,1,4.0", "2023-01-02,S1,A,,,,,,,,,,"]
    bad = {
        "2023-01-03,S1,A,three,1,2,10.5,,7.0,2.0,3.5,1,4.0": "unreadable",
        "2023-01-04,S1,A,3": "unreadable",
        "2023-01-05,S1,A,3,1,2,10.5,,7.0,2.0,3.5,1,4.0,9": "unreadable",
        "2023-02-30,S1,A,3,1,2,10.5,,7.0,2.0,3.5,1,4.0": "bad date",
        ",S1,A,3,1,2,10.5,,7.0,2.0,3.5,1,4.0": "no key",
        "2023-01-06,,A,3,1,2,10.5,,7.0,2.0,3.5,1,4.0": "no key",
    }
    (tmp_path / "t.csv").write_text("\n".join([head, *good, *bad]) + "\n")
    rows = retail_csv.read_checked(spark, str(tmp_path / "t.csv"), retail_csv.C.TRANSACTIONS)
    assert [str(r["date"]) for r in retail_csv.taken(rows).collect()] == ["2023-01-01", "2023-01-02"]
    assert retail_csv.taken(rows).select("category").count() == 2  # whatever columns are asked for
    assert retail_csv.taken(rows).columns == retail_csv.C.TRANSACTIONS.fieldNames()
    refused = {r["line"]: r["reason"] for r in retail_csv.refused(rows).collect()}
    assert refused == {line: reason.replace("bad date", "unreadable") for line, reason in bad.items()}
    text = retail_csv.parse_checked(retail_csv.read_checked(spark, str(tmp_path / "t.csv"), retail_csv.C.TRANSACTIONS, text_dates=True))
    assert [str(r["date"]) for r in retail_csv.taken(text).collect()] == ["2023-01-01", "2023-01-02"]
    refused = {r["line"]: r["reason"] for r in retail_csv.refused(text).collect()}
    assert refused == {(line[:10] if reason == "bad date" else line): reason for line, reason in bad.items()}
    (tmp_path / "none.csv").write_text(head + "\n")
    assert retail_csv.taken(retail_csv.read_checked(spark, str(tmp_path / "none.csv"), retail_csv.C.TRANSACTIONS)).isEmpty()


def test_columns_share_one_set_of_aggregates(spark, monkeypatch):
    """However many columns or pairs: one set of aggregates, and the figures of each column alone; numbers are counted as numbers."""
    from datetime import date
    from itertools import combinations

    from shelfspark.operators import columns, quality, readiness
    from shelfspark.plans import exploration

    rows = [(i, None if i % 5 == 0 else float(i % 7), -0.0 if i % 2 else 0.0, None, ["a", "b", None][i % 3]) for i in range(60)]
    df = spark.createDataFrame(rows, "i int, v double, z double, n double, s string")
    numeric = ["i", "v", "z", "n"]
    described = columns.numeric_describe(df, numeric)
    spread = ["i", "v", "n"]
    paired = readiness.correlation_pairs(df, spread)
    for frame, name in ((described, "skewness("), (paired, "corr(")):
        assert 1 <= frame._jdf.queryExecution().analyzed().toString().count(name) <= 2
    want = df.toPandas()
    got = {r["column"]: r for r in described.collect()}
    assert set(got) == {"i", "v", "z"}
    for c in ("i", "v"):
        assert (got[c]["count"], got[c]["mean"], got[c]["std"]) == (want[c].count(), pytest.approx(want[c].mean()), pytest.approx(want[c].std()))
        assert (got[c]["skewness"], got[c]["kurtosis"]) == (pytest.approx(want[c].skew()), pytest.approx(want[c].kurt()))
    pairs = {(r["var1"], r["var2"]): r["correlation"] for r in paired.collect()}
    assert set(pairs) == {*combinations(spread, 2)}
    assert pairs["i", "v"] == pytest.approx(want["i"].corr(want["v"])) and pairs["i", "n"] is None
    assert {r["correlation"] for r in readiness.correlation_pairs(df.limit(0), spread).collect()} == {None}
    sizes = columns.cardinalities(df)
    assert {r["column"]: r["cardinality"] for r in sizes.collect()} == {"i": 60, "v": 8, "z": 1, "n": 1, "s": 3}
    assert {r["column"] for r in columns.near_constant_columns(df).collect()} == {"z", "n"}
    calls = []
    monkeypatch.setattr(quality, "iqr_bounds", lambda *a, own=quality.iqr_bounds: calls.append(a) or own(*a))
    facts = spark.createDataFrame([("x", "A", date(2023, 1, 1 + i), *[float(i)] * 6) for i in range(9)], "store_id string, category string, date date, amount_total double, units_sold double, avg_ticket double, amount_cash double, amount_card double, replenishment_signal double").withColumn("cash_transactions", F.lit(1))
    plain = spark.range(3)
    assert exploration.quality_metrics(facts, plain, plain).where("path LIKE 'iqr_outliers%'").count() == 5 * 8
    assert len(calls) == 1
