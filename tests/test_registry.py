"""The registry is consistent, and a few queries of each kind equal their SQL on the small data."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check_oracle import TABLES, ordered

SPOT = (
    "s01_fact_scan", "s07_calendar", "g08_master_panel", "i07_repaired_facts", "f01_lags", "t04_seasonal_naive",
    "t05b_fixed_smoothing", "m03_business_impact", "q08_iqr_outliers", "n09_histogram", "a01_claim_audit",
)


@pytest.fixture(scope="module")
def con(small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    return con


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 110


@pytest.mark.parametrize("name", SPOT)
def test_query_equals_sql(spark, small, con, name):
    df = entry.queries()[name](spark, small)
    result = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    assert ordered([tuple(r) for r in df.collect()], df.columns) == ordered(result.fetchall(), names)


def test_flagship_ranks_smoothing_first(spark):
    rows = entry.entry(spark).collect()
    assert [r.model for r in rows] == ["AutoETS", "SeasonalNaive"]
    assert rows[0].n == rows[1].n > 0


def test_run_results_and_statistics(spark, small):
    results = {r.path: r.value for r in entry.queries()["s05_run_results"](spark, small).collect()}
    assert results["gate.passes_baseline_gate"] == 1.0
    assert results["rows.VAL.rows"] == 62 * 5 * 6
    assert results["holdout.forecast_records_count"] == 29 * 5 * 6
