"""Shared pieces of the registered queries: loading, tidy output, digests, oracle CTEs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.plans.training import Inputs
from shelfspark.sources.trade_panel import PERIOD_START, SPLITS, RetailTables, load_trade_panel


def load(spark: SparkSession, folder: str, grain: str = "supplier") -> RetailTables:
    return load_trade_panel(spark, folder, grain)


def inputs(spark: SparkSession, folder: str, grain: str = "supplier") -> Inputs:
    """Tables for jobs that pass over the facts more than once."""
    t = load(spark, folder, grain).stored()
    return Inputs(t.facts, t.stores, t.calendar, SPLITS)


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Whole numbers as bigint, doubles rounded: the form both engines are compared in."""
    kinds = {"int": "bigint", "smallint": "bigint", "tinyint": "bigint"}
    out = []
    for name, kind in df.dtypes:
        if kind == "double":
            out.append(F.round(F.col(name), digits).alias(name))
        else:
            out.append(F.col(name).cast(kinds.get(kind, kind)).alias(name))
    return df.select(*out)


# Added before a value is cut to thousandths. Sums and quotients of cents often lie exactly on a
# boundary between two of them, where a last-bit difference between engines would show.
OFF_BOUNDARY = 0.000123457


def digest(df: DataFrame, columns: Sequence[str], key: Sequence[str] = ("store_id", "category"), day: str = "date") -> DataFrame:
    """One row per series over all its cells: for each column the number of known values, their
    sum and their sum weighted by the day number, which pins every value to its day. Sums are whole
    thousandths, so they do not depend on the order of rows."""
    day_no = F.datediff(day, F.lit(PERIOD_START))
    aggregates = [F.count("*").alias("cells")]
    for c in columns:
        exact = F.floor((F.col(c).cast("double") + F.lit(OFF_BOUNDARY)) * 1000).cast("bigint")
        aggregates += [
            F.count(c).alias(f"{c}_n"),
            F.sum(exact).alias(f"{c}_sum"),
            F.sum(exact * day_no).alias(f"{c}_by_day"),
        ]
    return df.groupBy(*key).agg(*aggregates)


def digest_sql(source: str, columns: Sequence[str], key: str = "store_id, category", day: str = "date") -> str:
    parts = [key, "count(*) AS cells"]
    for c in columns:
        exact = f"floor((({c})::double + {OFF_BOUNDARY}::double) * 1000)::bigint"
        parts += [
            f"count({c}) AS {c}_n",
            f"sum({exact})::bigint AS {c}_sum",
            f"sum({exact} * date_diff('day', date '1995-01-02', {day}))::bigint AS {c}_by_day",
        ]
    return f"SELECT {', '.join(parts)} FROM {source} GROUP BY {key}"


_EVENTS = """
 (VALUES ('1995-04-09','1995-04-16'),('1996-03-31','1996-04-07'),('1997-03-23','1997-03-30'),
  ('1998-04-05','1998-04-12'),('1999-03-28','1999-04-04'),('2000-04-16','2000-04-23'),
  ('2001-04-08','2001-04-15')) AS holy(a, b)"""
_BUEN_FIN = """
 (VALUES ('1995-11-17','1995-11-20'),('1996-11-15','1996-11-18'),('1997-11-14','1997-11-17'),
  ('1998-11-13','1998-11-16'),('1999-11-12','1999-11-15'),('2000-11-17','2000-11-20'),
  ('2001-11-16','2001-11-19')) AS sales(a, b)"""

CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "lines": (
        (),
        """SELECT l_shipdate::date AS date, 'STR_' || l_suppkey AS store_id, l_suppkey AS store_no,
 p_type AS category, l_linestatus, l_quantity::decimal(8,2) AS quantity,
 l_extendedprice::decimal(8,2) AS price, l_discount::decimal(4,2) AS discount
 FROM lineitem JOIN part ON l_partkey = p_partkey""",
    ),
    "lines_r": (
        (),
        """SELECT l_shipdate::date AS date, r_name AS store_id, r_regionkey AS store_no,
 p_type AS category, l_linestatus, l_quantity::decimal(8,2) AS quantity,
 l_extendedprice::decimal(8,2) AS price, l_discount::decimal(4,2) AS discount
 FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
 JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    ),
    "cells": (
        ("lines",),
        """SELECT date, store_id, category,
 31 * date_diff('day', date '1995-01-02', date) + 7 * max(store_no) + 3 * length(category) AS slot,
 count(*) AS total_transactions,
 count(*) FILTER (WHERE l_linestatus = 'O') AS cash,
 count(*) FILTER (WHERE l_linestatus = 'F') AS card_transactions,
 sum(price)::double AS amount_total,
 coalesce(sum(price) FILTER (WHERE l_linestatus = 'O'), 0)::double AS cash_amount,
 coalesce(sum(price) FILTER (WHERE l_linestatus = 'F'), 0)::double AS amount_card,
 sum(quantity)::double AS units,
 sum((quantity * (1 + discount))::decimal(8,4))::double AS signal
 FROM lines GROUP BY date, store_id, category""",
    ),
    "facts": (
        ("cells",),
        """SELECT date, store_id, category, total_transactions,
 CASE WHEN slot % 17 <> 0 THEN cash END AS cash_transactions,
 card_transactions, amount_total,
 CASE WHEN slot % 17 <> 0 THEN cash_amount END AS amount_cash,
 amount_card,
 CASE WHEN slot % 33 <> 1 THEN units END AS units_sold,
 CASE WHEN slot % 41 <> 2 THEN amount_total / total_transactions END AS avg_ticket,
 CASE WHEN slot % 10 = 3 THEN 1 ELSE 0 END AS has_promotion,
 CASE WHEN date <= date '2001-11-02' THEN signal END AS replenishment_signal
 FROM cells""",
    ),
    "stores": (
        (),
        """SELECT 'STR_' || s_suppkey AS store_id,
 CASE s_nationkey % 3 WHEN 0 THEN 'Supercenter' WHEN 1 THEN 'Bodega' ELSE 'Express' END AS store_format,
 r_name AS region, (floor(abs(s_acctbal)) + 500)::int AS size_sqm, s_nationkey + 4 AS num_checkouts,
 s_nationkey + 1985 AS opening_year,
 CASE s_nationkey % 4 WHEN 0 THEN 'C' WHEN 1 THEN 'C+' WHEN 2 THEN 'B' ELSE 'A/B' END AS socioeconomic_level,
 floor(abs(s_acctbal)) + 500 > 5000 AS has_pharmacy, s_nationkey % 4 = 1 AS has_fuel_station
 FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    ),
    "stores_r": (
        (),
        """SELECT r_name AS store_id,
 CASE r_regionkey % 3 WHEN 0 THEN 'Supercenter' WHEN 1 THEN 'Bodega' ELSE 'Express' END AS store_format,
 r_name AS region, (count(*) * 100)::int AS size_sqm, r_regionkey + 4 AS num_checkouts,
 r_regionkey + 1985 AS opening_year,
 CASE r_regionkey % 4 WHEN 0 THEN 'C' WHEN 1 THEN 'C+' WHEN 2 THEN 'B' ELSE 'A/B' END AS socioeconomic_level,
 count(*) * 100 > 5000 AS has_pharmacy, r_regionkey % 4 = 1 AS has_fuel_station
 FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
 GROUP BY r_name, r_regionkey""",
    ),
    "calendar": (
        (),
        f"""SELECT date, isodow(date) - 1 AS day_of_week, dayname(date) AS day_name, week(date) AS week_of_year,
 month(date) AS month, year(date) AS year, quarter(date) AS quarter,
 CASE WHEN month(date) IN (12, 1, 2) THEN 'Invierno' WHEN month(date) IN (3, 4, 5) THEN 'Primavera'
  WHEN month(date) IN (6, 7, 8) THEN 'Verano' ELSE 'Otoño' END AS season,
 holiday_name IS NOT NULL AS is_holiday, holiday_name,
 day(date) = 15 OR date = last_day(date) AS is_payday, isodow(date) >= 6 AS is_weekend,
 strftime(date, '%m-%d') >= '12-15' OR strftime(date, '%m-%d') <= '01-06' AS is_navidad_season,
 EXISTS (SELECT 1 FROM {_BUEN_FIN} WHERE date BETWEEN a::date AND b::date) AS is_buen_fin,
 EXISTS (SELECT 1 FROM {_EVENTS} WHERE date BETWEEN a::date AND b::date) AS is_semana_santa
 FROM (SELECT d::date AS date, CASE strftime(d, '%m-%d') WHEN '01-01' THEN 'Año Nuevo'
  WHEN '02-05' THEN 'Día de la Constitución' WHEN '03-21' THEN 'Natalicio de Benito Juárez'
  WHEN '05-01' THEN 'Día del Trabajo' WHEN '09-16' THEN 'Día de la Independencia'
  WHEN '11-20' THEN 'Día de la Revolución' WHEN '12-25' THEN 'Navidad' END AS holiday_name
  FROM generate_series(timestamp '1995-01-02', timestamp '2001-11-04', interval 1 day) AS g(d))""",
    ),
    "known": (
        ("facts",),
        """SELECT date, store_id, category, total_transactions,
 coalesce(cash_transactions, total_transactions - card_transactions) AS cash_transactions, card_transactions,
 amount_total, coalesce(amount_cash, amount_total - amount_card) AS amount_cash, amount_card, units_sold,
 coalesce(avg_ticket, CASE WHEN total_transactions > 0 THEN amount_total / total_transactions END) AS avg_ticket,
 has_promotion, replenishment_signal FROM facts""",
    ),
    "week_medians": (
        ("known",),
        """SELECT store_id, category, isodow(date) - 1 AS day_of_week,
 quantile_cont(units_sold, 0.5) AS units_sold_median, quantile_cont(avg_ticket, 0.5) AS avg_ticket_median
 FROM known WHERE date <= date '2001-08-05' GROUP BY ALL""",
    ),
    "category_medians": (
        ("known",),
        """SELECT category, quantile_cont(units_sold, 0.5) AS units_sold_median,
 quantile_cont(avg_ticket, 0.5) AS avg_ticket_median
 FROM known WHERE date <= date '2001-08-05' GROUP BY category""",
    ),
    "clean": (
        ("known", "week_medians", "category_medians"),
        """SELECT k.* REPLACE (coalesce(k.units_sold, w.units_sold_median, c.units_sold_median) AS units_sold,
 coalesce(k.avg_ticket, w.avg_ticket_median, c.avg_ticket_median) AS avg_ticket)
 FROM known k LEFT JOIN week_medians w ON k.store_id = w.store_id AND k.category = w.category
 AND isodow(k.date) - 1 = w.day_of_week LEFT JOIN category_medians c ON k.category = c.category""",
    ),
    "cells_all": (
        ("calendar", "stores", "facts"),
        """SELECT date, store_id, category FROM (SELECT DISTINCT date FROM calendar),
 (SELECT DISTINCT store_id FROM stores), (SELECT DISTINCT category FROM facts WHERE category IS NOT NULL)""",
    ),
    "grid": (
        ("cells_all", "facts"),
        """SELECT g.*, f.* EXCLUDE (date, store_id, category), (f.amount_total IS NULL)::int AS pos_outage_flag
 FROM cells_all g LEFT JOIN facts f USING (date, store_id, category)""",
    ),
    "master": (
        ("cells_all", "clean", "stores", "calendar"),
        """SELECT g.date, g.store_id, g.category,
 coalesce(f.total_transactions, 0) AS total_transactions, coalesce(f.cash_transactions, 0) AS cash_transactions,
 coalesce(f.card_transactions, 0) AS card_transactions, coalesce(f.amount_total, 0) AS amount_total,
 coalesce(f.amount_cash, 0) AS amount_cash, coalesce(f.amount_card, 0) AS amount_card,
 f.units_sold, f.avg_ticket, f.has_promotion, f.replenishment_signal,
 (f.amount_total IS NULL)::int AS pos_outage_flag,
 s.* EXCLUDE (store_id), c.* EXCLUDE (date)
 FROM cells_all g LEFT JOIN clean f USING (date, store_id, category)
 LEFT JOIN stores s ON g.store_id = s.store_id LEFT JOIN calendar c ON g.date = c.date""",
    ),
    "master_s": (
        ("master",),
        """SELECT *, CASE WHEN date BETWEEN date '1995-01-02' AND date '2001-08-05' THEN 'TRAIN'
 WHEN date BETWEEN date '2001-08-06' AND date '2001-10-06' THEN 'VAL'
 WHEN date BETWEEN date '2001-10-07' AND date '2001-11-04' THEN 'HOLDOUT' END AS split FROM master""",
    ),
    "category_enc": (
        ("master_s",),
        "SELECT category, avg(replenishment_signal) AS m FROM master_s WHERE split = 'TRAIN' GROUP BY category",
    ),
    "format_enc": (
        ("master_s",),
        "SELECT store_format, avg(replenishment_signal) AS m FROM master_s WHERE split = 'TRAIN' GROUP BY store_format",
    ),
    "global_enc": (("master_s",), "SELECT avg(replenishment_signal) AS m FROM master_s WHERE split = 'TRAIN'"),
    "series_raw": (
        ("master",),
        """SELECT store_id || '_' || category AS unique_id, date AS ds, replenishment_signal AS y
 FROM master WHERE date <= date '2001-10-06'""",
    ),
    "series": (
        ("series_raw",),
        """SELECT unique_id, ds, y FROM (SELECT unique_id, ds,
 coalesce(last_value(y IGNORE NULLS) OVER (PARTITION BY unique_id ORDER BY ds ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(y IGNORE NULLS) OVER (PARTITION BY unique_id ORDER BY ds ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS y
 FROM series_raw) WHERE y IS NOT NULL""",
    ),
    "folds": (
        ("series",),
        """SELECT unique_id, date '2001-08-11' + (7 * (day // 7))::int AS cutoff, ds, day % 7 + 1 AS step, y, yhat
 FROM (SELECT unique_id, ds, y, lag(y, 7) OVER (PARTITION BY unique_id ORDER BY ds) AS yhat,
  date_diff('day', date '2001-08-11', ds) - 1 AS day FROM series)
 WHERE day >= 0""",
    ),
    "fold_scores": (
        ("folds",),
        """SELECT 'SeasonalNaive' AS model, count(*) AS n, sum(abs(y - yhat)) / sum(abs(y)) AS wape,
 sqrt(avg((y - yhat) ^ 2)) AS rmse, sum(greatest(yhat - y, 0)) AS overstock_units,
 sum(greatest(y - yhat, 0)) AS stockout_units FROM folds""",
    ),
}
_COARSE = {"lines": "lines_r", "stores": "stores_r"}


def with_ctes(body: str, *names: str, coarse: bool = False) -> str:
    """``body`` preceded by the named CTEs and whatever they need."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        source = _COARSE.get(name, name) if coarse else name
        for need in CTES[source][0]:
            visit(need)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    ctes = [f"{n} AS ({CTES[_COARSE.get(n, n) if coarse else n][1]})" for n in ordered]
    return f"WITH {', '.join(ctes)} {body}"
