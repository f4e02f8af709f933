"""Registered queries: sources, grid, repairs, features."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.common import digest, digest_sql, inputs, load, tidy, with_ctes
from shelfspark import contract as C
from shelfspark.operators import encoders, features, grid, impute
from shelfspark.plans import training
from shelfspark.session import scratch_path, settle
from shelfspark.sources.retail_csv import REASON, parse_checked, parse_dates, read_checked, refused, taken
from shelfspark.sources.trade_panel import PERIOD_START, SPLITS

TRAIN_END = SPLITS.train_end
QUERIES, ORACLE = {}, {}


def register(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return keep


FACT_SQL = """date, store_id, category, total_transactions::bigint AS total_transactions,
 cash_transactions::bigint AS cash_transactions, card_transactions::bigint AS card_transactions,
 round(amount_total, 6) AS amount_total, round(amount_cash, 6) AS amount_cash, round(amount_card, 6) AS amount_card,
 round(units_sold, 6) AS units_sold, round(avg_ticket, 6) AS avg_ticket, has_promotion::bigint AS has_promotion,
 round(replenishment_signal, 6) AS replenishment_signal"""


@register("s01_fact_scan", with_ctes(f"SELECT {FACT_SQL} FROM facts", "facts"))
def s01(spark, folder):
    return tidy(load(spark, folder).facts)


@register(
    "s02_text_dates",
    with_ctes(
        """SELECT store_id, category, count(*) AS n_rows, min(date) AS first_day, max(date) AS last_day
 FROM facts GROUP BY store_id, category""",
        "facts",
    ),
)
def s02(spark, folder):
    facts = load(spark, folder).facts
    text = facts.withColumn("date", F.date_format("date", "yyyy-MM-dd"))
    return tidy(
        parse_dates(text)
        .groupBy("store_id", "category")
        .agg(F.count("*").alias("n_rows"), F.min("date").alias("first_day"), F.max("date").alias("last_day"))
    )


# A spoiled copy of the facts of every 97th day stands beside them: a word for a number, a value too many, a date that is none,
# no store.
SPOILED_SQL = "SELECT date_diff('day', date '1995-01-02', date) // 97 % 4 AS kind FROM facts WHERE date_diff('day', date '1995-01-02', date) % 97 = 5"


def _csv_files(spark, folder):
    """The facts written as CSV, and beside them lines that cannot be taken."""
    facts = load(spark, folder).facts
    good, bad = scratch_path(spark, "csv"), scratch_path(spark, "csv-spoiled")
    facts = settle(facts, "facts")
    facts.write.option("header", True).csv(good)
    day = F.datediff("date", F.lit(PERIOD_START))
    kind = F.expr(f"datediff(date, date '{PERIOD_START}') div 97 % 4")
    spoiled = facts.where(day % 97 == 5).withColumn("kind", kind).select(*(F.col(c).cast("string").alias(c) for c in facts.columns), "kind")
    changes = {"amount_total": (0, F.lit("unknown")), "replenishment_signal": (1, F.lit("1,5")), "date": (2, F.concat("date", F.lit("-"))), "store_id": (3, F.lit(None))}
    for c, (which, value) in changes.items():
        spoiled = spoiled.withColumn(c, F.when(F.col("kind") == which, value).otherwise(F.col(c)))
    spoiled.drop("kind").write.option("header", True).option("quote", "\u0000").csv(bad)
    return [good, bad]


@register("s01_csv_scan", with_ctes(f"SELECT {FACT_SQL} FROM facts", "facts"))
def s01_csv(spark, folder):
    """The facts from CSV files with some bad lines."""
    return tidy(taken(read_checked(spark, _csv_files(spark, folder), C.TRANSACTIONS)))


@register(
    "s01_csv_bad_lines",
    with_ctes(
        f"SELECT CASE WHEN kind = 3 THEN 'no key' ELSE 'unreadable' END AS reason, count(*) AS lines FROM ({SPOILED_SQL}) GROUP BY 1",
        "facts",
    ),
)
def s01_bad(spark, folder):
    """What the scan refused, by reason."""
    return refused(read_checked(spark, _csv_files(spark, folder), C.TRANSACTIONS)).groupBy("reason").agg(F.count("line").alias("lines"))


@register(
    "s02_csv_text_dates",
    with_ctes(
        f"""SELECT 'taken' AS reason, count(*) AS lines, min(date) AS first_day, max(date) AS last_day FROM facts
 UNION ALL SELECT CASE kind WHEN 2 THEN 'bad date' WHEN 3 THEN 'no key' ELSE 'unreadable' END, count(*), NULL, NULL
 FROM ({SPOILED_SQL}) GROUP BY 1""",
        "facts",
    ),
)
def s02_csv(spark, folder):
    """Dates scanned as text and read afterwards: lines taken with their first and last day, and lines refused."""
    rows = parse_checked(read_checked(spark, _csv_files(spark, folder), C.TRANSACTIONS, text_dates=True))
    reason = F.coalesce(REASON, F.lit("taken"))
    day = F.when(F.col(REASON).isNull(), F.col("date"))
    return rows.groupBy(reason.alias("reason")).agg(F.count("*").alias("lines"), F.min(day).alias("first_day"), F.max(day).alias("last_day"))


@register(
    "s07_calendar",
    with_ctes(
        """SELECT c.date, day_of_week::bigint AS day_of_week, day_name, week_of_year::bigint AS week_of_year,
 month::bigint AS month, year::bigint AS year, quarter::bigint AS quarter, season, is_holiday, holiday_name,
 is_payday, is_weekend, is_navidad_season, is_buen_fin, is_semana_santa, coalesce(n, 0)::bigint AS lines
 FROM calendar c LEFT JOIN (SELECT date, count(*) AS n FROM lines GROUP BY date) l ON c.date = l.date""",
        "calendar",
        "lines",
    ),
)
def s07(spark, folder):
    t = load(spark, folder)
    sold = t.lines.groupBy("date").agg(F.count("*").alias("lines"))
    return tidy(t.calendar.join(sold, "date", "left").fillna(0, ["lines"]))


@register(
    "g01_domains",
    with_ctes(
        """SELECT 'date' AS domain, date::varchar AS value FROM calendar
 UNION ALL SELECT 'store_id', store_id FROM stores
 UNION ALL SELECT 'category', category FROM (SELECT DISTINCT category FROM facts)""",
        "calendar",
        "stores",
        "facts",
    ),
)
def g01(spark, folder):
    t = load(spark, folder)
    parts = [
        d.select(F.lit(name).alias("domain"), F.col(name).cast("string").alias("value"))
        for name, d in grid.domains(t.facts, t.stores, t.calendar).items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _grid(spark, folder):
    i = inputs(spark, folder)
    return grid.densify(i.facts, i.stores, i.calendar, i.categories)


@register(
    "g02_grid_cells",
    with_ctes(
        """SELECT store_id, category, count(*) AS cells, count(DISTINCT date) AS days, min(date) AS first_day,
 max(date) AS last_day FROM cells_all GROUP BY store_id, category""",
        "cells_all",
    ),
)
def g02(spark, folder):
    return (
        _grid(spark, folder)
        .groupBy("store_id", "category")
        .agg(
            F.count("*").alias("cells"),
            F.countDistinct("date").alias("days"),
            F.min("date").alias("first_day"),
            F.max("date").alias("last_day"),
        )
    )


GRID_COLUMNS = ["total_transactions", "cash_transactions", "amount_total", "units_sold", "replenishment_signal"]


@register("g03_grid_facts", with_ctes(digest_sql("grid", GRID_COLUMNS), "grid"))
def g03(spark, folder):
    return digest(_grid(spark, folder), GRID_COLUMNS)


@register("g04_outage_flag", with_ctes(digest_sql("grid", ["pos_outage_flag"]), "grid"))
def g04(spark, folder):
    return digest(grid.flag_outages(_grid(spark, folder)), ["pos_outage_flag"])


@register(
    "g05_zero_fill",
    with_ctes(
        digest_sql(
            "(SELECT date, store_id, category, coalesce(total_transactions, 0) AS total_transactions,"
            " coalesce(amount_cash, 0) AS amount_cash, units_sold, has_promotion FROM grid)",
            ["total_transactions", "amount_cash", "units_sold", "has_promotion"],
        ),
        "grid",
    ),
)
def g05(spark, folder):
    return digest(
        grid.zero_fill(_grid(spark, folder)), ["total_transactions", "amount_cash", "units_sold", "has_promotion"]
    )


@register(
    "g06_store_join",
    with_ctes(
        """SELECT date, f.store_id, category, round(amount_total, 6) AS amount_total, store_format, region,
 size_sqm::bigint AS size_sqm, num_checkouts::bigint AS num_checkouts, opening_year::bigint AS opening_year,
 socioeconomic_level, has_pharmacy, has_fuel_station
 FROM facts f LEFT JOIN stores s ON f.store_id = s.store_id""",
        "facts",
        "stores",
    ),
)
def g06(spark, folder):
    t = load(spark, folder)
    return tidy(grid.with_stores(t.facts.select("date", "store_id", "category", "amount_total"), t.stores))


@register(
    "g07_calendar_join",
    with_ctes(
        """SELECT f.date, store_id, category, round(amount_total, 6) AS amount_total, season, is_payday,
 is_holiday, holiday_name, is_buen_fin FROM facts f LEFT JOIN calendar c ON f.date = c.date""",
        "facts",
        "calendar",
    ),
)
def g07(spark, folder):
    t = load(spark, folder)
    slim = t.calendar.select("date", "season", "is_payday", "is_holiday", "holiday_name", "is_buen_fin")
    return tidy(grid.with_calendar(t.facts.select("date", "store_id", "category", "amount_total"), slim))


MASTER_COLUMNS = [
    *C.MEASURES,
    "has_promotion",
    "pos_outage_flag",
    "size_sqm",
    "opening_year",
    "day_of_week",
    "week_of_year",
]


@register("g08_master_panel", with_ctes(digest_sql("master", MASTER_COLUMNS), "master"))
def g08(spark, folder):
    return digest(training.panel(inputs(spark, folder)), MASTER_COLUMNS)


@register(
    "i01_cash_count",
    with_ctes(
        "SELECT date, store_id, category, cash_transactions::bigint AS cash_transactions FROM known", "known"
    ),
)
def i01(spark, folder):
    facts = impute.cash_count_identity(load(spark, folder).facts)
    return tidy(facts.select("date", "store_id", "category", "cash_transactions"))


@register(
    "i02_cash_amount",
    with_ctes("SELECT date, store_id, category, round(amount_cash, 6) AS amount_cash FROM known", "known"),
)
def i02(spark, folder):
    facts = impute.cash_amount_identity(load(spark, folder).facts)
    return tidy(facts.select("date", "store_id", "category", "amount_cash"))


@register(
    "i03_average_ticket",
    with_ctes("SELECT date, store_id, category, round(avg_ticket, 6) AS avg_ticket FROM known", "known"),
)
def i03(spark, folder):
    return tidy(
        impute.recompute_ticket(load(spark, folder).facts).select("date", "store_id", "category", "avg_ticket")
    )


@register(
    "i04_weekday_medians",
    with_ctes(
        """SELECT store_id, category, day_of_week::bigint AS day_of_week,
 round(units_sold_median, 6) AS units_sold_median, round(avg_ticket_median, 6) AS avg_ticket_median
 FROM week_medians""",
        "week_medians",
    ),
)
def i04(spark, folder):
    return tidy(impute.weekday_medians(impute.apply_identities(load(spark, folder).facts), TRAIN_END))


@register(
    "i05_category_medians",
    with_ctes(
        """SELECT category, round(units_sold_median, 6) AS units_sold_median,
 round(avg_ticket_median, 6) AS avg_ticket_median FROM category_medians""",
        "category_medians",
    ),
)
def i05(spark, folder):
    return tidy(impute.category_medians(impute.apply_identities(load(spark, folder).stored().facts), TRAIN_END))


@register(
    "i06_training_rows",
    with_ctes(
        """SELECT store_id, category, count(*) AS n_rows, max(date) AS last_day FROM facts
 WHERE date <= date '2001-08-05' GROUP BY store_id, category""",
        "facts",
    ),
)
def i06(spark, folder):
    rows = impute.training_rows(load(spark, folder).facts, TRAIN_END)
    return rows.groupBy("store_id", "category").agg(F.count("*").alias("n_rows"), F.max("date").alias("last_day"))


@register("i07_repaired_facts", with_ctes(f"SELECT {FACT_SQL} FROM clean", "clean"))
def i07(spark, folder):
    return tidy(impute.repair_readings(load(spark, folder).stored().facts, TRAIN_END))


# The unbounded variant: the frame is its own reference, so category medians see weekday fills.
_OPEN_CTES = """, wk AS (SELECT store_id, category, isodow(date) AS d, quantile_cont(units_sold, 0.5) AS u
 FROM known GROUP BY ALL),
 step AS (SELECT k.date, k.store_id, k.category, coalesce(k.units_sold, wk.u) AS units_sold FROM known k
 LEFT JOIN wk ON k.store_id = wk.store_id AND k.category = wk.category AND isodow(k.date) = wk.d),
 cm AS (SELECT category, quantile_cont(units_sold, 0.5) AS u FROM step GROUP BY category)
 SELECT date, store_id, step.category, round(coalesce(units_sold, cm.u), 6) AS units_sold
 FROM step LEFT JOIN cm ON step.category = cm.category"""


@register("i07_repaired_without_bound", with_ctes(_OPEN_CTES, "known"))
def i07_open(spark, folder):
    repaired = impute.repair_readings(load(spark, folder).stored().facts)
    return tidy(repaired.select("date", "store_id", "category", "units_sold"))


BY_SERIES = "OVER (PARTITION BY store_id, category ORDER BY date"
LAG_COLUMNS = [f"{t}_lag_{n}d" for t in C.LAG_TARGETS for n in C.LAG_DAYS]
LAG_SQL = ", ".join(f"lag({t}, {n}) {BY_SERIES}) AS {t}_lag_{n}d" for t in C.LAG_TARGETS for n in C.LAG_DAYS)
MEAN_COLUMNS = [f"{t}_roll_mean_{w}d" for t in C.ROLL_TARGETS for w in C.ROLL_DAYS]
MEAN_SQL = ", ".join(
    f"avg({t}) {BY_SERIES} ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING) AS {t}_roll_mean_{w}d"
    for t in C.ROLL_TARGETS
    for w in C.ROLL_DAYS
)
STD_COLUMNS = [f"{t}_roll_std_{w}d" for t in C.ROLL_TARGETS for w in C.ROLL_DAYS]
STD_SQL = ", ".join(
    f"stddev_samp({t}) {BY_SERIES} ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING) AS {t}_roll_std_{w}d"
    for t in C.ROLL_TARGETS
    for w in C.ROLL_DAYS
)
_30 = f"{BY_SERIES} ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)"
RATIO_SQL = f"sum(amount_cash) {_30} / (sum(amount_total) {_30} + 1e-5)"
CASH_SQL = (
    f"CASE WHEN {RATIO_SQL} IS NOT NULL THEN greatest(0.0, least(1.0, {RATIO_SQL})) END AS cash_ratio_roll_30d"
)
DAY, DIM = "day(date)", "day(last_day(date))"
PHASE_SQL = f"""{DAY} AS day_of_month, {DIM} AS days_in_month,
 ({DAY} IN (14, 15, 16) OR {DAY} >= {DIM} - 1 OR coalesce(is_payday, false))::int AS is_payday_window,
 CASE WHEN {DAY} <= 15 THEN 15 - {DAY} ELSE {DIM} - {DAY} END AS days_to_next_payday,
 ({DAY} <= 5)::int AS is_month_start, ({DAY} >= {DIM} - 4)::int AS is_month_end"""
KEYS_SQL = "date, store_id, category"


def _master(spark, folder):
    return training.panel(inputs(spark, folder))


def _rolled(spark, folder):
    """The master panel's cells with rolling columns, which the grid makes while it unfolds."""
    return features.add_rolling(training.panel(inputs(spark, folder), features.rolling_features(), C.ROLL_TARGETS))


@register(
    "f01_lags", with_ctes(digest_sql(f"(SELECT {KEYS_SQL}, {LAG_SQL} FROM master)", LAG_COLUMNS), "master")
)
def f01(spark, folder):
    return digest(features.add_lags(_master(spark, folder)), LAG_COLUMNS)


@register(
    "f02_rolling_mean",
    with_ctes(digest_sql(f"(SELECT {KEYS_SQL}, {MEAN_SQL} FROM master)", MEAN_COLUMNS), "master"),
)
def f02(spark, folder):
    return digest(_rolled(spark, folder), MEAN_COLUMNS)


@register(
    "f03_rolling_std",
    with_ctes(digest_sql(f"(SELECT {KEYS_SQL}, {STD_SQL} FROM master)", STD_COLUMNS), "master"),
)
def f03(spark, folder):
    return digest(_rolled(spark, folder), STD_COLUMNS)


YESTERDAY = f"lag(amount_total, 1) {BY_SERIES})"


def _ratios(spark, folder):
    lagged = features.add_lags(_master(spark, folder), ("amount_total",), (1,))
    return features.add_store_ratios(lagged)


@register(
    "f04_sales_per_sqm",
    with_ctes(
        digest_sql(
            f"(SELECT {KEYS_SQL}, {YESTERDAY} / (size_sqm + 1) AS sales_per_sqm FROM master)", ["sales_per_sqm"]
        ),
        "master",
    ),
)
def f04(spark, folder):
    return digest(_ratios(spark, folder), ["sales_per_sqm"])


@register(
    "f05_sales_per_checkout",
    with_ctes(
        digest_sql(
            f"(SELECT {KEYS_SQL}, {YESTERDAY} / (num_checkouts + 1) AS sales_per_checkout FROM master)",
            ["sales_per_checkout"],
        ),
        "master",
    ),
)
def f05(spark, folder):
    return digest(_ratios(spark, folder), ["sales_per_checkout"])


@register(
    "f06_store_age",
    with_ctes(
        digest_sql(f"(SELECT {KEYS_SQL}, year - opening_year AS store_age_years FROM master)", ["store_age_years"]),
        "master",
    ),
)
def f06(spark, folder):
    return digest(_ratios(spark, folder), ["store_age_years"])


@register(
    "f07_cash_ratio",
    with_ctes(digest_sql(f"(SELECT {KEYS_SQL}, {CASH_SQL} FROM master)", ["cash_ratio_roll_30d"]), "master"),
)
def f07(spark, folder):
    return digest(features.add_payment_ratio(_master(spark, folder).select(C.DAY, *C.KEYS, "amount_cash", "amount_total")), ["cash_ratio_roll_30d"])


def _phase(name: str, columns: list[str]):
    casts = ", ".join(f"{c}::bigint AS {c}" for c in columns)
    sql = with_ctes(
        f"""SELECT date, n_rows, {casts} FROM (SELECT date, is_payday, count(*) AS n_rows FROM facts
 JOIN calendar USING (date) GROUP BY date, is_payday), LATERAL (SELECT {PHASE_SQL})""",
        "facts",
        "calendar",
    )

    @register(name, sql)
    def run(spark, folder):
        t = load(spark, folder)
        days = t.facts.groupBy("date").agg(F.count("*").alias("n_rows")).join(
            t.calendar.select("date", "is_payday"), "date"
        )
        return tidy(features.add_calendar_phases(days).select("date", "n_rows", *columns))


_phase("f08_month_days", ["day_of_month", "days_in_month"])
_phase("f09_payday_window", ["is_payday_window"])
_phase("f10_days_to_payday", ["days_to_next_payday"])
_phase("f11_month_phase", ["is_month_start", "is_month_end"])


@register(
    "f12_fit_target_means",
    with_ctes(
        """SELECT 'category' AS "column", category AS "key", round(m, 6) AS mean_target FROM category_enc
 UNION ALL SELECT 'store_format', store_format, round(m, 6) FROM format_enc
 UNION ALL SELECT 'overall', 'overall', round(m, 6) FROM global_enc""",
        "category_enc",
        "format_enc",
        "global_enc",
    ),
)
def f12(spark, folder):
    return tidy(training.target_means(inputs(spark, folder)))


ENC_SQL = """SELECT f.date, f.store_id, f.category,
 round(coalesce(ce.m, (SELECT m FROM global_enc)), 6) AS category_target_enc,
 round(coalesce(fe.m, (SELECT m FROM global_enc)), 6) AS store_format_target_enc
 FROM facts f LEFT JOIN stores s ON f.store_id = s.store_id
 LEFT JOIN category_enc ce ON f.category = ce.category LEFT JOIN format_enc fe ON s.store_format = fe.store_format"""


@register(
    "f13_apply_target_means", with_ctes(ENC_SQL, "facts", "stores", "category_enc", "format_enc", "global_enc")
)
def f13(spark, folder):
    t = inputs(spark, folder)
    rows = grid.with_stores(t.facts.select("date", "store_id", "category"), t.stores)
    encoded = encoders.apply_target_means(rows, training.target_means(t))
    return tidy(
        encoded.select("date", "store_id", "category", "category_target_enc", "store_format_target_enc")
    )


@register(
    "f14_ordinal_rank",
    with_ctes(
        """SELECT socioeconomic_level, CASE socioeconomic_level WHEN 'C+' THEN 1 WHEN 'B' THEN 2
 WHEN 'A/B' THEN 3 ELSE 0 END::bigint AS socioeconomic_level_ord, count(*) AS n_rows
 FROM facts f LEFT JOIN stores s ON f.store_id = s.store_id GROUP BY ALL""",
        "facts",
        "stores",
    ),
)
def f14(spark, folder):
    t = load(spark, folder)
    ranked = encoders.with_socioeconomic_rank(grid.with_stores(t.facts.select("store_id"), t.stores))
    return tidy(
        ranked.groupBy("socioeconomic_level", "socioeconomic_level_ord").agg(F.count("*").alias("n_rows"))
    )


ENGINEERED = [
    *LAG_COLUMNS,
    *MEAN_COLUMNS,
    *STD_COLUMNS,
    "cash_ratio_roll_30d",
    "sales_per_sqm",
    "store_age_years",
    "is_payday_window",
    "days_to_next_payday",
    "is_month_end",
]
FEATURE_SQL = f"""(SELECT *, amount_total_lag_1d / (size_sqm + 1) AS sales_per_sqm, year - opening_year AS store_age_years
 FROM (SELECT {KEYS_SQL}, size_sqm, opening_year, year, {LAG_SQL}, {MEAN_SQL}, {STD_SQL}, {CASH_SQL}, {PHASE_SQL}
 FROM master))"""


@register("f15_feature_pipeline", with_ctes(digest_sql(FEATURE_SQL, ENGINEERED), "master"))
def f15(spark, folder):
    of_stores = ("size_sqm", "num_checkouts", "opening_year")
    return digest(training.feature_panel(inputs(spark, folder), of_stores), ENGINEERED)


@register(
    "f16_splits",
    with_ctes(
        """SELECT store_id, category, split, count(*) AS cells, min(date) AS first_day, max(date) AS last_day
 FROM master_s GROUP BY store_id, category, split""",
        "master_s",
    ),
)
def f16(spark, folder):
    return (
        features.with_split(_master(spark, folder), SPLITS)
        .groupBy("store_id", "category", "split")
        .agg(F.count("*").alias("cells"), F.min("date").alias("first_day"), F.max("date").alias("last_day"))
    )


SAFE_LAGS = [c for c in LAG_COLUMNS if (features.lag_of(c) or 0) >= C.GAP_HORIZON]
MATRIX_SQL = f"""SELECT m.date, m.store_id, m.category, split, replenishment_signal,
 is_payday_window, days_to_next_payday, is_month_start, is_month_end,
 coalesce(ce.m, (SELECT m FROM global_enc)) AS category_target_enc,
 coalesce(fe.m, (SELECT m FROM global_enc)) AS store_format_target_enc,
 CASE socioeconomic_level WHEN 'C+' THEN 1 WHEN 'B' THEN 2 WHEN 'A/B' THEN 3 ELSE 0 END AS socioeconomic_level_ord,
 size_sqm, num_checkouts, is_holiday, is_payday, is_weekend, is_buen_fin, is_navidad_season, {", ".join(SAFE_LAGS)}
 FROM (SELECT *, {LAG_SQL}, {PHASE_SQL} FROM master_s) m
 LEFT JOIN category_enc ce ON m.category = ce.category LEFT JOIN format_enc fe ON m.store_format = fe.store_format"""
COMPLETE_SQL = f"""SELECT * FROM ({MATRIX_SQL}) WHERE split IN ('TRAIN', 'VAL') AND replenishment_signal IS NOT NULL
 AND {" AND ".join(f"{c} IS NOT NULL" for c in SAFE_LAGS)}"""
MATRIX_OUT = ", ".join(
    ["date", "store_id", "category", "split", "round(replenishment_signal, 6) AS replenishment_signal"]
    + [f"round({c}, 6) AS {c}" for c in ("category_target_enc", "store_format_target_enc")]
    + [
        f"{c}::bigint AS {c}"
        for c in (
            "is_payday_window",
            "days_to_next_payday",
            "is_month_start",
            "is_month_end",
            "socioeconomic_level_ord",
            "size_sqm",
            "num_checkouts",
        )
    ]
    + ["is_holiday", "is_payday", "is_weekend", "is_buen_fin", "is_navidad_season"]
    + [f"round({c}, 6) AS {c}" for c in SAFE_LAGS]
)
ENC_CTES = ("master_s", "category_enc", "format_enc", "global_enc")


@register("f17_gap_safe_columns", with_ctes(f"SELECT {MATRIX_OUT} FROM ({MATRIX_SQL})", *ENC_CTES, coarse=True))
def f17(spark, folder):
    i = inputs(spark, folder, "region")
    encoded = encoders.encode(training.feature_panel(i), training.target_means(i))
    columns = features.gap_safe_columns(encoded.columns)
    return tidy(encoded.select(*C.KEYS, "date", "split", "replenishment_signal", *columns))


@register("f18_complete_cases", with_ctes(f"SELECT {MATRIX_OUT} FROM ({COMPLETE_SQL})", *ENC_CTES, coarse=True))
def f18(spark, folder):
    return tidy(training.training_matrix(inputs(spark, folder, "region")))


@register(
    "x02_repair_coverage",
    with_ctes(
        """, ticket AS (SELECT count(*) AS n FROM facts WHERE avg_ticket IS NULL),
 units AS (SELECT count(*) AS n, count(w.units_sold_median) AS by_week,
  count(*) FILTER (WHERE w.units_sold_median IS NULL AND c.units_sold_median IS NOT NULL) AS by_cat,
  count(*) FILTER (WHERE w.units_sold_median IS NULL AND c.units_sold_median IS NULL) AS rest
  FROM known k LEFT JOIN week_medians w ON k.store_id = w.store_id AND k.category = w.category
   AND isodow(k.date) - 1 = w.day_of_week LEFT JOIN category_medians c ON k.category = c.category
  WHERE k.units_sold IS NULL),
 cash AS (SELECT count(*) AS n FROM facts WHERE cash_transactions IS NULL)
 SELECT 'cash_transactions' AS "column", n AS nulls_before, n AS by_identity, 0::bigint AS by_weekday_median,
  0::bigint AS by_category_median, 0::bigint AS nulls_after FROM cash
 UNION ALL SELECT 'amount_cash', n, n, 0, 0, 0 FROM cash
 UNION ALL SELECT 'units_sold', n, 0, by_week, by_cat, rest FROM units
 UNION ALL SELECT 'avg_ticket', n, n, 0, 0, 0 FROM ticket""",
        "known",
        "week_medians",
        "category_medians",
    ),
)
def x02(spark, folder):
    return tidy(impute.repair_coverage(load(spark, folder).stored().facts, TRAIN_END))


UNSAFE = {
    "same-day reading": [m for m in C.MEASURES if m != "replenishment_signal"],
    "lag shorter than the horizon": [f"{t}_lag_1d" for t in C.LAG_TARGETS],
    "window ends yesterday": [*MEAN_COLUMNS, *STD_COLUMNS, "cash_ratio_roll_30d"],
    "built on yesterday's sales": ["sales_per_sqm", "sales_per_checkout"],
}
LEAK_SQL = f""", feat AS (SELECT *, amount_total_lag_1d / (size_sqm + 1) AS sales_per_sqm,
 amount_total_lag_1d / (num_checkouts + 1) AS sales_per_checkout
 FROM (SELECT *, {LAG_SQL}, {MEAN_SQL}, {STD_SQL}, {CASH_SQL} FROM master)) """ + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS known_values, '{reason.replace("'", "''")}' AS reason FROM feat"""
    for reason, names in UNSAFE.items()
    for c in names
)


@register("x03_leak_flags", with_ctes(LEAK_SQL, "master", coarse=True))
def x03(spark, folder):
    i = inputs(spark, folder, "region")
    featured = training.feature_panel(i)
    flags = features.flag_leaks(featured)
    known = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.count(c).alias("known_values"))
            for c in featured.columns
            if features.leak_reason(c)
        ]
    )
    return featured.agg(known.alias("rows")).select(F.inline("rows")).join(flags, "column")
