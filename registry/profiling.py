"""Registered queries: overview, quality, profiles, readiness, charts, columns, audit, documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.common import load, tidy, with_ctes
from shelfspark import contract as C
from shelfspark.operators import audit, charts, columns, overview, profile, quality, readiness, sketches
from shelfspark.plans import exploration, training
from shelfspark.session import scratch_path, settle
from shelfspark.sources.documents import flatten, read_draft, read_metrics, write_metrics
from shelfspark.sources.trade_panel import SPLITS

QUERIES, ORACLE = {}, {}


def register(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return keep


FACT_COLUMNS = (
    "date store_id category total_transactions cash_transactions card_transactions amount_total amount_cash "
    "amount_card units_sold avg_ticket has_promotion replenishment_signal"
).split()


def union_all(template: str, names, **more) -> str:
    return " UNION ALL ".join(template.format(c=c, **more) for c in names)


LONG_MEASURES = union_all(
    "SELECT '{c}' AS \"column\", {c}::double AS v FROM facts WHERE {c} IS NOT NULL", C.MEASURES
)


@register(
    "o01_shapes",
    with_ctes(
        """SELECT 'transactions' AS "table", count(*) AS row_count, 13::bigint AS col_count FROM facts
 UNION ALL SELECT 'stores', count(*), 9 FROM stores UNION ALL SELECT 'calendar', count(*), 15 FROM calendar""",
        "facts",
        "stores",
        "calendar",
    ),
)
def o01(spark, folder):
    t = load(spark, folder)
    parts = [
        columns.table_shape(df).withColumn("table", F.lit(name))
        for name, df in (("transactions", t.facts), ("stores", t.stores), ("calendar", t.calendar))
    ]
    return tidy(parts[0].unionByName(parts[1]).unionByName(parts[2]))


@register(
    "o02_cardinality",
    with_ctes(
        union_all(
            "SELECT '{c}' AS \"column\", count(DISTINCT {c}) + max(({c} IS NULL)::int) AS cardinality FROM facts",
            FACT_COLUMNS,
        ),
        "facts",
    ),
)
def o02(spark, folder):
    return columns.cardinalities(load(spark, folder).facts).select("column", "cardinality")


# The first twenty nations as the dimension leave the other stores' facts orphaned.
@register(
    "o03_orphan_stores",
    with_ctes("SELECT DISTINCT store_id FROM facts WHERE store_id NOT IN (SELECT store_id FROM stores)", "facts", "stores"),
)
def o03(spark, folder):
    t = load(spark, folder)
    return overview.orphan_stores(t.facts, t.stores)


@register(
    "o03_orphan_documents",
    "SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL AND doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)",
)
def o03_documents(spark, folder):
    """The same check where something is missing: documents against the ratings."""
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    return overview.orphan_stores(docs, labels, "doc_id")


@register(
    "o04_idle_stores",
    with_ctes("SELECT store_id FROM stores WHERE store_id NOT IN (SELECT store_id FROM facts)", "facts", "stores"),
)
def o04(spark, folder):
    t = load(spark, folder)
    return overview.idle_stores(t.facts, t.stores)


@register(
    "o04_idle_vectors",
    """SELECT vec_id FROM (SELECT DISTINCT vec_id FROM embeddings WHERE vec_id IS NOT NULL)
 WHERE vec_id NOT IN (SELECT page_id FROM pages WHERE page_id IS NOT NULL)""",
)
def o04_vectors(spark, folder):
    """The same check where something is idle: vectors without a page of their number."""
    vectors, pages = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("embeddings", "pages"))
    return overview.idle_stores(pages.withColumnRenamed("page_id", "vec_id"), vectors, "vec_id")


@register(
    "o05_referential_match",
    with_ctes(
        """SELECT count(f) AS stores_in_facts, count(s) AS stores_in_dimension,
 count(*) FILTER (WHERE s IS NULL) AS orphan_stores, count(*) FILTER (WHERE f IS NULL) AS stores_without_facts,
 round(count(*) FILTER (WHERE f IS NOT NULL AND s IS NOT NULL) / greatest(count(s), 1) * 100, 6)
  AS referential_match_pct
 FROM (SELECT DISTINCT store_id AS f FROM facts) FULL JOIN (SELECT DISTINCT store_id AS s FROM stores) ON f = s""",
        "facts",
        "stores",
    ),
)
def o05(spark, folder):
    t = load(spark, folder)
    return tidy(overview.referential_match(t.facts, t.stores))


@register(
    "o06_date_span",
    with_ctes(
        """SELECT min(date) AS first_day, max(date) AS last_day,
 date_diff('day', min(date), max(date)) + 1 AS expected_days FROM facts""",
        "facts",
    ),
)
def o06(spark, folder):
    return overview.date_span(load(spark, folder).facts)


CONTINUITY_SQL = """SELECT store_id, min(date) AS min_date, max(date) AS max_date, count(DISTINCT date) AS active_days,
 (SELECT date_diff('day', min(date), max(date)) + 1 FROM facts) AS expected_days FROM facts GROUP BY store_id"""


@register(
    "o07_store_continuity",
    with_ctes(
        f"""SELECT *, expected_days - active_days AS missing_days,
 round(active_days / expected_days * 100, 6) AS continuity_pct FROM ({CONTINUITY_SQL})""",
        "facts",
    ),
)
def o07(spark, folder):
    return tidy(overview.store_continuity(load(spark, folder).facts))


@register(
    "o08_missing_store_days",
    with_ctes(
        f"""SELECT count(*) AS stores_count,
 sum(greatest(expected_days - active_days, 0))::bigint AS total_missing_store_days FROM ({CONTINUITY_SQL})""",
        "facts",
    ),
)
def o08(spark, folder):
    return tidy(overview.missing_store_days(load(spark, folder).facts))


@register(
    "q01_null_counts",
    with_ctes(
        union_all(
            """SELECT '{c}' AS "column", count(*) AS total_rows, count(*) - count({c}) AS null_count,
 round((count(*) - count({c})) / count(*) * 100, 6) AS null_percentage FROM facts""",
            FACT_COLUMNS,
        ),
        "facts",
    ),
)
def q01(spark, folder):
    return tidy(columns.null_counts(load(spark, folder).facts))


@register(
    "q02_null_totals",
    with_ctes(
        f"""SELECT count(*) AS total_rows, sum(nulls)::bigint AS total_null_cells, count(*) * 13 AS total_cells,
 round(sum(nulls) / (count(*) * 13) * 100, 6) AS global_null_percentage
 FROM (SELECT {" + ".join(f"({c} IS NULL)::int" for c in FACT_COLUMNS)} AS nulls FROM facts)""",
        "facts",
    ),
)
def q02(spark, folder):
    return tidy(columns.null_totals(load(spark, folder).facts))


@register(
    "q03_nulls_by_category",
    with_ctes(
        "SELECT * FROM ("
        + union_all(
            """SELECT '{c}' AS "column", category, count(*) FILTER (WHERE {c} IS NULL) AS null_count
 FROM facts GROUP BY category""",
            C.GROUPED_NULL_MEASURES,
        )
        + ") WHERE null_count > 0",
        "facts",
    ),
)
def q03(spark, folder):
    return columns.nulls_by(load(spark, folder).facts, "category", C.GROUPED_NULL_MEASURES)


# Whole line items have no copies; without the order key and prices they do.
@register(
    "q04_duplicate_rows",
    with_ctes(
        """SELECT 'facts' AS "table", (count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM facts))) AS duplicate_rows
 FROM facts UNION ALL SELECT 'lineitem', (SELECT count(*) FROM lineitem) -
 (SELECT count(*) FROM (SELECT DISTINCT * FROM lineitem))
 UNION ALL SELECT 'lineitem_keys', (SELECT count(*) FROM lineitem) -
 (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem))""",
        "facts",
    ),
)
def q04(spark, folder):
    items = spark.read.parquet(f"{folder}/lineitem.parquet")
    tables = {
        "facts": load(spark, folder).facts,
        "lineitem": items,
        "lineitem_keys": items.select("l_orderkey", "l_linenumber"),
    }
    parts = [columns.duplicate_rows(df).withColumn("table", F.lit(n)) for n, df in tables.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


WITH_CONSTANTS = """(SELECT *, 'MXN' AS currency, CASE WHEN total_transactions < 4 THEN 'usual' ELSE 'busy' END AS load
 FROM facts)"""
MORE_COLUMNS = [*FACT_COLUMNS, "currency", "load"]


def _with_constants(spark, folder):
    busy = F.when(F.col("total_transactions") < 4, "usual").otherwise("busy")
    return load(spark, folder).facts.withColumns({"currency": F.lit("MXN"), "load": busy})


@register(
    "q05_constant_columns",
    with_ctes(
        'SELECT "column" FROM ('
        + union_all(
            "SELECT '{c}' AS \"column\", count(DISTINCT {c}) + max(({c} IS NULL)::int) AS n FROM {source}",
            MORE_COLUMNS,
            source=WITH_CONSTANTS,
        )
        + ") WHERE n <= 1",
        "facts",
    ),
)
def q05(spark, folder):
    return columns.constant_columns(_with_constants(spark, folder))


@register(
    "q06_near_constant_columns",
    with_ctes(
        'SELECT "column", round(share, 6) AS top_share FROM ('
        + union_all(
            """SELECT '{c}' AS "column", max(n) / sum(n) AS share
 FROM (SELECT {c}, count(*) AS n FROM {source} GROUP BY {c})""",
            MORE_COLUMNS,
            source=WITH_CONSTANTS,
        )
        + ") WHERE share > 0.99",
        "facts",
    ),
)
def q06(spark, folder):
    return tidy(columns.near_constant_columns(_with_constants(spark, folder)))


BOUNDS_SQL = f"""SELECT "column", n, q25, q75, q75 - q25 AS iqr, q25 - 1.5 * (q75 - q25) AS lower_bound,
 q75 + 1.5 * (q75 - q25) AS upper_bound FROM (SELECT "column", count(*) AS n, quantile_cont(v, 0.25) AS q25,
 quantile_cont(v, 0.75) AS q75 FROM ({LONG_MEASURES}) WHERE "column" IN {C.OUTLIER_MEASURES} GROUP BY "column")"""


@register(
    "q07_iqr_bounds",
    with_ctes(
        f"""SELECT "column", n, round(q25, 6) AS q25, round(q75, 6) AS q75, round(iqr, 6) AS iqr,
 round(lower_bound, 6) AS lower_bound, round(upper_bound, 6) AS upper_bound FROM ({BOUNDS_SQL})""",
        "facts",
    ),
)
def q07(spark, folder):
    return tidy(quality.iqr_bounds(load(spark, folder).stored().facts))


@register(
    "q08_iqr_outliers",
    with_ctes(
        f"""SELECT l."column", count(*) FILTER (WHERE v < lower_bound OR v > upper_bound) AS outlier_count,
 round(count(*) FILTER (WHERE v < lower_bound OR v > upper_bound) / count(*) * 100, 6) AS outlier_pct
 FROM ({LONG_MEASURES}) l JOIN ({BOUNDS_SQL}) b ON l."column" = b."column" GROUP BY l."column" """,
        "facts",
    ),
)
def q08(spark, folder):
    return tidy(quality.iqr_outliers(load(spark, folder).stored().facts))


SKEW_SQL = "round(coalesce(CASE WHEN isnan(skewness(v)) THEN 0 ELSE skewness(v) END, 0), 6)"
KURT_SQL = "round(coalesce(kurtosis(v), 0), 6)"


@register(
    "p01_describe",
    with_ctes(
        f"""SELECT "column", count(*) AS "count", round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std,
 round(min(v), 6) AS "min", round(max(v), 6) AS "max" FROM ({LONG_MEASURES}) GROUP BY "column" """,
        "facts",
    ),
)
def p01(spark, folder):
    described = columns.numeric_describe(load(spark, folder).facts, C.MEASURES)
    return tidy(described.select("column", "count", "mean", "std", "min", "max"))


PERCENTILE_SQL = ", ".join(
    f"round(quantile_cont(v, {p}), 6) AS {name}" for name, p in profile.PERCENTILES.items()
)


@register(
    "p02_percentiles",
    with_ctes(f'SELECT "column", {PERCENTILE_SQL} FROM ({LONG_MEASURES}) GROUP BY "column"', "facts"),
)
def p02(spark, folder):
    return tidy(profile.percentiles(load(spark, folder).stored().facts))


RANKS_SQL = "unnest([" + ", ".join(f"{p}::double" for p in profile.PERCENTILES.values()) + "]) AS p"


@register(
    "p02_percentiles_approx",
    with_ctes(
        f'SELECT "column", n, {RANKS_SQL}, true AS within_bound FROM (SELECT "column", count(*) AS n FROM ({LONG_MEASURES}) GROUP BY "column")',
        "facts",
    ),
)
def p02_approx(spark, folder):
    """Percentiles from written states per day; the ranks that they have among all readings keep the bound."""
    facts = load(spark, folder).stored().facts
    states = settle(sketches.part_states(facts, C.MEASURES), "states")
    found = settle(sketches.merged_quantiles(states, list(profile.PERCENTILES.values())), "quantiles")
    within = F.col("rank_error") <= sketches.rank_bound() + 1 / F.col("n")
    return sketches.rank_errors(facts, found).select("column", "n", "p", within.alias("within_bound"))


@register(
    "p03_shape",
    with_ctes(
        f"""SELECT "column", {SKEW_SQL} AS skewness, {KURT_SQL} AS kurtosis FROM ({LONG_MEASURES}) GROUP BY "column" """,
        "facts",
    ),
)
def p03(spark, folder):
    described = columns.numeric_describe(load(spark, folder).facts, C.MEASURES)
    return tidy(described.select("column", "skewness", "kurtosis"))


@register(
    "p04_payment_shares",
    with_ctes(
        """SELECT round(a, 2) AS total_amount, round(ac, 2) AS total_amount_cash, round(ad, 2) AS total_amount_card,
 t AS total_transactions, tc AS total_cash_transactions, td AS total_card_transactions,
 round(ac / a * 100, 6) AS cash_amount_share_pct, round(ad / a * 100, 6) AS card_amount_share_pct,
 round(tc / t * 100, 6) AS cash_tx_share_pct, round(td / t * 100, 6) AS card_tx_share_pct
 FROM (SELECT sum(amount_total::decimal(18,2))::double AS a, sum(amount_cash::decimal(18,2))::double AS ac,
 sum(amount_card::decimal(18,2))::double AS ad, sum(total_transactions)::bigint AS t,
 sum(cash_transactions)::bigint AS tc, sum(card_transactions)::bigint AS td FROM facts)""",
        "facts",
    ),
)
def p04(spark, folder):
    return tidy(profile.payment_shares(load(spark, folder).facts))


@register(
    "p05_format_performance",
    with_ctes(
        """SELECT store_format, count(DISTINCT f.store_id) AS store_count,
 round(sum(amount_total::decimal(18,2))::double, 6) AS total_sales_mxn,
 round(avg(amount_total), 6) AS mean_daily_sales_mxn, round(avg(avg_ticket), 6) AS mean_avg_ticket_mxn,
 round(avg(units_sold), 6) AS mean_units_sold, round(quantile_cont(amount_total, 0.5), 6) AS median_daily_sales_mxn,
 round(quantile_cont(avg_ticket, 0.5), 6) AS median_avg_ticket_mxn
 FROM facts f JOIN stores s ON f.store_id = s.store_id GROUP BY store_format""",
        "facts",
        "stores",
    ),
)
def p05(spark, folder):
    t = load(spark, folder).stored()
    return tidy(profile.format_performance(t.facts, t.stores))


@register(
    "p06_socioeconomic_performance",
    with_ctes(
        """SELECT socioeconomic_level, count(DISTINCT f.store_id) AS store_count,
 round(sum(amount_total::decimal(18,2))::double, 6) AS total_sales_mxn,
 round(avg(amount_total), 6) AS mean_daily_sales_mxn, round(avg(avg_ticket), 6) AS mean_avg_ticket_mxn,
 round(sum(amount_cash::decimal(18,2))::double / sum(amount_total::decimal(18,2))::double * 100, 6) AS cash_share_pct
 FROM facts f JOIN stores s ON f.store_id = s.store_id GROUP BY socioeconomic_level""",
        "facts",
        "stores",
    ),
)
def p06(spark, folder):
    t = load(spark, folder)
    return tidy(profile.socioeconomic_performance(t.facts, t.stores))


@register(
    "p07_promotion_split",
    with_ctes(
        """SELECT has_promotion::bigint AS has_promotion, count(*) AS record_count,
 round(count(*) / (SELECT count(*) FROM facts) * 100, 6) AS record_pct,
 round(avg(amount_total), 6) AS mean_amount_total, round(avg(units_sold), 6) AS mean_units_sold,
 round(avg(avg_ticket), 6) AS mean_avg_ticket, round(quantile_cont(amount_total, 0.5), 6) AS median_amount_total
 FROM facts GROUP BY has_promotion""",
        "facts",
    ),
)
def p07(spark, folder):
    return tidy(profile.promotion_split(load(spark, folder).stored().facts))


@register(
    "p08_promotion_lift",
    with_ctes(
        """SELECT a AS with_promotion, b AS without_promotion, round((a - b) / b * 100, 6) AS sales_lift_pct
 FROM (SELECT round(avg(amount_total) FILTER (WHERE has_promotion = 1), 2) AS a,
 round(avg(amount_total) FILTER (WHERE has_promotion = 0), 2) AS b FROM facts)""",
        "facts",
    ),
)
def p08(spark, folder):
    return tidy(profile.promotion_lift(load(spark, folder).facts, 2))


@register(
    "p09_signal_nulls",
    with_ctes(
        """SELECT count(*) - count(replenishment_signal) AS null_count,
 round((count(*) - count(replenishment_signal)) / count(*) * 100, 6) AS null_pct FROM facts""",
        "facts",
    ),
)
def p09(spark, folder):
    return tidy(profile.signal_nulls(load(spark, folder).facts))


@register(
    "p10_signal_correlations",
    with_ctes(
        """SELECT round(corr(replenishment_signal, amount_total), 6) AS correlation_with_amount_total,
 round(corr(replenishment_signal, units_sold), 6) AS correlation_with_units_sold FROM facts""",
        "facts",
    ),
)
def p10(spark, folder):
    return tidy(profile.signal_correlations(load(spark, folder).facts))


@register(
    "p11_recent_signal_nulls",
    with_ctes(
        """SELECT count(*) AS rows, round((count(*) - count(replenishment_signal)) / count(*) * 100, 6) AS recent_null_pct
 FROM facts WHERE date >= (SELECT max(date) - 7 FROM facts)""",
        "facts",
    ),
)
def p11(spark, folder):
    return tidy(profile.recent_signal_nulls(load(spark, folder).facts))


DOMAINS_SQL = """SELECT DISTINCT 'category' AS "column", category AS value FROM facts
 UNION ALL SELECT DISTINCT 'region', region FROM stores UNION ALL SELECT DISTINCT 'socioeconomic_level',
 socioeconomic_level FROM stores UNION ALL SELECT DISTINCT 'store_format', store_format FROM stores"""


@register(
    "e01_domain_values",
    with_ctes(
        f'SELECT "column", value, count(*) OVER (PARTITION BY "column") AS cardinality FROM ({DOMAINS_SQL})',
        "facts",
        "stores",
    ),
)
def e01(spark, folder):
    t = load(spark, folder)
    of_stores = ["region", "socioeconomic_level", "store_format"]
    values = readiness.domain_values(t.facts, ["category"]).unionByName(readiness.domain_values(t.stores, of_stores))
    sizes = readiness.domain_sizes(t.facts, ["category"]).unionByName(readiness.domain_sizes(t.stores, of_stores))
    return values.join(sizes, "column")


@register(
    "e02_repair_need",
    with_ctes(
        union_all(
            """SELECT '{c}' AS "column", round((count(*) - count({c})) / count(*) * 100, 6) AS null_percentage FROM facts""",
            ("amount_cash", "units_sold", "replenishment_signal"),
        ),
        "facts",
    ),
)
def e02(spark, folder):
    return tidy(readiness.repair_need(load(spark, folder).facts))


def _pairs_sql(names) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS var1, '{b}' AS var2, corr({a}, {b}) AS r FROM facts"
        for i, a in enumerate(names)
        for b in names[i + 1 :]
    )


@register(
    "e03_collinear_pairs",
    with_ctes(
        f"""SELECT var1, var2, round(r, 6) AS correlation FROM ({_pairs_sql(C.COLLINEAR_MEASURES)}) WHERE abs(r) > 0.5""",
        "facts",
    ),
)
def e03(spark, folder):
    """With a lower threshold than the default, which no pair of this data reaches."""
    return tidy(readiness.collinear_pairs(load(spark, folder).facts, threshold=0.5))


@register(
    "e04_grid_sparsity",
    with_ctes(
        """SELECT s AS unique_stores, c AS unique_categories, d AS total_days, n AS actual_rows,
 s * c * d AS theoretical_rows, s * c * d - n AS missing_rows, round((1 - n / (s * c * d)) * 100, 6) AS sparsity_pct
 FROM (SELECT count(DISTINCT store_id) AS s, count(DISTINCT category) AS c, count(DISTINCT date) AS d, count(*) AS n
 FROM facts)""",
        "facts",
    ),
)
def e04(spark, folder):
    return tidy(readiness.grid_sparsity(load(spark, folder).facts))


@register(
    "v01_missing_share",
    with_ctes(
        'SELECT * FROM (SELECT "column", round(nulls / n * 100, 6) AS null_percentage FROM ('
        + union_all(
            "SELECT '{c}' AS \"column\", count(*) AS n, count(*) - count({c}) AS nulls FROM joined",
            [
                *FACT_COLUMNS,
                "store_format",
                "region",
                "size_sqm",
                "season",
                "is_holiday",
                "holiday_name",
                "is_payday",
                "is_buen_fin",
            ],
        ).replace("FROM joined", "FROM (facts JOIN stores USING (store_id)) JOIN calendar USING (date)")
        + ")) WHERE null_percentage > 0",
        "facts",
        "stores",
        "calendar",
    ),
)
def v01(spark, folder):
    t = load(spark, folder)
    return tidy(charts.missing_share(t.facts, t.stores, t.calendar))


@register(
    "v02_daily_totals",
    with_ctes(
        """SELECT date, round(sum(amount_total::decimal(18,2))::double, 6) AS amount_total,
 sum(total_transactions)::bigint AS total_transactions FROM facts GROUP BY date ORDER BY date""",
        "facts",
    ),
)
def v02(spark, folder):
    return tidy(charts.daily_totals(load(spark, folder).facts))


def _box_sql(source: str, by: list[str]) -> str:
    keys = ", ".join([*by, '"column"'])
    match = " AND ".join(f"b.{k} = l.{k}" for k in [*by, '"column"'])
    picked = ", ".join(f"l.{k}" for k in [*by, '"column"'])
    near = "v BETWEEN q25 - 1.5 * (q75 - q25) AND q75 + 1.5 * (q75 - q25)"
    return f""", long AS ({source}), box AS (SELECT {keys}, count(*) AS n, quantile_cont(v, 0.25) AS q25,
 quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q75 FROM long GROUP BY {keys})
 SELECT {picked}, any_value(n) AS n, round(any_value(q25), 6) AS q25, round(any_value(median), 6) AS median,
 round(any_value(q75), 6) AS q75, round(min(v) FILTER (WHERE {near}), 6) AS whisker_low,
 round(max(v) FILTER (WHERE {near}), 6) AS whisker_high, count(*) FILTER (WHERE NOT ({near})) AS outliers
 FROM long l JOIN box b ON {match} GROUP BY {picked}"""


@register(
    "v03_store_boxes",
    with_ctes(
        _box_sql(
            union_all(
                """SELECT store_format, socioeconomic_level, '{c}' AS "column", {c} AS v FROM facts f
 JOIN stores s ON f.store_id = s.store_id WHERE {c} IS NOT NULL""",
                ("amount_total", "avg_ticket"),
            ),
            ["store_format", "socioeconomic_level"],
        ),
        "facts",
        "stores",
    ),
)
def v03(spark, folder):
    t = load(spark, folder).stored()
    return tidy(charts.store_boxes(t.facts, t.stores))


@register(
    "v04_event_means",
    with_ctes(
        union_all(
            """SELECT '{c}' AS event, CASE WHEN {c} THEN 'active' ELSE 'inactive' END AS state,
 round(avg(amount_total), 6) AS mean_amount_total FROM facts JOIN calendar USING (date) GROUP BY {c}""",
            charts.EVENT_FLAGS,
        ),
        "facts",
        "calendar",
    ),
)
def v04(spark, folder):
    t = load(spark, folder)
    return tidy(charts.event_means(t.facts, t.calendar))


@register(
    "v05_correlation_matrix",
    with_ctes(
        " UNION ALL ".join(
            f"SELECT '{a}' AS var1, '{b}' AS var2, round(corr({a}, {b}), 6) AS correlation FROM facts"
            for a in C.MEASURES
            for b in C.MEASURES
        ),
        "facts",
    ),
)
def v05(spark, folder):
    return tidy(readiness.correlation_matrix(load(spark, folder).facts))


CALENDAR_DAYS = "facts JOIN calendar USING (date)"


def _dated(spark, folder):
    """Facts with the calendar columns the notebook profiles."""
    t = load(spark, folder).stored()
    return t.facts.join(t.calendar, "date", "left")


@register(
    "n01_head_tail",
    with_ctes(
        """SELECT * FROM (SELECT 'head' AS part, date, store_id, category, round(amount_total, 6) AS amount_total FROM facts
 ORDER BY date, store_id, category LIMIT 5) UNION ALL SELECT * FROM (SELECT 'tail', date, store_id, category,
 round(amount_total, 6) FROM facts ORDER BY date DESC, store_id DESC, category DESC LIMIT 5)""",
        "facts",
    ),
)
def n01(spark, folder):
    facts = load(spark, folder).facts.select("date", "store_id", "category", "amount_total")
    order = ["date", "store_id", "category"]
    head = columns.head_rows(facts, order).withColumn("part", F.lit("head"))
    return tidy(head.unionByName(columns.tail_rows(facts, order).withColumn("part", F.lit("tail"))))


NUMERIC_DAYS = ["day_of_week", "week_of_year", "month", "year", "quarter"]
LONG_DAYS = union_all(f"SELECT '{{c}}' AS \"column\", {{c}}::double AS v FROM {CALENDAR_DAYS}", NUMERIC_DAYS)


@register(
    "n02_numeric_describe",
    with_ctes(
        f"""SELECT "column", count(*) AS "count", round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std,
 min(v) AS "min", max(v) AS "max", max(v) - min(v) AS "range", {SKEW_SQL} AS skewness, {KURT_SQL} AS kurtosis
 FROM ({LONG_DAYS}) GROUP BY "column" """,
        "facts",
        "calendar",
    ),
)
def n02(spark, folder):
    return tidy(columns.numeric_describe(_dated(spark, folder), NUMERIC_DAYS))


TEXT_DAYS = ["day_name", "season", "is_holiday", "is_payday", "is_weekend", "is_navidad_season", "holiday_name"]
COUNTS_SQL = union_all(
    f"SELECT '{{c}}' AS \"column\", {{c}}::varchar AS value, count(*) AS n FROM {CALENDAR_DAYS} GROUP BY {{c}}",
    TEXT_DAYS,
)


@register(
    "n03_categorical_describe",
    with_ctes(
        f"""SELECT "column", sum(n)::bigint AS "count", count(*) AS "unique",
 arg_min(value, (-n, value)) AS top, max(n) AS freq FROM ({COUNTS_SQL}) WHERE value IS NOT NULL GROUP BY "column" """,
        "facts",
        "calendar",
    ),
)
def n03(spark, folder):
    return columns.categorical_describe(_dated(spark, folder), TEXT_DAYS)


@register(
    "n04_nulls_and_duplicates",
    with_ctes(
        union_all(
            """SELECT '{c}' AS "column", count(*) - count({c}) AS null_count,
 round((count(*) - count({c})) / count(*) * 100, 6) AS null_percentage,
 (SELECT count(*) FROM days) - (SELECT count(*) FROM (SELECT DISTINCT * FROM days)) AS duplicate_rows
 FROM days""",
            TEXT_DAYS,
        ).replace("FROM days", f"FROM (SELECT {', '.join(TEXT_DAYS)} FROM {CALENDAR_DAYS})"),
        "facts",
        "calendar",
    ),
)
def n04(spark, folder):
    days = _dated(spark, folder).select(*TEXT_DAYS)
    copies = columns.duplicate_rows(days)
    nulls = columns.null_counts(days).drop("total_rows").withColumn("duplicate_rows", copies.scalar())
    return tidy(nulls)


@register(
    "n05_cardinality_report",
    with_ctes(
        f"""SELECT "column", CASE WHEN "column" IN ('day_name', 'season', 'holiday_name') THEN 'string' ELSE 'boolean' END
 AS "type", count(value) AS n_unique, round(count(value) / sum(n) * 100, 6) AS cardinality_pct
 FROM ({COUNTS_SQL}) GROUP BY "column" """,
        "facts",
        "calendar",
    ),
)
def n05(spark, folder):
    return tidy(columns.cardinality_report(_dated(spark, folder), TEXT_DAYS))


# The prose of the documents table has the stray blanks that the calendar lacks.
@register(
    "n06_whitespace",
    union_all(
        """SELECT '{c}' AS "column", count(*) FILTER (WHERE regexp_replace({c}, '^\\s+|\\s+$', '', 'g') <> {c}) AS padded,
 count(*) FILTER (WHERE regexp_replace({c}, '^\\s+|\\s+$', '', 'g') = '') AS empty FROM documents""",
        ("text", "lang", "source"),
    ),
)
def n06(spark, folder):
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    return columns.whitespace_report(documents, ["text", "lang", "source"])


@register(
    "n07_value_shares",
    with_ctes(
        f"""SELECT "column", value, n, round(n / sum(n) OVER (PARTITION BY "column") * 100, 6) AS pct
 FROM ({COUNTS_SQL})""",
        "facts",
        "calendar",
    ),
)
def n07(spark, folder):
    return tidy(columns.value_shares(_dated(spark, folder), TEXT_DAYS))


@register(
    "n08_extended_describe",
    with_ctes(
        f"""SELECT "column", count(*) AS "count", round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std,
 min(v) AS "min", max(v) AS "max", max(v) - min(v) AS "range", {SKEW_SQL} AS skewness, {KURT_SQL} AS kurtosis,
 quantile_cont(v, 0.25) AS p25, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS p75,
 quantile_cont(v, 0.75) - quantile_cont(v, 0.25) AS iqr FROM ({LONG_DAYS}) GROUP BY "column" """,
        "facts",
        "calendar",
    ),
)
def n08(spark, folder):
    return tidy(columns.extended_describe(_dated(spark, folder), NUMERIC_DAYS))


@register(
    "n09_histogram",
    with_ctes(
        f""", long AS ({LONG_DAYS}), edge AS (SELECT "column", min(v) AS lo, (max(v) - min(v)) / 15 AS w FROM long
 GROUP BY "column")
 SELECT "column", bin::bigint AS bin, round(lo + bin * w, 6) AS lower, round(lo + bin * w + w, 6) AS upper, count(*) AS n
 FROM (SELECT "column", lo, w, CASE WHEN w = 0 THEN 0 ELSE least(floor((v - lo) / w), 14) END AS bin
 FROM long JOIN edge USING ("column")) GROUP BY "column", bin, lo, w""",
        "facts",
        "calendar",
    ),
)
def n09(spark, folder):
    return tidy(columns.histogram(_dated(spark, folder), NUMERIC_DAYS))


@register(
    "n10_value_order",
    with_ctes(
        f"SELECT day_name, count(*) AS n FROM {CALENDAR_DAYS} GROUP BY day_name ORDER BY n DESC, day_name",
        "facts",
        "calendar",
    ),
)
def n10(spark, folder):
    return charts.value_order(_dated(spark, folder), "day_name")


@register("n10_calendar_boxes", with_ctes(_box_sql(LONG_DAYS, []), "facts", "calendar"))
def n10_boxes(spark, folder):
    return tidy(charts.box_statistics(_dated(spark, folder), NUMERIC_DAYS))


@register(
    "x01_zero_inflation",
    with_ctes(
        """SELECT count(cash_transactions) AS known, count(*) FILTER (WHERE cash_transactions = 0) AS zeros,
 round(count(*) FILTER (WHERE cash_transactions = 0) / count(cash_transactions) * 100, 6) AS zero_inflation_pct
 FROM facts""",
        "facts",
    ),
)
def x01(spark, folder):
    """On the cash counts: the signal itself is never zero where it is known."""
    return tidy(profile.zero_inflation(load(spark, folder).facts, "cash_transactions"))


@register(
    "x01_signal_zero_inflation",
    with_ctes(
        """SELECT count(replenishment_signal) AS known, count(*) FILTER (WHERE replenishment_signal = 0) AS zeros,
 round(count(*) FILTER (WHERE replenishment_signal = 0) / count(replenishment_signal) * 100, 6) AS zero_inflation_pct
 FROM facts""",
        "facts",
    ),
)
def x01_signal(spark, folder):
    return tidy(profile.zero_inflation(load(spark, folder).facts))


@register(
    "x01_signal_distribution",
    with_ctes(
        f"""SELECT category, n, zeros, {RANKS_SQL}, true AS within_bound FROM (SELECT category, count(replenishment_signal) AS n,
 count(*) FILTER (WHERE replenishment_signal = 0) AS zeros FROM facts GROUP BY category)""",
        "facts",
    ),
)
def x01_distribution(spark, folder):
    """Distribution of the signal by category beside its zeros: states of the days up to the split and of those after it, kept
    apart and merged."""
    facts = load(spark, folder).stored().facts
    days = F.col(C.DAY) <= F.lit(SPLITS.train_end)
    kept, added = (
        settle(sketches.part_states(facts.where(own), ["replenishment_signal"], ["category", C.DAY]), "states") for own in (days, ~days)
    )
    found = settle(profile.signal_distribution(facts, states=kept.unionByName(added)), "quantiles")
    within = F.col("rank_error") <= sketches.rank_bound() + 1 / F.col("n")
    checked = sketches.rank_errors(facts, found.drop("zeros"), ["category"]).select("category", "n", "p", within.alias("within_bound"))
    return checked.join(found.select("category", "zeros").distinct(), "category").select("category", "n", "zeros", "p", "within_bound")


@register(
    "x04_blind_windows",
    with_ctes(
        """SELECT store_id, category, last_known, date_diff('day', coalesce(last_known, first_day - 1),
 max(last_day) OVER ()) AS blind_days FROM (SELECT store_id, category,
 max(date) FILTER (WHERE replenishment_signal IS NOT NULL) AS last_known, min(date) AS first_day, max(date) AS last_day
 FROM grid GROUP BY store_id, category)""",
        "grid",
    ),
)
def x04(spark, folder):
    from registry.common import inputs

    i = inputs(spark, folder)
    return tidy(quality.blind_series(i.facts, i.stores, i.calendar, i.categories))


PAYMENT_LONG = """SELECT 'profiling' AS section, 'cash_vs_card.' || name AS path, round(value, 6) AS value,
 NULL::varchar AS "text" FROM (SELECT sum(amount_total::decimal(18,2))::double AS total_amount,
 sum(amount_cash::decimal(18,2))::double AS total_amount_cash, sum(amount_card::decimal(18,2))::double AS total_amount_card
 FROM facts) UNPIVOT (value FOR name IN (total_amount, total_amount_cash, total_amount_card))"""


def _payment_metrics(spark, folder):
    shares = profile.payment_shares(load(spark, folder).facts)
    return flatten(shares.select("total_amount", "total_amount_cash", "total_amount_card"), "profiling", "cash_vs_card")


@register("s03_write_statistics", with_ctes(PAYMENT_LONG, "facts"))
def s03(spark, folder):
    """The written document, read back as plain rows."""
    path = write_metrics(_payment_metrics(spark, folder), scratch_path(spark, "statistics"))
    return tidy(read_metrics(spark, path))


@register("s04_read_statistics")
def s04(spark, folder):
    """The whole statistics document of the exploration run, written and read back."""
    t = load(spark, folder).stored()
    document = exploration.statistics(t.facts, t.stores, t.calendar)
    return read_metrics(spark, write_metrics(document, scratch_path(spark, "statistics")))


@register("s05_run_results")
def s05(spark, folder):
    """Result rows of the training run, written and read back."""
    from registry.common import inputs
    from shelfspark.sources.trade_panel import SPLITS

    rows = training.results(training.panel(inputs(spark, folder, "region")), SPLITS)
    return read_metrics(spark, write_metrics(rows, scratch_path(spark, "results")))




@register(
    "a01_claim_audit",
    with_ctes(
        """, truth AS (SELECT sum(price)::double AS total FROM lines),
 measured AS (SELECT sum(amount_total::decimal(18,2))::double AS total_amount,
  sum(amount_cash::decimal(18,2))::double AS total_amount_cash FROM facts)
 SELECT 'total sales' AS fact, 'cash_vs_card.total_amount' AS path, round(total, 2) AS claimed,
  round(total_amount, 2) AS measured, 'PASSED' AS status FROM truth, measured WHERE total = total_amount
 UNION ALL SELECT 'cash sales', 'cash_vs_card.total_amount_cash', round(total, 2), round(total_amount_cash, 2), 'FAILED'
  FROM truth, measured WHERE total <> total_amount_cash
 UNION ALL SELECT 'gift cards', 'cash_vs_card.total_amount_gift', round(total, 2), NULL, 'MISSING' FROM truth""",
        "lines",
        "facts",
    ),
)
def a01(spark, folder):
    """Claims taken from the raw line items: one right, one wrong, one without a metric."""
    total = load(spark, folder).lines.agg(F.sum("price").cast("double").alias("claimed"))
    names = (
        ("total sales", "cash_vs_card.total_amount"),
        ("cash sales", "cash_vs_card.total_amount_cash"),
        ("gift cards", "cash_vs_card.total_amount_gift"),
    )
    rows = F.array(*[F.struct(F.lit(n).alias("fact"), F.lit(p).alias("path")) for n, p in names])
    claims = total.select("claimed", F.inline(rows)).withColumn("digits", F.lit(2))
    return tidy(audit.reconcile(claims, _payment_metrics(spark, folder)), 2)


# What a writer would say of each fact, in their order; the cash share is misquoted and the sparsity left out.
SENTENCES = (
    "The transactions table holds {} rows,",
    "its stores match the store table to {} percent",
    "with {} orphans.",
    "Of all cells {} percent are null;",
    "{} rows are exact copies.",
    "Sales come to {} MXN,",
    "of which cash makes {} percent",
    "and cards {} percent.",
    "A promotion lifts sales by {} percent.",
    None,
)
MISQUOTED = "cash share"


def _draft(metrics):
    """Lines of a draft that quotes the document, numbers with separators for thousands."""
    lines = [(path, digits, line, 1.5 if fact == MISQUOTED else 0.0) for (fact, path, digits), line in zip(audit.FACTS, SENTENCES, strict=True) if line]
    rows = F.array(*[F.struct(*map(F.lit, row)) for row in lines])
    said = metrics.sparkSession.range(1).select(F.inline(rows).alias("path", "digits", "line", "off"))
    number = F.col("value") + F.col("off")
    quoted = F.when(F.col("digits") == 0, F.format_number(number, 0)).when(F.col("digits") == 2, F.format_number(number, 2))
    return said.join(metrics, "path").select(F.replace("line", F.lit("{}"), quoted.otherwise(F.format_number(number, 4))).alias("line"))


AUDIT_SQL = """, sold AS (SELECT count(f) AS listed, count(*) FILTER (WHERE s IS NULL) AS orphans, count(f) FILTER (WHERE s IS NOT NULL) AS both_sides,
  count(s) AS known FROM (SELECT DISTINCT store_id AS f FROM facts) FULL JOIN (SELECT DISTINCT store_id AS s FROM stores) ON f = s),
 money AS (SELECT sum(amount_total::decimal(18,2))::double AS total, sum(amount_cash::decimal(18,2))::double AS cash,
  sum(amount_card::decimal(18,2))::double AS card, count(*) AS n, sum(NULLS)::double AS gaps,
  count(DISTINCT store_id) * count(DISTINCT category) * count(DISTINCT date) AS cells,
  round(avg(amount_total) FILTER (WHERE has_promotion = 1), 2) AS promoted, round(avg(amount_total) FILTER (WHERE has_promotion = 0), 2) AS plain
  FROM (SELECT *, NULL_SUM AS NULLS FROM facts)),
 copies AS (SELECT (SELECT count(*) FROM facts) - (SELECT count(*) FROM (SELECT DISTINCT * FROM facts)) AS n),
 audited(fact, path, measured, status) AS (
 SELECT 'row count', 'tables_overview.transactions.row_count', n::double, 'PASSED' FROM money
 UNION ALL SELECT 'referential match', 'referential_integrity.referential_match_pct', both_sides / greatest(known, 1) * 100, 'PASSED' FROM sold
 UNION ALL SELECT 'orphan stores', 'referential_integrity.orphan_stores', orphans::double, 'PASSED' FROM sold
 UNION ALL SELECT 'global null share', 'missingness.transactions.global_null_percentage', gaps / (n * 13) * 100, 'PASSED' FROM money
 UNION ALL SELECT 'exact duplicates', 'exact_duplicates.transactions.duplicate_rows', n::double, 'PASSED' FROM copies
 UNION ALL SELECT 'total sales', 'cash_vs_card.total_amount', total, 'PASSED' FROM money
 UNION ALL SELECT 'cash share', 'cash_vs_card.cash_amount_share_pct', cash / total * 100, 'FAILED' FROM money
 UNION ALL SELECT 'card share', 'cash_vs_card.card_amount_share_pct', card / total * 100, 'PASSED' FROM money
 UNION ALL SELECT 'promotion lift', 'promotion_impact.sales_lift_pct', (promoted - plain) / plain * 100, 'PASSED' FROM money
 UNION ALL SELECT 'temporal sparsity', 'temporal_sparsity.sparsity_pct', (1 - n / cells) * 100, 'FAILED' FROM money)""".replace(
    "NULL_SUM", " + ".join(f"({c} IS NULL)::int" for c in FACT_COLUMNS)
)


def _audit(spark, folder):
    """A draft of the ten facts, written and read as text, next to the document that it quotes."""
    t = load(spark, folder).stored()
    metrics = settle(exploration.audited_metrics(t.facts, t.stores), "metrics")
    path = scratch_path(spark, "draft")
    _draft(metrics).write.text(path)
    return audit.audit_draft(read_draft(spark, path), metrics)


@register("a01_draft_audit", with_ctes(AUDIT_SQL + " SELECT fact, path, round(measured, 6) AS measured, status FROM audited", "facts", "stores"))
def a01_draft(spark, folder):
    """The ten facts in a draft that misquotes one and leaves one out."""
    return tidy(_audit(spark, folder))


@register(
    "a01_draft_verdict",
    with_ctes(
        AUDIT_SQL
        + """ SELECT count(*) AS checks, count(*) FILTER (WHERE status = 'PASSED') AS passed, count(*) FILTER (WHERE status <> 'PASSED') AS failed,
 count(*) FILTER (WHERE status <> 'PASSED') = 0 AS approved FROM audited""",
        "facts",
        "stores",
    ),
)
def a01_verdict(spark, folder):
    return audit.verdict(_audit(spark, folder))


# Names of types differ between engines.
TYPES_SQL = union_all(
    """SELECT '{c}' AS "table", column_name AS "column", CASE data_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int'
 WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'TIMESTAMP WITH TIME ZONE' THEN 'timestamp' ELSE lower(data_type) END AS "type" FROM information_schema.columns WHERE table_name = '{c}'""",
    ("lineitem", "part", "supplier"),
)


@register("o01_column_types", TYPES_SQL)
def o01_types(spark, folder):
    """Columns and types of given tables, as their files declare them."""
    parts = [
        columns.column_types(spark.read.parquet(f"{folder}/{name}.parquet")).select(F.lit(name).alias("table"), "column", "type")
        for name in ("lineitem", "part", "supplier")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
