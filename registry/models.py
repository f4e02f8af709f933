"""Registered queries: series, folds, smoothing, boosted models, scores and the gate."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from registry.common import digest, digest_sql, inputs, load, tidy, with_ctes
from registry.panel import COMPLETE_SQL, ENC_CTES
from shelfspark import contract as C
from shelfspark.functions import scores as S
from shelfspark.operators import anomaly, boosting, scoring, series, smoothing, states, theta
from shelfspark.plans import challenge, training
from shelfspark.session import scratch_path, settle
from shelfspark.sources.trade_panel import SPLITS

VAL_END = SPLITS.val_end
QUERIES, ORACLE = {}, {}
# The training run's own settings of the two boosted models.
RUN = {"deep": {"n_trees": 400, "learning_rate": 0.03}, "shallow": {"n_trees": 300, "learning_rate": 0.03}}


def register(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return keep


def _panel(spark, folder, grain="supplier"):
    return training.panel(inputs(spark, folder, grain))


def _vectors(spark, folder):
    return training.panel_vectors(inputs(spark, folder), VAL_END)


def _series(spark, folder, grain="supplier"):
    return series.build_series(_panel(spark, folder, grain), VAL_END, keyed=True)


def _series_digest(df):
    return digest(df, ["y"], series.id_columns(df) + ["unique_id"], "ds").drop(*C.KEYS)


def _series_digest_sql(source):
    return digest_sql(source, ["y"], "unique_id", "ds")


@register("t01_series", with_ctes(_series_digest_sql("series_raw"), "series_raw"))
def t01(spark, folder):
    return _series_digest(series.to_long(_panel(spark, folder), VAL_END, keyed=True))


@register("t02_filled_series", with_ctes(_series_digest_sql("series"), "series"))
def t02(spark, folder):
    return _series_digest(_series(spark, folder))


FOLD_SQL = """SELECT unique_id, cutoff, ds, step::bigint AS step, round(y, 6) AS y FROM folds"""


@register("t03_rolling_folds", with_ctes(FOLD_SQL, "folds"))
def t03(spark, folder):
    return tidy(series.rolling_folds(_series(spark, folder), VAL_END).drop("yhat"))


@register(
    "t04_seasonal_naive",
    with_ctes(
        "SELECT unique_id, cutoff, ds, 'SeasonalNaive' AS model, round(y, 6) AS y, round(yhat, 6) AS yhat FROM folds",
        "folds",
    ),
)
def t04(spark, folder):
    return tidy(series.seasonal_naive_folds(_series(spark, folder), VAL_END))


LONG_SQL = """SELECT unique_id, cutoff, ds, date_diff('day', cutoff, ds)::bigint AS step, round(y, 6) AS y,
 round(CASE WHEN ds - cutoff <= 7 THEN week ELSE fortnight END, 6) AS yhat
 FROM (SELECT *, unnest([date '2001-09-08', date '2001-09-15', date '2001-09-22']) AS cutoff FROM (
  SELECT unique_id, ds, y, lag(y, 7) OVER own AS week, lag(y, 14) OVER own AS fortnight
  FROM series WINDOW own AS (PARTITION BY unique_id ORDER BY ds)) WHERE ds > date '2001-09-08')
 WHERE ds > cutoff AND ds <= cutoff + 14"""


@register("t04_overlapping_folds", with_ctes(LONG_SQL, "series"))
def t04_long(spark, folder):
    return tidy(series.rolling_folds(_series(spark, folder), VAL_END, horizon=14, step=7, windows=3))


@register("t05_smoothing_folds")
def t05(spark, folder):
    return smoothing.model_folds(_vectors(spark, folder), VAL_END, (smoothing.ETS,))


HOLT_SQL = """, numbered AS (SELECT unique_id, y, row_number() OVER (PARTITION BY unique_id ORDER BY ds) AS i FROM series),
 opening AS (SELECT unique_id, list(y ORDER BY i) AS w, sum(y ORDER BY i) / 7 AS l FROM numbered WHERE i <= 7
  GROUP BY unique_id),
 fold AS (SELECT unique_id, 7::bigint AS i, l AS level, 0.0::double AS trend,
  list_transform(w, lambda v: v - l) AS wave, 0.0::double AS sse FROM opening
  UNION ALL
  SELECT f.unique_id, f.i + 1, base + 0.1 * err, 0.95 * f.trend + 0.01 * err,
  list_append(list_slice(f.wave, 2, 7), f.wave[1] + 0.1 * err), f.sse + err * err
  FROM fold f JOIN numbered n ON n.unique_id = f.unique_id AND n.i = f.i + 1,
  LATERAL (SELECT f.level + 0.95 * f.trend AS base) b, LATERAL (SELECT n.y - b.base - f.wave[1] AS err) e)
 SELECT unique_id, i AS n, round(level, 6) AS level, round(trend, 6) AS trend, round(sse, 2) AS sse
 FROM fold WHERE i = (SELECT max(i) FROM numbered)"""


@register("t05b_fixed_smoothing", with_ctes(HOLT_SQL, "series", coarse=True).replace("WITH ", "WITH RECURSIVE ", 1))
def t05b(spark, folder):
    fitted = smoothing.fixed_smoothing(_series(spark, folder, "region")).where("step = 1").drop("step", "yhat")
    return tidy(fitted).withColumn("sse", F.round("sse", 2))


# The fold of every (series, parameter set) pair of the small grid, day by day.
SEARCH_SQL = f""", numbered AS (SELECT unique_id, y, row_number() OVER (PARTITION BY unique_id ORDER BY ds) AS i FROM series),
 sets(nth, alpha, beta, phi, trended, gamma, seasonal) AS (VALUES {", ".join(str((i, *row[:6])) for i, row in enumerate(states.SMALL_GRID))}),
 weeks AS (SELECT unique_id, list(y ORDER BY i) AS w, avg(y) AS l, avg(y) FILTER (i > 7) - avg(y) FILTER (i <= 7) AS rise
  FROM numbered WHERE i <= 14 GROUP BY unique_id),
 fold AS (SELECT unique_id, nth, 0::bigint AS i, l::double AS level, (rise / 7 * trended)::double AS trend,
  list_transform(range(1, 8), lambda k: ((w[k] + w[k + 7]) / 2 - l) * seasonal::double) AS wave, 0.0::double AS sse FROM weeks, sets
  UNION ALL
  SELECT f.unique_id, f.nth, f.i + 1, base + alpha::double * err, phi::double * f.trend + beta::double * err,
  list_append(list_slice(f.wave, 2, 7), f.wave[1] + gamma::double * err), f.sse + err * err
  FROM fold f JOIN sets s ON s.nth = f.nth JOIN numbered n ON n.unique_id = f.unique_id AND n.i = f.i + 1,
  LATERAL (SELECT f.level + s.phi::double * f.trend AS base) b, LATERAL (SELECT n.y - b.base - f.wave[1] AS err) e),
 scored AS (SELECT *, i * ln(greatest(sse, 1e-12) / i) + 2 * free + 2 * free * (free + 1) / (i - free - 1) AS criterion FROM (
  SELECT *, 2 + 2 * trended + (phi < 1)::int + 8 * seasonal AS free FROM fold JOIN sets USING (nth) WHERE i = (SELECT max(i) FROM numbered))),
 best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY unique_id ORDER BY criterion, nth) = 1)"""


def _searched(series_sql: str) -> str:
    return with_ctes(SEARCH_SQL + series_sql, "series", coarse=True).replace("WITH ", "WITH RECURSIVE ", 1)


def _states(spark, folder, end=VAL_END):
    return states.fit_states(_series(spark, folder, "region"), end)


@register(
    "t05_searched_states",
    _searched(
        """ SELECT unique_id, date '2001-10-06' AS last_ds, i AS n, alpha::double AS alpha, beta::double AS beta, phi::double AS phi,
 gamma::double AS gamma, round(level, 6) AS level, round(trend, 6) AS trend, round(wave[1], 6) AS wave_1, round(wave[7], 6) AS wave_7,
 round(sse, 2) AS sse, round(criterion, 4) AS criterion FROM best"""
    ),
)
def t05_searched(spark, folder):
    """Parameter search as a fold: the best of four sets for every series, with its state."""
    found = _states(spark, folder).select(
        *("unique_id", "last_ds", "n", "alpha", "beta", "phi", "gamma", "level", "trend"),
        F.col("wave")[0].alias("wave_1"),
        F.col("wave")[6].alias("wave_7"),
        *("sse", "criterion"),
    )
    return tidy(found).withColumns({"sse": F.round("sse", 2), "criterion": F.round("criterion", 4)})


@register(
    "s06_series_states",
    _searched(
        """ SELECT unique_id, date '2001-10-06' + k::int AS ds, round(level + wave[(k - 1) % 7 + 1]
 + trend * CASE WHEN phi = 1 THEN k ELSE phi * (1 - phi ^ k) / (1 - phi) END, 6) AS yhat
 FROM (SELECT * REPLACE (phi::double AS phi), unnest(range(1, 30)) AS k FROM best)"""
    ),
)
def s06_states(spark, folder):
    """Forecasts of the holdout days from the states as they were written and read again."""
    return tidy(states.forecast_states(settle(_states(spark, folder), "states"), SPLITS.holdout_days))


@register(
    "t08_carried_states",
    with_ctes(
        "SELECT unique_id, true AS same_state, true AS same_season FROM series GROUP BY unique_id", "series", coarse=True
    ),
)
def t08_carried(spark, folder):
    """States of a week earlier, carried on by the last seven days, next to a refit of all days with the same parameters."""
    s, fixed = _series(spark, folder, "region"), states.SMALL_GRID[-1:]
    earlier = settle(states.fit_states(s, VAL_END - timedelta(days=7), fixed), "states")
    carried, refit = states.advance_states(earlier, s), states.fit_states(s, VAL_END, fixed)

    def near(name: str):
        return F.abs(F.col(f"a.{name}") - F.col(f"b.{name}")) <= 1e-9 * (1 + F.abs(f"b.{name}"))

    both = carried.alias("a").join(refit.alias("b"), "unique_id")
    same = near("level") & near("trend") & near("sse") & near("criterion") & (F.col("a.last_ds") == F.col("b.last_ds")) & (F.col("a.n") == F.col("b.n"))
    waves = F.forall(F.zip_with("a.wave", "b.wave", lambda x, y: F.abs(x - y) <= 1e-9 * (1 + F.abs(y))), lambda x: x)
    return both.select("unique_id", same.alias("same_state"), waves.alias("same_season"))


@register("t06_theta_folds")
def t06(spark, folder):
    return smoothing.model_folds(_vectors(spark, folder), VAL_END, (smoothing.THETA,))


# The line and the indices by SQL's own aggregates, the level of every (series, parameter set) pair day by day.
THETA_SQL = f""", rows AS (SELECT unique_id, y, date_diff('day', date '2001-10-06', ds) AS t, row_number() OVER own AS i,
  avg(y) OVER (PARTITION BY unique_id) AS mean, avg(y) OVER (PARTITION BY unique_id, isodow(ds)) AS weekday
  FROM series WINDOW own AS (PARTITION BY unique_id ORDER BY ds)),
 factors AS (SELECT *, weekday / mean AS factor FROM rows),
 numbered AS (SELECT unique_id, i, t, factor, y / factor AS x FROM factors),
 line AS (SELECT unique_id, regr_slope(x, t) AS b, regr_intercept(x, t) AS a FROM numbered GROUP BY unique_id),
 sets(nth, alpha, theta) AS (VALUES {", ".join(str((i, *row)) for i, row in enumerate(theta.GRID))}),
 fold AS (SELECT unique_id, nth, i, s.theta::double * x + (1 - s.theta::double) * (a + b * t) AS level, 0.0::double AS sse
  FROM numbered JOIN line USING (unique_id), sets s WHERE i = 1
  UNION ALL
  SELECT f.unique_id, f.nth, n.i, s.alpha::double * (s.theta::double * n.x + (1 - s.theta::double) * (a + b * n.t)) + (1 - s.alpha::double) * f.level,
  f.sse + (n.x - f.level / s.theta::double - (1 - 1 / s.theta::double) * (a + b * n.t)) ^ 2
  FROM fold f JOIN sets s ON s.nth = f.nth JOIN numbered n ON n.unique_id = f.unique_id AND n.i = f.i + 1
  JOIN line l ON l.unique_id = f.unique_id),
 best AS (SELECT * FROM fold JOIN sets USING (nth) JOIN line USING (unique_id) WHERE i = (SELECT max(i) FROM numbered)
  QUALIFY row_number() OVER (PARTITION BY unique_id ORDER BY sse, nth) = 1)"""


def _theta_sql(body: str) -> str:
    return with_ctes(THETA_SQL + body, "series", coarse=True).replace("WITH ", "WITH RECURSIVE ", 1)


@register(
    "t06_theta_states",
    _theta_sql(
        """ SELECT unique_id, i AS n, alpha::double AS alpha, theta::double AS theta, round(level, 6) AS level, round(a, 6) AS intercept,
 round(b, 8) AS slope, round(sse, 2) AS sse FROM best"""
    ),
)
def t06_states(spark, folder):
    """Theta lines of all series, with the best of four parameter sets."""
    found = theta.fit_theta(_series(spark, folder, "region"), VAL_END)
    digits = {"level": 6, "intercept": 6, "slope": 8, "sse": 2}
    return found.select("unique_id", F.col("n").cast("bigint").alias("n"), "alpha", "theta", *(F.round(c, k).alias(c) for c, k in digits.items()))


@register(
    "t06_theta_forecasts",
    _theta_sql(
        """ SELECT b.unique_id, date '2001-10-06' + k::int AS ds,
 round((level / theta::double + (1 - 1 / theta::double) * (a + b * k)) * f.factor, 6) AS yhat
 FROM (SELECT *, unnest(range(1, 30)) AS k FROM best) b JOIN (SELECT DISTINCT unique_id, ((t % 7) + 7) % 7 AS phase, factor FROM factors) f
 ON f.unique_id = b.unique_id AND f.phase = k % 7"""
    ),
)
def t06_forecasts(spark, folder):
    """Forecasts of the holdout days from the theta lines as they were written and read again."""
    fitted = settle(theta.fit_theta(_series(spark, folder, "region"), VAL_END), "theta")
    return tidy(theta.forecast_theta(fitted, VAL_END, SPLITS.holdout_days))


LAG_BASELINE_SQL = f"""SELECT 'SeasonalNaive' AS model, replenishment_signal AS y, replenishment_signal_lag_7d AS yhat
 FROM ({COMPLETE_SQL}) WHERE split = 'VAL'"""


def _scores_sql(source: str) -> str:
    return f"""SELECT model, count(*) AS n, round(sum(abs(y - yhat)) / sum(abs(y)), 6) AS wape,
 round(sqrt(avg((y - yhat) ^ 2)), 6) AS rmse, round(sum(greatest(yhat - y, 0)), 4) AS overstock_units,
 round(sum(greatest(y - yhat, 0)), 4) AS stockout_units,
 round(sum(greatest(yhat - y, 0)) * 150 * 0.15, 4) AS overstock_cost_mxn,
 round(sum(greatest(y - yhat, 0)) * 150 * 0.30, 4) AS stockout_cost_mxn,
 round(sum(greatest(yhat - y, 0)) * 150 * 0.15 + sum(greatest(y - yhat, 0)) * 150 * 0.30, 4)
  AS total_financial_loss_mxn FROM ({source}) GROUP BY model"""


def _tidy_scores(df):
    loose = [c for c in df.columns if c.endswith(("_units", "_mxn"))]
    return tidy(df).withColumns({c: F.round(c, 4) for c in loose})


@register("t07_lag_baseline", with_ctes(_scores_sql(LAG_BASELINE_SQL), *ENC_CTES, coarse=True))
def t07(spark, folder):
    matrix = training.training_matrix(inputs(spark, folder, "region"))
    return _tidy_scores(scoring.score(training.lag_baseline(matrix)))


@register("t08_blind_forecast")
def t08(spark, folder):
    return training.blind_forecast(_vectors(spark, folder), SPLITS)


@register(
    "t09_forecast_summary",
    with_ctes(
        """SELECT count(yhat) AS forecast_records_count, round(avg(yhat), 6) AS mean_predicted_signal,
 round(min(yhat), 6) AS min_predicted_signal, round(max(yhat), 6) AS max_predicted_signal FROM folds""",
        "folds",
    ),
)
def t09(spark, folder):
    return tidy(series.forecast_summary(series.seasonal_naive_folds(_series(spark, folder), VAL_END)))


def _boosted(spark, folder, preset):
    """Fitted model, TRAIN and VAL rows. The matrix is written once for the rows of all rounds."""
    matrix = settle(training.training_matrix(inputs(spark, folder, "region")))
    names = training.matrix_features(matrix)
    train, val = (matrix.where(F.col("split") == s) for s in ("TRAIN", "VAL"))
    return boosting.DemandRegressor(preset, dict(RUN[preset])).fit(train, names, val), train, val


BOUND_SQL = with_ctes(
    f"""SELECT date, store_id, category, round(replenishment_signal, 6) AS y, true AS fits_training
 FROM ({COMPLETE_SQL}) WHERE split = 'VAL'""",
    *ENC_CTES,
    coarse=True,
)


def _bounded(spark, folder, preset):
    """Every predicted VAL row, and whether the model's squared error on TRAIN is below that of the mean."""
    model, train, val = _boosted(spark, folder, preset)
    y = F.col("replenishment_signal")
    fitted = model.predict(train)
    own, plain = F.sum((y - F.col(boosting.PREDICTION)) ** 2), F.var_pop(y) * F.count(y)
    fits = fitted.agg(own < plain).scalar()
    predicted = model.predict(val).where(F.col(boosting.PREDICTION).isNotNull())
    return tidy(predicted.select("date", *C.KEYS, y.alias("y"), fits.alias("fits_training")))


@register("t10_error_bound", BOUND_SQL)
def t10_bound(spark, folder):
    return _bounded(spark, folder, "deep")


@register("t11_error_bound", BOUND_SQL)
def t11_bound(spark, folder):
    return _bounded(spark, folder, "shallow")


@register(
    "s06_model_round_trip",
    with_ctes(
        f"SELECT count(*) AS rows, 0::bigint AS differing FROM ({COMPLETE_SQL}) WHERE split = 'VAL'", *ENC_CTES, coarse=True
    ),
)
def s06(spark, folder):
    """Predictions of a model before and after it was saved and loaded."""
    model, _, val = _boosted(spark, folder, "deep")
    path = scratch_path(spark, "model")
    model.save(path)
    before, after = (
        m.predict(val).select("date", *C.KEYS, F.col(boosting.PREDICTION).alias(name))
        for m, name in ((model, "before"), (boosting.DemandRegressor.load(path), "after"))
    )
    both = before.join(after, ["date", *C.KEYS])
    return both.agg(F.count("*").alias("rows"), F.count_if(~F.col("before").eqNullSafe(F.col("after"))).alias("differing"))


@register("t10_boosted_early_stop")
def t10(spark, folder):
    model, _, val = _boosted(spark, folder, "deep")
    return model.predict(val).select("date", *C.KEYS, "replenishment_signal", boosting.PREDICTION)


@register("t11_boosted_fixed")
def t11(spark, folder):
    model, _, val = _boosted(spark, folder, "shallow")
    return model.predict(val).select("date", *C.KEYS, "replenishment_signal", boosting.PREDICTION)


@register("t12_saved_model_predict")
def t12(spark, folder):
    """Save, reload and predict (also the model round trip of the sources section)."""
    model, _, val = _boosted(spark, folder, "deep")
    path = scratch_path(spark, "model")
    model.save(path)
    loaded = boosting.DemandRegressor.load(path)
    return loaded.predict(val).select("date", *C.KEYS, boosting.PREDICTION)


@register("t13_feature_importance")
def t13(spark, folder):
    model, _, _ = _boosted(spark, folder, "deep")
    return model.feature_importance(10)


SAMPLE_SQL = """(SELECT * FROM series WHERE unique_id IN (SELECT unique_id FROM (SELECT DISTINCT unique_id FROM series)
 ORDER BY md5(unique_id || ':42'), unique_id LIMIT 48))"""


@register("t14_sampled_series", with_ctes(_series_digest_sql(SAMPLE_SQL), "series"))
def t14(spark, folder):
    return _series_digest(series.sample_series(_series(spark, folder), 48))


@register("t15_model_ranking")
def t15(spark, folder):
    return tidy(challenge.challenge(_vectors(spark, folder), VAL_END))


BY_STORE_SQL = """(SELECT split_part(unique_id, '_', 2) AS store_no, y, yhat FROM folds)"""


def _naive_by_store(spark, folder):
    folds = series.seasonal_naive_folds(_series(spark, folder), VAL_END)
    return folds.withColumn("store_no", F.split("unique_id", "_")[1])


@register(
    "m01_wape",
    with_ctes(
        f"SELECT store_no, round(sum(abs(y - yhat)) / nullif(sum(abs(y)), 0), 6) AS wape FROM {BY_STORE_SQL} GROUP BY 1",
        "folds",
    ),
)
def m01(spark, folder):
    return tidy(_naive_by_store(spark, folder).groupBy("store_no").agg(S.wape("y", "yhat").alias("wape")))


# Days without a sale count as zero demand here, so some stores have months with a zero denominator.
ZERO_SQL = """SELECT store_no, month, round(CASE WHEN sum(a) = 0 THEN {zero} ELSE sum(e) / sum(a) END, 6) AS wape
 FROM (SELECT store_id AS store_no, strftime(date, '%Y-%m') AS month, abs(units) AS a, abs(units - coalesce(before, 0)) AS e FROM (
  SELECT store_id, date, units, lag(units) OVER (PARTITION BY store_id, category ORDER BY date) AS before
  FROM (SELECT store_id, category, date, coalesce(units_sold, 0) AS units FROM grid))) GROUP BY store_no, month"""


def _zero_demand(spark, folder, on_zero):
    from shelfspark.operators import grid
    from shelfspark.operators.features import add_lags

    i = inputs(spark, folder)
    dense = grid.densify(i.facts, i.stores, i.calendar, i.categories).fillna(0.0, ["units_sold"])
    rows = add_lags(dense, ("units_sold",), (1,)).fillna(0.0, ["units_sold_lag_1d"])
    rows = rows.withColumnRenamed("store_id", "store_no").withColumn("month", F.date_format("date", "yyyy-MM"))
    return tidy(rows.groupBy("store_no", "month").agg(S.wape("units_sold", "units_sold_lag_1d", on_zero).alias("wape")))


@register("m01_wape_zero_denominator", with_ctes(ZERO_SQL.format(zero="0.0"), "grid"))
def m01_zero(spark, folder):
    return _zero_demand(spark, folder, 0.0)


@register("m01b_wape_null_denominator", with_ctes(ZERO_SQL.format(zero="NULL"), "grid"))
def m01b(spark, folder):
    return _zero_demand(spark, folder, None)


@register(
    "m02_rmse",
    with_ctes(
        f"SELECT store_no, round(sqrt(avg((y - yhat) ^ 2)), 6) AS rmse FROM {BY_STORE_SQL} GROUP BY 1", "folds"
    ),
)
def m02(spark, folder):
    return tidy(_naive_by_store(spark, folder).groupBy("store_no").agg(S.rmse("y", "yhat").alias("rmse")))


@register(
    "m03_business_impact",
    with_ctes(
        f"""SELECT store_no, round(sum(greatest(yhat - y, 0)), 4) AS overstock_units,
 round(sum(greatest(y - yhat, 0)), 4) AS stockout_units,
 round(sum(greatest(yhat - y, 0)) * 150 * 0.15, 4) AS overstock_cost_mxn,
 round(sum(greatest(y - yhat, 0)) * 150 * 0.30, 4) AS stockout_cost_mxn,
 round(sum(greatest(yhat - y, 0)) * 150 * 0.15 + sum(greatest(y - yhat, 0)) * 150 * 0.30, 4)
  AS total_financial_loss_mxn FROM {BY_STORE_SQL} GROUP BY store_no""",
        "folds",
    ),
)
def m03(spark, folder):
    rows = _naive_by_store(spark, folder).groupBy("store_no").agg(*S.business_impact("y", "yhat"))
    return tidy(rows, 4)


# Two simple forecasters of the same folds, so the bundle, savings, gate and ranking meet SQL.
TWO_SQL = """SELECT 'SeasonalNaive' AS model, y, yhat FROM folds UNION ALL
 SELECT 'TrailingMean', f.y, m.yhat FROM folds f JOIN (SELECT unique_id, ds,
  avg(y) OVER (PARTITION BY unique_id ORDER BY ds ROWS BETWEEN 34 PRECEDING AND 7 PRECEDING) AS yhat FROM series) m
 USING (unique_id, ds)"""


def _two_models(spark, folder):
    vectors = settle(_vectors(spark, folder), "vectors")
    first = series.cutoffs(VAL_END)[0]
    s = series.unrolled(vectors, first - timedelta(days=34))
    frame = series.by_id(s).rowsBetween(-34, -7)
    trailing = s.withColumn("mean", F.avg("y").over(frame))
    folds = series.rolling_folds(vectors, VAL_END).select("unique_id", "ds", "y", "yhat")
    other = trailing.where(F.col("ds") > F.lit(first)).select(
        F.lit("TrailingMean").alias("model"), "y", F.col("mean").alias("yhat")
    )
    return folds.select(F.lit("SeasonalNaive").alias("model"), "y", "yhat").unionByName(other)


@register("m04_metric_bundle", with_ctes(_scores_sql(TWO_SQL), "folds", "series"))
def m04(spark, folder):
    return _tidy_scores(scoring.score(_two_models(spark, folder)))


_LOSS = f"""(SELECT model, sum(greatest(yhat - y, 0)) * 150 * 0.15 + sum(greatest(y - yhat, 0)) * 150 * 0.30 AS loss
 FROM ({TWO_SQL}) GROUP BY model)"""
SAVINGS_SQL = f"""SELECT round(max(loss) FILTER (WHERE model = 'SeasonalNaive'), 4) AS baseline_loss_mxn,
 round(min(loss) FILTER (WHERE model <> 'SeasonalNaive'), 4) AS best_loss_mxn,
 arg_min(model, loss) FILTER (WHERE model <> 'SeasonalNaive') AS best_model,
 round(max(loss) FILTER (WHERE model = 'SeasonalNaive') - min(loss) FILTER (WHERE model <> 'SeasonalNaive'), 4)
  AS savings_mxn {{gate}} FROM {_LOSS}"""
GATE_SQL = """, max(loss) FILTER (WHERE model = 'SeasonalNaive') >=
 min(loss) FILTER (WHERE model <> 'SeasonalNaive') AS passes_baseline_gate"""


@register("m05_savings", with_ctes(SAVINGS_SQL.format(gate=""), "folds", "series"))
def m05(spark, folder):
    return tidy(scoring.savings(scoring.score(_two_models(spark, folder))), 4)


@register("m06_promotion_gate", with_ctes(SAVINGS_SQL.format(gate=GATE_SQL), "folds", "series"))
def m06(spark, folder):
    return tidy(scoring.gate(scoring.score(_two_models(spark, folder))), 4)


@register("m06_production_gate")
def m06_production(spark, folder):
    """The gate on the smoothing model itself."""
    return scoring.gate(scoring.score(training.rolling_forecasts(_vectors(spark, folder), SPLITS)))


@register(
    "t15_two_model_ranking",
    with_ctes(
        f"""SELECT model, round(wape, 6) AS wape, row_number() OVER (ORDER BY wape, model) AS place,
 round(max(wape) FILTER (WHERE model = 'SeasonalNaive') OVER (), 6) AS baseline_wape,
 wape < max(wape) FILTER (WHERE model = 'SeasonalNaive') OVER () AS beats_baseline
 FROM (SELECT model, sum(abs(y - yhat)) / sum(abs(y)) AS wape FROM ({TWO_SQL}) GROUP BY model)""",
        "folds",
        "series",
    ),
)
def t15_two(spark, folder):
    return tidy(scoring.ranking(scoring.score(_two_models(spark, folder), on_zero=None)))


@register(
    "m07_split_rows",
    with_ctes("SELECT split, count(*) AS rows FROM master_s WHERE split IS NOT NULL GROUP BY split", "master_s"),
)
def m07(spark, folder):
    return training.split_counts(_panel(spark, folder), SPLITS)


@register("q09_isolation_forest")
def q09(spark, folder):
    t = load(spark, folder).stored()
    found = anomaly.find_anomalies(t.facts, t.calendar)
    return found.select("date", *C.KEYS, *C.FOREST_FEATURES, "normality", "commercial", "pos_error")


@register("q10_anomaly_summary")
def q10_summary(spark, folder):
    t = load(spark, folder).stored()
    return anomaly.summarize_anomalies(anomaly.find_anomalies(t.facts, t.calendar))


# Classification alone, of every fact.
_EVENT = """(coalesce(is_holiday, false) OR coalesce(is_buen_fin, false) OR coalesce(is_navidad_season, false)
 OR coalesce(is_payday, false))"""


@register(
    "q10_classification",
    with_ctes(
        f"""SELECT f.date, store_id, category, {_EVENT} AS commercial,
 (amount_total = 0 OR (cash_transactions IS NULL AND units_sold IS NULL) OR NOT {_EVENT}) AS pos_error
 FROM facts f LEFT JOIN calendar c ON f.date = c.date""",
        "facts",
        "calendar",
    ),
)
def q10(spark, folder):
    t = load(spark, folder)
    return anomaly.classify_anomalies(t.facts, t.calendar).select("date", *C.KEYS, "commercial", "pos_error")


def flagship(spark, folder):
    return scoring.score(training.rolling_forecasts(_vectors(spark, folder), SPLITS)).orderBy("wape")


@register("m04_rolling_evaluation")
def m04_rolling(spark, folder):
    return flagship(spark, folder)
