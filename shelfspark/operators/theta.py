"""Theta forecasts in column expressions: weekly indices and the trend line from one aggregation, a fold for the level.

The sums of readings and of day-weighted readings by weekday give the weekly index of each weekday and, since the adjusted readings
are the readings over their index, the regression line through those as well: nothing passes over the days twice. A theta line
turns the adjusted readings around that line; its level is smoothed day by day. Each (series, parameter set) pair is a row,
and the set of the smallest squared one-step errors stays.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark import contract as C
from shelfspark.operators.series import id_columns

#: (alpha, theta): weight of a new reading in the level, and how far the line turns the readings.
GRID = ((0.1, 2.0), (0.3, 2.0), (0.1, 3.0), (0.3, 1.0))
TINY, LEAST_INDEX = 1e-9, 1e-6


def _total(values: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, values)


def fit_theta(series: DataFrame, end, grid: Sequence[tuple[float, float]] = GRID, season: int = C.SEASON_LENGTH) -> DataFrame:
    """One row per series with days up to ``end``: ``unique_id``, ``n`` (days), ``alpha`` and ``theta`` as chosen from ``grid``,
    ``level``, ``intercept`` and ``slope`` of the line (by days after ``end``), ``index`` (factor of each day number modulo
    ``season``, counted from ``end``) and ``sse``. Of equal errors the first set wins. Days without a reading are passed over. Where
    a weekday has no reading, or an index is not positive, all are 1; a single day has slope 0."""
    if any(not 0 < a <= 1 or t < 1 for a, t in grid):
        raise ValueError("alpha lies above 0 and at most at 1, theta is 1 or more")
    known = series.where((F.col("ds") <= F.lit(end)) & F.col("y").isNotNull())
    t = F.datediff("ds", F.lit(end)).cast("double")
    phases, y = range(season), F.col("y").cast("double")
    rows = known.select(*dict.fromkeys([*id_columns(series), "unique_id"]), t.alias("t"), y.alias("y"))

    def by_phase(value: Column) -> list[Column]:
        return [F.sum(F.when(F.pmod(F.col("t").cast("int"), F.lit(season)) == k, value)) for k in phases]

    days, sums, weighted = by_phase(F.lit(1.0)), by_phase(F.col("y")), by_phase(F.col("t") * F.col("y"))
    # Calendar-bounded: as many readings as the series has days.
    moments = rows.groupBy(*rows.columns[:-2]).agg(
        F.count("*").alias("n"),
        F.sum("t").alias("st"),
        F.sum(F.col("t") * F.col("t")).alias("stt"),
        F.array(*days).alias("days"),
        F.array(*sums).alias("sums"),
        F.array(*weighted).alias("weighted"),
        F.array_sort(F.collect_list(F.struct("t", "y"))).alias("obs"),
    )
    mean = _total([F.coalesce(F.col("sums")[k], F.lit(0.0)) for k in phases]) / F.col("n")
    moments = moments.withColumn("mean", F.when(F.abs(mean) > TINY, mean).otherwise(1.0))
    raw = F.transform("sums", lambda s, k: s / F.col("days")[k] / F.col("mean"))
    usable = F.forall("raw", lambda v: F.coalesce(v > LEAST_INDEX, F.lit(False)))
    moments = moments.withColumn("raw", raw).withColumn(
        "index", F.when(usable, F.col("raw")).otherwise(F.array(*[F.lit(1.0)] * season))
    )

    def adjusted(name: str) -> Column:
        return _total([F.coalesce(F.col(name)[k], F.lit(0.0)) / F.col("index")[k] for k in phases])

    n, st = F.col("n"), F.col("st")
    spread = F.col("stt") - st * st / n
    moments = moments.withColumn("sx", adjusted("sums")).withColumn(
        "slope", F.when(spread > TINY, (adjusted("weighted") - st * F.col("sx") / n) / spread).otherwise(0.0)
    )
    lines = moments.withColumn("intercept", (F.col("sx") - F.col("slope") * st) / n).withColumn(
        "x", F.transform("obs", lambda o: F.struct(o["t"].alias("t"), (o["y"] / F.get(F.col("index"), F.pmod(o["t"].cast("int"), F.lit(season)))).alias("x")))
    )
    sets = F.array(*(F.struct(F.lit(i).alias("nth"), F.lit(float(a)).alias("alpha"), F.lit(float(b)).alias("theta")) for i, (a, b) in enumerate(grid)))
    pairs = lines.withColumn("p", F.explode(sets))
    alpha, theta = F.col("p.alpha"), F.col("p.theta")

    def line(t: Column) -> Column:
        return F.col("intercept") + F.col("slope") * t

    def turned(o: Column) -> Column:
        return theta * o["x"] + (1 - theta) * line(o["t"])

    def step(s: Column, o: Column) -> Column:
        error = o["x"] - s["level"] / theta - (1 - 1 / theta) * line(o["t"])
        level = alpha * turned(o) + (1 - alpha) * s["level"]
        return F.struct(level.alias("level"), (s["sse"] + error * error).alias("sse"))

    start = F.struct(turned(F.col("x")[0]).alias("level"), F.lit(0.0).alias("sse"))
    folded = pairs.withColumn("s", F.aggregate(F.slice("x", 2, F.size("x")), start, step))
    # The pairs of a series are unfolded in its partition and meet again in one aggregation.
    best = folded.groupBy("unique_id").agg(
        F.min_by(F.struct("n", "p", "s", "intercept", "slope", "index"), F.struct("s.sse", "p.nth")).alias("b")
    )
    return best.select("unique_id", "b.n", "b.p.alpha", "b.p.theta", "b.s.level", "b.intercept", "b.slope", "b.index", "b.s.sse")


def forecast_theta(states: DataFrame, end, horizon: int, season: int = C.SEASON_LENGTH) -> DataFrame:
    """(unique_id, ds, yhat) for the ``horizon`` days after ``end``, from the rows of ``fit_theta`` for that day."""
    rows = states.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    k, theta = F.col("step"), F.col("theta")
    line = F.col("intercept") + F.col("slope") * k
    yhat = (F.col("level") / theta + (1 - 1 / theta) * line) * F.get("index", F.pmod(k, F.lit(season)))
    return rows.select("unique_id", F.date_add(F.lit(end), k).alias("ds"), yhat.alias("yhat"))
