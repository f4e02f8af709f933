"""Fitted smoothing states as a table: searched, forecast from, and carried on day by day without a refit.

Every (series, parameter set) pair is a row; a fold over its days keeps level, trend, the seasonal terms and the sum of squared
errors, and the set of lowest corrected criterion stays. Everything is column expressions. A state holds all that a forecast of
any horizon needs; new days are folded into it with its own parameters. For the wide search grid over many
series the sweep in ``smoothing`` is the faster form of the same search.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark import contract as C
from shelfspark.functions.sweeps import ets_grid
from shelfspark.operators.series import series_vectors

PARAMETERS = ("alpha", "beta", "phi", "trended", "gamma", "seasonal", "multiplicative")
#: Level only; damped trend; season; damped trend with season.
SMALL_GRID = (
    (0.1, 0.0, 1.0, 0.0, 0.0, 0.0, 0.0),
    (0.1, 0.01, 0.95, 1.0, 0.0, 0.0, 0.0),
    (0.05, 0.0, 1.0, 0.0, 0.1, 1.0, 0.0),
    (0.1, 0.01, 0.95, 1.0, 0.1, 1.0, 0.0),
)
TINY = 1e-9


def wide_grid() -> list[tuple[float, ...]]:
    """The sets of the automatic search: additive ones, then those with a multiplicative season."""
    g = ets_grid()
    plain = list(zip(*(map(float, g[k]) for k in ("alpha", "beta", "phi", "trend", "gamma", "season")), strict=True))
    return [(*p, 0.0) for p in plain] + [(*p, 1.0) for p in plain if p[5] > 0]


def _average(y: Column, start: int | Column, count: int | Column) -> Column:
    return F.aggregate(F.slice(y, start, count), F.lit(0.0), lambda a, v: a + v) / count


def _opened(y: Column, p: Column, season: int) -> Column:
    """State before the first day, from the first two weeks, or what there is of them."""
    warm = F.least(F.size(y), F.lit(2 * season))
    level = _average(y, 1, warm)
    slope = F.when(warm == 2 * season, (_average(y, season + 1, season) - _average(y, 1, season)) / season).otherwise(0.0)

    def term(k: Column) -> Column:
        own = F.filter(F.slice(y, 1, warm), lambda _, i: F.pmod(i, F.lit(season)) == k)
        mean = F.when(F.size(own) > 0, F.aggregate(own, F.lit(0.0), lambda a, v: a + v) / F.size(own)).otherwise(level)
        odd = F.when(p["multiplicative"] > 0, mean / level - 1).otherwise(mean - level)
        return p["multiplicative"] + odd * p["seasonal"]

    return F.struct(
        level.alias("level"),
        (slope * p["trended"]).alias("trend"),
        F.transform(F.sequence(F.lit(0), F.lit(season - 1)), term).alias("wave"),
        F.lit(0.0).alias("sse"),
    )


def _safe(x: Column) -> Column:
    return F.when(F.abs(x) > TINY, x).otherwise(TINY)


def _folded(y: Column, state: Column, p: Column, season: int) -> Column:
    """``state`` after the days of ``y``; ``wave`` starts with the term of the next day."""

    def step(s: Column, v: Column) -> Column:
        base, wave = s["level"] + p["phi"] * s["trend"], s["wave"][0]
        times = p["multiplicative"] > 0
        error = v - F.when(times, base * wave).otherwise(base + wave)
        scaled = F.when(times, error / _safe(wave)).otherwise(error)
        turned = wave + p["gamma"] * F.when(times, error / _safe(base)).otherwise(error)
        return F.struct(
            (base + p["alpha"] * scaled).alias("level"),
            (p["phi"] * s["trend"] + p["beta"] * scaled).alias("trend"),
            F.concat(F.slice(s["wave"], 2, season - 1), F.array(turned)).alias("wave"),
            (s["sse"] + error * error).alias("sse"),
        )

    return F.aggregate(y, state, step)


def _criterion(sse: Column, n: Column, p: Column, season: int) -> Column:
    """Corrected Akaike criterion of the one-step errors; infinite for more parameters than the days bear."""
    free = 2 + 2 * p["trended"] + F.when(p["phi"] < 1, 1).otherwise(0) + (season + 1) * p["seasonal"]
    left = n - free - 1
    penalty = F.when(left > 0, 2 * free + 2 * free * (free + 1) / F.greatest(left, F.lit(1.0))).otherwise(float("inf"))
    return n * F.log(F.greatest(sse, F.lit(1e-12)) / n) + penalty


def fit_states(
    series: DataFrame, end, grid: Sequence[Sequence[float]] = SMALL_GRID, season: int = C.SEASON_LENGTH
) -> DataFrame:
    """One row per series with days up to ``end``: ``unique_id``, ``last_ds``, ``n`` (days), the parameters chosen from ``grid``
    (rows of PARAMETERS), ``level``, ``trend``, ``wave``, ``sse`` and ``criterion``. Of equal criteria the first set wins; sets
    with a multiplicative season compete where all readings are positive."""
    sets = F.array(
        *(F.struct(F.lit(i).alias("nth"), *(F.lit(float(v)).alias(c) for c, v in zip(PARAMETERS, row, strict=True))) for i, row in enumerate(grid))
    )
    known = series_vectors(series.where(F.col("ds") <= F.lit(end))).select("unique_id", "first_ds", "y")
    # The pairs of one series stay in its partition: the rows are unfolded there and meet again in one aggregation.
    pairs = known.withColumn("p", F.explode(sets)).where("p.multiplicative = 0 OR NOT exists(y, v -> v <= 0)")
    y, p = F.col("y"), F.col("p")
    fitted = pairs.withColumn("s", _folded(y, _opened(y, p, season), p, season)).withColumn("n", F.size(y))
    fitted = fitted.withColumn("criterion", _criterion(F.col("s.sse"), F.col("n"), p, season))
    order = F.struct(F.coalesce("criterion", F.lit(float("inf"))).alias("criterion"), F.col("p.nth").alias("nth"))
    best = fitted.groupBy("unique_id").agg(F.min_by(F.struct("first_ds", "n", "p", "s", "criterion"), order).alias("b"))
    return best.select(
        "unique_id",
        F.expr("date_add(b.first_ds, b.n - 1)").alias("last_ds"),
        "b.n",
        *(f"b.p.{c}" for c in PARAMETERS),
        *(f"b.s.{c}" for c in ("level", "trend", "wave", "sse")),
        "b.criterion",
    )


def advance_states(states: DataFrame, days: DataFrame, season: int = C.SEASON_LENGTH) -> DataFrame:
    """``states`` after the days of ``days`` (``unique_id``, ``ds``, ``y``) that follow them, with the parameters they have. Days up
    to a state's last one are passed over; a gap after it is an error. Series without new days stay as they are."""
    last = states.select("unique_id", F.col("last_ds").alias("_last"))
    later = days.join(last, "unique_id").where(F.col("ds") > F.col("_last")).select("unique_id", "ds", "y")
    rows = states.join(series_vectors(later), "unique_id", "left")
    late = F.col("first_ds") != F.date_add("last_ds", 1)
    new = F.when(late, F.raise_error(F.concat(F.lit("days are missing: "), "unique_id")).cast("array<double>")).otherwise(F.col("y"))
    p = F.struct(*PARAMETERS)
    moved = rows.withColumn("y", F.coalesce(new, F.array().cast("array<double>")))
    moved = moved.withColumn("s", _folded(F.col("y"), F.struct("level", "trend", "wave", "sse"), p, season))
    total = F.col("n") + F.size("y")
    return moved.select(
        "unique_id",
        F.expr("date_add(last_ds, size(y))").alias("last_ds"),
        total.alias("n"),
        *PARAMETERS,
        *(f"s.{c}" for c in ("level", "trend", "wave", "sse")),
        _criterion(F.col("s.sse"), total, p, season).alias("criterion"),
    )


def forecast_states(states: DataFrame, horizon: int, season: int = C.SEASON_LENGTH) -> DataFrame:
    """(unique_id, ds, yhat) for the ``horizon`` days after each state's last one."""
    rows = states.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    phi, k = F.col("phi"), F.col("step")
    reach = F.when(phi == 1, k.cast("double")).otherwise(phi * (1 - F.pow(phi, k)) / (1 - phi))
    base = F.col("level") + reach * F.col("trend")
    wave = F.col("wave")[F.pmod(k - 1, F.lit(season))]
    yhat = F.when(F.col("multiplicative") > 0, base * wave).otherwise(base + wave)
    return rows.select("unique_id", F.date_add("last_ds", k).alias("ds"), yhat.alias("yhat"))
