"""Calendar dimension generated from date rules and a list of event intervals."""

from __future__ import annotations

from datetime import date, timedelta

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Official holidays that fall on the same day each year.
FIXED_HOLIDAYS = (
    (1, 1, "Año Nuevo"),
    (2, 5, "Día de la Constitución"),
    (3, 21, "Natalicio de Benito Juárez"),
    (5, 1, "Día del Trabajo"),
    (9, 16, "Día de la Independencia"),
    (11, 20, "Día de la Revolución"),
    (12, 25, "Navidad"),
)
# Month to season.
SEASONS = {
    "Invierno": (12, 1, 2),
    "Primavera": (3, 4, 5),
    "Verano": (6, 7, 8),
    "Otoño": (9, 10, 11),
}


def easter_sunday(year: int) -> date:
    """Gregorian Easter, from the golden number and the paschal full moon."""
    golden, century = year % 19, year // 100
    epact = (century - century // 4 - (8 * century + 13) // 25 + 19 * golden + 15) % 30
    full_moon = epact - (epact // 28) * (1 - (29 // (epact + 1)) * ((21 - golden) // 11))
    weekday = (year + year // 4 + full_moon + 2 - century + century // 4) % 7
    offset = full_moon - weekday
    return date(year, 3, 28) + timedelta(days=offset)


def event_intervals(first_year: int, last_year: int) -> list[tuple[str, str, date, date]]:
    """Holidays, Holy Week and the November sales weekend: about ten rows a year."""
    rows = []
    for year in range(first_year, last_year + 1):
        for month, day, name in FIXED_HOLIDAYS:
            rows.append(("holiday", name, date(year, month, day), date(year, month, day)))
        easter = easter_sunday(year)
        rows.append(("semana_santa", "Semana Santa", easter - timedelta(days=7), easter))
        november = date(year, 11, 1)
        third_monday = november + timedelta(days=(7 - november.weekday()) % 7 + 14)
        rows.append(("buen_fin", "Buen Fin", third_monday - timedelta(days=3), third_monday))
    return rows


def build_calendar(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per day from ``start`` to ``end``.

    Events are spread over their days first, so the lookup is an equi-join on the date. Both
    sides are literals whose size the planner knows, here and where the calendar is joined.
    """
    d = F.col("date")
    season = F.coalesce(
        *[F.when(F.month(d).isin(*months), F.lit(name)) for name, months in SEASONS.items()]
    )
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias("date"))
    names = ("kind", "name", "first_day", "last_day")
    events = event_intervals(start.year, end.year)
    intervals = spark.createDataFrame(
        pa.table({n: [e[i] for e in events] for i, n in enumerate(names)})
    )
    marks = (
        intervals.select("kind", "name", F.explode(F.sequence("first_day", "last_day")).alias("date"))
        .groupBy("date")
        .agg(
            F.max(F.col("kind") == "holiday").alias("holiday"),
            F.max(F.when(F.col("kind") == "holiday", F.col("name"))).alias("holiday_name"),
            F.max(F.col("kind") == "buen_fin").alias("buen_fin"),
            F.max(F.col("kind") == "semana_santa").alias("semana_santa"),
        )
    )
    month_day = F.month(d) * 100 + F.dayofmonth(d)
    return days.join(marks, "date", "left").select(
        "date",
        F.weekday(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.weekofyear(d).alias("week_of_year"),
        F.month(d).alias("month"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        season.alias("season"),
        F.coalesce("holiday", F.lit(False)).alias("is_holiday"),
        "holiday_name",
        ((F.dayofmonth(d) == 15) | (d == F.last_day(d))).alias("is_payday"),
        (F.weekday(d) >= 5).alias("is_weekend"),
        ((month_day >= 1215) | (month_day <= 106)).alias("is_navidad_season"),
        F.coalesce("buen_fin", F.lit(False)).alias("is_buen_fin"),
        F.coalesce("semana_santa", F.lit(False)).alias("is_semana_santa"),
    )
