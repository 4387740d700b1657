"""Calendar dimension, working-day correction and request ranges."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: calendar range, fixed bank holidays (month, day), request span --------
FIRST_DAY = date(2002, 1, 1)
LAST_DAY = date(2027, 12, 31)
HOLIDAYS = [(1, 1), (1, 6), (5, 1), (5, 3), (8, 15), (11, 1), (11, 11), (12, 25), (12, 26)]
MONTH_NAMES = [
    "January", "February", "March", "April", "May", "June", "July", "August", "September",
    "October", "November", "December",
]
REQUEST_SPAN = 90
# -------------------------------------------------------------------------------------------


def date_key(day: Column) -> Column:
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def calendar(
    spark: SparkSession, first: date | Column = FIRST_DAY, last: date | Column = LAST_DAY
) -> DataFrame:
    """One row per day with its calendar attributes and the provisional bank-day flag."""
    lo = F.lit(first) if isinstance(first, date) else first
    hi = F.lit(last) if isinstance(last, date) else last
    day = F.col("full_date")
    names = F.array(*[F.lit(n) for n in MONTH_NAMES])
    holiday = F.struct(F.month(day), F.dayofmonth(day)).isin(
        [F.struct(F.lit(m), F.lit(d)) for m, d in HOLIDAYS]
    )
    weekend = F.weekday(day) >= 5
    return (
        spark.range(1)
        .select(F.explode(F.sequence(lo, hi)).alias("full_date"))
        .select(
            date_key(day).alias("date_key"),
            day,
            F.year(day).alias("year"),
            F.quarter(day).alias("quarter"),
            F.month(day).alias("month"),
            F.element_at(names, F.month(day)).alias("month_name"),
            F.weekofyear(day).alias("week_of_year"),
            (F.weekday(day) + 1).alias("day_of_week"),
            weekend.alias("is_weekend"),
            (~weekend & ~holiday).alias("is_nbp_working_day"),
        )
    )


def refresh_working_days(dim_date: DataFrame, fact_rates: DataFrame) -> DataFrame:
    """Correct the bank-day flag by the days on which rates were really published.

    A published day is a working day; a weekday inside the published range without
    any publication is none; other days keep their flag. The published days are at most
    one row per calendar day, so they are broadcast.
    """
    published = (
        fact_rates.select("date_key", F.col("effective_date").alias("_day")).distinct()
    )
    bounds = fact_rates.select(
        F.struct(F.min("effective_date").alias("lo"), F.max("effective_date").alias("hi")).alias("b")
    ).scalar()
    flagged = dim_date.join(
        F.broadcast(published.select("date_key", F.lit(True).alias("_published")).distinct()),
        "date_key",
        "left",
    ).withColumn("_bounds", bounds)
    inside = F.col("full_date").between(F.col("_bounds.lo"), F.col("_bounds.hi"))
    return flagged.withColumn(
        "is_nbp_working_day",
        F.when(F.col("_published"), F.lit(True))
        .when(inside & ~F.col("is_weekend"), F.lit(False))
        .otherwise(F.col("is_nbp_working_day")),
    ).select(*dim_date.columns)


def date_segments(
    spark: SparkSession, first: date | Column, last: date | Column, span: int = REQUEST_SPAN
) -> DataFrame:
    """Consecutive request ranges of at most ``span`` days, the last one clipped."""
    lo = F.lit(first) if isinstance(first, date) else first
    hi = F.lit(last) if isinstance(last, date) else last
    starts = F.sequence(lo, hi, F.make_dt_interval(F.lit(span)))
    return (
        spark.range(1)
        .select(F.when(lo <= hi, starts).alias("starts"), hi.alias("hi"))
        .select(F.explode("starts").alias("segment_start"), "hi")
        .select(
            "segment_start",
            F.least(F.date_add("segment_start", span - 1), F.col("hi")).alias("segment_end"),
        )
    )


def last_days(days: int, today: Column | None = None) -> tuple[Column, Column]:
    """Range bounds of an incremental request: the last ``days`` days up to today."""
    end = F.current_date() if today is None else today
    return F.date_sub(end, days), end
