"""Calendar generation.

Calendars are generated from a one-row range (``sequence`` + ``explode``), never read from a
daily dimension, and stay tiny: a day calendar of a century is 36,525 rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.functions import scalar as X


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def date_range(df: DataFrame, date_col: str) -> DataFrame:
    """One row: ``start_date, end_date`` of a date/timestamp column."""
    d = F.to_date(F.col(date_col))
    return df.agg(F.min(d).alias("start_date"), F.max(d).alias("end_date"))


def calendar_days(bounds: DataFrame, start: str = "start_date", end: str = "end_date") -> DataFrame:
    """One row per day between two dates of a one-row frame."""
    return bounds.select(
        F.explode(F.sequence(F.col(start), F.col(end), F.expr("interval 1 day"))).alias("date")
    )


def calendar_months(bounds: DataFrame, start: str = "start_date", end: str = "end_date") -> DataFrame:
    """One row per month touched by ``[start, end]``; month dimension columns."""
    months = bounds.select(
        F.explode(
            F.sequence(F.trunc(F.col(start), "MM"), F.trunc(F.col(end), "MM"), F.expr("interval 1 month"))
        ).alias("month_start")
    )
    return months.select(
        "month_start",
        F.last_day("month_start").alias("month_end"),
        F.year("month_start").alias("year"),
        F.month("month_start").alias("month"),
        F.date_format("month_start", "MMMM").alias("month_name"),
        F.dayofmonth(F.last_day("month_start")).alias("days_in_month"),
        X.metrics_start("month_start").alias("metrics_start"),
        F.add_months("month_start", 1).alias("next_month_start"),
    )


def date_parts(df: DataFrame, date_col: str) -> DataFrame:
    """Calendar attributes of a date column (Monday = 0, ISO week)."""
    d = F.to_date(F.col(date_col))
    return df.withColumns(
        {
            "year": F.year(d),
            "month": F.month(d),
            "day": F.dayofmonth(d),
            "quarter": F.quarter(d),
            "month_name": F.date_format(d, "MMMM"),
            "day_name": F.date_format(d, "EEEE"),
            "weekday": X.weekday_monday0(d),
            "iso_week": F.weekofyear(d),
            "is_weekend": (X.weekday_monday0(d) >= 5),
            "semester": X.semester(d),
        }
    )


def future_spine(df: DataFrame, series: Sequence[str], date_col: str, periods: int = 100) -> DataFrame:
    """Every history date of each series plus ``periods`` days after its last date.

    Output ``*series, ds, is_future``. The future part is generated per series from its max
    date (one row per series before the explode), so nothing is broadcast.
    """
    keys = list(series)
    d = F.to_date(F.col(date_col))
    hist = df.select(*keys, d.alias("ds")).distinct().withColumn("is_future", F.lit(False))
    fut = (
        df.groupBy(*keys)
        .agg(F.max(d).alias("_last"))
        .select(
            *keys,
            F.explode(
                F.sequence(F.date_add("_last", 1), F.date_add("_last", periods), F.expr("interval 1 day"))
            ).alias("ds"),
        )
        .withColumn("is_future", F.lit(True))
    )
    return hist.unionByName(fut)
