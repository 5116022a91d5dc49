"""Calendar row source and the date dimension."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.dates import date_key, day_of_week_iso, is_month_end, padded_name
from tessera.schemas import CALENDAR_END, CALENDAR_START


def spine_days(start: str, end: str) -> int:
    """Number of rows ``date_spine(start, end)`` yields (end excluded)."""
    return (dt.date.fromisoformat(end) - dt.date.fromisoformat(start)).days


def date_spine(spark: SparkSession, start: str = CALENDAR_START,
               end: str = CALENDAR_END) -> DataFrame:
    """One row per day from ``start`` up to, not including, ``end``.

    Generated by ``spark.range`` over day offsets, so the rows are spread
    over tasks instead of being built in one array on one executor."""
    n = spine_days(start, end)
    return (spark.range(0, max(n, 0))
            .select(F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias("date_day")))


def date_dimension(spark: SparkSession, start: str = CALENDAR_START,
                   end: str = CALENDAR_END) -> DataFrame:
    d = F.col("date_day")
    dow = day_of_week_iso(d)
    return date_spine(spark, start, end).select(
        date_key(d).alias("date_key"),
        d,
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        padded_name(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).alias("day_of_month"),
        dow.alias("day_of_week"),
        padded_name(d, "EEEE").alias("day_name"),
        dow.isin(6, 7).alias("is_weekend"),
        F.weekofyear(d).alias("week_of_year"),
        F.dayofyear(d).alias("day_of_year"),
        is_month_end(d).alias("is_month_end"),
    )
