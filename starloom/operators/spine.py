"""Number series, date spines, calendars."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starloom.functions.dates import add_units, calendar_parts, units_between
from starloom.functions.text import ColumnLike, as_column


def number_series(spark: SparkSession, upper_bound: int) -> DataFrame:
    """1..n as `generated_number`, made in parallel."""
    if upper_bound <= 0:
        raise ValueError("upper bound must be positive")
    return spark.range(1, upper_bound + 1).select(F.col("id").alias("generated_number"))


def date_spine(spark: SparkSession, unit: str, start: date | datetime, end: date | datetime) -> DataFrame:
    """steps of `unit` from `start` on, as `date_<unit>`; an aligned `end` is not part of the spine.

    There are as many steps as unit boundaries between the two moments; none is an error.
    """
    first, last = F.lit(start), F.lit(end)
    n = spark.range(1).select(units_between(unit, first, last).alias("n")).first().n
    moment = add_units(first, unit, F.col("generated_number").cast("int") - 1)
    if not isinstance(start, datetime) and unit not in ("hour", "minute", "second"):
        moment = moment.cast("date")
    name = f"date_{unit}"
    return number_series(spark, n).select(moment.alias(name)).filter(F.col(name) <= last)


def calendar(spark: SparkSession, start: date, end: date, iso: bool = False) -> DataFrame:
    """One row per day, both ends included, without gaps."""
    days = (end - start).days + 1
    return spark.range(0, days).select(
        F.date_add(F.lit(start), F.col("id").cast("int")).alias("_day")
    ).select(*calendar_parts("_day", iso))


def calendar_spanning(df: DataFrame, moment: ColumnLike, iso: bool = False) -> DataFrame:
    """The calendar from a table's first to its last day.

    Two bounds are the only thing the plan aggregates; the days are made from that one row.
    """
    day = as_column(moment).cast("date")
    return (
        df.agg(F.min(day).alias("_from"), F.max(day).alias("_to"))
        .select(F.explode(F.sequence("_from", "_to")).alias("_day"))
        .select(*calendar_parts("_day", iso))
    )


def with_days(members: DataFrame, start: Column, end: Column, name: str = "full_date") -> DataFrame:
    """Every member once per day from `start` to `end`, for filling gaps.

    Days are made per row from its own bounds, so no side is copied to every task.
    """
    return members.withColumn(name, F.explode(F.sequence(start, end)))
