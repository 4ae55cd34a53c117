"""Checks on whole tables or groups; all reduce rows before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from starloom.checks.outcome import check
from starloom.functions.dates import add_units
from starloom.functions.text import ColumnLike, as_column
from starloom.operators.columns import fresh_name, quoted
from starloom.operators.compare import compare_counts


@check
def unique(df: DataFrame, column: ColumnLike):
    """K2: values that occur more than once, with their row counts; nulls are ignored."""
    value = as_column(column)
    return (
        df.filter(value.isNotNull())
        .groupBy(value.alias("unique_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter("n_records > 1")
    )


@check
def unique_combination_of_columns(df: DataFrame, columns: list[str]):
    """Combinations that occur more than once; nulls equal each other."""
    n = fresh_name(df, "_n")
    return df.groupBy(*map(quoted, columns)).agg(F.count(F.lit(1)).alias(n)).filter(F.col(n) > 1).drop(n)


@check
def equal_rowcount(df: DataFrame, compare: DataFrame, group_by: list[str] = (), strict: bool = False):
    """K9/C4: row counts of both tables; failures are the summed differences.

    A group on one side only has no difference and passes, and so does an empty table; with `strict`, a
    missing side counts as 0 rows, so both fail.
    """
    counts = compare_counts(df, compare, list(group_by), ("count_a", "count_b"))
    if strict:
        counts = counts.fillna(0, ["count_a", "count_b"])
    return (
        counts.withColumn("diff_count", F.abs(F.col("count_a") - F.col("count_b"))),
        F.sum(F.coalesce("diff_count", F.lit(0))),
    )


@check
def fewer_rows_than(df: DataFrame, compare: DataFrame, group_by: list[str] = (), strict: bool = False):
    """The surplus over the other table, or 1 where both are equal; else 0.

    With `strict`, a side that is missing or empty counts as 0 rows; otherwise it passes.
    """
    ours, theirs = "count_our_model", "count_comparison_model"
    counts = compare_counts(df, compare, list(group_by), (ours, theirs))
    if strict:
        counts = counts.fillna(0, [ours, theirs])
    delta = (
        F.when(F.col(ours) > F.col(theirs), F.col(ours) - F.col(theirs))
        .when(F.col(ours) == F.col(theirs), F.lit(1))
        .otherwise(F.lit(0))
    )
    return counts.withColumn("row_count_delta", delta), F.sum("row_count_delta")


@check
def recency(
    df: DataFrame,
    field: ColumnLike,
    datepart: str,
    interval: int,
    ignore_time_component: bool = False,
    group_by: list[str] = (),
    as_of: Column | None = None,
):
    """Groups whose newest value lies before `as_of` minus the interval; no value at all passes.

    `as_of` defaults to the clock. Without the time component both sides are dates.
    """
    moment = F.current_timestamp() if as_of is None else as_of
    newest, threshold = F.max(as_column(field)), add_units(moment, datepart, -interval)
    if ignore_time_component:
        newest, threshold = newest.cast("date"), threshold.cast("date")
    return (
        df.groupBy(*map(quoted, group_by))
        .agg(newest.alias("most_recent"))
        .withColumn("threshold", threshold)
        .filter("most_recent < threshold")
    )


@check
def at_least_one(df: DataFrame, column: str, group_by: list[str] = ()):
    """Groups without any value. The whole-table form stops at the first value it finds."""
    if group_by:
        rows = df.groupBy(*map(quoted, group_by))
    else:
        rows = df.select(quoted(column)).filter(F.col(quoted(column)).isNotNull()).limit(1).groupBy()
    return rows.agg(F.count(quoted(column)).alias("filler_column")).filter("filler_column = 0")


@check
def not_constant(df: DataFrame, column: str, group_by: list[str] = ()):
    """Groups with exactly one distinct value; no value at all passes.

    One distinct value means that the least and the greatest are the same, which needs no shuffle of
    values as counting them would.
    """
    value = F.col(quoted(column))
    lo, hi = fresh_name(df, "_lo"), fresh_name(df, "_hi")
    return (
        df.groupBy(*map(quoted, group_by))
        .agg(F.min(value).alias(lo), F.max(value).alias(hi))
        .filter(F.col(lo) == F.col(hi))
        .withColumn("filler_column", F.lit(1).cast("bigint"))
        .drop(lo, hi)
    )


@check
def not_null_proportion(
    df: DataFrame,
    column: ColumnLike,
    at_least: float,
    at_most: float = 1.0,
    group_by: list[str] = (),
):
    """Groups whose share of values lies outside the bounds; an empty table passes."""
    share = F.count(as_column(column)) / F.nullif(F.count(F.lit(1)), F.lit(0))
    return (
        df.groupBy(*map(quoted, group_by))
        .agg(share.alias("not_null_proportion"))
        .filter((F.col("not_null_proportion") < at_least) | (F.col("not_null_proportion") > at_most))
    )
