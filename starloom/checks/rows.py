"""Checks that look at one row at a time; a scan with a pushed-down filter is all they cost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from starloom.checks.outcome import check
from starloom.operators.columns import quoted
from starloom.functions.text import ColumnLike, as_column


@check
def not_null(df: DataFrame, column: ColumnLike):
    """K1: rows whose value is null."""
    return df.filter(as_column(column).isNull())


@check
def accepted_values(df: DataFrame, column: ColumnLike, values: list):
    """K4: values outside the list with their row counts; null passes."""
    return _values_with_counts(df.filter(~as_column(column).isin(values)), column)


@check
def not_accepted_values(df: DataFrame, column: ColumnLike, values: list):
    """Listed values that occur, each once; null passes."""
    return df.filter(as_column(column).isin(values)).select(as_column(column).alias("value_field")).distinct()


def _values_with_counts(df: DataFrame, column: ColumnLike) -> DataFrame:
    return df.groupBy(as_column(column).alias("value_field")).agg(F.count(F.lit(1)).alias("n_records"))


@check
def expression_is_true(df: DataFrame, expression: str | Column, column: str | None = None):
    """K8: rows where the expression is false; null passes.

    With `column` the expression is what follows the column, such as `+ col_b = 1`.
    """
    if column is not None:
        expression = f"{column} {expression}"
    holds = F.expr(expression) if isinstance(expression, str) else expression
    return df.filter(~holds)


@check
def not_empty_string(df: DataFrame, column: str, trim_whitespace: bool = True):
    """Empty texts, after trimming unless told otherwise; null passes."""
    value = F.col(quoted(column))
    value = F.trim(value) if trim_whitespace else value
    return df.select(value.alias(column)).filter(F.col(quoted(column)) == "")


@check
def accepted_range(
    df: DataFrame,
    column: ColumnLike,
    min_value=None,
    max_value=None,
    inclusive: bool = True,
):
    """Values outside the bounds, which may be columns; null passes."""
    value = as_column(column)
    outside = F.lit(False)
    if min_value is not None:
        low = min_value if isinstance(min_value, Column) else F.lit(min_value)
        outside = outside | ~((value >= low) if inclusive else (value > low))
    if max_value is not None:
        high = max_value if isinstance(max_value, Column) else F.lit(max_value)
        outside = outside | ~((value <= high) if inclusive else (value < high))
    return df.filter(outside)


@check
def assert_equal(df: DataFrame, actual: ColumnLike, expected: ColumnLike):
    """Rows where the two differ; null on either side passes."""
    return df.filter(as_column(actual) != as_column(expected))
