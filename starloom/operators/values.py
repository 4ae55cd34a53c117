"""Value lists and single values taken from a query."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from starloom.functions.text import ColumnLike, as_column


def column_values(
    df: DataFrame,
    column: ColumnLike,
    order_by: list[tuple[Column, str]] | None = None,
    max_records: int | None = None,
    where: str | Column | None = None,
) -> DataFrame:
    """distinct values of a column as `value`, ordered by aggregates (default: most frequent first).

    `order_by` holds pairs of an aggregate and `asc` or `desc`. Equal ranks are ordered by value. With `max_records` the plan is a bounded top-k, not a full sort.
    """
    rows = df if where is None else df.filter(where)
    order_by = order_by or [(F.count(F.lit(1)), "desc")]
    ranks = [(agg.alias(f"_rank{i}"), F.col(f"_rank{i}"), way) for i, (agg, way) in enumerate(order_by)]
    out = (
        rows.groupBy(as_column(column).alias("value"))
        .agg(*[agg for agg, _, _ in ranks])
        .orderBy(*[c.desc() if way == "desc" else c.asc() for _, c, way in ranks], F.col("value"))
    )
    if max_records is not None:
        out = out.limit(max_records)
    return out.select("value")


def value_list(
    df: DataFrame | None,
    column: ColumnLike,
    max_values: int,
    default: list | None = None,
    **options,
) -> list:
    """F1 for building a plan (the headers of a pivot): the values on the driver.

    How many the plan can take is the caller's to say: more than `max_values` values are an error, never a shorter list.
    A missing table needs a default; an empty result gives it.
    """
    if df is None:
        if default is None:
            raise ValueError("the table does not exist and no default was given")
        return default
    rows = column_values(df, column, **options).limit(max_values + 1).collect()
    if len(rows) > max_values:
        raise ValueError(f"more than {max_values} distinct values")
    return [r.value for r in rows] or default


def single_value(query: DataFrame, default=None) -> Column:
    """First column of the query's first row as a value inside another query.

    A query without rows gives the default; a row that holds null gives null. Nothing is collected
    while the plan is built: Spark runs it as a scalar subquery and can push the value into the scan.
    """
    first = query.columns[0]
    if default is None:
        return query.limit(1).select(first).scalar()
    # The struct tells a missing row from a null.
    kind = query.schema[first].dataType
    wrapped = query.limit(1).select(F.struct(F.col(first).alias("v")))
    fallback = F.struct(F.lit(default).cast(kind).alias("v"))
    return F.coalesce(wrapped.scalar(), fallback)["v"]
