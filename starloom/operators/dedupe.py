"""One row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from starloom.functions.text import ColumnLike, as_column
from starloom.operators.columns import fresh_name, quoted


def deduplicate(
    df: DataFrame,
    partition_by: list[ColumnLike],
    order_by: list[ColumnLike],
    tie_break: list[ColumnLike] | None = None,
) -> DataFrame:
    """The first row of each partition in the given order; expressions are fine in both lists.

    `tie_break` defaults to the other columns in schema order, which makes the survivor the same in
    every run. Spark keeps the best row per key inside each input partition before the shuffle
    (`WindowGroupLimit`), so a key that holds much of the table sends one row per input partition.
    """
    if tie_break is None:
        used = {c for c in [*partition_by, *order_by] if isinstance(c, str)}
        tie_break = [
            F.col(quoted(f.name)) for f in df.schema if f.name not in used and _orderable(f.dataType)
        ]
    window = Window.partitionBy(*map(as_column, partition_by)).orderBy(
        *map(as_column, [*order_by, *tie_break])
    )
    rank = fresh_name(df, "_rank")
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) == 1).drop(rank)


def _orderable(kind) -> bool:
    return kind.typeName() not in ("map", "variant")


def latest_per_key(df: DataFrame, keys: list[ColumnLike], snapshot: ColumnLike, *then: Column) -> DataFrame:
    """The row of the newest snapshot per key."""
    return deduplicate(df, keys, [as_column(snapshot).desc_nulls_first(), *then])


def drop_duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key with a stable survivor, unlike `dropDuplicates`."""
    return deduplicate(df, keys, [])


def distinct_pairs(df: DataFrame, *columns: Column) -> DataFrame:
    """Distinct rows of a projection."""
    return df.select(*columns).distinct()


def natural_join(a: DataFrame, b: DataFrame) -> DataFrame:
    """Equi-join on every column name the frames share; a null in any of them never matches."""
    theirs = {c.lower() for c in b.columns}
    shared = [c for c in a.columns if c.lower() in theirs]
    if not shared:
        raise ValueError("the frames share no column")
    return a.join(b, shared, "inner")
