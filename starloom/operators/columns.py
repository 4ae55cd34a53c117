"""Column lists and blanket projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from starloom.functions.text import blank_to_null


def filtered_columns(df: DataFrame, exclude: list[str] = ()) -> list[str]:
    """The frame's columns in order, minus names matched without regard to case."""
    dropped = {name.lower() for name in exclude}
    return [c for c in df.columns if c.lower() not in dropped]


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def fresh_name(df: DataFrame, base: str) -> str:
    """`base`, with underscores added until no column of the frame has that name in any case."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def star(
    df: DataFrame,
    exclude: list[str] = (),
    prefix: str = "",
    suffix: str = "",
    relation_alias: str | None = None,
) -> list[Column]:
    """Select items for all columns but some; renamed only when a prefix or suffix is given.

    An empty list is possible, and means that no column was left.
    """
    qualifier = f"{quoted(relation_alias)}." if relation_alias else ""
    items = []
    for name in filtered_columns(df, exclude):
        item = F.col(qualifier + quoted(name))
        items.append(item.alias(prefix + name + suffix) if prefix or suffix else item)
    return items


def nullcheck(df: DataFrame) -> DataFrame:
    """Empty text becomes null in every string column; other columns are untouched."""
    return df.select(
        [
            blank_to_null(F.col(quoted(f.name))).alias(f.name)
            if isinstance(f.dataType, StringType)
            else F.col(quoted(f.name))
            for f in df.schema
        ]
    )


def group_by_first(df: DataFrame, n: int):
    """Group on the first `n` columns of the frame."""
    if not 1 <= n <= len(df.columns):
        raise ValueError(f"n must lie in 1..{len(df.columns)}, got {n}")
    return df.groupBy(*[F.col(quoted(c)) for c in df.columns[:n]])
