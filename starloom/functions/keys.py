"""Hash keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from starloom.functions.text import ColumnLike, as_column

# Keys must equal those that were built elsewhere from the same fields.
NULL_MARK = "_dbt_utils_surrogate_key_null_"
SEPARATOR = "-"
DEFAULT_MEMBER = "Unknown"


def hash_key(c: ColumnLike) -> Column:
    """md5 of one natural value; null stays null."""
    return F.md5(as_column(c))


def member(c: ColumnLike, default: str = DEFAULT_MEMBER) -> Column:
    """A missing value belongs to the default member."""
    return F.coalesce(as_column(c), F.lit(default))


def surrogate_key(fields: list[ColumnLike], nulls_as_empty: bool = False) -> Column:
    """md5 over the text of several fields; a null counts as its own mark, or as empty text."""
    mark = F.lit("" if nulls_as_empty else NULL_MARK)
    parts = [F.coalesce(as_column(f).cast("string"), mark) for f in fields]
    return F.md5(F.concat_ws(SEPARATOR, *parts))


def namespaced(prefix: str, c: ColumnLike) -> Column:
    """Natural key with the feed's prefix; a null id gives a null key."""
    return F.concat(F.lit(prefix), as_column(c).cast("string"))
