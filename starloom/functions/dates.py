"""Dates: keys, calendar parts, unit arithmetic, tolerant parsing (H3, H7-H9)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from starloom.functions.text import ColumnLike, as_column


def date_key(c: ColumnLike) -> Column:
    """H8: YYYYMMDD as an integer; null stays null."""
    return F.date_format(as_column(c), "yyyyMMdd").cast("int")


def calendar_parts(c: ColumnLike, iso: bool = False) -> list[Column]:
    """H7: the columns of one calendar day.

    Days of the week run 0 = Sunday .. 6 = Saturday, or 1 = Monday .. 7 = Sunday with `iso`.
    The week is the ISO week in both.
    """
    day = as_column(c)
    weekday = F.weekday(day) + 1 if iso else F.dayofweek(day) - 1
    return [
        date_key(day).alias("date_key"),
        day.alias("full_date"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMM").alias("month_name"),
        F.weekofyear(day).alias("week_of_year"),
        weekday.alias("day_of_week"),
        F.date_format(day, "E").alias("day_name"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
    ]


def add_units(c: ColumnLike, unit: str, amount: int | Column) -> Column:
    """H9: `amount` steps of `unit` after the moment."""
    n = amount if isinstance(amount, Column) else F.lit(amount)
    return F.timestamp_add(unit.upper(), n.cast("int"), as_column(c))


def units_between(unit: str, start: ColumnLike, end: ColumnLike) -> Column:
    """H9: unit boundaries passed between two moments."""
    return F.timestamp_diff(
        unit.upper(), F.date_trunc(unit, as_column(start)), F.date_trunc(unit, as_column(end))
    )


def parse_timestamp(c: ColumnLike, pattern: str | None = None) -> Column:
    """H3: malformed text is null, not an error."""
    c = as_column(c)
    return F.try_to_timestamp(c, F.lit(pattern)) if pattern else F.try_to_timestamp(c)


def utc_timestamp(c: ColumnLike, pattern: str | None = None) -> Column:
    """H3 whatever the session's zone: text without an offset is UTC; one with an offset is that moment.

    With a `pattern`, which has no offset, a closing `Z` is allowed.
    """
    c = as_column(c)
    if pattern:
        return parse_timestamp(F.concat(F.regexp_replace(c, "Z$", ""), F.lit("Z")), f"{pattern}XXX")
    bare = ~F.regexp_like(F.trim(c), F.lit(r"\d[T ].*([Zz]|[A-Za-z/_]{3,}.*|[+-]\d{1,2}(:?\d{2}){0,2})$"))
    dated = F.regexp_like(F.trim(c), F.lit(r"^\d+-\d+-\d+$"))
    full = F.when(dated, F.concat(F.trim(c), F.lit("T00:00:00Z"))).when(bare, F.concat(F.trim(c), F.lit("Z")))
    return F.coalesce(parse_timestamp(full), parse_timestamp(c))


def utc_wall_clock(moment: ColumnLike) -> Column:
    """A timestamp as the zone-free time that clocks show in UTC, whatever the session's zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.unix_micros(as_column(moment)) * F.expr("INTERVAL '0.000001' SECOND")
