"""Next and previous row in an order, also within very large groups.

A window puts a whole group, or without a group the whole table, into one task. Here the order is cut into slices by
expressions of the order columns alone: an integer by its high bits, a time by its day and second, a text by its
beginning. Slices are contiguous in the order, so neighbours are looked up inside slices first. Only the first and the
last row of a slice can have a neighbour elsewhere; these edges meet in coarser slices, and theirs again, up to the
group. Every step is one window. How many steps there are follows from the types, not from the data, and so does the
bound on the rows that meet: rows are unique in group and order, so a slice has no more of them than values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from starloom.operators.columns import fresh_name, quoted

#: Values of an integer that one slice holds: 2 to this power. Two edges for each of so many slices meet in the next.
SLICE_BITS = 21
#: Days from year 1 to 9999 are fewer than 2 to the 22nd, so a date needs no slices of the usual size.
WIDTHS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64, T.DateType: 22}
#: Characters; texts have no bound on the values that share a beginning.
TEXT_LENGTHS = (2, 4, 8, 16)
COPIES_PER_BLOCK = 100_000


def _integer_cuts(code: Column, width: int, bits: int) -> list[Column]:
    """High bits of an integer, the highest alone first; the last cut leaves `bits` bits to a slice."""
    n = max(0, -(-(width - bits - 1) // bits))
    return [F.shiftright(code, bits * k) for k in range(n, 0, -1)]


def _real_cuts(value: Column, bits: int) -> list[Column]:
    """Slices by magnitude: exponent and leading digits, in the order of Spark's sort (NaN last)."""
    size = F.least(F.log2(F.abs(value)), F.lit(1025.0)) + 1075  # 1 .. 2100
    code = F.when(F.isnan(value), 3000.0).when(value == 0, 0.0).otherwise(F.signum(value) * size)
    return [F.floor(code * 2.0 ** (52 - k * bits)) for k in (2, 1)]


def slice_cuts(column: Column, kind: T.DataType, bits: int = SLICE_BITS) -> list[Column]:
    """Expressions that cut the order of a column into contiguous slices, from coarse to fine; null for nulls."""
    if type(kind) in WIDTHS:
        code = F.unix_date(column) if isinstance(kind, T.DateType) else column
        return _integer_cuts(code.cast("bigint"), WIDTHS[type(kind)], bits)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return [column.cast("date"), F.date_trunc("second", column)]
    if isinstance(kind, T.DecimalType) and kind.precision <= 18:
        return _integer_cuts((column * F.lit(10**kind.scale)).cast("bigint"), 64, bits)
    if isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
        return _real_cuts(column.cast("double"), bits)
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return [F.substring(column, 1, n) for n in TEXT_LENGTHS]
    return []


def slice_levels(df: DataFrame, order: list[str], bits: int = SLICE_BITS) -> list[list[Column]]:
    """What a slice is told apart by, level by level from the whole group (nothing) to the finest."""
    levels: list[list[Column]] = [[]]
    before: list[Column] = []
    for k, name in enumerate(order):
        column = F.col(quoted(name))
        cuts = slice_cuts(column, df.schema[name].dataType, bits)
        levels += [[*before, cut] for cut in cuts]
        before = [*before, column]
        if k + 1 < len(order):
            levels.append(before)
    return levels


def with_neighbours(
    df: DataFrame,
    group: list[str],
    order: list[str],
    following: str | None = None,
    previous: str | None = None,
    slice_bits: int = SLICE_BITS,
) -> DataFrame:
    """Add structs with the order columns (o0, o1, ...) of the next and the previous row of the same group.

    Rows are unique in group and order; nulls sort last. A struct is null at the end of its group. Nothing runs while
    the plan is built.
    """
    ordering = [F.col(quoted(o)).asc_nulls_last() for o in order]
    here = F.struct(*[F.col(quoted(o)).alias(f"o{i}") for i, o in enumerate(order)])
    keys = [F.col(quoted(g)) for g in group]
    after, before, edge = (fresh_name(df, n) for n in ("_after", "_before", "_edge"))
    levels = slice_levels(df, order, slice_bits)
    own = [F.col(quoted(c)) for c in df.columns]
    out = df
    for k, cuts in enumerate(reversed(levels)):
        # rows inside a finer slice have both neighbours: they stay out of the way, each for itself
        aside = [F.when(~F.col(edge), F.xxhash64(*map(quoted, order)))] if k else []
        window = Window.partitionBy(*keys, *cuts, *aside).orderBy(*ordering)
        found = [F.lead(here).over(window), F.lag(here).over(window)]
        if k:
            found = [F.coalesce(F.col(c), F.when(F.col(edge), f)) for c, f in zip((after, before), found)]
        out = out.select(*own, found[0].alias(after), found[1].alias(before))
        if k + 1 < len(levels):
            out = out.withColumn(edge, F.col(after).isNull() | F.col(before).isNull())
    return out.select(*own, *[F.col(c).alias(n) for c, n in ((after, following), (before, previous)) if n])


def with_neighbour(df: DataFrame, group: list[str], order: list[str], out: str, forward: bool = True, slice_bits: int = SLICE_BITS) -> DataFrame:
    """Add a struct `out` with the order columns of the next (or previous) row; see `with_neighbours`."""
    return with_neighbours(df, group, order, **{"following" if forward else "previous": out}, slice_bits=slice_bits)


def repeat_rows(df: DataFrame, times: str) -> DataFrame:
    """Each row as often as its column `times` says, which is dropped.

    Copies are made in blocks that are spread over tasks, so one row with very many copies neither
    builds one huge array nor keeps one task busy.
    """
    most = COPIES_PER_BLOCK
    n = F.col(quoted(times))
    block, size, copy = (fresh_name(df, c) for c in ("_block", "_size", "_copy"))
    blocks = df.filter(n > 0).withColumn(
        block, F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((n - 1) / most)))
    )
    spread = blocks.withColumn(size, F.least(F.lit(most).cast("bigint"), n - F.col(block) * most))
    return (
        spread.hint("rebalance")
        .withColumn(copy, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(size))))
        .drop(times, block, size, copy)
    )
