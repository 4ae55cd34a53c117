"""Checks on consecutive rows.

Equal rows are counted first, so a value that fills much of the table is one row when neighbours are
looked up; its copies come back at the end, if they are violations. Neighbours come from
`operators.ordered`, which looks them up slice by slice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starloom.checks.outcome import check
from starloom.functions.dates import add_units
from starloom.functions.text import ColumnLike, as_column, slug
from starloom.operators.columns import fresh_name, quoted
from starloom.operators.ordered import SLICE_BITS, repeat_rows, with_neighbour

# Comparison and its name in the result columns.
GAP_RULES = {
    "not_allowed": ("=", "equal_to"),
    "allowed": ("<=", "less_than_or_equal_to"),
    "required": ("<", "less_than"),
}
LENGTH_RULES = {False: ("<", "less_than"), True: ("<=", "less_than_or_equal_to")}


@check
def sequential_values(
    df: DataFrame,
    column: str,
    interval: int = 1,
    datepart: str | None = None,
    group_by: list[str] = (),
    slice_bits: int = SLICE_BITS,
):
    """Rows whose value is not the previous one plus the interval; first rows and nulls pass."""
    keys = list(group_by)
    previous = f"previous_{slug(column)}"
    rows = df.select(*map(quoted, keys), quoted(column)).filter(F.col(quoted(column)).isNotNull())
    n, near, times = (fresh_name(rows, c) for c in ("_n", "_before", "_times"))
    values = rows.groupBy(*map(quoted, [*keys, column])).agg(F.count(F.lit(1)).alias(n))
    placed = with_neighbour(values, keys, [column], near, forward=False, slice_bits=slice_bits)
    # Of n equal rows one follows the value before, and n - 1 follow their own value.
    followed = placed.select(
        *map(quoted, [*keys, column]),
        F.inline(
            F.array(
                F.struct(F.col(near)["o0"].alias(previous), F.lit(1).cast("bigint").alias(times)),
                F.struct(F.col(quoted(column)).alias(previous), (F.col(n) - 1).alias(times)),
            )
        ),
    )
    value, before = F.col(quoted(column)), F.col(quoted(previous))
    if datepart:
        due = value.cast("timestamp_ntz") == add_units(before, datepart, interval).cast("timestamp_ntz")
    else:
        due = value == before + F.lit(interval)
    return repeat_rows(followed.filter(~due), times)


@check
def mutually_exclusive_ranges(
    df: DataFrame,
    lower_bound: ColumnLike,
    upper_bound: ColumnLike,
    partition_by: ColumnLike | None = None,
    gaps: str = "allowed",
    zero_length_range_allowed: bool = False,
    slice_bits: int = SLICE_BITS,
):
    """Ranges with bounds in the wrong order, or that do not fit the next range.

    A null bound is a violation; the last range of a partition has nothing to fit. Bounds and the
    partition may be expressions.
    """
    if gaps not in GAP_RULES:
        raise ValueError(f"gaps must be one of {list(GAP_RULES)}, got {gaps!r}")
    gap_sign, gap_words = GAP_RULES[gaps]
    length_sign, length_words = LENGTH_RULES[zero_length_range_allowed]

    def expression(c: ColumnLike):
        return F.expr(c) if isinstance(c, str) else as_column(c)

    keys = [] if partition_by is None else ["partition_by_col"]
    parts = [] if partition_by is None else [expression(partition_by).alias("partition_by_col")]
    rows = df.select(
        *parts,
        expression(lower_bound).alias("lower_bound"),
        expression(upper_bound).alias("upper_bound"),
    )
    columns = [*keys, "lower_bound", "upper_bound"]
    ranges = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    placed = with_neighbour(ranges, keys, ["lower_bound", "upper_bound"], "_next", slice_bits=slice_bits)
    # Of n equal ranges n - 1 are followed by an equal one.
    followed = placed.select(
        *columns,
        F.inline(
            F.array(
                F.struct(
                    F.col("_next.o0").alias("next_lower_bound"),
                    F.col("_next").isNull().alias("is_last_record"),
                    F.lit(1).cast("bigint").alias("_times"),
                ),
                F.struct(
                    F.col("lower_bound").alias("next_lower_bound"),
                    F.lit(False).alias("is_last_record"),
                    (F.col("_n") - 1).alias("_times"),
                ),
            )
        ),
    )
    ordered, fitting = f"lower_bound_{length_words}_upper_bound", f"upper_bound_{gap_words}_next_lower_bound"
    judged = followed.withColumn(
        ordered, F.coalesce(F.expr(f"lower_bound {length_sign} upper_bound"), F.lit(False))
    ).withColumn(
        fitting, F.coalesce(F.expr(f"upper_bound {gap_sign} next_lower_bound"), F.col("is_last_record"))
    )
    return repeat_rows(judged.filter(~(F.col(ordered) & F.col(fitting))), "_times")
