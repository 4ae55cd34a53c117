"""Differences between two frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starloom.operators.columns import fresh_name, quoted

ONLY_LEFT, ONLY_RIGHT = "a_minus_b", "b_minus_a"


def two_way_except(a: DataFrame, b: DataFrame, tag: str = "which_diff") -> DataFrame:
    """Distinct rows of `a` missing from `b`, and of `b` missing from `a`, tagged.

    Both directions come from one grouping of the stacked frames: one shuffle instead of the four of
    two EXCEPTs, and repeated rows shrink before it. Nulls equal each other, as in EXCEPT.
    """
    columns = a.columns
    side, lo, hi = (fresh_name(a, n) for n in ("_side", "_lo", "_hi"))
    stacked = a.withColumn(side, F.lit(1)).unionAll(b.toDF(*columns).withColumn(side, F.lit(2)))
    return (
        stacked.groupBy(*map(quoted, columns))
        .agg(F.min(side).alias(lo), F.max(side).alias(hi))
        .filter(F.col(lo) == F.col(hi))
        .select(
            F.when(F.col(lo) == 1, F.lit(ONLY_LEFT)).otherwise(F.lit(ONLY_RIGHT)).alias(tag),
            *map(quoted, columns),
        )
    )


def compare_counts(a: DataFrame, b: DataFrame, group: list[str], names: tuple[str, str]) -> DataFrame:
    """C4: row counts of both frames side by side, by group or in total, as a full outer join would give them.

    Each side is one row per group when it reaches the join. Null group keys do not match; in total, an
    empty frame has no count rather than 0. Group columns come back as `<name>_a` and `<name>_b`.
    """
    if not group:
        sides = a.select(F.lit(True).alias("_ours")).unionAll(b.select(F.lit(False).alias("_ours")))
        counts = [F.count_if("_ours"), F.count_if(~F.col("_ours"))]
        totals = sides.agg(*[F.nullif(c, F.lit(0)).alias(n) for c, n in zip(counts, names)])
        return totals.filter(F.coalesce(*names).isNotNull())

    def counted(df: DataFrame, side: str, name: str) -> DataFrame:
        keys = [F.col(quoted(g)).alias(f"{g}_{side}") for g in group]
        return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))

    left, right = counted(a, "a", names[0]), counted(b, "b", names[1])
    on = [left[quoted(f"{g}_a")] == right[quoted(f"{g}_b")] for g in group]
    keys = [f"{g}_{side}" for g in group for side in ("a", "b")]
    return left.join(right, on, "full_outer").select(*map(quoted, keys), *names)
