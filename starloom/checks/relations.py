"""Checks between two tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import NumericType

from starloom.checks.outcome import check
from starloom.functions.text import ColumnLike, as_column
from starloom.operators.columns import filtered_columns, quoted
from starloom.operators.compare import ONLY_LEFT, ONLY_RIGHT, two_way_except


def _orphans(child: DataFrame, column: ColumnLike, parent: DataFrame, field: ColumnLike) -> DataFrame:
    """One row `id, right_id` per child row without a parent.

    Both sides are reduced to distinct keys before they meet, so a key shared by much of the table is
    one row in the anti join. Only where orphan keys were found are the child rows looked up again;
    adaptive execution drops that second scan for a sound table, and broadcasts the orphan keys only
    if they turn out small.
    """
    ids = child.select(as_column(column).alias("id")).filter("id IS NOT NULL")
    parents = parent.select(as_column(field).alias("id")).filter("id IS NOT NULL").distinct()
    missing = ids.distinct().join(parents, "id", "left_anti")
    kind = dict(missing.dtypes)["id"]
    return ids.join(missing, "id", "left_semi").select("id", F.lit(None).cast(kind).alias("right_id"))


@check
def relationships(df: DataFrame, column: ColumnLike, to: DataFrame, field: ColumnLike):
    """K3: child rows without a parent; a null child passes."""
    return _orphans(df, column, to, field)


@check
def relationships_where(
    df: DataFrame,
    column: ColumnLike,
    to: DataFrame,
    field: ColumnLike,
    from_condition: str | Column = "1=1",
    to_condition: str | Column = "1=1",
):
    """K5: K3 with both tables filtered first."""
    return _orphans(df.filter(from_condition), column, to.filter(to_condition), field)


@check
def cardinality_equality(df: DataFrame, column: str, to: DataFrame, field: str):
    """K7: values with their row counts, for every value whose counts differ; one row per side that has it.

    Both tables are counted in one grouping, so the values meet after partial aggregation.
    """
    sides = df.select(F.col(quoted(column)), F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionAll(
        to.select(F.col(quoted(field)), F.lit(0), F.lit(1))
    )
    counted = sides.groupBy(quoted(column)).agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))
    return (
        counted.filter("_a <> _b")
        .select(quoted(column), F.explode(F.array("_a", "_b")).alias("num_rows"))
        .filter("num_rows > 0")
    )


@check
def equality(
    df: DataFrame,
    compare: DataFrame,
    compare_columns: list[str] | None = None,
    exclude_columns: list[str] | None = None,
    precision: int | None = None,
):
    """Rows of one table that the other lacks, tagged by side.

    Tables are compared as sets; the failure count adds the imbalance between the sides. Numbers are
    rounded to `precision` where it is given.
    """
    if compare_columns and exclude_columns:
        raise ValueError("give compare_columns or exclude_columns, not both")
    if compare_columns:
        columns = list(compare_columns)
    else:
        columns = filtered_columns(df, exclude_columns or [])
        theirs = filtered_columns(compare, exclude_columns or [])
        if {c.lower() for c in columns} != {c.lower() for c in theirs}:
            raise ValueError("the tables have different columns; use compare_columns or exclude_columns")

    def projected(frame: DataFrame) -> DataFrame:
        kinds = {f.name.lower(): f.dataType for f in frame.schema}
        return frame.select(
            [
                F.round(quoted(c), precision).alias(c)
                if precision is not None and isinstance(kinds[c.lower()], NumericType)
                else F.col(quoted(c))
                for c in columns
            ]
        )

    violations = two_way_except(projected(df), projected(compare))
    side = F.col("which_diff")
    imbalance = F.abs(F.count_if(side == ONLY_LEFT) - F.count_if(side == ONLY_RIGHT))
    return violations, F.count(F.lit(1)) + imbalance


@check
def expect_table_columns_to_match_set(df: DataFrame, columns: list[str]):
    """Column names on one side only, as `relation_column, input_column`; case is ignored.

    This is a full outer join of two name lists. Both are schema, known while the plan is built, so
    they are put side by side there and no rows move.
    """
    ours, given = {c.upper() for c in df.columns}, {c.upper() for c in columns}

    def name_if(present: bool, name: str) -> Column:
        return (F.lit(name) if present else F.lit(None)).cast("string")

    pairs = [
        F.struct(
            name_if(n in ours, n).alias("relation_column"), name_if(n in given, n).alias("input_column")
        )
        for n in sorted(ours | given)
    ]
    return (
        df.sparkSession.range(0, 1, 1, 1)
        .select(F.inline(F.array(*pairs)))
        .filter("relation_column IS NULL OR input_column IS NULL")
    )
