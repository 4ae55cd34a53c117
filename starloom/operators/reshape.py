"""Union of differing frames, pivot, unpivot, column-wise collect."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BooleanType

from starloom.functions.text import as_column, bool_to_text, slug
from starloom.operators.columns import filtered_columns, quoted

# Fixed value: default name of the lineage column.
SOURCE_COLUMN = "_dbt_source_relation"


def union_relations(
    relations: dict[str, DataFrame],
    column_override: dict[str, str] | None = None,
    include: list[str] = (),
    exclude: list[str] = (),
    source_column: str | None = SOURCE_COLUMN,
    where: str | Column | None = None,
) -> DataFrame:
    """G1: UNION ALL over the superset of columns, in first-seen order.

    A column that a frame lacks is a typed null; the type is that of the first frame that has it, or
    the override. `where` filters each frame before its columns are cut.
    """
    if include and exclude:
        raise ValueError("give include or exclude, not both")
    wanted = {n.lower() for n in include}
    # Names are compared without regard to case, as Spark does; the first spelling stays.
    kinds: dict[str, tuple[str, str]] = {}
    for df in relations.values():
        types = dict(df.dtypes)
        for name in filtered_columns(df, exclude):
            if not wanted or name.lower() in wanted:
                kinds.setdefault(name.lower(), (name, types[name]))
    if not kinds:
        raise ValueError(f"no columns left to union for {', '.join(relations)}")
    overrides = {n.lower(): t for n, t in (column_override or {}).items()}

    def part(label: str, df: DataFrame) -> DataFrame:
        present = {c.lower() for c in df.columns}
        lineage = [F.lit(label).alias(source_column)] if source_column else []
        rows = df if where is None else df.filter(where)
        return rows.select(
            *lineage,
            *[
                (F.col(quoted(name)) if key in present else F.lit(None))
                .cast(overrides.get(key, kind))
                .alias(name)
                for key, (name, kind) in kinds.items()
            ],
        )

    return reduce(lambda a, b: a.unionByName(b), [part(n, df) for n, df in relations.items()])


_COMPARISONS = {
    "=": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<>": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "like": lambda a, b: F.like(a, b),
    "ilike": lambda a, b: F.ilike(a, b),
}


def pivot(
    column: str | Column,
    values: list,
    *,
    alias: bool = True,
    agg: str = "sum",
    cmp: str = "=",
    prefix: str = "",
    suffix: str = "",
    then_value=1,
    else_value=0,
    quote_identifiers: bool = True,
    distinct: bool = False,
) -> list[Column]:
    """One aggregate per value, for use in `groupBy(...).agg(*pivot(...))`.

    A cell without rows holds the aggregate of `else_value`, which `groupBy().pivot()` cannot give; all
    cells come from one partial aggregation over one scan. With `distinct`, Spark expands each row once
    per value, so keep that list short.
    """
    compare = _COMPARISONS[cmp.lower()]

    def value_of(v):
        return v if isinstance(v, Column) else F.lit(v)

    cells = []
    for value in values:
        item = F.when(compare(as_column(column), F.lit(value)), value_of(then_value)).otherwise(
            value_of(else_value)
        )
        cell = F.call_function(agg, item) if not distinct else _distinct_aggregate(agg, item)
        if alias:
            header = f"{prefix}{value}{suffix}"
            cell = cell.alias(header if quote_identifiers else slug(header))
        cells.append(cell)
    return cells


def _distinct_aggregate(agg: str, item: Column) -> Column:
    known = {"count": F.count_distinct, "sum": F.sum_distinct}
    if agg.lower() in ("min", "max"):
        return F.call_function(agg, item)
    if agg.lower() not in known:
        raise ValueError(f"distinct works with count, sum, min and max, not {agg!r}")
    return known[agg.lower()](item)


def unpivot(
    df: DataFrame,
    cast_to: str = "string",
    exclude: list[str] = (),
    remove: list[str] = (),
    field_name: str = "field_name",
    value_name: str = "value",
) -> DataFrame:
    """One row per row and column, with all values cast to one type; nulls are kept.

    `exclude` columns are carried along, `remove` columns are dropped. One scan, each row expanded in place.
    """
    carried = [quoted(c) for c in exclude]
    melted = filtered_columns(df, [*exclude, *remove])
    kinds = {f.name: f.dataType for f in df.schema}

    def text_or_cast(name: str) -> Column:
        c = F.col(quoted(name))
        if isinstance(kinds[name], BooleanType):
            c = bool_to_text(c)
        return c.cast(cast_to).alias(name)

    typed = df.select(*carried, *[text_or_cast(n) for n in melted])
    return typed.unpivot(carried, [quoted(n) for n in melted], field_name, value_name)


def columnwise(df: DataFrame, order_by: list[str], max_rows: int = 10_000) -> DataFrame:
    """One row with an array per column, values in the given order, nulls kept.

    For small results only, as the whole frame becomes one row: more than `max_rows` rows are an error,
    never a shorter array.
    """
    bounded = df.orderBy(*order_by).limit(max_rows + 1)
    row = F.struct(*order_by, *[c for c in df.columns if c not in order_by])
    return bounded.agg(F.sort_array(F.collect_list(row)).alias("_rows")).select(
        [
            F.when(
                F.size("_rows") > max_rows,
                F.raise_error(F.lit(f"columnwise: more than {max_rows} rows")),
            )
            .otherwise(_field_of_each("_rows", c))
            .alias(c)
            for c in df.columns
        ]
    )


def _field_of_each(rows: str, name: str) -> Column:
    return F.transform(rows, lambda r: r[name])
