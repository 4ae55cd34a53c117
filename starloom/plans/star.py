"""Reading the star: facts joined to the dimensions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Path:
    """A foreign key of the fact, the dimension it leads to, and the attributes wanted from there."""

    key: str
    dimension: DataFrame
    attributes: dict[str, str | Column]
    dimension_key: str | None = None

    def lookup(self) -> DataFrame:
        return self.dimension.select(
            F.col(self.dimension_key or self.key).alias(self.key),
            *[(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in self.attributes.items()],
        )


def star_join(fact: DataFrame, paths: list[Path]) -> DataFrame:
    """Every fact row with its attributes; a key without a member keeps its row with nulls.

    Whether a dimension is broadcast is left to adaptive execution, which sees its real size; a large one
    is joined by shuffle, with hot keys split.
    """
    out = fact
    for path in paths:
        out = out.join(path.lookup(), path.key, "left")
    return out


def star_rollup(
    fact: DataFrame,
    paths: list[Path],
    measures: dict[str, Column],
    degenerate: list[str] = (),
) -> DataFrame:
    """C2 + aggregation: counts and sums of the fact by attributes of the dimensions.

    The fact is first summed by its foreign keys, then joined, then summed by attribute. What meets the
    dimensions is one row per key combination however many facts share it, so a company that holds a
    third of the facts costs no more than any other. `measures` are additive inputs, each summed;
    `degenerate` are columns of the fact itself to group by.
    """
    keys = [*degenerate, *[p.key for p in paths]]
    summed = fact.groupBy(*keys).agg(*[F.sum(c).alias(n) for n, c in measures.items()])
    attributes = [*degenerate, *[n for p in paths for n in p.attributes]]
    return (
        star_join(summed, paths)
        .groupBy(*attributes)
        .agg(*[F.sum(n).alias(n) for n in measures])
    )
