"""Many checks at once (K1-K3, K22, K23): one scan for each table, one grouping for all keys.

Checks are declared first and planned together. Each table is read once; a row unfolds into the keys that it owns, the
keys that it refers to, and a mark for each rule it breaks. All of them are counted by key in one grouping, which adds
up within a task before it moves rows, so a key that a third of a table shares is one row of a task. The counts answer
every check: a key that its table has twice isn't unique, one that is used but not owned is an orphan.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from starloom.checks.outcome import status_of
from starloom.operators.columns import quoted


@dataclass(frozen=True)
class Rule:
    """A declared check with its thresholds; see `Check.verdict`."""

    label: str
    table: str
    error_if: str = "!= 0"
    warn_if: str = "!= 0"
    severity: str = "error"


@dataclass(frozen=True)
class RowRule(Rule):
    """Failures are the rows for which `violated` is true."""

    violated: Column | None = None


@dataclass(frozen=True)
class UniqueRule(Rule):
    """Failures are the values that occur more than once; nulls are ignored."""

    column: str = ""


@dataclass(frozen=True)
class ReferenceRule(Rule):
    """Failures are the rows whose value the parent's field doesn't have; nulls pass."""

    column: str = ""
    parent: str = ""
    field: str = ""


@dataclass(frozen=True)
class ColumnsRule(Rule):
    """Failures are the names on one side only, without regard to case."""

    columns: tuple[str, ...] = ()


def required(table: str, column: str, **thresholds) -> RowRule:
    """K1."""
    return RowRule(f"not_null {table}.{column}", table, violated=F.col(quoted(column)).isNull(), **thresholds)


def holds(table: str, condition: Column | str, label: str | None = None, **thresholds) -> RowRule:
    """K8: rows for which the condition is false; null passes."""
    condition = F.expr(condition) if isinstance(condition, str) else condition
    return RowRule(label or f"expression_is_true {table}", table, violated=~condition, **thresholds)


def unique_key(table: str, column: str, **thresholds) -> UniqueRule:
    """K2."""
    return UniqueRule(f"unique {table}.{column}", table, column=column, **thresholds)


def refers(table: str, column: str, parent: str, field: str, **thresholds) -> ReferenceRule:
    """K3."""
    label = f"relationships {table}.{column} -> {parent}.{field}"
    return ReferenceRule(label, table, column=column, parent=parent, field=field, **thresholds)


def has_columns(table: str, columns: list[str], **thresholds) -> ColumnsRule:
    """K22."""
    return ColumnsRule(f"columns {table}", table, columns=tuple(columns), **thresholds)


OWNED = -1


def planned_verdicts(tables: dict[str, DataFrame], rules: list[Rule]) -> DataFrame:
    """`check, failures, status` for every rule, in one pass over each table.

    Keys are compared as text. Rules of tables that aren't given are an error, and so are two rules of one label.
    """
    names = [t for r in rules for t in (r.table, *([r.parent] if isinstance(r, ReferenceRule) else []))]
    missing = sorted(set(names) - set(tables))
    if missing:
        raise ValueError(f"no tables named {missing}")
    labels = [r.label for r in rules]
    if len(set(labels)) < len(labels):
        raise ValueError("two rules have one label")

    # a domain is a field whose values are counted, or a rule whose marks are
    domains: dict[object, int] = {}
    uses: dict[int, int] = {}  # references to a domain so far
    unfolded: dict[str, list[Column]] = {}
    failures: dict[str, tuple[int | None, str | None, int]] = {}  # label: domain, measure, constant

    def domain_of(field: object) -> int:
        return domains.setdefault(field, len(domains))

    def unfold(table: str, domain: int, key: Column, use: int, when: Column) -> None:
        item = F.struct(F.lit(domain).alias("domain"), key.cast("string").alias("key"), F.lit(use).alias("use"))
        unfolded.setdefault(table, []).append(F.when(when, item))

    def own(table: str, field: str) -> int:
        new = (table, field) not in domains
        domain = domain_of((table, field))
        if new:
            unfold(table, domain, F.col(quoted(field)), OWNED, F.col(quoted(field)).isNotNull())
        return domain

    for i, rule in enumerate(rules):
        if isinstance(rule, ColumnsRule):
            ours, given = {c.upper() for c in tables[rule.table].columns}, {c.upper() for c in rule.columns}
            failures[rule.label] = (None, None, len(ours ^ given))
        elif isinstance(rule, UniqueRule):
            failures[rule.label] = (own(rule.table, rule.column), "repeated", 0)
        elif isinstance(rule, ReferenceRule):
            domain = own(rule.parent, rule.field)
            use = uses[domain] = uses.get(domain, -1) + 1
            unfold(rule.table, domain, F.col(quoted(rule.column)), use, F.col(quoted(rule.column)).isNotNull())
            failures[rule.label] = (domain, f"orphans{use}", 0)
        else:
            domain = domain_of(i)
            unfold(rule.table, domain, F.lit(None), OWNED, rule.violated)
            failures[rule.label] = (domain, "marks", 0)

    # one row for each rule, also for tables without rows
    wanted = [(i, r.label, *failures[r.label]) for i, r in enumerate(rules)]
    spark = next(iter(tables.values())).sparkSession
    found = spark.createDataFrame(wanted, "rule int, label string, own int, measure string, constant bigint")
    value = F.col("constant")
    if unfolded:
        widest = 1 + max(uses.values(), default=-1)
        measures = ["repeated", "marks", *[f"orphans{u}" for u in range(widest)]]
        # items that don't apply become rows of nulls, which go again: cheaper than to test every array first
        items = [tables[t].select(F.inline(F.array(*cols))).filter(F.col("domain").isNotNull()) for t, cols in unfolded.items()]
        keys = reduce(lambda a, b: a.unionAll(b), items).groupBy("domain", "key")
        by_key = keys.agg(
            F.count_if(F.col("use") == OWNED).alias("owned"),
            *[F.count_if(F.col("use") == u).alias(f"used{u}") for u in range(widest)],
        )
        lost = F.col("owned") == 0
        counted = by_key.groupBy("domain").agg(
            F.count_if(F.col("key").isNotNull() & (F.col("owned") > 1)).alias("repeated"),
            F.sum(F.when(F.col("key").isNull(), F.col("owned")).otherwise(0)).alias("marks"),
            *[F.sum(F.when(lost, F.col(f"used{u}")).otherwise(0)).alias(f"orphans{u}") for u in range(widest)],
        )
        found = found.join(counted, F.col("own") == F.col("domain"), "left")
        value = F.coalesce(*[F.when(F.col("measure") == m, F.col(m)) for m in measures], value)
    status = F.lit(None).cast("string")
    groups: dict[tuple[str, str, str], list[int]] = {}
    for i, r in enumerate(rules):
        groups.setdefault((r.error_if, r.warn_if, r.severity), []).append(i)
    for thresholds, ids in groups.items():
        status = F.when(F.col("rule").isin(ids), status_of(*thresholds)).otherwise(status)
    found = found.withColumn("failures", value.cast("bigint"))
    return found.select(F.col("label").alias("check"), "failures", status.alias("status"))
