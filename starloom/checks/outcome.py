"""What a check returns, and how it is judged."""

from __future__ import annotations

import functools
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Check:
    """The violating rows, and the expression over them that counts failures (the row count if None)."""

    name: str
    violations: DataFrame
    failures: Column | None = None

    def verdict(
        self,
        error_if: str = "!= 0",
        warn_if: str = "!= 0",
        severity: str = "error",
        label: str | None = None,
    ) -> DataFrame:
        """One row `check, failures, status`.

        The thresholds are comparisons with the failure count, such as `> 10`; `error_if="<1"` turns a
        check around. With severity `warn` the error threshold is not looked at.
        """
        count = F.count(F.lit(1)) if self.failures is None else self.failures
        counted = self.violations.agg(F.coalesce(count, F.lit(0)).cast("bigint").alias("failures"))
        return judge(counted, F.lit(label or self.name), error_if, warn_if, severity)


def judge(
    counted: DataFrame,
    name: Column,
    error_if: str = "!= 0",
    warn_if: str = "!= 0",
    severity: str = "error",
) -> DataFrame:
    """`check, failures, status` for rows that hold a failure count."""
    return counted.select(name.alias("check"), "failures", status_of(error_if, warn_if, severity).alias("status"))


def status_of(error_if: str = "!= 0", warn_if: str = "!= 0", severity: str = "error") -> Column:
    """The status of a row's `failures`; see `Check.verdict`."""
    if severity not in ("error", "warn"):
        raise ValueError(f"severity must be 'error' or 'warn', got {severity!r}")
    warned = F.when(F.expr(f"failures {warn_if}"), F.lit("warn")).otherwise(F.lit("pass"))
    if severity == "warn":
        return warned
    return F.when(F.expr(f"failures {error_if}"), F.lit("error")).otherwise(warned)


def verdicts(rows: list[DataFrame]) -> DataFrame:
    """The verdict rows of several checks as one frame."""
    return reduce(lambda a, b: a.unionAll(b), rows)


def check(fn):
    """Give a check function its name and the common `where` argument, which filters the checked frame."""

    @functools.wraps(fn)
    def run(df: DataFrame, *args, where: str | Column | None = None, **kwargs) -> Check:
        found = fn(df if where is None else df.filter(where), *args, **kwargs)
        violations, failures = found if isinstance(found, tuple) else (found, None)
        return Check(fn.__name__, violations, failures)

    return run
