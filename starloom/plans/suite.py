"""Integrity of staging and marts as one frame of verdicts."""

from __future__ import annotations

from pyspark.sql import DataFrame

from starloom.checks.planner import Rule, has_columns, planned_verdicts, refers, required, unique_key
from starloom.schemas import FOREIGN_KEYS, MARTS, PRIMARY_KEYS

STAGING_REQUIRED = {"stg_jobs": ["posting_id"], "stg_job_skills": ["posting_id", "skill"]}


def declared_rules(tables: dict[str, DataFrame], declared_columns: bool = True) -> list[Rule]:
    """The rules on the tables given: required fields, keys, foreign keys whose parent is given, columns."""
    rules: list[Rule] = []
    for table, columns in STAGING_REQUIRED.items():
        if table in tables:
            rules += [required(table, c) for c in columns]
    if "stg_jobs" in tables:
        rules.append(unique_key("stg_jobs", "posting_id"))
    for table, key in PRIMARY_KEYS.items():
        if table in tables:
            rules += [required(table, key), unique_key(table, key)]
    rules += [refers(*key) for key in FOREIGN_KEYS if key[0] in tables and key[2] in tables]
    if declared_columns:
        rules += [has_columns(t, schema.fieldNames()) for t, schema in MARTS.items() if t in tables]
    return rules


def integrity_suite(tables: dict[str, DataFrame], declared_columns: bool = True) -> DataFrame:
    """`check, failures, status` for all declared keys of the tables given, in one scan of each.

    `tables` holds marts by name, and staging under `stg_jobs` and `stg_job_skills` where wanted.
    """
    return planned_verdicts(tables, declared_rules(tables, declared_columns))
