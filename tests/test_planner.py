"""Planned checks against the single ones, and their scans."""

import random

import pytest
from pyspark.sql import functions as F

from starloom import checks as k
from starloom.checks import planner
from starloom.plans import marts
from starloom.plans.suite import declared_rules, integrity_suite
from starloom.queries.registry import Tables
from starloom.queries.star import staged, staged_skills
from starloom.sources.versions import replace_rows

FOLDER = "/root/testdata/sf0.001"


def by_label(df):
    return {r.check: (r.failures, r.status) for r in df.collect()}


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(9)
    parent = [(rng.choice([None, *range(30)]), rng.choice(["a", "b", None])) for _ in range(60)]
    child = [(7 if rng.random() < 0.34 else rng.choice([None, *range(40)]), rng.choice([None, *range(35)]), float(rng.randint(0, 9))) for _ in range(400)]
    return {
        "parent": spark.createDataFrame(parent, "id int, name string"),
        "child": spark.createDataFrame(child, "parent_id int, `other id` int, v double"),
        "empty": spark.createDataFrame([], "id int, parent_id int"),
    }


def test_planned_verdicts_equal_the_single_checks(tables):
    parent, child, empty = tables["parent"], tables["child"], tables["empty"]
    single = {
        "not_null parent.id": k.not_null(parent, "id"),
        "not_null child.other id": k.not_null(child, "other id"),
        "not_null empty.id": k.not_null(empty, "id"),
        "unique parent.id": k.unique(parent, "id"),
        "unique parent.name": k.unique(parent, "name"),
        "unique child.parent_id": k.unique(child, "parent_id"),
        "unique empty.id": k.unique(empty, "id"),
        "relationships child.parent_id -> parent.id": k.relationships(child, "parent_id", parent, "id"),
        "relationships child.other id -> parent.id": k.relationships(child, F.col("`other id`"), parent, "id"),
        "relationships empty.parent_id -> parent.id": k.relationships(empty, "parent_id", parent, "id"),
        "relationships child.parent_id -> empty.id": k.relationships(child, "parent_id", empty, "id"),
        "small": k.expression_is_true(child, "v < 8"),
        "columns parent": k.expect_table_columns_to_match_set(parent, ["ID", "extra"]),
    }
    rules = [
        planner.required("parent", "id"), planner.required("child", "other id"), planner.required("empty", "id"),
        planner.unique_key("parent", "id"), planner.unique_key("parent", "name"), planner.unique_key("child", "parent_id"), planner.unique_key("empty", "id"),
        planner.refers("child", "parent_id", "parent", "id"), planner.refers("child", "other id", "parent", "id"),
        planner.refers("empty", "parent_id", "parent", "id"), planner.refers("child", "parent_id", "empty", "id"),
        planner.holds("child", "v < 8", "small"), planner.has_columns("parent", ["ID", "extra"]),
    ]
    want = {name: tuple(c.verdict().select("failures", "status").first()) for name, c in single.items()}
    assert by_label(planner.planned_verdicts(tables, rules)) == want
    assert sum(f > 0 for f, _ in want.values()) >= 6


def test_thresholds(tables):
    rules = [
        planner.holds("child", "v < 8", "at most 1000", error_if="> 1000"),
        planner.holds("child", "v < 8", "warned", severity="warn"),
        planner.holds("child", "v < 8", "turned around", error_if="< 1", warn_if="< 0"),
        planner.unique_key("empty", "id"),
    ]
    assert {c: s for c, (_, s) in by_label(planner.planned_verdicts(tables, rules)).items()} == {
        "at most 1000": "warn", "warned": "warn", "turned around": "pass", "unique empty.id": "pass"}
    assert by_label(planner.planned_verdicts(tables, [planner.has_columns("empty", ["id"])])) == {"columns empty": (1, "error")}
    with pytest.raises(ValueError, match="severity"):
        planner.planned_verdicts(tables, [planner.holds("child", "v < 8", severity="loud")])
    with pytest.raises(ValueError, match="no tables named"):
        planner.planned_verdicts(tables, [planner.refers("child", "parent_id", "nowhere", "id")])
    with pytest.raises(ValueError, match="one label"):
        planner.planned_verdicts(tables, [planner.required("child", "v")] * 2)


def test_the_suite_reads_each_table_once(spark, tmp_path):
    t = Tables(spark, FOLDER)
    postings = replace_rows(staged(t), str(tmp_path / "stg_jobs"))
    skills = replace_rows(staged_skills(t), str(tmp_path / "stg_job_skills"))
    written = {"stg_jobs": postings, "stg_job_skills": skills}
    for name, df in marts.build_marts(spark, postings, skills).items():
        written[name] = replace_rows(df, str(tmp_path / name))
    suite = integrity_suite(written)
    plan = suite._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == len(written)
    assert {f.split(str(tmp_path))[1].split("/")[1] for f in suite.inputFiles()} == set(written)
    assert suite.count() == len(declared_rules(written)) == 33
    # one grouping of all keys, one of the counts
    assert plan.count("Exchange hashpartitioning(") == 2
