"""Registered queries against DuckDB, and the shape of the plans that matter at scale."""

import inspect
import pathlib
import re

import pytest

import __spark_entry__ as contract
import starloom
from starloom.queries import REGISTRY
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.fixture(scope="module")
def made(spark):
    """Each query's frame, built once: some write whole layers while they are built."""
    frames = {}

    def get(name):
        if name not in frames:
            frames[name] = REGISTRY[name].run(spark, FOLDER)
        return frames[name]

    return get


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query_equals_sql(made, duck, name):
    assert compare(made(name), duck, REGISTRY[name].sql) is None


def test_contract(spark):
    assert contract.entry(spark).count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert all(len(inspect.signature(fn).parameters) == 2 for fn in contract.queries().values())


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    from starloom.checks import accepted_range, not_null

    orders = spark.read.parquet(f"{FOLDER}/orders.parquet")
    plan = physical(accepted_range(orders, "o_totalprice", 1000).violations.select("o_orderkey"))
    assert "PushedFilters: [IsNotNull(o_totalprice), LessThan(o_totalprice,1000.0)]" in plan
    assert re.search(r"ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>", plan)
    assert "PushedFilters: [IsNull(o_orderdate)]" in physical(not_null(orders, "o_orderdate").violations)


def test_single_value_is_pushed_into_the_scan(spark):
    plan = physical(REGISTRY["scalar_threshold"].run(spark, FOLDER))
    assert "GreaterThan(o_totalprice,ScalarSubquery" in plan


@pytest.mark.parametrize("name", ["fact_posting", "latest_snapshot", "dedup_lines"])
def test_one_shuffle_and_a_limit_before_it(spark, name):
    plan = physical(REGISTRY[name].run(spark, FOLDER))
    assert plan.count("Exchange") == 1 and "WindowGroupLimit" in plan


def test_unpivot_scans_once(spark):
    assert physical(REGISTRY["unpivot_long"].run(spark, FOLDER)).count("FileScan") == 1


def test_both_directions_of_a_comparison_share_one_shuffle(spark):
    assert physical(REGISTRY["two_way_difference"].run(spark, FOLDER)).count("Exchange") == 1


@pytest.mark.parametrize("name", list(REGISTRY))
def test_no_nested_loops_or_python_in_plans(made, name):
    plan = physical(made(name))
    for word in ("NestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "InPandas"):
        assert word not in plan


def test_library_keeps_to_distributed_calls():
    root = pathlib.Path(starloom.__file__).parent
    for path in root.rglob("*.py"):
        code = path.read_text()
        for word in ("localCheckpoint", "crossJoin", "toPandas", ".rdd", "toLocalIterator", "F.udf", "pandas_udf"):
            assert word not in code, f"{word} in {path}"
