"""Every check on a passing and a failing frame, with the edge cases of nulls and empty tables."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from starloom import checks as k
from starloom.operators.ordered import SLICE_BITS


def failures(check, **kwargs):
    row = check.verdict(**kwargs).first()
    return row.failures, row.status


@pytest.fixture
def make(spark):
    return lambda data, schema: spark.createDataFrame(data, schema)


def test_not_null_unique(make, rows):
    df = make([(1,), (2,), (2,), (None,), (None,)], "v int")
    assert failures(k.not_null(df, "v")) == (2, "error")
    assert failures(k.not_null(df, "v", where="v > 0")) == (0, "pass")
    assert rows(k.unique(df, "v").violations) == [(2, 2)]
    assert failures(k.unique(df, "v", where="v < 2")) == (0, "pass")


def test_relationships(make, rows):
    child = make([(1,), (4,), (4,), (None,)], "id int")
    parent = make([(1,), (1,), (2,), (None,)], "pid int")
    found = k.relationships(child, "id", parent, "pid")
    assert rows(found.violations) == [(4, None), (4, None)]
    assert failures(found) == (2, "error")
    assert failures(k.relationships_where(child, "id", parent, "pid", from_condition="id <> 4")) == (0, "pass")
    assert failures(k.relationships_where(child, "id", parent, "pid", to_condition="pid > 1")) == (3, "error")


def test_value_lists(make, rows):
    df = make([("Madrid",), ("Berlin",), ("Berlin",), ("Rome",), (None,)], "city string")
    assert rows(k.accepted_values(df, "city", ["Madrid", "Rome"]).violations) == [("Berlin", 2)]
    assert rows(k.not_accepted_values(df, "city", ["Berlin", "Madrid", "Oslo"]).violations) == [("Berlin",), ("Madrid",)]
    assert failures(k.not_accepted_values(df, "city", ["Oslo"])) == (0, "pass")


def test_unique_combination(make, rows):
    df = make([("jan", "a"), ("jan", "b"), ("feb", None), ("feb", None)], "month string, product string")
    assert rows(k.unique_combination_of_columns(df, ["month", "product"]).violations) == [("feb", None)]
    assert failures(k.unique_combination_of_columns(df, ["month", "product"], where="product IS NOT NULL")) == (0, "pass")


def test_cardinality_equality(make, rows):
    a = make([("x",), ("x",), ("y",), (None,)], "same string")
    b = make([("x",), ("y",), ("y",), (None,), ("z",)], "other string")
    assert failures(k.cardinality_equality(a, "same", a, "same")) == (0, "pass")
    assert rows(k.cardinality_equality(a, "same", b, "other").violations) == [("x", 1), ("x", 2), ("y", 1), ("y", 2), ("z", 1)]


def test_expression_is_true(make):
    df = make([(0.5, 0.5), (1.0, 0.0), (None, 1.0)], "col_a double, col_b double")
    assert failures(k.expression_is_true(df, "col_a + col_b = 1")) == (0, "pass")
    assert failures(k.expression_is_true(df, "= 0.5", column="col_b")) == (2, "error")
    assert failures(k.expression_is_true(df, "= 0.5", column="col_b", where="col_a = 0.5")) == (0, "pass")
    assert failures(k.expression_is_true(df, F.col("col_a") > 0.6)) == (1, "error")


def test_equal_rowcount(make):
    a = make([("x",), ("x",), ("y",), (None,)], "f string")
    one_sided = make([("x",), ("x",), (None,), (None,)], "f string")
    assert failures(k.equal_rowcount(a, a, ["f"])) == (0, "pass")
    # y is on one side only and nulls never match, so nothing is counted.
    assert failures(k.equal_rowcount(a, one_sided, ["f"])) == (0, "pass")
    assert failures(k.equal_rowcount(a, a.filter("f = 'x'"))) == (2, "error")
    assert failures(k.equal_rowcount(a, a.limit(0))) == (0, "pass")
    assert failures(k.equal_rowcount(a.limit(0), a.limit(0))) == (0, "pass")


def test_fewer_rows_than(make):
    a = make([("x",), ("x",), ("y",)], "g string")
    b = make([("x",), ("x",), ("x",), ("y",), ("y",)], "g string")
    assert failures(k.fewer_rows_than(a, b)) == (0, "pass")
    assert failures(k.fewer_rows_than(a, b, ["g"])) == (0, "pass")
    assert failures(k.fewer_rows_than(a, a)) == (1, "error")
    assert failures(k.fewer_rows_than(a, a, ["g"])) == (2, "error")
    assert failures(k.fewer_rows_than(b, a)) == (2, "error")
    assert failures(k.fewer_rows_than(a, b.limit(0))) == (0, "pass")


def test_equality(make, rows):
    a = make([(1, "x", 1.00004), (1, "x", 1.00004), (2, "y", 2.0)], "id int, s string, f double")
    b = make([(1, "x", 1.00001), (2, "y", 2.0)], "ID int, s string, f double")
    assert failures(k.equality(a, a)) == (0, "pass")
    assert failures(k.equality(a, b, compare_columns=["id", "s"])) == (0, "pass")
    assert failures(k.equality(a, b, exclude_columns=["F"])) == (0, "pass")
    assert failures(k.equality(a, b, precision=4)) == (0, "pass")
    assert failures(k.equality(a, b, precision=5)) == (2, "error")
    # One row too few on a side counts itself and the imbalance.
    assert failures(k.equality(a, b.filter("id = 2"), compare_columns=["id", "s"])) == (2, "error")
    with pytest.raises(ValueError, match="different columns"):
        k.equality(a, b.drop("f"))
    with pytest.raises(ValueError, match="not both"):
        k.equality(a, b, compare_columns=["id"], exclude_columns=["s"])


def test_recency(make, rows):
    df = make([("a", datetime(2026, 1, 1, 13)), ("b", datetime(2026, 1, 2, 1)), ("c", None)], "g string, at timestamp_ntz")
    as_of = F.lit("2026-01-02 12:00:00").cast("timestamp_ntz")
    assert failures(k.recency(df, "at", "day", 1, as_of=as_of)) == (0, "pass")
    assert rows(k.recency(df, "at", "hour", 12, group_by=["g"], as_of=as_of).violations) == [
        ("a", datetime(2026, 1, 1, 13), datetime(2026, 1, 2))
    ]
    late = F.lit("2026-01-02 14:00:00").cast("timestamp_ntz")
    assert failures(k.recency(df, "at", "day", 1, as_of=late, where="g = 'a'")) == (1, "error")
    assert failures(k.recency(df, "at", "day", 1, ignore_time_component=True, as_of=late, where="g = 'a'")) == (0, "pass")
    assert failures(k.recency(df, "at", "day", 1, as_of=as_of, where="false")) == (0, "pass")
    assert failures(k.recency(df.withColumn("at", F.current_timestamp()), "at", "day", 1)) == (0, "pass")


def test_at_least_one(make, rows):
    df = make([("a", 1), ("a", None), ("b", None)], "field string, value int")
    assert failures(k.at_least_one(df, "value")) == (0, "pass")
    assert rows(k.at_least_one(df, "value", ["field"]).violations) == [("b", 0)]
    assert failures(k.at_least_one(df, "value", where="field = 'b'")) == (1, "error")
    assert failures(k.at_least_one(df, "value", where="false")) == (1, "error")
    assert failures(k.at_least_one(df, "field", ["field"])) == (0, "pass")


def test_not_constant(make, rows):
    df = make([("a", 1), ("a", 1), ("b", 1), ("b", 2), ("c", None), ("d", 5), ("d", None)], "g string, v int")
    assert failures(k.not_constant(df, "v")) == (0, "pass")
    assert rows(k.not_constant(df, "v", ["g"]).violations) == [("a", 1), ("d", 1)]
    assert failures(k.not_constant(df, "v", where="g = 'a'")) == (1, "error")
    assert failures(k.not_constant(df, "v", where="g = 'c'")) == (0, "pass")


def test_not_null_proportion(make, rows):
    df = make([("a", 1), ("a", None), ("b", 1)], "g string, v int")
    assert failures(k.not_null_proportion(df, "v", 0.5)) == (0, "pass")
    assert rows(k.not_null_proportion(df, "v", 0.4, 0.6, ["g"]).violations) == [("b", 1.0)]
    assert failures(k.not_null_proportion(df, "v", 0.9)) == (1, "error")
    assert failures(k.not_null_proportion(df, "v", 0.9, where="false")) == (0, "pass")


def test_not_empty_string(make):
    df = make([(1, "a"), (2, "   "), (3, ""), (4, None), (5, " b ")], "id int, v string")
    assert failures(k.not_empty_string(df, "v")) == (2, "error")
    assert failures(k.not_empty_string(df, "v", trim_whitespace=False)) == (1, "error")
    assert failures(k.not_empty_string(df, "v", where="id IN (1, 4, 5)")) == (0, "pass")


def test_accepted_range(make):
    df = make([(-1, 0), (0, 0), (11, 20), (None, 1)], "id int, top int")
    assert failures(k.accepted_range(df, "id", -1, 11)) == (0, "pass")
    assert failures(k.accepted_range(df, "id", -2, 11.1, inclusive=False)) == (0, "pass")
    assert failures(k.accepted_range(df, "id", -1, 11, inclusive=False)) == (2, "error")
    assert failures(k.accepted_range(df, "id", 0, where="id <> -1")) == (0, "pass")
    assert failures(k.accepted_range(df, "id", max_value=F.col("top"), inclusive=False)) == (1, "error")
    assert failures(k.accepted_range(df, "id")) == (0, "pass")


@pytest.mark.parametrize("slice_bits", [7, SLICE_BITS])
def test_sequential_values(make, rows, slice_bits):
    df = make([("a", 1), ("a", 2), ("a", 4), ("b", 4), ("b", 4), ("b", 4), ("b", None)], "g string, my_value int")
    found = k.sequential_values(df, "my_value", group_by=["g"], slice_bits=slice_bits)
    assert found.violations.columns == ["g", "my_value", "previous_my_value"]
    assert rows(found.violations) == [("a", 4, 2), ("b", 4, 4), ("b", 4, 4)]
    assert failures(k.sequential_values(df, "my_value", 2, where="my_value IN (2, 4) AND g = 'a'", slice_bits=slice_bits)) == (0, "pass")
    hours = make([(datetime(2026, 1, 1, h),) for h in (0, 1, 2, 5)], "My_timestamp timestamp_ntz")
    found = k.sequential_values(hours, "My_timestamp", 1, "hour", slice_bits=slice_bits)
    assert rows(found.violations) == [(datetime(2026, 1, 1, 5), datetime(2026, 1, 1, 2))]


RANGES = "sub int, valid_from date, valid_to date"


def day(n):
    return date(2026, 1, n)


@pytest.mark.parametrize("slice_bits", [7, SLICE_BITS])
@pytest.mark.parametrize(
    ("gaps", "data", "bad"),
    [
        ("not_allowed", [(1, 1, 3), (1, 3, 5)], 0),
        ("not_allowed", [(1, 1, 3), (1, 4, 5)], 1),
        ("allowed", [(1, 1, 3), (1, 4, 5), (2, 2, 3)], 0),
        ("allowed", [(1, 1, 5), (1, 4, 6)], 1),
        ("required", [(1, 1, 3), (1, 4, 5)], 0),
        ("required", [(1, 1, 3), (1, 3, 5)], 1),
        ("allowed", [(1, 1, 1)], 1),
        ("allowed", [(1, 3, 1)], 1),
        ("allowed", [(1, 1, 3), (1, 1, 3), (1, 1, 3)], 2),
        ("allowed", [(1, 1, None)], 1),
        # The null bound sorts last: it is the last range, and the one before has nothing to compare with.
        ("allowed", [(1, 1, 3), (1, None, 5)], 2),
    ],
)
def test_mutually_exclusive_ranges(make, slice_bits, gaps, data, bad):
    df = make([(s, a and day(a), b and day(b)) for s, a, b in data], RANGES)
    found = k.mutually_exclusive_ranges(df, "valid_from", "valid_to", "sub", gaps, slice_bits=slice_bits)
    assert failures(found)[0] == bad


def test_range_options(make):
    df = make([(1, day(1), day(1)), (1, day(2), None)], RANGES)
    open_end = "coalesce(valid_to, date'2099-01-01')"
    assert failures(k.mutually_exclusive_ranges(df, "valid_from", open_end, "sub"))[0] == 1
    assert failures(k.mutually_exclusive_ranges(df, "valid_from", open_end, "sub", zero_length_range_allowed=True))[0] == 0
    whole = k.mutually_exclusive_ranges(df, "valid_from", open_end, gaps="required", zero_length_range_allowed=True)
    assert whole.violations.columns == [
        "lower_bound",
        "upper_bound",
        "next_lower_bound",
        "is_last_record",
        "lower_bound_less_than_or_equal_to_upper_bound",
        "upper_bound_less_than_next_lower_bound",
    ]
    with pytest.raises(ValueError, match="gaps"):
        k.mutually_exclusive_ranges(df, "valid_from", "valid_to", gaps="maybe")


def test_assert_equal(make):
    df = make([(1, 1), (1, 2), (None, 2), (2, None)], "actual int, expected int")
    assert failures(k.assert_equal(df, "actual", "expected")) == (1, "error")


def test_columns_match(make, rows):
    df = make([(1, 2)], "id int, Name int")
    assert failures(k.expect_table_columns_to_match_set(df, ["ID", "name"])) == (0, "pass")
    assert rows(k.expect_table_columns_to_match_set(df, ["id", "extra"]).violations) == [(None, "EXTRA"), ("NAME", None)]


def test_verdict_thresholds(make):
    df = make([(None,)] * 3 + [(1,)], "v int")
    check = k.not_null(df, "v")
    assert failures(check, error_if="> 10", warn_if="> 2") == (3, "warn")
    assert failures(check, error_if="> 10", warn_if="> 5") == (3, "pass")
    assert failures(check, severity="warn") == (3, "warn")
    assert failures(check, error_if="<1", warn_if="<0") == (3, "pass")
    assert failures(k.not_null(df, "v", where="v = 1"), error_if="<1", warn_if="<0") == (0, "error")
    both = k.verdicts([check.verdict(), check.verdict(label="again", severity="warn")])
    assert [tuple(r) for r in both.collect()] == [("not_null", 3, "error"), ("again", 3, "warn")]
    with pytest.raises(ValueError, match="severity"):
        check.verdict(severity="loud")
