"""Frame operators on hand-made rows."""

import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import Window, functions as F

from starloom.operators import columns, compare, dedupe, ordered, reshape, spine, values


def test_star_and_filtered_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "field_1 int, Field_2 int, field_3 int")
    assert columns.filtered_columns(df, ["FIELD_2"]) == ["field_1", "field_3"]
    assert df.select(*columns.star(df, exclude=["field_3"])).columns == ["field_1", "Field_2"]
    assert df.select(*columns.star(df, prefix="a_", suffix="_z")).columns == ["a_field_1_z", "a_Field_2_z", "a_field_3_z"]
    assert columns.star(df, exclude=["field_1", "field_2", "FIELD_3"]) == []
    both = df.alias("l").join(df.alias("r"), F.col("l.field_1") == F.col("r.field_1"))
    assert both.select(*columns.star(df, relation_alias="l")).first() == (1, 2, 3)


def test_nullcheck_and_group_by(spark, rows):
    df = spark.createDataFrame([("", " ", 0), ("x", None, 1)], "a string, b string, n int")
    assert rows(columns.nullcheck(df)) == [(None, " ", 0), ("x", None, 1)]
    assert rows(columns.group_by_first(df, 1).count()) == [("", 1), ("x", 1)]
    with pytest.raises(ValueError):
        columns.group_by_first(df, 4)


def test_deduplicate_is_total_and_keeps_null_keys(spark, rows):
    df = spark.createDataFrame(
        [(1, 1, "b"), (1, 2, "a"), (1, 2, "c"), (2, None, "x"), (None, 5, "n"), (None, 4, "m")], "user_id int, version int, v string"
    )
    got = dedupe.deduplicate(df, ["user_id"], [F.desc("version")])
    assert rows(got) == [(None, 5, "n"), (1, 2, "a"), (2, None, "x")]
    same = dedupe.deduplicate(df.repartition(3).orderBy(F.rand(1)), ["user_id"], [F.desc("version")])
    assert rows(same) == rows(got)


def test_deduplicate_reduces_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = dedupe.deduplicate(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert plan.count("Exchange") == 1


def test_natural_join_loses_null_rows(spark, rows):
    a = spark.createDataFrame([(1, "x"), (2, None)], "id int, k string")
    b = spark.createDataFrame([(1, "x", 7), (2, None, 8)], "ID int, k string, v int")
    assert rows(dedupe.natural_join(a, b).select("id", "k", "v")) == [(1, "x", 7)]
    with pytest.raises(ValueError):
        dedupe.natural_join(a, spark.range(1).toDF("other"))


def test_union_relations(spark, rows):
    a = spark.createDataFrame([(1, "ann", "red")], "id int, name string, color string")
    b = spark.createDataFrame([(2, 7, "bob")], "id int, favorite_number int, name string")
    got = reshape.union_relations({"a": a, "b": b})
    assert got.columns == [reshape.SOURCE_COLUMN, "id", "name", "color", "favorite_number"]
    assert rows(got) == [("a", 1, "ann", "red", None), ("b", 2, "bob", None, 7)]
    cased = reshape.union_relations({"a": a, "b": b.withColumnRenamed("name", "NAME")}, source_column=None)
    assert cased.columns == ["id", "name", "color", "favorite_number"] and cased.filter("name = 'bob'").count() == 1
    typed = reshape.union_relations({"a": a, "b": b}, column_override={"id": "string"}, exclude=["NAME"], source_column=None, where="id > 1")
    assert typed.dtypes == [("id", "string"), ("color", "string"), ("favorite_number", "int")]
    assert rows(typed) == [("2", None, 7)]
    with pytest.raises(ValueError, match="not both"):
        reshape.union_relations({"a": a}, include=["id"], exclude=["name"])
    with pytest.raises(ValueError, match="no columns"):
        reshape.union_relations({"a": a}, include=["zzz"])


SIZES = [("S", "red", 1), ("S", "blue", 2), ("S", "red", 4), ("M", "red", 8)]


def test_pivot(spark, rows):
    df = spark.createDataFrame(SIZES, "size string, color string, quantity int")
    counted = df.groupBy("size").agg(*reshape.pivot("color", ["red", "blue"]))
    assert counted.columns == ["size", "red", "blue"]
    assert rows(counted) == [("M", 1, 0), ("S", 2, 1)]
    summed = df.groupBy("size").agg(
        *reshape.pivot("color", ["red", "it's"], then_value=F.col("quantity"), prefix="Q ", quote_identifiers=False)
    )
    assert summed.columns == ["size", "q_red", "q_its"]
    assert rows(summed) == [("M", 8, 0), ("S", 5, 0)]
    other = df.groupBy().agg(*reshape.pivot("color", ["red"], agg="count", cmp="!=", then_value=F.col("size"), else_value=F.lit(None), distinct=True))
    assert rows(other) == [(1,)]
    assert df.groupBy().agg(*reshape.pivot("color", ["red"], alias=False)).columns != ["red"]


def test_unpivot_keeps_nulls(spark, rows):
    df = spark.createDataFrame([(1, date(2026, 1, 1), True, None), (2, None, None, 5)], "id int, created date, active boolean, n int")
    got = reshape.unpivot(df, exclude=["id"], remove=["CREATED"], field_name="f", value_name="v")
    assert got.columns == ["id", "f", "v"]
    assert rows(got) == [(1, "active", "true"), (1, "n", None), (2, "active", None), (2, "n", "5")]


def test_columnwise(spark):
    df = spark.createDataFrame([(3, "c", None), (1, "a", True), (2, "b", False)], "col_1 int, col_2 string, col_3 boolean")
    assert reshape.columnwise(df, ["col_1"]).first().asDict() == {
        "col_1": [1, 2, 3],
        "col_2": ["a", "b", "c"],
        "col_3": [True, False, None],
    }
    with pytest.raises(Exception, match="more than 2 rows"):
        reshape.columnwise(df, ["col_1"], max_rows=2).collect()


def test_column_values(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("c", 1), (None, 0)], "field string, n int")
    get = lambda most=9, **kw: values.value_list(df, "field", most, **kw)
    assert get()[0] == "a" and len(get()) == 4
    assert get(max_records=1) == ["a"]
    assert get(order_by=[(F.max("n"), "desc")], max_records=2) == ["b", "a"]
    assert get(where="n > 2") == ["b"]
    assert get(where="n > 9", default=["z"]) == ["z"]
    assert values.value_list(None, "field", 9, default=[]) == []
    with pytest.raises(ValueError, match="no default"):
        values.value_list(None, "field", 9)
    with pytest.raises(ValueError, match="more than 2"):
        get(2)


def test_single_value(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "i int, s string")
    got = spark.range(1).select(
        values.single_value(df.orderBy("i"), 9).alias("first"),
        values.single_value(df.filter("i > 5"), 9).alias("fallback"),
        values.single_value(df.filter("i = 1").select("s"), "d").alias("null_row"),
    )
    assert got.first() == (1, 9, None)


def test_number_series_and_spine(spark):
    assert [r[0] for r in spine.number_series(spark, 10).orderBy(F.col("generated_number")).collect()] == list(range(1, 11))
    with pytest.raises(ValueError, match="positive"):
        spine.number_series(spark, 0)
    days = [r[0] for r in spine.date_spine(spark, "day", date(2018, 1, 1), date(2018, 1, 10)).orderBy("date_day").collect()]
    assert days == [date(2018, 1, d) for d in range(1, 10)]
    months = spine.date_spine(spark, "month", date(2026, 1, 15), date(2026, 3, 20))
    assert sorted(r[0] for r in months.collect()) == [date(2026, 1, 15), date(2026, 2, 15)]
    hours = spine.date_spine(spark, "hour", datetime(2026, 1, 1, 22), datetime(2026, 1, 2, 1))
    assert [r[0].hour for r in hours.orderBy("date_hour").collect()] == [22, 23, 0]
    with pytest.raises(ValueError):
        spine.date_spine(spark, "day", date(2026, 1, 2), date(2026, 1, 2))


def test_calendar(spark):
    cal = spine.calendar(spark, date(2020, 1, 1), date(2030, 12, 31))
    got = cal.agg(F.count("*"), F.min("full_date"), F.max("full_date"), F.countDistinct("date_key")).first()
    assert got == (4018, date(2020, 1, 1), date(2030, 12, 31), 4018)


def test_two_way_except_is_a_set_operation(spark, rows):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (3, "y")], "i int, s string")
    b = spark.createDataFrame([(2, None), (3, "z"), (3, "z")], "i int, s string")
    assert rows(compare.two_way_except(a, b)) == [("a_minus_b", 1, "x"), ("a_minus_b", 3, "y"), ("b_minus_a", 3, "z")]


def test_compare_counts(spark, rows):
    a = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "g string")
    b = spark.createDataFrame([("x",), ("z",), (None,)], "g string")
    got = compare.compare_counts(a, b, ["g"], ("n", "m"))
    assert rows(got) == [(None, None, None, 1), (None, None, 1, None), (None, "z", None, 1), ("x", "x", 2, 1), ("y", None, 1, None)]
    assert rows(compare.compare_counts(a, b, [], ("n", "m"))) == [(4, 3)]
    assert rows(compare.compare_counts(a, b.limit(0), [], ("n", "m"))) == [(4, None)]


@pytest.mark.parametrize("forward", [True, False])
@pytest.mark.parametrize("group", [["g"], []])
def test_sliced_neighbours_equal_the_plain_window(spark, rows, forward, group):
    rng = random.Random(7)
    # One group holds most rows; nulls occur in the group and in both order columns.
    data = {
        (
            "hot" if rng.random() < 0.7 else rng.choice(["a", "b", None]),
            rng.choice([None, *range(40)]),
            rng.choice([None, *range(20)]),
        )
        for _ in range(900)
    }
    df = spark.createDataFrame(list(data), "g string, x int, y int")
    if not group:
        df = df.select("x", "y").distinct()
    step = F.lead if forward else F.lag
    window = Window.partitionBy(*group).orderBy(F.asc_nulls_last("x"), F.asc_nulls_last("y"))
    plain = df.withColumn("near", step(F.struct(F.col("x").alias("o0"), F.col("y").alias("o1"))).over(window))
    for bits in (8, ordered.SLICE_BITS):
        assert rows(ordered.with_neighbour(df, group, ["x", "y"], "near", forward, bits)) == rows(plain)


REALS = [0.0, -0.0, 1.0, -1.0, 5e-324, -5e-324, 1e-300, 1.7e308, float("inf"), float("-inf"), float("nan"), 2.0**-31, 1 + 2.0**-52]
KINDS = {
    "tinyint": lambda r: r.randint(-128, 127),
    "smallint": lambda r: r.randint(-32768, 32767),
    "bigint": lambda r: r.choice([r.randint(-50, 50), r.randint(-(1 << 63), (1 << 63) - 1)]),
    "double": lambda r: r.choice([*REALS, r.uniform(-9, 9), r.uniform(-1e9, 1e9), r.gauss(0, 1) * 10 ** r.randint(-300, 300)]),
    "float": lambda r: r.choice([0.0, 1.5, -2.5, float("nan"), float("inf"), r.uniform(-9, 9)]),
    "decimal(12,3)": lambda r: Decimal(r.randint(-(10**8), 10**8)).scaleb(-3),
    "decimal(30,9)": lambda r: Decimal(r.randint(-(10**25), 10**25)).scaleb(-9),
    "date": lambda r: date.fromordinal(r.randint(1, 3_650_000)),
    "timestamp": lambda r: datetime(2024, 3, 30, 22) + timedelta(microseconds=r.choice([r.randint(0, 10**7), r.randint(0, 10**13)])),
    "timestamp_ntz": lambda r: datetime(1969, 12, 31, 23) + timedelta(microseconds=r.randint(0, 10**11)),
    "string": lambda r: r.choice(["", "a", "é", "\U0001f600", "ab"]) * r.randint(0, 9) + r.choice("abé"),
    "binary": lambda r: bytes(r.choices(range(256), k=r.randint(0, 5))),
    "boolean": lambda r: r.random() < 0.5,
}


@pytest.mark.parametrize("kind", list(KINDS))
def test_slices_of_every_type_keep_the_order(spark, kind):
    rng = random.Random(kind)
    data = [("hot" if rng.random() < 0.7 else rng.choice(["a", None]), None if rng.random() < 0.05 else KINDS[kind](rng)) for _ in range(500)]
    df = spark.createDataFrame(data, f"g string, `_after` {kind}").distinct()
    both = ordered.with_neighbours(df, ["g"], ["_after"], following="n", previous="p", slice_bits=9)
    window = Window.partitionBy("g").orderBy(F.asc_nulls_last("_after"))
    here = F.struct(F.col("_after").alias("o0"))
    plain = df.select("g", "_after", F.lead(here).over(window).alias("n"), F.lag(here).over(window).alias("p"))
    assert both.columns == plain.columns
    assert both.exceptAll(plain).isEmpty() and plain.exceptAll(both).isEmpty()


def test_nothing_runs_while_neighbours_are_planned(spark):
    df = spark.range(5000).withColumn("g", F.lit(1))
    spark.sparkContext.setJobGroup("planning", "neighbours")
    out = ordered.with_neighbour(df, ["g"], ["id"], "near", slice_bits=4)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("planning")
    spark.sparkContext.setJobGroup("rest", "rest")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "SinglePartition" not in plan
    assert out.filter("near.o0 <> id + 1").isEmpty()
    assert out.filter("near IS NULL").count() == 1


def test_a_slice_holds_a_bounded_part_of_one_group(spark):
    """With 2 to the 5th values a slice, no window of any step sees more than 128 of 3,000 rows that matter."""
    df = spark.range(3000).select((F.col("id") * 7).cast("int").alias("x"), F.lit(1).alias("g"))
    levels = ordered.slice_levels(df, ["x"], 5)
    assert len(levels) > 3
    edge = df
    for cuts in reversed(levels):
        window = Window.partitionBy("g", *cuts).orderBy("x")
        assert edge.groupBy("g", *cuts).count().agg(F.max("count")).first()[0] <= 128
        edge = edge.withColumn("e", F.lead("x").over(window).isNull() | F.lag("x").over(window).isNull()).filter("e").drop("e")


def test_repeat_rows(spark, rows, monkeypatch):
    monkeypatch.setattr(ordered, "COPIES_PER_BLOCK", 10)
    df = spark.createDataFrame([("a", 0), ("b", 1), ("c", 37), ("d", 20)], "k string, n bigint")
    got = ordered.repeat_rows(df, "n").groupBy("k").count()
    assert rows(got) == [("b", 1), ("c", 37), ("d", 20)]
