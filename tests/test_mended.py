"""Inputs that were lost or mixed up once: old files, half-read feeds, null feed keys, clashing and dotted names."""

import json
import os
import time
from datetime import date

import pytest
from pyspark.sql import functions as F

from starloom.checks import equal_rowcount, fewer_rows_than, unique_combination_of_columns
from starloom.operators.compare import two_way_except
from starloom.operators.dedupe import deduplicate
from starloom.plans import daily
from starloom.plans.conform import SourceMapping
from starloom.plans.daily import LandingRejected, land
from starloom.sources.bronze import flatten_pages, read_elements, read_feed, split_elements
from starloom.sources.versions import read_table
from starloom.streaming.load import load_new_files


def test_old_files_are_loaded(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")

    def add(name, age_days):
        at = source / "ingestion_date=2026-01-01"
        spark.createDataFrame([(name,)], "v string").coalesce(1).write.mode("append").parquet(str(at))
        new = max(at.glob("part-*"), key=lambda p: p.stat().st_mtime)
        then = time.time() - age_days * 86400
        os.utime(new, (then, then))

    def load():
        schema = spark.createDataFrame([], "v string, ingestion_date date").schema
        load_new_files(spark, str(source), target, str(tmp_path / "log"), schema)
        return sorted(r.v for r in spark.read.parquet(target).collect())

    add("now", 0)
    assert load() == ["now"]
    add("old", 400)
    add("yesterday", 1)
    assert load() == ["now", "old", "yesterday"]


@pytest.mark.parametrize("text", ['[{"a":1}][{"a":2}]', '{"a":1}\n{"a":2}', '{"a":1}', '[{"a":1}] x'])
def test_feed_is_exactly_one_array(spark, tmp_path, text):
    at = tmp_path / "bronze/source=s/ingestion_date=2026-06-01"
    at.mkdir(parents=True)
    (at / "f.json").write_text(text)
    schema = spark.createDataFrame([], "a int").schema
    with pytest.raises(Exception, match="not a JSON array"):
        read_feed(spark, str(tmp_path), "s", date(2026, 6, 1), schema).collect()


def test_null_feed_key_stops(spark):
    rows = [(None, 1, [1]), (None, 2, []), (None, 3, [9]), ("f", 1, [2]), ("f", 2, None), ("f", 3, [9])]
    df = spark.createDataFrame(rows, "feed string, page int, items array<int>").withColumn("_stop", F.lit(7))
    got = flatten_pages(df, "items", "page", ["feed"]).collect()
    assert sorted((r.feed or "", r.page, r["item"]) for r in got) == [("", 1, 1), ("f", 1, 2)]


def test_all_rejected_files_are_in_the_report(spark, tmp_path):
    at = tmp_path / "landing/source=s/ingestion_date=2026-06-01"
    at.mkdir(parents=True)
    for k in range(30):
        (at / f"bad{k:02}.json").write_text("{}" if k else "")
    (at / "good.json").write_text("[{}]")
    with pytest.raises(LandingRejected, match=r"30 files rejected \(empty body: 1, not a JSON array: 29\); see .*landing_report") as e:
        land(spark, str(tmp_path / "landing"), str(tmp_path / "base"))
    assert "bad" not in str(e.value) and not (tmp_path / "base/bronze").exists()
    report = read_table(spark, str(tmp_path / "base/landing_report"))
    assert "payload" not in report.columns
    rejected = {r.path.split("/")[-1]: r.reason for r in report.filter("NOT accepted").collect()}
    assert rejected == {f"bad{k:02}.json": "not a JSON array" if k else "empty body" for k in range(30)}


def test_one_feed_file_is_read_by_several_tasks(spark, tmp_path):
    landing = tmp_path / "landing/source=s/ingestion_date=2026-06-01"
    landing.mkdir(parents=True)
    elements = [{"a": k, "b": {"c": "x" * 50}, "d": 1.50} for k in range(20_000)] + [None, 7, {"e": "line\nbreak"}, {"a": "9"}]
    (landing / "f.json").write_text(json.dumps(elements, indent=1))
    base, day = str(tmp_path / "base"), date(2026, 6, 1)
    land(spark, str(tmp_path / "landing"), base, {"s": SourceMapping("s", None, None, root="b")})
    schema = spark.createDataFrame([], "a string, b struct<c:string>, d string, e string").schema
    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    own.conf.set("spark.sql.files.openCostInBytes", "0")
    split = read_elements(own, base, "s", day, schema)
    assert len([*(tmp_path / "base/elements").rglob("part-*.txt")]) == 1
    assert split.select(F.spark_partition_id().alias("p")).distinct().count() >= 8
    got = split.collect()
    assert len(got) == 20_004 and sum(r.a is None for r in got) == 3
    assert {r.d for r in got} == {"1.50", None} or {r.d for r in got} == {"1.5", None}
    assert [r.e for r in got if r.e] == ["line\nbreak"]
    assert {(r.source, r.ingestion_date) for r in got} == {("s", day)}
    with pytest.raises(ValueError, match="expected 'zzz'"):
        split_elements(spark, base, "s", day, root="zzz")


def test_a_late_file_waits_for_the_next_run(spark, tmp_path, monkeypatch):
    landing = tmp_path / "landing/source=s/ingestion_date=2026-06-01"
    landing.mkdir(parents=True)
    (landing / "f.json").write_text('[{"a": 1}]')
    real = daily.promote

    def late(payloads, base):
        (landing / "g.json").write_text("broken")
        real(payloads, base)

    monkeypatch.setattr(daily, "promote", late)
    daily.land(spark, str(tmp_path / "landing"), str(tmp_path / "base"))
    assert [f.read_text().strip() for f in (tmp_path / "base/bronze").rglob("part-*.txt")] == ['[{"a": 1}]']


def test_helper_names_do_not_clash(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 6, "b"), (2, 7, "c")], "k int, _rank int, v string")
    got = deduplicate(df, ["k"], ["_rank"])
    assert got.columns == ["k", "_rank", "v"] and sorted(map(tuple, got.collect())) == [(1, 5, "a"), (2, 7, "c")]
    side = spark.createDataFrame([(1, "x"), (2, "y")], "_side int, _lo string")
    assert two_way_except(side, side).count() == 0
    assert two_way_except(side, side.limit(1)).count() == 1
    n = spark.createDataFrame([(1,), (1,), (2,)], "_n int")
    assert [r[0] for r in unique_combination_of_columns(n, ["_n"]).violations.collect()] == [1]


def test_strict_counts_and_dotted_groups(spark):
    a = spark.createDataFrame([("x",), ("y",)], "`g.h` string")
    b = spark.createDataFrame([("x",)], "`g.h` string")

    def failures(check):
        return check.verdict().first().failures

    assert failures(equal_rowcount(a, b, ["g.h"])) == 0
    assert failures(equal_rowcount(a, b, ["g.h"], strict=True)) == 1
    assert failures(equal_rowcount(a, b.limit(0), strict=True)) == 2
    assert failures(fewer_rows_than(a, b.limit(0), strict=True)) == 2
    assert failures(fewer_rows_than(b, a, ["g.h"], strict=True)) == 1
