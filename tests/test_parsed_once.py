"""Findings F5 to F7: a feed is parsed as often as it must be, and no more, on its way through a day."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from starloom.functions.dates import utc_wall_clock
from starloom.functions.rules import tag_terms
from starloom.functions.text import mentions
from starloom.plans.conform import FLAT, conform
from starloom.sources.bronze import _array_length, _is_array, judge_payloads, read_elements, split_elements
from starloom.sources.lake import day_path

DAY = date(2026, 6, 1)


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def landed(spark, tmp_path, body: str) -> str:
    base = str(tmp_path)
    spark.createDataFrame([(body,)], "value string").coalesce(1).write.text(day_path(f"{base}/bronze", FLAT.source, DAY))
    return base


def test_a_row_is_parsed_once_although_its_title_is_filtered(spark, tmp_path):
    base = landed(spark, tmp_path, '[{"id": 1, "position": " a "}, {"id": 2}, null, 7]')
    split_elements(spark, base, FLAT.source, DAY, root="position")
    raw = read_elements(spark, base, FLAT.source, DAY, FLAT.schema)
    assert raw.count() == 4
    rows = conform(raw.drop("source", "ingestion_date"), FLAT, DAY).base
    assert plan(rows).count("from_json(") == 1
    assert [(r.posting_id, r.title) for r in rows.collect()] == [("1", "a")]


def test_the_gate_parses_a_payload_twice_at_most(spark):
    bodies = ["[1,2]", "", " [ ]", '{"a":1}', "[1] [2]", "1],[2", "[1", "null", None, '\n[{"a":[1]}]\n', "\x0b[1]"]
    payloads = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i int, payload string")
    judged = judge_payloads(payloads)
    assert plan(judged).count("lengthOfJsonArray") == 2
    found = [(r.n_records, r.reason, r.accepted) for r in judged.orderBy("i").collect()]
    broken, empty = (None, "not a JSON array", False), (None, "empty body", False)
    good = {0: (2, None, True), 2: (0, "no records", False), 9: (1, None, True)}
    assert found == [good.get(i, empty if not b else broken) for i, b in enumerate(bodies)]
    same = payloads.select(F.coalesce(_is_array(F.col("payload")), F.lit(False)) == _array_length(F.col("payload")).isNotNull())
    assert {r[0] for r in same.collect()} == {True}


@pytest.mark.parametrize("body", ['[{"position": null}, {"x": {"position": 1}}]', "[1, null]"])
def test_a_feed_without_its_root_stops(spark, tmp_path, body):
    base = landed(spark, tmp_path, body)
    with pytest.raises(ValueError, match="expected 'position'"):
        split_elements(spark, base, FLAT.source, DAY, root="position")


def test_terms_and_mentions_are_as_before(spark):
    texts = ["JavaScript & Go", "C++; Power BI", "", None, "nothing", "REMOTE", "télétravail, teleworker"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.orderBy("i").select(
        tag_terms("t").alias("tags"),
        tag_terms("t", []).alias("none"),
        mentions(["t", "t"], "remote|telework").alias("far"),
        mentions(["t"], "^nothing$").alias("anchored"),
    ).collect()
    assert [r.tags for r in rows] == [["java", "javascript", "go"], ["c++", "power bi"], [], [], [], [], []]
    assert [r.none for r in rows] == [[]] * 7
    assert [r.far for r in rows] == [False] * 5 + [True, True]
    assert [r.anchored for r in rows] == [False] * 4 + [True, False, False]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_wall_clock_by_whole_numbers(spark, zone):
    own = spark.newSession()
    own.conf.set("spark.sql.session.timeZone", zone)
    moments = ["2024-11-03T01:30:00-05:00", "1850-01-01T00:00:00.123457Z", "9999-12-31T23:59:59.999999Z", None]
    df = own.createDataFrame([(i, m) for i, m in enumerate(moments)], "i int, m string")
    clock = df.select("i", utc_wall_clock(F.col("m").cast("timestamp")).alias("c"))
    assert "decimal" not in plan(clock)
    found = [r.c for r in clock.select("i", F.col("c").cast("string").alias("c")).orderBy("i").collect()]
    assert found == ["2024-11-03 06:30:00", "1850-01-01 00:00:00.123457", "9999-12-31 23:59:59.999999", None]
