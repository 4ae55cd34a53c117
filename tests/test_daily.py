"""Whole days over several runs, and the sinks they use."""

import json
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from starloom.plans import marts
from starloom.plans.daily import LandingRejected, run_day
from starloom.plans.star import Path, star_join, star_rollup
from starloom.schemas import MARTS, RAW_JOBS, STAGED_POSTINGS
from starloom.sources import lake, versions
from starloom.streaming.load import load_new_files

FEEDS = {
    "RemoteOK": [
        {"legal": "x"},
        {"id": "1", "position": "Senior Data Engineer", "company": "A", "date": "2026-05-31T00:00:00+00:00",
         "salary_min": 100, "salary_max": 200, "tags": ["SQL", "Spark"]},
        {"id": "2", "position": "Intern", "date": "2031-01-01T00:00:00+00:00", "tags": ["sql "]},
    ],
    "Adzuna": [{"id": "1", "title": "Cook", "description": "java", "created": "2026-05-31T00:00:00Z"}],
    "USAJobs": [{"MatchedObjectId": "1", "MatchedObjectDescriptor": {"PositionTitle": "Clerk", "OrganizationName": "A"}}],
}


def land(tmp_path, day, feeds):
    for source, elements in feeds.items():
        folder = tmp_path / f"landing-{day}" / f"source={source}" / f"ingestion_date={day}"
        folder.mkdir(parents=True)
        (folder / "feed.json").write_text(json.dumps(elements))
    return str(tmp_path / f"landing-{day}")


def failing(result):
    return {r.check: r.failures for r in result.verdicts.collect() if r.status != "pass"}


def test_two_days_and_a_rerun(spark, tmp_path, rows):
    base, first, second = str(tmp_path / "lake"), date(2026, 6, 1), date(2026, 6, 2)
    result = run_day(spark, base, first, landing=land(tmp_path, first, FEEDS))
    assert result.counts == {
        "RemoteOK": {"jobs": 2, "job_skills": 3},
        "Adzuna": {"jobs": 1, "job_skills": 1},
        "USAJobs": {"jobs": 1, "job_skills": 0},
    }
    assert result.tables["fact_job_posting"].count() == 4
    assert rows(result.tables["dim_skill"].select("skill_name", "skill_category")) == [
        ("java", "language"), ("spark", "framework"), ("sql", "language")]
    assert rows(result.tables["dim_company"].select("company_name")) == [("A",), ("Unknown",)]
    # The posting of 2031 lies outside the calendar; a missing date is no orphan.
    assert failing(result) == {"relationships fact_job_posting.date_key -> dim_date.date_key": 1}
    for name, schema in MARTS.items():
        assert result.tables[name].dtypes == [(f.name, f.dataType.simpleString()) for f in schema]

    changed = {**FEEDS, "RemoteOK": [{"id": "1", "position": "Lead Data Engineer", "tags": ["Kafka"]}]}
    again = run_day(spark, base, second, landing=land(tmp_path, second, changed))
    fact, roles = again.tables["fact_job_posting"], again.tables["dim_role"]
    titles = star_join(fact, [Path("role_key", roles, {"t": "role_title"})]).select("posting_id", "t")
    assert dict(rows(titles)) == {"1": "Lead Data Engineer", "2": "Intern", "adzuna-1": "Cook", "usajobs-1": "Clerk"}
    assert rows(again.tables["stg_job_skills"].filter("posting_id = '1'")) == [("1", "kafka"), ("1", "spark"), ("1", "sql")]

    # Repeating a day replaces its rows in raw, and nothing downstream changes but the moment of the load.
    before = {n: rows(df.drop("loaded_at")) for n, df in again.tables.items()}
    loaded = spark.table("MARTS.fact_job_posting").agg(F.max("loaded_at")).first()[0]
    for _ in range(2):
        repeated = run_day(spark, base, second, schema="marts_rerun", cluster_facts=True)
        assert {n: rows(df.drop("loaded_at")) for n, df in repeated.tables.items()} == before
        assert spark.read.schema(RAW_JOBS).parquet(f"{base}/raw/raw_jobs").count() == 4 + 3
    assert spark.table("MARTS_RERUN.dim_date").count() == 4018
    assert spark.table("MARTS_RERUN.fact_job_posting").agg(F.min("loaded_at")).first()[0] > loaded
    assert rows(spark.table("STAGING.stg_job_skills")) == before["stg_job_skills"]
    assert {t.name: t.tableType for t in spark.catalog.listTables("STAGING")} == {"stg_jobs": "VIEW", "stg_job_skills": "VIEW"}

    # A feed that has become empty takes its day out of raw.
    emptied = {**changed, "RemoteOK": [{"legal": "nothing today"}]}
    run_day(spark, base, second, landing=land(tmp_path / "x", second, emptied), schema=None, staging_schema=None)
    assert spark.read.schema(RAW_JOBS).parquet(f"{base}/raw/raw_jobs").count() == 4 + 2


def test_a_bad_file_stops_the_day(spark, tmp_path):
    landing = land(tmp_path, date(2026, 6, 1), {"RemoteOK": FEEDS["RemoteOK"], "Adzuna": []})
    with pytest.raises(LandingRejected, match="no records"):
        run_day(spark, str(tmp_path / "lake"), date(2026, 6, 1), landing=landing)
    assert not (tmp_path / "lake" / "bronze").exists()


def test_staging_takes_the_newest_and_settles_ties(spark, rows):
    def job(pid, day, title, posted=None, pay=None):
        return (pid, title, None, " L ", pay, None, None, True, None, posted, "S", date(2026, 6, day))

    data = [
        job("a", 1, " old "),
        job("a", 2, " new "),
        job("b", 1, "z", datetime(2026, 1, 2)),
        job("b", 1, "y", datetime(2026, 1, 1)),
        job("c", 1, "z"),
        job("c", 1, "y", pay=1e12),
        job(None, 1, "n"),
    ]
    got = marts.stage_postings(spark.createDataFrame(data, RAW_JOBS))
    assert got.dtypes == [(f.name, f.dataType.simpleString()) for f in STAGED_POSTINGS]
    # Pay beyond the stored precision is unknown, not an error.
    assert rows(got.select("posting_id", "title", "location_raw", "salary_min_usd")) == [
        ("a", "new", "L", None), ("b", "z", "L", None), ("c", "y", "L", None)]


def test_staging_money_is_exact(spark):
    row = ("a", "t", None, None, 10.005, 20.0, 15.1, True, None, None, "S", date(2026, 6, 1))
    got = marts.stage_postings(spark.createDataFrame([row], RAW_JOBS)).first()
    assert (got.salary_max_usd, got.salary_avg_usd) == (Decimal("20.00"), Decimal("15.10"))


def test_stage_skills(spark, rows):
    raw = spark.createDataFrame([("a", " SQL "), ("a", "sql"), ("a", "  "), ("a", None), (None, "x")], "posting_id string, skill string")
    assert rows(marts.stage_skills(raw)) == [("a", "sql")]


def test_rollup_equals_join_then_group(spark, rows):
    fact = spark.createDataFrame([(i % 3, i % 5, i) for i in range(50)] + [(9, 0, 1)], "a int, b int, v int")
    dim_a = spark.createDataFrame([(0, "x"), (1, "x"), (2, "y")], "a int, name string")
    dim_b = spark.createDataFrame([(i, i > 2) for i in range(5)], "b_key int, big boolean")
    paths = [Path("a", dim_a, {"name": "name"}), Path("b", dim_b, {"big": "big"}, "b_key")]
    rolled = star_rollup(fact, paths, {"n": F.lit(1), "total": F.col("v")})
    plain = star_join(fact, paths).groupBy("name", "big").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("total"))
    assert rows(rolled) == rows(plain)


def test_write_day_replaces_only_its_day(spark, tmp_path, rows):
    root = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "s", date(2026, 6, 1)), (2, "s", date(2026, 6, 2)), (3, "q", date(2026, 6, 1))], "v int, source string, ingestion_date date")
    lake.write_partitions(df, root)
    lake.write_partitions(df.filter("v = 2").withColumn("v", F.lit(20)), root)
    lake.write_day(df.limit(0), root, "q", date(2026, 6, 1))
    assert rows(spark.read.schema(df.schema).parquet(root).select("v")) == [(1,), (20,)]


def test_catalog(spark, tmp_path, rows):
    df = spark.createDataFrame([(1,)], "v int")
    for name in ("events_1", "Events_2", "events_old", "other"):
        lake.publish(df, " stage_test ", name)
    view = lake.publish_view(spark, " stage_test", "peek", "SELECT v + 1 AS v FROM stage_test.other")
    assert rows(view) == [(2,)]
    lake.publish(df.withColumn("v", F.lit(5)), "stage_test", "other", location=f"{tmp_path}/other")
    assert rows(spark.table("stage_test.peek")) == [(6,)]  # a view keeps its query, not its rows
    lake.publish(df.withColumn("v", F.lit(8)), "stage_test", "other", location=f"{tmp_path}/other")
    assert rows(spark.newSession().table("STAGE_TEST.peek")) == [(9,)]
    lake.publish(df, "stage_test", "events_1")  # a rebuild replaces
    assert spark.table("stage_test.events_1").count() == 1
    found = lake.matching_tables(spark, "STAGE\\_TEST", "EVENTS%", exclude="%old")
    assert rows(found.select("table_name", "table_type")) == [("events_1", "table"), ("events_2", "table")]
    assert rows(lake.tables_with_prefix(spark, "stage_test", "OTH").select("table_name")) == [("other",)]
    assert set(lake.open_tables(spark, found)) == {"stage_test.events_1", "stage_test.events_2"}
    every = lake.matching_tables(spark, "stage\\_test", "%")
    assert rows(every.filter("table_name IN ('other', 'peek')").select("table_name", "table_type")) == [("other", "external"), ("peek", "view")]


def test_a_killed_refresh_leaves_the_old_table(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    lake.publish(spark.range(3).toDF("v"), "refresh_test", "t", location=path)
    old = versions.read_table(spark, path)
    broken = spark.range(0, 100, 1, 4).select(F.when(F.col("id") < 80, F.col("id")).otherwise(F.raise_error(F.lit("killed")).cast("bigint")).alias("v"))
    for refresh in (lambda: versions.replace_rows(broken, path), lambda: lake.publish(broken, "refresh_test", "t", location=path)):
        with pytest.raises(Exception, match="killed"):
            refresh()
        assert rows(old) == rows(versions.read_table(spark, path)) == rows(spark.table("refresh_test.t")) == [(0,), (1,), (2,)]
    # a job that died without an error leaves files but no mark
    left = tmp_path / "t" / "_v000000077"
    left.mkdir()
    (left / "part-0.parquet").write_text("half a file")
    assert rows(versions.read_table(spark, path)) == [(0,), (1,), (2,)]
    for k in (7, 8, 9):
        assert rows(versions.replace_rows(spark.range(k, k + 1).toDF("v"), path)) == [(k,)]
    assert not left.exists() and len([d for d in (tmp_path / "t").iterdir() if d.is_dir()]) == 2
    assert rows(versions.read_table(spark, path)) == [(9,)]
    with pytest.raises(Exception):
        spark.read.parquet(path).count()  # nobody reads all versions as one
    quoted = str(tmp_path / "it's")
    for k in (1, 2):
        assert rows(lake.publish(spark.range(k, k + 1), "refresh_test", "q", location=quoted)) == [(k,)]
    assert rows(lake.publish(spark.range(3).selectExpr("id", "'x' AS other"), "refresh_test", "q", location=quoted).limit(0)) == []
    assert spark.table("refresh_test.q").columns == ["id", "other"]


def test_a_null_in_a_declared_column_stops_the_write(spark, tmp_path, rows):
    declared = T.StructType([T.StructField("K", T.StringType(), False), T.StructField("n", T.IntegerType())])
    good, bad = spark.createDataFrame([("a", None)], "k string, n int"), spark.createDataFrame([("a", 1), (None, 2)], "k string, n int")
    path = str(tmp_path / "t")
    assert rows(versions.replace_rows(lake.enforced(good, declared, "t"), path)) == [("a", None)]
    with pytest.raises(Exception, match="null in t.K, declared NOT NULL"):
        versions.replace_rows(lake.enforced(bad, declared, "t"), path)
    with pytest.raises(Exception, match="null in t.K"):  # also where the column is missing
        versions.replace_rows(lake.enforced(bad.drop("k"), declared, "t"), path)
    assert rows(versions.read_table(spark, path)) == [("a", None)]
    assert lake.enforced(good, MARTS["dim_skill"], "dim_skill").columns == MARTS["dim_skill"].fieldNames()


def test_a_day_in_several_batches_is_whole(spark, tmp_path, rows):
    folder, target, log = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "log")
    df = spark.range(0, 60, 1, 6).select("id", F.lit("s").alias("source"), F.lit(date(2026, 6, 1)).alias("ingestion_date"))
    df.write.partitionBy("source", "ingestion_date").parquet(folder)
    for _ in range(2):
        load_new_files(spark, folder, target, log, df.schema, files_per_batch=2)
        assert rows(spark.read.parquet(target).select("id")) == rows(df.select("id"))
    lake.write_day(df.limit(7), folder, "s", date(2026, 6, 1))
    load_new_files(spark, folder, target, log, df.schema, files_per_batch=2)
    assert spark.read.parquet(target).count() == 7
