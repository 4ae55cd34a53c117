"""The three feeds from hand-written JSON."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from starloom.functions.dates import utc_timestamp
from starloom.plans.conform import FLAT, NESTED, STRUCTS, by_whole_words, conform
from starloom.plans.marts import fact_job_posting, stage_postings
from starloom.sources import bronze, lake

DAY = date(2026, 6, 1)


def read(spark, tmp_path, mapping, elements):
    folder = tmp_path / "bronze" / f"source={mapping.source}" / f"ingestion_date={DAY}"
    folder.mkdir(parents=True)
    (folder / "feed.json").write_text(json.dumps(elements, indent=1))
    whole = bronze.read_feed(spark, str(tmp_path), mapping.source, DAY, mapping.schema)
    bronze.split_elements(spark, str(tmp_path), mapping.source, DAY)
    lines = bronze.read_elements(spark, str(tmp_path), mapping.source, DAY, mapping.schema)
    assert lines.schema == whole.schema and sorted(map(str, lines.collect())) == sorted(map(str, whole.collect()))
    return lines


def by_id(df):
    return {r.posting_id: r for r in df.collect()}


def test_flat_feed(spark, tmp_path, rows):
    raw = read(
        spark,
        tmp_path,
        FLAT,
        [
            {"legal": "terms"},
            {"id": "1", "position": "  Dev ", "company": " A ", "salary_min": 0, "salary_max": 90000.5,
             "date": "2026-05-31T23:00:00+00:00", "tags": [" SQL", "sql", "", "  ", "Go"], "url": "u1"},
            {"id": 2, "position": "Ops", "location": " Oslo ", "salary_min": 10, "salary_max": 20, "date": "soon", "tags": None},
            {"id": "1", "position": "Dev old", "date": "2026-05-01T00:00:00+00:00", "tags": ["rust"]},
            {"id": "3", "position": "Min only", "salary_min": "5000", "salary_max": "n/a", "tags": []},
        ],
    )
    made = conform(raw.drop("source", "ingestion_date"), FLAT, DAY)
    jobs = by_id(made.jobs)
    assert set(jobs) == {"1", "2", "3"}
    one = jobs["1"]
    assert (one.title, one.company, one.location_raw, one.is_remote, one.job_url) == ("Dev", "A", "Remote", True, "u1")
    assert (one.salary_min_usd, one.salary_max_usd, one.salary_avg_usd) == (None, 90000.5, 90000.5)
    assert one.posted_at == datetime(2026, 5, 31, 23)
    assert (jobs["2"].location_raw, jobs["2"].salary_avg_usd, jobs["2"].posted_at) == ("Oslo", 15.0, None)
    assert (jobs["3"].salary_min_usd, jobs["3"].salary_max_usd, jobs["3"].salary_avg_usd) == (5000.0, None, 5000.0)
    assert rows(made.skills.select("posting_id", "skill")) == [("1", "go"), ("1", "rust"), ("1", "sql")]
    assert made.jobs.filter("ingestion_date <> date'2026-06-01' OR source <> 'RemoteOK'").isEmpty()


def test_flat_feed_without_tags_has_an_empty_bridge(spark, tmp_path):
    raw = read(spark, tmp_path, FLAT, [{"id": "1", "position": "x"}])
    made = conform(raw.drop("source", "ingestion_date"), FLAT, DAY)
    assert made.skills.isEmpty() and made.jobs.count() == 1
    assert all(kind != "void" for _, kind in made.jobs.dtypes)


def test_struct_feed(spark, tmp_path, rows):
    raw = read(
        spark,
        tmp_path,
        STRUCTS,
        [
            {"id": "7", "title": " Java dev ", "company": {"display_name": " C "}, "location": {"display_name": "Rome"},
             "created": "2026-05-30T10:11:12Z", "description": "JavaScript, Python", "redirect_url": "r"},
            {"id": "8", "title": "Remote cook", "created": "2026-05-30T10:11:12"},
            {"id": "9", "title": "Baker", "description": "fully REMOTE", "created": "30.05.2026"},
            {"id": "10", "title": None, "description": "python"},
            {"title": "No id", "company": None},
        ],
    )
    made = conform(raw.drop("source", "ingestion_date"), STRUCTS, DAY)
    jobs = by_id(made.jobs)
    assert set(jobs) == {"adzuna-7", "adzuna-8", "adzuna-9", None}
    assert (jobs["adzuna-7"].company, jobs["adzuna-7"].is_remote) == ("C", False)
    assert jobs["adzuna-7"].posted_at == jobs["adzuna-8"].posted_at == datetime(2026, 5, 30, 10, 11, 12)
    assert (jobs["adzuna-8"].is_remote, jobs["adzuna-9"].is_remote, jobs["adzuna-9"].posted_at) == (True, True, None)
    assert rows(made.skills.select("posting_id", "skill")) == [("adzuna-7", s) for s in ("java", "javascript", "python")]


def nested(ident, **inner):
    return {"MatchedObjectId": ident, "MatchedObjectDescriptor": {"PositionTitle": "T", **inner}}


def test_nested_feed(spark, tmp_path, rows):
    def pay(code, low="10", high="30"):
        return [{"MinimumRange": low, "MaximumRange": high, "RateIntervalCode": code}]

    raw = read(
        spark,
        tmp_path,
        NESTED,
        [
            nested(1, PositionRemuneration=pay("PA"), PublicationStartDate="2026-05-01T00:00:00.0000000"),
            nested(2, PositionRemuneration=pay("PH")),
            nested(3, PositionRemuneration=[], QualificationSummary="Telework, SQL"),
            nested(4, PositionRemuneration=pay("PA", "high", "0"), PositionLocationDisplay=" Boise "),
            nested(5, PositionTitle=None),
        ],
    )
    assert lake.require_root(raw, NESTED.root) is raw
    jobs = by_id(conform(raw.drop("source", "ingestion_date"), NESTED, DAY).jobs)
    assert set(jobs) == {f"usajobs-{i}" for i in (1, 2, 3, 4)}
    assert (jobs["usajobs-1"].salary_min_usd, jobs["usajobs-1"].salary_avg_usd) == (10.0, 20.0)
    assert jobs["usajobs-1"].posted_at == datetime(2026, 5, 1)
    assert [jobs[f"usajobs-{i}"].salary_avg_usd for i in (2, 3, 4)] == [None, None, None]
    assert (jobs["usajobs-3"].is_remote, jobs["usajobs-4"].is_remote) == (True, False)
    assert jobs["usajobs-4"].location_raw == "Boise"


def test_nested_feed_without_its_root_is_refused(spark, tmp_path):
    raw = read(spark, tmp_path, NESTED, [{"MatchedObjectId": 1}])
    with pytest.raises(ValueError, match="MatchedObjectDescriptor"):
        lake.require_root(raw, NESTED.root)
    with pytest.raises(ValueError, match="other"):
        lake.require_root(raw, "other")


def test_landing_gate_and_promotion(spark, tmp_path):
    bodies = {"A": "", "B": "{", "C": "{}", "D": "[]", "E": '[{"id": 1},\n {"id": 2}]', "F": "[1] [2]", "G": "[1],[2]"}
    for source, body in bodies.items():
        folder = tmp_path / "landing" / f"source={source}" / "ingestion_date=2026-06-01"
        folder.mkdir(parents=True)
        (folder / "x.json").write_text(body)
    report = bronze.landing_report(spark, str(tmp_path / "landing"))
    got = {r.path.split("source=")[1][0]: (r.n_records, r.reason, r.accepted) for r in report.collect()}
    assert got == {
        "A": (None, "empty body", False),
        "B": (None, "not a JSON array", False),
        "C": (None, "not a JSON array", False),
        "D": (0, "no records", False),
        "E": (2, None, True),
        "F": (None, "not a JSON array", False),
        "G": (None, "not a JSON array", False),
    }
    for _ in range(2):  # a rerun replaces the day
        bronze.promote(report, str(tmp_path))
    files = list((tmp_path / "bronze").rglob("part-*"))
    assert [f.read_text().rstrip("\n") for f in files] == [bodies["E"]]
    assert sorted(r.id for r in bronze.read_feed(spark, str(tmp_path), "E", DAY, FLAT.schema).collect()) == ["1", "2"]


def test_drifting_fields_and_broken_files(spark, tmp_path):
    elements = [{"id": 1.5, "company": "plain text", "title": "a"}, None, {"id": {"x": 1}, "company": {"display_name": "c"}}]
    got = read(spark, tmp_path, STRUCTS, elements).select("id", "title", "company.display_name").collect()
    assert [tuple(r) for r in got] == [("1.5", "a", None), (None, None, None), ('{"x":1}', None, "c")]
    (tmp_path / "bronze" / "source=Adzuna" / f"ingestion_date={DAY}" / "more.json").write_text("[{")
    with pytest.raises(Exception, match="not a JSON array"):
        bronze.read_feed(spark, str(tmp_path), "Adzuna", DAY, STRUCTS.schema).collect()


def test_flatten_pages_stops_at_the_first_empty_page(spark, rows):
    pages = spark.createDataFrame(
        [("a", 1, [1, 2]), ("a", 2, []), ("a", 3, [9]), ("b", 1, [5]), ("b", 2, [6]), ("c", 1, None), ("c", 2, [7])],
        "feed string, page int, results array<int>",
    )
    got = bronze.flatten_pages(pages, "results", keys=["feed"])
    assert rows(got) == [("a", 1, 1), ("a", 1, 2), ("b", 1, 5), ("b", 2, 6)]
    assert rows(bronze.flatten_pages(pages.filter("feed = 'a'"), "results").select("page", "item")) == [(1, 1), (1, 2)]
    assert rows(bronze.flatten_pages(pages.filter("feed = 'b'"), "results").select("item")) == [(5,), (6,)]


def test_absent_columns(spark):
    df = spark.createDataFrame([(1, ("x",))], "a int, s struct<f: string>")
    got = df.select(
        lake.column_or_null(df, "a", "int").alias("a"),
        lake.column_or_null(df, "zzz", "string").alias("z"),
        lake.field_or_null(df, "s", "f", "string").alias("f"),
        lake.field_or_null(df, "zzz", "f", "string").alias("g"),
    )
    assert got.first() == (1, None, "x", None)
    assert got.dtypes == [("a", "int"), ("z", "string"), ("f", "string"), ("g", "string")]
    with pytest.raises(Exception, match="FIELD_NOT_FOUND"):
        df.select(lake.field_or_null(df, "s", "other", "string")).collect()


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_facts_do_not_depend_on_the_zone_of_the_session(spark, zone):
    own = spark.newSession()
    own.conf.set("spark.sql.session.timeZone", zone)
    flat = own.createDataFrame(
        [("1", "2026-05-30T02:00:00+00:00"), ("2", "2026-05-30T02:00:00"), ("3", "2026-05-30"), ("4", "2026-05-30T04:00:00+02:00"),
         ("5", "2026-11-01T05:30:00Z"), ("6", "2026-11-01 06:30:00"), ("7", "soon"), ("8", None)],
        "id string, date string",
    ).withColumn("posted_at", utc_timestamp("date"))
    struct = own.createDataFrame([("1", "2026-05-30T02:00:00Z"), ("2", "2026-05-30T02:00:00"), ("3", "x")], "id string, date string")
    struct = struct.withColumn("posted_at", utc_timestamp("date", "yyyy-MM-dd'T'HH:mm:ss"))
    found = []
    for raw in (flat, struct):
        raw = raw.select(
            F.col("id").alias("posting_id"), "posted_at", F.lit(DAY).alias("ingestion_date"), F.lit(True).alias("is_remote"),
            *[F.lit("a").alias(c) for c in ("source", "title", "company", "location_raw", "job_url")],
            *[F.lit(1.0).alias(f"salary_{m}_usd") for m in ("min", "max", "avg")],
        )
        facts = fact_job_posting(stage_postings(raw)).orderBy("posting_id")
        found.append([(r.date_key, r.at) for r in facts.select("date_key", F.col("posted_at").cast("string").alias("at")).collect()])
    two = (20260530, "2026-05-30 02:00:00")
    assert found[0] == [
        two, two, (20260530, "2026-05-30 00:00:00"), two,
        (20261101, "2026-11-01 05:30:00"), (20261101, "2026-11-01 06:30:00"), (None, None), (None, None),
    ]
    assert found[1] == [two, two, (None, None)]


def test_a_feed_tagged_by_whole_words(spark, tmp_path):
    raw = read(spark, tmp_path, STRUCTS, [{"id": 1, "title": "a", "description": "JavaScript, going; machine learning"}])
    inside, whole = (sorted(r.skill for r in conform(raw, m, DAY).skills.collect()) for m in (STRUCTS, by_whole_words(STRUCTS)))
    assert inside == ["go", "java", "javascript", "machine learning"] and whole == ["javascript", "machine learning"]
