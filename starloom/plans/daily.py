"""One logical day from landed files to checked marts."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from starloom.plans.conform import FEEDS, Conformed, SourceMapping, conform
from starloom.plans.marts import build_marts, stage_postings, stage_skills
from starloom.plans.suite import integrity_suite
from starloom.schemas import MARTS
from starloom.sources.bronze import landed_payloads, landing_report, promote, read_elements, split_elements
from starloom.sources.lake import clustered, day_path, enforced, publish, publish_staging, write_day
from starloom.sources.versions import current_path, path_exists, replace_rows
from starloom.streaming.load import RAW_TABLES, load_raw


@dataclass(frozen=True)
class DayResult:
    """What a run leaves behind: counts per feed, the tables, the verdicts."""

    counts: dict[str, dict[str, int]]
    tables: dict[str, DataFrame]
    verdicts: DataFrame


class LandingRejected(RuntimeError):
    """A landed file is no usable feed; nothing of this day was taken over."""


def land(spark: SparkSession, landing: str, base: str, feeds: dict[str, SourceMapping] = FEEDS, packed: bool = False) -> None:
    """A3/A2: accept or reject the landed files, then take them over unchanged, with their elements line by line.

    The verdicts on all files are written as a table below `landing_report`; an error only counts them. Nothing is
    taken over unless all files pass, and a file that lands after its report was written waits for the next run.
    `packed` payloads and lines are gzip files.
    """
    verdicts = landing_report(spark, landing).drop("payload")
    report = replace_rows(verdicts, f"{base}/landing_report")
    counts = report.filter(~F.col("accepted")).groupBy("reason").count().orderBy("reason").collect()  # a row per reason
    if counts:
        listed = ", ".join(f"{r.reason}: {r['count']}" for r in counts)
        table = current_path(spark, f"{base}/landing_report")
        raise LandingRejected(f"{sum(r['count'] for r in counts)} files rejected ({listed}); see {table}")
    known = report.select("path", "accepted")
    promote(landed_payloads(spark, landing).join(known, "path"), base, **({"packed": True} if packed else {}))
    for source, day in report.select("source", "ingestion_date").distinct().collect():  # feeds of one landing
        split_elements(spark, base, source, day, feeds[source].root if source in feeds else None, packed)


def conform_day(spark: SparkSession, base: str, mapping: SourceMapping, day: date) -> dict[str, int]:
    """L1-L3 for one feed and day: its elements are parsed once, row counts are taken while writing.

    Feeds that didn't come through the gate are split into lines first. The narrow projection is written as a layer of
    its own, which both outputs read.
    """
    if not path_exists(spark, day_path(f"{base}/elements", mapping.source, day)):
        split_elements(spark, base, mapping.source, day, mapping.root, packed=True)
    raw = read_elements(spark, base, mapping.source, day, mapping.schema)
    projected = conform(raw.drop("source", "ingestion_date"), mapping, day).base
    path = day_path(f"{base}/conformed", mapping.source, day)
    projected.write.mode("overwrite").parquet(path)
    made = Conformed.of(spark.read.schema(projected.schema).parquet(path))
    counts = {}
    for folder, rows in (("jobs", made.jobs), ("job_skills", made.skills)):
        seen = Observation(folder)
        write_day(rows.observe(seen, F.count(F.lit(1)).alias("n")), f"{base}/silver/{folder}", mapping.source, day)
        counts[folder] = seen.get["n"]
    return counts


def run_day(
    spark: SparkSession,
    base: str,
    day: date,
    landing: str | None = None,
    feeds: dict[str, SourceMapping] = FEEDS,
    schema: str | None = "marts",
    staging_schema: str | None = "staging",
    cluster_facts: bool = False,
) -> DayResult:
    """Land, conform each feed, load, stage, model, check; `day` is the only date but `loaded_at`.

    Every layer is written before the next one reads it, so a lost executor repeats at most one layer. Staging and
    marts are written aside and switched to, so a run that dies leaves yesterday's tables readable.
    Staging becomes views of `staging_schema`, marts become tables of `schema`; None leaves them out of the catalog.
    `cluster_facts` sorts the fact by date, for tables of hundreds of millions of rows.
    """
    if landing:
        land(spark, landing, base, feeds, packed=True)
    counts = {name: conform_day(spark, base, mapping, day) for name, mapping in feeds.items()}

    empty = {t: [(feeds[n].source, day) for n, c in counts.items() if not c[folder]] for t, (folder, _) in RAW_TABLES.items()}
    raw = load_raw(spark, base, empty)
    staged = {}
    for name, rows in (("stg_jobs", stage_postings(raw["raw_jobs"])), ("stg_job_skills", stage_skills(raw["raw_job_skills"]))):
        location = f"{base}/staging/{name}"
        staged[name] = (
            publish_staging(rows, staging_schema, name, location, f"{base}/catalog/staging")
            if staging_schema
            else replace_rows(rows, location)
        )
    marts = build_marts(spark, staged["stg_jobs"], staged["stg_job_skills"])
    if cluster_facts:
        marts["fact_job_posting"] = clustered(marts["fact_job_posting"], "date_key")
    written = {}
    for name, df in marts.items():
        location, rows = f"{base}/marts/{name}", enforced(df, MARTS[name], name)
        written[name] = (
            publish(rows, schema, name, location=location, schema_location=f"{base}/catalog/marts")
            if schema
            else replace_rows(rows, location)
        )
    tables = {**staged, **written}
    return DayResult(counts, tables, integrity_suite(tables))
