"""Three feed shapes made from the tables, conformed (L1-L3)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from starloom.functions.dates import utc_wall_clock
from starloom.functions.rules import SKILL_TERMS
from starloom.plans.conform import FLAT, NESTED, STRUCTS, Conformed, conform
from starloom.queries.registry import Tables, query

RUN_DATE = date(2026, 6, 1)

# Survivor of equal ids: the newest, then the least in column order.
_SURVIVOR = """PARTITION BY posting_id ORDER BY posted_at DESC NULLS LAST, title NULLS FIRST, company NULLS FIRST,
    location_raw NULLS FIRST, salary_min_usd NULLS FIRST, salary_max_usd NULLS FIRST, salary_avg_usd NULLS FIRST,
    is_remote NULLS FIRST, job_url NULLS FIRST"""

_JOBS = f"""
    SELECT posting_id, source, title, company, location_raw, salary_min_usd, salary_max_usd, salary_avg_usd,
           is_remote, job_url, posted_at, DATE '2026-06-01' AS ingestion_date
    FROM (SELECT *, row_number() OVER ({_SURVIVOR}) AS rn
          FROM (SELECT *, CASE WHEN salary_min_usd IS NOT NULL AND salary_max_usd IS NOT NULL
                               THEN (salary_min_usd + salary_max_usd) / 2.0
                               ELSE coalesce(salary_min_usd, salary_max_usd) END AS salary_avg_usd
                FROM (SELECT * REPLACE (CASE WHEN salary_min_usd > 0 THEN salary_min_usd END AS salary_min_usd,
                                        CASE WHEN salary_max_usd > 0 THEN salary_max_usd END AS salary_max_usd)
                      FROM feed WHERE title IS NOT NULL)))
    WHERE rn = 1"""

_SKILLS = """
    SELECT DISTINCT posting_id, source, DATE '2026-06-01' AS ingestion_date, lower(trim(raw)) AS skill
    FROM (SELECT posting_id, source, unnest(skills) AS raw FROM feed WHERE title IS NOT NULL)
    WHERE length(trim(raw)) > 0"""


def tagged_sql(text: str) -> str:
    terms = ", ".join(f"'{s}'" for s in SKILL_TERMS)
    return f"list_filter([{terms}], lambda w: contains(lower(coalesce({text}, '')), w))"


_FLAT_SQL = """
    WITH feed AS (
        SELECT CAST(l_partkey AS VARCHAR) AS posting_id, 'RemoteOK' AS source,
               CASE WHEN l_linenumber <> 7 THEN l_returnflag || ' line ' || l_linenumber END AS title,
               'Supplier ' || l_suppkey AS company, CASE WHEN l_linestatus = 'O' THEN 'Remote' ELSE 'Berlin' END AS location_raw,
               l_quantity - 25 AS salary_min_usd, CASE WHEN l_returnflag <> 'R' THEN l_quantity END AS salary_max_usd,
               true AS is_remote, 'https://flat.example/' || l_orderkey AS job_url,
               CASE WHEN l_linenumber <> 6 THEN l_shipdate END AS posted_at,
               CASE WHEN l_linenumber <> 5 THEN [' SQL ', l_returnflag, lower(l_returnflag), '  '] END AS skills
        FROM lineitem)"""


def flat_feed(t: Tables) -> Conformed:
    """Lines as a feed with flat fields and tags: padded texts, unknown pay, bad dates, missing tags, repeated ids."""
    line, flag = F.col("l_linenumber"), F.col("l_returnflag")
    quantity = F.col("l_quantity").cast("int")
    raw = t.lineitem.select(
        F.col("l_partkey").cast("string").alias("id"),
        F.when(line != 7, F.concat(F.lit(" "), flag, F.lit(" line "), line, F.lit(" "))).alias("position"),
        F.concat(F.lit(" Supplier "), F.col("l_suppkey")).alias("company"),
        F.when(F.col("l_linestatus") != "O", F.lit(" Berlin ")).alias("location"),
        (quantity - 25).cast("string").alias("salary_min"),
        F.when(flag != "R", quantity.cast("string")).alias("salary_max"),
        F.when(line == 6, F.lit("soon"))
        .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'+00:00'"))
        .alias("date"),
        F.concat(F.lit("https://flat.example/"), F.col("l_orderkey")).alias("url"),
        F.when(line != 5, F.array(F.lit(" SQL "), flag, F.lower(flag), F.lit("  "))).alias("tags"),
    )
    return conform(raw, FLAT, RUN_DATE)


_STRUCT_SQL = f"""
    WITH feed AS (
        SELECT 'adzuna-' || CASE WHEN lang <> 'es' THEN n_chars END AS posting_id, 'Adzuna' AS source,
               CASE WHEN source <> 'src3' THEN lang || ' writer' END AS title, source AS company, upper(lang) AS location_raw,
               CAST(n_chars - 300 AS DOUBLE) AS salary_min_usd, CASE WHEN lang <> 'de' THEN CAST(n_chars AS DOUBLE) END AS salary_max_usd,
               contains(lower(lang || ' writer ' || lang || ' ' || text), 'remote') AS is_remote, 'https://s.example/' || doc_id AS job_url,
               CASE WHEN lang <> 'fr' THEN TIMESTAMP '2026-05-01 08:30:00' + to_days(CAST(doc_id % 28 AS INTEGER)) END AS posted_at,
               {tagged_sql("text")} AS skills
        FROM documents)"""


def struct_feed(t: Tables) -> Conformed:
    """Documents as a feed with nested names and free text: null ids and titles, dates with and without zone."""
    lang, doc = F.col("lang"), F.col("doc_id")
    created = F.date_format(
        F.timestamp_add("DAY", (doc % 28).cast("int"), F.lit("2026-05-01 08:30:00").cast("timestamp_ntz")),
        "yyyy-MM-dd'T'HH:mm:ss",
    )
    raw = t.documents.select(
        F.when(lang != "es", F.col("n_chars").cast("string")).alias("id"),
        F.when(F.col("source") != "src3", F.concat(lang, F.lit(" writer"))).alias("title"),
        F.struct(F.concat(F.lit(" "), F.col("source")).alias("display_name")).alias("company"),
        F.struct(F.concat(F.upper(lang), F.lit(" ")).alias("display_name")).alias("location"),
        (F.col("n_chars") - 300).cast("string").alias("salary_min"),
        F.when(lang == "de", F.lit("unknown")).otherwise(F.col("n_chars").cast("string")).alias("salary_max"),
        F.when(lang == "fr", F.lit("yesterday"))
        .when(lang == "en", F.concat(created, F.lit("Z")))
        .otherwise(created)
        .alias("created"),
        F.concat(F.lit("https://s.example/"), doc).alias("redirect_url"),
        F.col("text").alias("description"),
    )
    return conform(raw, STRUCTS, RUN_DATE)


_NESTED_SQL = """
    WITH feed AS (
        SELECT 'usajobs-' || o_custkey AS posting_id, 'USAJobs' AS source,
               nullif(o_orderpriority, '5-LOW') AS title, 'Office ' || o_orderstatus AS company,
               CASE WHEN o_orderpriority = '2-HIGH' THEN 'Telework' ELSE 'Boise' END AS location_raw,
               CASE WHEN o_orderstatus = 'F' AND o_orderpriority <> '1-URGENT' THEN o_totalprice END AS salary_min_usd,
               CASE WHEN o_orderstatus = 'F' THEN o_totalprice + 1 END AS salary_max_usd,
               o_orderpriority = '2-HIGH' OR o_orderstatus = 'O' AS is_remote, 'https://n.example/' || o_orderkey AS job_url,
               o_orderdate AS posted_at,
               CASE o_orderstatus WHEN 'O' THEN ['java', 'javascript', 'sql'] WHEN 'F' THEN ['c++', 'power bi'] ELSE [] END AS skills
        FROM orders)"""


def nested_feed(t: Tables) -> Conformed:
    """Orders as a deeply nested feed with a pay array: empty arrays, other pay codes, text for numbers."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    pay = F.struct(
        F.when(priority == "1-URGENT", F.lit("negotiable"))
        .otherwise(F.col("o_totalprice").cast("string"))
        .alias("MinimumRange"),
        (F.col("o_totalprice") + 1).cast("string").alias("MaximumRange"),
        F.when(status == "F", F.lit("PA")).otherwise(F.lit("PH")).alias("RateIntervalCode"),
    )
    raw = t.orders.select(
        F.col("o_custkey").cast("string").alias("MatchedObjectId"),
        F.struct(
            F.nullif(priority, F.lit("5-LOW")).alias("PositionTitle"),
            F.concat(F.lit("Office "), status, F.lit(" ")).alias("OrganizationName"),
            F.when(priority == "2-HIGH", F.lit("Telework")).otherwise(F.lit("Boise")).alias("PositionLocationDisplay"),
            F.filter(F.array(pay), lambda p: status != "P").alias("PositionRemuneration"),
            F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'0'").alias("PublicationStartDate"),
            F.concat(F.lit("https://n.example/"), F.col("o_orderkey")).alias("PositionURI"),
            F.when(status == "O", F.lit("JavaScript and SQL, remote"))
            .when(status == "F", F.lit("C++ or Power BI"))
            .alias("QualificationSummary"),
        ).alias("MatchedObjectDescriptor"),
    )
    return conform(raw, NESTED, RUN_DATE)


def _in_utc(jobs: DataFrame) -> DataFrame:
    """SQL here has the moments of the feeds as zone-free times in UTC."""
    return jobs.withColumn("posted_at", utc_wall_clock("posted_at"))


@query(_FLAT_SQL + _JOBS)
def conform_flat_jobs(t: Tables) -> DataFrame:
    """L1, B5, B7, G6, H3, H4."""
    return _in_utc(flat_feed(t).jobs)


@query(_FLAT_SQL + _SKILLS)
def conform_flat_skills(t: Tables) -> DataFrame:
    """L1, G7."""
    return flat_feed(t).skills


@query(_STRUCT_SQL + _JOBS)
def conform_struct_jobs(t: Tables) -> DataFrame:
    """L2, B2, B6, H3, H5."""
    return _in_utc(struct_feed(t).jobs)


@query(_STRUCT_SQL + _SKILLS)
def conform_struct_skills(t: Tables) -> DataFrame:
    """L2, H6 with the full vocabulary over whole texts."""
    return struct_feed(t).skills


@query(_NESTED_SQL + _JOBS)
def conform_nested_jobs(t: Tables) -> DataFrame:
    """L3, B8, B9."""
    return _in_utc(nested_feed(t).jobs)


@query(_NESTED_SQL + _SKILLS)
def conform_nested_skills(t: Tables) -> DataFrame:
    """L3, H6."""
    return nested_feed(t).skills
