"""A posting history read out of `lineitem`, for the queries on staging and marts.

Every line is a snapshot of the posting of its order: orders have up to several lines, so postings repeat
over days and within a day. The same shape as SQL stands next to it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starloom.queries.registry import Tables

TITLES = [
    "Senior Data Engineer",
    "Machine Learning Intern",
    "Lead Analytics Developer",
    "Contract Platform Engineer",
    "Junior Software Engineer",
    "Product Owner (part time)",
]
TITLE_DEFAULT = "Clerk"
SKILLS = [" Python ", "SQL", "aws", "Spark", "Postgres", "   "]
SKILL_DEFAULT = "Excel"


def by_line(values: list[str], default: str):
    chain = F
    for i, v in enumerate(values, start=1):
        chain = chain.when(F.col("l_linenumber") == i, F.lit(v))
    return chain.otherwise(F.lit(default))


def by_line_sql(values: list[str], default: str) -> str:
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values, start=1))
    return f"CASE l_linenumber {arms} ELSE '{default}' END"


def raw_jobs(t: Tables) -> DataFrame:
    low, high = F.col("l_extendedprice"), F.col("l_extendedprice") + F.col("l_quantity")
    return t.lineitem.select(
        F.concat(F.lit("li-"), F.col("l_orderkey")).alias("posting_id"),
        F.nullif(F.col("l_returnflag"), F.lit("-")).alias("source"),
        F.concat(F.lit("  "), by_line(TITLES, TITLE_DEFAULT), F.lit(" ")).alias("title"),
        F.when(F.col("l_suppkey") != 7, F.concat(F.lit("Supplier "), F.col("l_suppkey"))).alias("company"),
        F.nullif(F.col("l_linestatus"), F.lit("O")).alias("location_raw"),
        low.alias("salary_min_usd"),
        high.alias("salary_max_usd"),
        ((low + high) / 2).alias("salary_avg_usd"),
        (F.col("l_linestatus") == "F").alias("is_remote"),
        F.concat(F.lit("https://jobs.example/"), F.col("l_partkey")).alias("job_url"),
        F.col("l_shipdate").alias("posted_at"),
        F.to_date("l_shipdate").alias("ingestion_date"),
    )


RAW_JOBS_SQL = f"""
    raw_jobs AS (
        SELECT 'li-' || l_orderkey AS posting_id, nullif(l_returnflag, '-') AS source,
               '  ' || {by_line_sql(TITLES, TITLE_DEFAULT)} || ' ' AS title,
               CASE WHEN l_suppkey <> 7 THEN 'Supplier ' || l_suppkey END AS company,
               nullif(l_linestatus, 'O') AS location_raw,
               l_extendedprice AS salary_min_usd, l_extendedprice + l_quantity AS salary_max_usd,
               (l_extendedprice + (l_extendedprice + l_quantity)) / 2 AS salary_avg_usd,
               l_linestatus = 'F' AS is_remote, 'https://jobs.example/' || l_partkey AS job_url,
               l_shipdate AS posted_at, CAST(l_shipdate AS DATE) AS ingestion_date
        FROM lineitem)"""

STAGED_SQL = f"""{RAW_JOBS_SQL},
    stg_jobs AS (
        SELECT posting_id, source, trim(title) AS title, trim(company) AS company, trim(location_raw) AS location_raw,
               CAST(salary_min_usd AS DECIMAL(12, 2)) AS salary_min_usd,
               CAST(salary_max_usd AS DECIMAL(12, 2)) AS salary_max_usd,
               CAST(salary_avg_usd AS DECIMAL(12, 2)) AS salary_avg_usd,
               is_remote, job_url, posted_at, ingestion_date
        FROM (SELECT *, row_number() OVER (PARTITION BY posting_id ORDER BY ingestion_date DESC NULLS FIRST,
                     posted_at DESC NULLS LAST, source NULLS FIRST, title NULLS FIRST, company NULLS FIRST,
                     location_raw NULLS FIRST, salary_min_usd NULLS FIRST, salary_max_usd NULLS FIRST,
                     salary_avg_usd NULLS FIRST, is_remote NULLS FIRST, job_url NULLS FIRST) AS rn
              FROM raw_jobs WHERE posting_id IS NOT NULL)
        WHERE rn = 1)"""


def raw_skills(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.concat(F.lit("li-"), F.col("l_orderkey")).alias("posting_id"),
        by_line(SKILLS, SKILL_DEFAULT).alias("skill"),
    )


STAGED_SKILLS_SQL = f"""
    stg_job_skills AS (
        SELECT DISTINCT posting_id, lower(trim(skill)) AS skill
        FROM (SELECT 'li-' || l_orderkey AS posting_id, {by_line_sql(SKILLS, SKILL_DEFAULT)} AS skill FROM lineitem)
        WHERE length(trim(skill)) > 0)"""
