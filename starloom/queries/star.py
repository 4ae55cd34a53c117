"""Staging, dimensions, facts and queries on the star."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starloom.operators.spine import calendar_spanning
from starloom.plans import marts
from starloom.plans.star import Path, star_join, star_rollup
from starloom.plans.suite import integrity_suite
from starloom.queries.labels import ROLES, SKILLS
from starloom.queries.postings import STAGED_SKILLS_SQL, STAGED_SQL, raw_jobs, raw_skills
from starloom.queries.registry import Tables, query
from starloom.session import scratch_path
from starloom.sources.versions import replace_rows

ROLE_SQL = f"""
    dim_role AS (
        SELECT md5(title) AS role_key, title AS role_title, role_family, seniority_level, employment_type
        FROM (SELECT DISTINCT title FROM stg_jobs WHERE title IS NOT NULL) LEFT JOIN {ROLES} ON role = title)"""

FACT_SQL = """
    fact_job_posting AS (
        SELECT md5(posting_id) AS job_posting_key, posting_id, md5(coalesce(company, 'Unknown')) AS company_key,
               md5(coalesce(location_raw, 'Unknown')) AS location_key, md5(source) AS source_key,
               md5(title) AS role_key, CAST(strftime(posted_at, '%Y%m%d') AS INTEGER) AS date_key,
               salary_min_usd, salary_max_usd, salary_avg_usd, is_remote, job_url, posted_at
        FROM stg_jobs)"""

CALENDAR_SQL = """
        SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date, CAST(year(d) AS INTEGER) AS year,
               CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month, strftime(d, '%b') AS month_name,
               CAST(weekofyear(d) AS INTEGER) AS week_of_year, CAST({dow} AS INTEGER) AS day_of_week,
               strftime(d, '%a') AS day_name, dayofweek(d) IN (0, 6) AS is_weekend
        FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d
              FROM (SELECT CAST(min({moment}) AS DATE) AS lo, CAST(max({moment}) AS DATE) AS hi FROM {table}))"""


def staged(t: Tables) -> DataFrame:
    return marts.stage_postings(raw_jobs(t))


def staged_skills(t: Tables) -> DataFrame:
    return marts.stage_skills(raw_skills(t))


def stored(t: Tables, rows: DataFrame) -> DataFrame:
    """Staging written once, as in a daily run, where several parts of one query read it."""
    return replace_rows(rows, scratch_path(t.spark, "staging"))


@query(
    f"""
    WITH {STAGED_SQL}, {ROLE_SQL}, {FACT_SQL},
    dim_date AS ({CALENDAR_SQL.format(dow="dayofweek(d)", moment="posted_at", table="stg_jobs")}),
    dim_location AS (SELECT DISTINCT md5(coalesce(location_raw, 'Unknown')) AS location_key,
                            coalesce(location_raw, 'Unknown') AS location_name FROM stg_jobs)
    SELECT d.year, r.role_family, r.seniority_level, l.location_name,
           CAST(count(*) AS BIGINT) AS postings, CAST(sum(f.salary_avg_usd) AS DOUBLE) AS salary_total,
           CAST(sum(f.salary_avg_usd) AS DOUBLE) / count(f.salary_avg_usd) AS salary_mean
    FROM fact_job_posting f
    LEFT JOIN dim_date d USING (date_key) LEFT JOIN dim_role r USING (role_key)
    LEFT JOIN dim_location l USING (location_key)
    GROUP BY ALL
    """
)
def star_year_segment(t: Tables) -> DataFrame:
    """Flagship: stage the newest snapshots, build keys, roll the fact up by year, role and place.

    Covers C1, C2, D1, E1, H8, H10, L5, L7-L10.
    """
    postings = stored(t, staged(t))
    fact = marts.fact_job_posting(postings)
    rolled = star_rollup(
        fact,
        [
            Path("date_key", calendar_spanning(t.lineitem, "l_shipdate"), {"year": "year"}),
            Path(
                "role_key",
                marts.dim_role(postings),
                {"role_family": "role_family", "seniority_level": "seniority_level"},
            ),
            Path("location_key", marts.dim_location(postings), {"location_name": "location_name"}),
        ],
        {
            "postings": F.lit(1),
            "_salary": F.col("salary_avg_usd"),
            "_paid": F.col("salary_avg_usd").isNotNull().cast("int"),
        },
    )
    total = F.col("_salary").cast("double")
    return rolled.select(
        "year",
        "role_family",
        "seniority_level",
        "location_name",
        "postings",
        total.alias("salary_total"),
        (total / F.col("_paid")).alias("salary_mean"),
    )


@query(f"WITH {STAGED_SQL} SELECT * FROM stg_jobs")
def latest_snapshot(t: Tables) -> DataFrame:
    """E1, L5."""
    return staged(t)


@query(f"WITH {STAGED_SKILLS_SQL} SELECT * FROM stg_job_skills")
def staged_skill_pairs(t: Tables) -> DataFrame:
    """G5, L6."""
    return staged_skills(t)


@query(
    f"""
    WITH {STAGED_SQL}
    SELECT md5(company_name) AS company_key, company_name, CAST(NULL AS VARCHAR) AS industry,
           CAST(NULL AS VARCHAR) AS company_size, CAST(NULL AS BOOLEAN) AS is_startup
    FROM (SELECT DISTINCT coalesce(company, 'Unknown') AS company_name FROM stg_jobs)
    """
)
def dim_company(t: Tables) -> DataFrame:
    """B15, D1, L7."""
    return marts.dim_company(staged(t))


@query(
    f"""
    WITH {STAGED_SQL}
    SELECT md5(location_name) AS location_key, location_name, true AS is_remote
    FROM (SELECT DISTINCT coalesce(location_raw, 'Unknown') AS location_name FROM stg_jobs)
    """
)
def dim_location(t: Tables) -> DataFrame:
    """L7."""
    return marts.dim_location(staged(t))


@query(
    f"""
    WITH {STAGED_SQL}
    SELECT md5(source_name) AS source_key, source_name, 'api' AS source_type
    FROM (SELECT DISTINCT source AS source_name FROM stg_jobs WHERE source IS NOT NULL)
    """
)
def dim_source(t: Tables) -> DataFrame:
    """L7."""
    return marts.dim_source(staged(t))


@query(f"WITH {STAGED_SQL}, {ROLE_SQL} SELECT * FROM dim_role")
def dim_role(t: Tables) -> DataFrame:
    """B17, L8."""
    return marts.dim_role(staged(t))


@query(
    f"""
    WITH {STAGED_SKILLS_SQL}
    SELECT md5(skill) AS skill_key, skill AS skill_name, skill_category
    FROM (SELECT DISTINCT skill FROM stg_job_skills) LEFT JOIN {SKILLS} USING (skill)
    """
)
def dim_skill(t: Tables) -> DataFrame:
    """L8."""
    return marts.dim_skill(staged_skills(t))


@query(f"WITH {STAGED_SQL}, {FACT_SQL} SELECT * FROM fact_job_posting")
def fact_posting(t: Tables) -> DataFrame:
    """C1, H8, H10, L10."""
    return marts.fact_job_posting(staged(t))


@query(
    f"""
    WITH {STAGED_SKILLS_SQL}
    SELECT md5(posting_id) AS job_posting_key, md5(skill) AS skill_key, posting_id, skill FROM stg_job_skills
    """
)
def fact_skill(t: Tables) -> DataFrame:
    """C1, L11."""
    return marts.fact_job_skill(staged_skills(t))


@query(
    f"""
    WITH {STAGED_SQL}, {STAGED_SKILLS_SQL}
    SELECT s.skill, j.source, CAST(count(*) AS BIGINT) AS postings,
           CAST(sum(j.salary_max_usd) AS DOUBLE) AS salary_total
    FROM stg_job_skills s JOIN stg_jobs j USING (posting_id) GROUP BY ALL
    """
)
def star_skill_demand(t: Tables) -> DataFrame:
    """C2 over the bridge: postings and pay by skill and source, through the hashed keys."""
    postings, skills = stored(t, staged(t)), stored(t, staged_skills(t))
    bridge = marts.fact_job_skill(skills).select("job_posting_key", "skill_key")
    fact = marts.fact_job_posting(postings).select("job_posting_key", "source_key", "salary_max_usd")
    return star_rollup(
        bridge.join(fact, "job_posting_key"),
        [
            Path("skill_key", marts.dim_skill(skills), {"skill": "skill_name"}),
            Path("source_key", marts.dim_source(postings), {"source": "source_name"}),
        ],
        {"postings": F.lit(1), "salary_total": F.col("salary_max_usd")},
    ).withColumn("salary_total", F.col("salary_total").cast("double"))


@query(
    """
    SELECT o.o_orderkey, c.c_name AS customer, n.n_name AS nation, o.o_totalprice
    FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
    """
)
def star_rows(t: Tables) -> DataFrame:
    """Row-level star join over two steps."""
    return star_join(
        t.orders,
        [
            Path("o_custkey", t.customer, {"customer": "c_name", "n_key": "c_nationkey"}, "c_custkey"),
            Path("n_key", t.nation, {"nation": "n_name"}, "n_nationkey"),
        ],
    ).select("o_orderkey", "customer", "nation", "o_totalprice")


@query(
    f"""
    WITH dim_date AS ({CALENDAR_SQL.format(dow="dayofweek(d)", moment="o_orderdate", table="orders")})
    SELECT dim_date.*, CAST(coalesce(n, 0) AS BIGINT) AS orders
    FROM dim_date LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS full_date, count(*) AS n FROM orders GROUP BY 1) USING (full_date)
    """
)
def calendar_dim(t: Tables) -> DataFrame:
    """The calendar over the span of the orders, with the orders of each day (also none)."""
    return _calendar_with_orders(t, iso=False)


@query(
    f"""
    WITH dim_date AS ({CALENDAR_SQL.format(dow="isodow(d)", moment="o_orderdate", table="orders")})
    SELECT dim_date.*, CAST(coalesce(n, 0) AS BIGINT) AS orders
    FROM dim_date LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS full_date, count(*) AS n FROM orders GROUP BY 1) USING (full_date)
    """
)
def calendar_dim_iso(t: Tables) -> DataFrame:
    """F6, H7, L9 with days of the week 1 = Monday .. 7 = Sunday."""
    return _calendar_with_orders(t, iso=True)


def _calendar_with_orders(t: Tables, iso: bool) -> DataFrame:
    per_day = t.orders.groupBy(F.to_date("o_orderdate").alias("full_date")).agg(F.count(F.lit(1)).alias("n"))
    return (
        calendar_spanning(t.orders, "o_orderdate", iso)
        .join(per_day, "full_date", "left")
        .withColumn("orders", F.coalesce("n", F.lit(0)).cast("bigint"))
        .drop("n")
    )


SUITE_PASSES = [
    "not_null stg_jobs.posting_id",
    "unique stg_jobs.posting_id",
    "not_null stg_job_skills.posting_id",
    "not_null stg_job_skills.skill",
    *[
        f"{kind} {table}.{key}"
        for table, key in {
            "dim_source": "source_key",
            "dim_company": "company_key",
            "dim_location": "location_key",
            "dim_skill": "skill_key",
            "dim_role": "role_key",
            "dim_date": "date_key",
            "fact_job_posting": "job_posting_key",
        }.items()
        for kind in ("not_null", "unique")
    ],
    *[
        f"relationships fact_job_posting.{k} -> {p}.{k}"
        for k, p in [
            ("company_key", "dim_company"),
            ("location_key", "dim_location"),
            ("source_key", "dim_source"),
            ("role_key", "dim_role"),
        ]
    ],
    "relationships fact_job_skill.skill_key -> dim_skill.skill_key",
    *[
        f"columns {t}"
        for t in (
            "dim_source dim_company dim_location dim_skill dim_role dim_date fact_job_posting fact_job_skill"
        ).split()
    ],
]


@query(
    f"""
    WITH {STAGED_SQL}, {STAGED_SKILLS_SQL}, counted AS (
        SELECT unnest({SUITE_PASSES}) AS "check", 0 AS failures
        UNION ALL
        SELECT 'relationships fact_job_posting.date_key -> dim_date.date_key',
               count(*) FILTER (year(posted_at) NOT BETWEEN 2020 AND 2030) FROM stg_jobs
        UNION ALL
        SELECT 'relationships fact_job_skill.job_posting_key -> fact_job_posting.job_posting_key', count(*)
        FROM stg_job_skills WHERE posting_id NOT IN (SELECT posting_id FROM stg_jobs))
    SELECT "check", CAST(failures AS BIGINT) AS failures, CASE WHEN failures <> 0 THEN 'error' ELSE 'pass' END AS status
    FROM counted
    """
)
def integrity_suite_verdicts(t: Tables) -> DataFrame:
    """All declared keys of the star, one verdict each.

    Postings older than the stored calendar are orphans of `dim_date`, and are reported as such. Staging is
    written first, as in a daily run, since every mart reads it; each mart is read once, so it is not.
    """
    postings, skills = stored(t, staged(t)), stored(t, staged_skills(t))
    return integrity_suite(
        {"stg_jobs": postings, "stg_job_skills": skills, **marts.build_marts(t.spark, postings, skills)}
    )
