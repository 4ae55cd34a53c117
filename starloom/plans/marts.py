"""Staging, dimensions and facts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import TimestampType

from starloom.functions.dates import date_key, utc_wall_clock
from starloom.functions.keys import hash_key, member
from starloom.functions.rules import (
    EMPLOYMENT_DEFAULT,
    EMPLOYMENT_TYPES,
    ROLE_FAMILIES,
    ROLE_FAMILY_DEFAULT,
    SENIORITY_DEFAULT,
    SENIORITY_LEVELS,
    SKILL_CATEGORIES,
    SKILL_CATEGORY_DEFAULT,
    classify_by_keyword,
    classify_by_value,
)
from starloom.operators.dedupe import distinct_pairs, latest_per_key
from starloom.operators.spine import calendar
from starloom.schemas import MONEY

# The span of the stored calendar.
CALENDAR_FROM, CALENDAR_TO = date(2020, 1, 1), date(2030, 12, 31)


def stage_postings(raw: DataFrame) -> DataFrame:
    """Typed and trimmed, the newest snapshot per posting; rows without an id are dropped.

    Postings that come twice in one snapshot are settled by the newest `posted_at`, then by column order.
    `posted_at` becomes the time in UTC, whatever the session's zone; one without a zone stays as it is.
    """
    zoned = isinstance(raw.schema["posted_at"].dataType, TimestampType)
    latest = latest_per_key(
        raw.filter(F.col("posting_id").isNotNull()),
        ["posting_id"],
        "ingestion_date",
        F.desc_nulls_last("posted_at"),
    )
    return latest.select(
        "posting_id",
        "source",
        *[F.trim(c).alias(c) for c in ("title", "company", "location_raw")],
        *[F.col(f"salary_{m}_usd").try_cast(MONEY).alias(f"salary_{m}_usd") for m in ("min", "max", "avg")],
        "is_remote",
        "job_url",
        (utc_wall_clock("posted_at") if zoned else F.col("posted_at").cast("timestamp_ntz")).alias("posted_at"),
        F.to_date("ingestion_date").alias("ingestion_date"),
    )


def stage_skills(raw: DataFrame) -> DataFrame:
    """Distinct cleaned pairs."""
    return distinct_pairs(
        raw.filter(F.col("posting_id").isNotNull() & (F.length(F.trim("skill")) > 0)),
        F.col("posting_id"),
        F.lower(F.trim("skill")).alias("skill"),
    )


def _members(staged: DataFrame, value: Column, key: str, name: str, *attributes: Column) -> DataFrame:
    """One row per natural value with its hash as the key."""
    return distinct_pairs(staged, value.alias(name)).select(
        hash_key(name).alias(key), name, *attributes
    )


def dim_source(postings: DataFrame) -> DataFrame:
    """L7."""
    known = postings.filter(F.col("source").isNotNull())
    return _members(known, F.col("source"), "source_key", "source_name", F.lit("api").alias("source_type"))


def dim_company(postings: DataFrame) -> DataFrame:
    """No feed gives the attributes yet; they are typed nulls."""
    return _members(
        postings,
        member("company"),
        "company_key",
        "company_name",
        F.lit(None).cast("string").alias("industry"),
        F.lit(None).cast("string").alias("company_size"),
        F.lit(None).cast("boolean").alias("is_startup"),
    )


def dim_location(postings: DataFrame) -> DataFrame:
    """The flag is constant here; the real one is on the fact."""
    return _members(
        postings, member("location_raw"), "location_key", "location_name", F.lit(True).alias("is_remote")
    )


def dim_skill(skills: DataFrame) -> DataFrame:
    """L8."""
    return _members(
        skills.filter(F.col("skill").isNotNull()),
        F.col("skill"),
        "skill_key",
        "skill_name",
        classify_by_value("skill_name", SKILL_CATEGORIES, SKILL_CATEGORY_DEFAULT).alias("skill_category"),
    )


def dim_role(postings: DataFrame) -> DataFrame:
    """Attributes are read from the title."""
    return _members(
        postings.filter(F.col("title").isNotNull()),
        F.col("title"),
        "role_key",
        "role_title",
        classify_by_keyword("role_title", ROLE_FAMILIES, ROLE_FAMILY_DEFAULT).alias("role_family"),
        classify_by_keyword("role_title", SENIORITY_LEVELS, SENIORITY_DEFAULT).alias("seniority_level"),
        classify_by_keyword("role_title", EMPLOYMENT_TYPES, EMPLOYMENT_DEFAULT).alias("employment_type"),
    )


def dim_date(spark: SparkSession, start: date = CALENDAR_FROM, end: date = CALENDAR_TO) -> DataFrame:
    """L9."""
    return calendar(spark, start, end)


def fact_job_posting(postings: DataFrame) -> DataFrame:
    """Keys are hashed from the same values as in the dimensions, so there is no join and no shuffle."""
    return postings.select(
        hash_key("posting_id").alias("job_posting_key"),
        "posting_id",
        hash_key(member("company")).alias("company_key"),
        hash_key(member("location_raw")).alias("location_key"),
        hash_key("source").alias("source_key"),
        hash_key("title").alias("role_key"),
        date_key("posted_at").alias("date_key"),
        "salary_min_usd",
        "salary_max_usd",
        "salary_avg_usd",
        "is_remote",
        "job_url",
        "posted_at",
    )


def fact_job_skill(skills: DataFrame) -> DataFrame:
    """L11/C1."""
    return skills.select(
        hash_key("posting_id").alias("job_posting_key"),
        hash_key("skill").alias("skill_key"),
        "posting_id",
        "skill",
    )


def build_marts(
    spark: SparkSession, postings: DataFrame, skills: DataFrame, loaded_at: Column | None = None
) -> dict[str, DataFrame]:
    """All dimensions and facts of a staged set.

    The posting fact has the moment of the load in UTC, by default that at which its job starts.
    """
    moment = utc_wall_clock(F.current_timestamp()) if loaded_at is None else loaded_at
    return {
        "dim_source": dim_source(postings),
        "dim_company": dim_company(postings),
        "dim_location": dim_location(postings),
        "dim_skill": dim_skill(skills),
        "dim_role": dim_role(postings),
        "dim_date": dim_date(spark),
        "fact_job_posting": fact_job_posting(postings).withColumn("loaded_at", moment.cast("timestamp_ntz")),
        "fact_job_skill": fact_job_skill(skills),
    }
