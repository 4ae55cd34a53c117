"""Three feeds of different shape into one posting record and one posting-skill bridge (L1-L3).

A feed is a `SourceMapping`: its schema and the expressions that name its fields. What follows is the
same for all feeds and written once: pay rules, remote flag, one row per posting, skill pairs. A new
feed is a new mapping.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import date
from functools import partial

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from starloom.functions.dates import utc_timestamp
from starloom.functions.keys import namespaced
from starloom.functions.numeric import midpoint, positive
from starloom.functions.rules import REMOTE_OR_TELEWORK_WORDS, REMOTE_WORDS, SKILL_TERMS, tag_terms
from starloom.functions.text import mentions
from starloom.operators.dedupe import deduplicate
from starloom.schemas import FLAT_FEED, NESTED_FEED, STRUCT_FEED

JOB_COLUMNS = [
    "posting_id",
    "source",
    "title",
    "company",
    "location_raw",
    "salary_min_usd",
    "salary_max_usd",
    "salary_avg_usd",
    "is_remote",
    "job_url",
    "posted_at",
    "ingestion_date",
]


@dataclass(frozen=True)
class SourceMapping:
    """How one feed names its fields.

    `fields` gives columns over the raw frame: posting_id, title, company, location_raw, pay_low, pay_high,
    posted_at, job_url, is_remote, skills (array of text). `root` is a field without which the feed is
    not the expected one.
    """

    source: str
    schema: StructType
    fields: Callable[[], dict[str, Column]]
    root: str | None = None


@dataclass(frozen=True)
class Conformed:
    """`base` is the narrow projection that both results are made of, for the caller to write."""

    base: DataFrame
    jobs: DataFrame
    skills: DataFrame

    @staticmethod
    def of(base: DataFrame) -> Conformed:
        return Conformed(base, _one_row_per_posting(base), _skill_pairs(base))


def _flat_fields() -> dict[str, Column]:
    title = F.trim("position")
    return {
        "posting_id": F.col("id"),
        "title": title,
        "company": F.trim("company"),
        "location_raw": F.coalesce(F.trim("location"), F.lit("Remote")),
        "pay_low": F.col("salary_min").try_cast("double"),
        "pay_high": F.col("salary_max").try_cast("double"),
        "posted_at": utc_timestamp("date"),
        "job_url": F.col("url"),
        "is_remote": F.lit(True),
        "skills": F.col("tags"),
    }


def _struct_fields(terms: list[str] = SKILL_TERMS, whole_word: bool = False) -> dict[str, Column]:
    title, location = F.trim("title"), F.trim("location.display_name")
    return {
        "posting_id": namespaced("adzuna-", "id"),
        "title": title,
        "company": F.trim("company.display_name"),
        "location_raw": location,
        "pay_low": F.col("salary_min").try_cast("double"),
        "pay_high": F.col("salary_max").try_cast("double"),
        "posted_at": utc_timestamp("created", "yyyy-MM-dd'T'HH:mm:ss"),
        "job_url": F.col("redirect_url"),
        "is_remote": mentions([title, location, "description"], REMOTE_WORDS),
        "skills": tag_terms("description", terms, whole_word),
    }


def _nested_fields(terms: list[str] = SKILL_TERMS, whole_word: bool = False) -> dict[str, Column]:
    def inner(name: str) -> Column:
        return F.col(f"MatchedObjectDescriptor.{name}")

    pay = F.get(inner("PositionRemuneration"), F.lit(0))
    yearly = pay["RateIntervalCode"] == "PA"
    title, location = F.trim(inner("PositionTitle")), F.trim(inner("PositionLocationDisplay"))
    return {
        "posting_id": namespaced("usajobs-", "MatchedObjectId"),
        "title": title,
        "company": F.trim(inner("OrganizationName")),
        "location_raw": location,
        "pay_low": F.when(yearly, pay["MinimumRange"].try_cast("double")),
        "pay_high": F.when(yearly, pay["MaximumRange"].try_cast("double")),
        "posted_at": utc_timestamp(inner("PublicationStartDate")),
        "job_url": inner("PositionURI"),
        "is_remote": mentions([title, location, inner("QualificationSummary")], REMOTE_OR_TELEWORK_WORDS),
        "skills": tag_terms(inner("QualificationSummary"), terms, whole_word),
    }


# Names and key prefixes of the feeds are part of the stored rows.
FLAT = SourceMapping("RemoteOK", FLAT_FEED, _flat_fields)
STRUCTS = SourceMapping("Adzuna", STRUCT_FEED, _struct_fields)
NESTED = SourceMapping("USAJobs", NESTED_FEED, _nested_fields, root="MatchedObjectDescriptor")
FEEDS = {m.source: m for m in (FLAT, STRUCTS, NESTED)}


def by_whole_words(mapping: SourceMapping) -> SourceMapping:
    """H6: a feed whose skills are read from its text, now as whole words."""
    return replace(mapping, fields=partial(mapping.fields, whole_word=True))


def conform(raw: DataFrame, mapping: SourceMapping, run_date: date | Column) -> Conformed:
    """L1-L3: the postings and skill pairs of one feed.

    The mapping gives typed columns (B7), first array elements and values kept on a condition (B8, B9);
    source and day are constants (B4), and the final projection drops what only the rules needed (B10).
    Rows without a title are no postings (B5). Whatever a row mentions is reduced to flags and a short
    array here, so bodies of text leave the plan at the scan.
    """
    day = F.lit(run_date) if isinstance(run_date, date) else run_date
    fields = mapping.fields()
    base = (
        raw.select(*[c.alias(n) for n, c in fields.items()], day.cast("date").alias("ingestion_date"))
        .filter(F.col("title").isNotNull())
        .withColumns({"salary_min_usd": positive("pay_low"), "salary_max_usd": positive("pay_high")})
        .withColumns(
            {
                "salary_avg_usd": midpoint("salary_min_usd", "salary_max_usd"),
                "source": F.lit(mapping.source),
            }
        )
        .select(*JOB_COLUMNS, "skills")
    )
    return Conformed.of(base)


def _one_row_per_posting(base: DataFrame) -> DataFrame:
    """G6 with a stable survivor: the newest, then the least in column order."""
    return deduplicate(base.select(*JOB_COLUMNS), ["posting_id"], [F.desc_nulls_last("posted_at")])


def _skill_pairs(base: DataFrame) -> DataFrame:
    """One row per posting and skill, lower-cased and trimmed, blanks dropped.

    The outer form of explode, whose nulls the filter drops: for the inner form Spark tests the array for
    emptiness first, which tags every text a second time.
    """
    return (
        base.select("posting_id", "source", "ingestion_date", F.explode_outer("skills").alias("_raw"))
        .select("posting_id", "source", "ingestion_date", F.lower(F.trim("_raw")).alias("skill"))
        .filter(F.length("skill") > 0)
        .distinct()
    )
