"""Declared schemas of every layer (A10, B1, B2).

Feeds are read with these instead of inference: a field that a day's file lacks is a typed null, and no
job runs to guess types. Scalars of the feeds are text, since the same field comes as number or text
from day to day; the mappings cast them.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

MONEY = DecimalType(12, 2)


def _texts(*names: str) -> list[StructField]:
    return [StructField(n, StringType()) for n in names]


def _required(name: str, kind) -> StructField:
    return StructField(name, kind, nullable=False)


# ---- feeds -------------------------------------------------------------------------------------

FLAT_FEED = StructType(
    _texts("id", "position", "company", "location", "salary_min", "salary_max", "date", "url", "legal")
    + [StructField("tags", ArrayType(StringType()))]
)

_DISPLAY_NAME = StructType(_texts("display_name"))
STRUCT_FEED = StructType(
    _texts("id", "title", "description", "created", "redirect_url", "salary_min", "salary_max")
    + [StructField("company", _DISPLAY_NAME), StructField("location", _DISPLAY_NAME)]
)

_PAY = StructType(_texts("MinimumRange", "MaximumRange", "RateIntervalCode"))
NESTED_FEED = StructType(
    [
        StructField("MatchedObjectId", StringType()),
        StructField(
            "MatchedObjectDescriptor",
            StructType(
                _texts(
                    "PositionTitle",
                    "OrganizationName",
                    "PositionLocationDisplay",
                    "PublicationStartDate",
                    "PositionURI",
                    "QualificationSummary",
                )
                + [StructField("PositionRemuneration", ArrayType(_PAY))]
            ),
        ),
    ]
)

# ---- silver: partition columns `source` and `ingestion_date` live in the path only -------------------

SILVER_JOBS = StructType(
    _texts("posting_id", "title", "company", "location_raw")
    + [StructField(n, DoubleType()) for n in ("salary_min_usd", "salary_max_usd", "salary_avg_usd")]
    + [
        StructField("is_remote", BooleanType()),
        StructField("job_url", StringType()),
        StructField("posted_at", TimestampType()),
    ]
)
SILVER_SKILLS = StructType(_texts("posting_id", "skill"))
PARTITION_FIELDS = [StructField("source", StringType()), StructField("ingestion_date", DateType())]
RAW_JOBS = StructType(SILVER_JOBS.fields + PARTITION_FIELDS)
RAW_SKILLS = StructType(SILVER_SKILLS.fields + PARTITION_FIELDS)

# ---- staging and marts -------------------------------------------------------------------------------

STAGED_POSTINGS = StructType(
    _texts("posting_id", "source", "title", "company", "location_raw")
    + [StructField(n, MONEY) for n in ("salary_min_usd", "salary_max_usd", "salary_avg_usd")]
    + [
        StructField("is_remote", BooleanType()),
        StructField("job_url", StringType()),
        StructField("posted_at", TimestampNTZType()),
        StructField("ingestion_date", DateType()),
    ]
)
STAGED_SKILLS = StructType(_texts("posting_id", "skill"))

MARTS: dict[str, StructType] = {
    "dim_source": StructType(
        [_required("source_key", StringType()), _required("source_name", StringType())]
        + _texts("source_type")
    ),
    "dim_company": StructType(
        [_required("company_key", StringType()), _required("company_name", StringType())]
        + _texts("industry", "company_size")
        + [StructField("is_startup", BooleanType())]
    ),
    "dim_location": StructType(
        [
            _required("location_key", StringType()),
            _required("location_name", StringType()),
            _required("is_remote", BooleanType()),
        ]
    ),
    "dim_skill": StructType(
        [_required("skill_key", StringType()), _required("skill_name", StringType())]
        + _texts("skill_category")
    ),
    "dim_role": StructType(
        [_required("role_key", StringType())]
        + _texts("role_title", "role_family", "seniority_level", "employment_type")
    ),
    "dim_date": StructType(
        [
            _required("date_key", IntegerType()),
            _required("full_date", DateType()),
            _required("year", IntegerType()),
            _required("quarter", IntegerType()),
            _required("month", IntegerType()),
            _required("month_name", StringType()),
            _required("week_of_year", IntegerType()),
            _required("day_of_week", IntegerType()),
            _required("day_name", StringType()),
            _required("is_weekend", BooleanType()),
        ]
    ),
    "fact_job_posting": StructType(
        [_required("job_posting_key", StringType()), _required("posting_id", StringType())]
        + _texts("company_key", "location_key", "source_key", "role_key")
        + [StructField("date_key", IntegerType())]
        + [StructField(n, MONEY) for n in ("salary_min_usd", "salary_max_usd", "salary_avg_usd")]
        + [
            StructField("is_remote", BooleanType()),
            StructField("job_url", StringType()),
            StructField("posted_at", TimestampNTZType()),
            StructField("loaded_at", TimestampNTZType()),
        ]
    ),
    "fact_job_skill": StructType(
        [_required("job_posting_key", StringType()), _required("skill_key", StringType())]
        + _texts("posting_id", "skill")
    ),
}

# Declared keys: table -> key column, and (child, column, parent, column). `plans.suite` checks them.
PRIMARY_KEYS = {
    "dim_source": "source_key",
    "dim_company": "company_key",
    "dim_location": "location_key",
    "dim_skill": "skill_key",
    "dim_role": "role_key",
    "dim_date": "date_key",
    "fact_job_posting": "job_posting_key",
}
FOREIGN_KEYS = [
    ("fact_job_posting", "company_key", "dim_company", "company_key"),
    ("fact_job_posting", "location_key", "dim_location", "location_key"),
    ("fact_job_posting", "source_key", "dim_source", "source_key"),
    ("fact_job_posting", "role_key", "dim_role", "role_key"),
    ("fact_job_posting", "date_key", "dim_date", "date_key"),
    ("fact_job_skill", "job_posting_key", "fact_job_posting", "job_posting_key"),
    ("fact_job_skill", "skill_key", "dim_skill", "skill_key"),
]
