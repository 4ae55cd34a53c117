"""Landing, writing, loading and the whole day, with data made from the tables and kept in the shared folder."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType, DateType, LongType, StringType, StructField, StructType

from starloom.functions.dates import add_units
from starloom.operators.reshape import union_relations
from starloom.plans.conform import FLAT, NESTED, STRUCTS
from starloom.plans.daily import DayResult, run_day
from starloom.plans.star import Path, star_rollup
from starloom.queries.feeds import tagged_sql
from starloom.queries.registry import Tables, query
from starloom.queries.star import SUITE_PASSES
from starloom.schemas import FLAT_FEED
from starloom.session import scratch_path
from starloom.sources.bronze import PACKED, flatten_pages, judge_payloads, promote, read_elements, read_feed, split_elements
from starloom.sources.lake import (
    conform_to,
    empty_frame,
    matching_tables,
    open_tables,
    publish,
    publish_view,
    require_root,
    union_sources,
    write_day,
    write_partitions,
)
from starloom.sources.versions import replace_rows
from starloom.streaming.load import load_new_files

DAY = date(2026, 6, 1)
# Feed files made here hold the rows of this many consecutive keys; the keys are unique, so a file is bounded.
KEYS_PER_FILE = 5_000
LONG_TEXTS_PER_FILE = 500


def payload_files(rows: DataFrame, key: str, element, source: str, keys_per_file: int = KEYS_PER_FILE) -> DataFrame:
    """JSON arrays of bounded length, one per future file: `source, ingestion_date, payload`."""
    return (
        rows.select(F.floor(F.col(key) / keys_per_file).alias("_file"), element.alias("_element"))
        .groupBy("_file")
        .agg(F.to_json(F.collect_list("_element")).alias("payload"))
        .select(F.lit(source).alias("source"), F.lit(DAY).alias("ingestion_date"), "payload")
    )


@query(
    """
    WITH x AS (SELECT doc_id, lang, source, text FROM documents)
    SELECT doc_id,
           CASE WHEN lang = 'es' THEN NULL WHEN lang = 'de' OR source = 'src3' THEN CASE WHEN lang = 'de' THEN 0 END
                ELSE len(string_split(text, chr(10))) END::INTEGER AS n_records,
           CASE WHEN lang = 'es' THEN 'empty body' WHEN lang = 'de' THEN 'no records'
                WHEN source = 'src3' THEN 'not a JSON array' END AS reason,
           lang NOT IN ('es', 'de') AND source <> 'src3' AS accepted
    FROM x
    """
)
def landing_gate(t: Tables) -> DataFrame:
    """A3: texts as payloads: arrays of their lines, empty bodies, empty arrays, and text that is no JSON array."""
    lang = F.col("lang")
    payload = (
        F.when(lang == "es", F.lit(""))
        .when(lang == "de", F.lit("[]"))
        .when(F.col("source") == "src3", F.to_json(F.struct("text")))
        .otherwise(F.to_json(F.split("text", "\n")))
    )
    return judge_payloads(t.documents.select("doc_id", payload.alias("payload"))).drop("payload")


@query(
    """
    WITH p AS (SELECT conv_id, turn, CASE WHEN length(text) < 60 THEN [] ELSE string_split(text, ' ') END AS items FROM conversations),
         s AS (SELECT conv_id, min(turn) AS stop FROM p WHERE len(items) = 0 GROUP BY 1)
    SELECT conv_id, turn, unnest(items) AS item FROM p LEFT JOIN s USING (conv_id) WHERE stop IS NULL OR turn < stop
    """
)
def paged_items(t: Tables) -> DataFrame:
    """A4: turns as pages of words; a short turn is an empty page and ends its conversation."""
    long_enough = F.length("text") >= 60
    pages = t.conversations.select(
        "conv_id",
        "turn",
        F.when(long_enough, F.split("text", " ")).when(F.col("role") == "user", F.array().cast("array<string>")).alias("items"),
    )
    return flatten_pages(pages, "items", "turn", ["conv_id"])


@query(
    """
    SELECT p_partkey::VARCHAR AS id, p_name AS position, CASE WHEN p_size > 25 THEN p_retailprice::VARCHAR END AS salary_max,
           CASE WHEN p_type = 'PROMO' THEN 0 ELSE 2 END AS n_tags, CAST(NULL AS VARCHAR) AS legal,
           'RemoteOK' AS source, DATE '2026-06-01' AS ingestion_date
    FROM part
    """
)
def feed_round_trip(t: Tables) -> DataFrame:
    """Parts written as JSON array files to the bronze layout, split into lines, and read with the declared schema."""
    base = scratch_path(t.spark, "feed")
    element = F.struct(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("position"),
        F.when(F.col("p_size") > 25, F.col("p_retailprice")).alias("salary_max"),
        F.when(F.col("p_type") != "PROMO", F.split("p_name", " ")).alias("tags"),
    )
    promote(judge_payloads(payload_files(t.part, "p_partkey", element, FLAT.source)), base)
    require_root(read_feed(t.spark, base, FLAT.source, DAY, FLAT_FEED), "position")
    split_elements(t.spark, base, FLAT.source, DAY, root="position")
    return read_elements(t.spark, base, FLAT.source, DAY, FLAT_FEED).select(
        "id", "position", "salary_max", F.coalesce(F.size("tags"), F.lit(0)).alias("n_tags"), "legal", "source", "ingestion_date"
    )


@query(
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN o_totalprice + 1 ELSE o_totalprice END AS price,
           o_orderstatus AS source, CAST(date_trunc('year', o_orderdate) AS DATE) AS ingestion_date
    FROM orders WHERE NOT (o_orderstatus = 'F' AND year(o_orderdate) = 1996)
    """
)
def overwrite_partitions(t: Tables) -> DataFrame:
    """A5: one source is written again with other values and one day emptied; the other partitions stay."""
    root = scratch_path(t.spark, "silver")
    rows = t.orders.select(
        "o_orderkey",
        F.col("o_totalprice").alias("price"),
        F.col("o_orderstatus").alias("source"),
        F.trunc("o_orderdate", "year").alias("ingestion_date"),
    )
    write_partitions(rows, root)
    write_partitions(rows.filter("source = 'P'").withColumn("price", F.col("price") + 1), root)
    write_day(rows.filter("source = 'none'"), root, "F", date(1996, 1, 1))
    return t.spark.read.schema(rows.schema).parquet(root)


@query(
    """
    SELECT o_orderkey, o_totalprice AS price, o_orderstatus AS source, CAST(date_trunc('year', o_orderdate) AS DATE) AS ingestion_date
    FROM orders
    """
)
def stream_load(t: Tables) -> DataFrame:
    """Files arriving in two waves are loaded by three runs, each file once, columns matched in any case."""
    base = scratch_path(t.spark, "load")
    rows = t.orders.select(
        "O_ORDERKEY",
        F.col("o_totalprice").alias("PRICE"),
        F.col("o_orderstatus").alias("source"),
        F.trunc("o_orderdate", "year").alias("ingestion_date"),
    )
    declared = StructType(
        [StructField(f.name.lower(), f.dataType) for f in rows.schema]
    )
    for wave in ("source = 'F'", "source <> 'F'", "false"):
        write_partitions(rows.filter(wave), f"{base}/silver")
        load_new_files(t.spark, f"{base}/silver", f"{base}/raw", f"{base}/progress", declared)
    return t.spark.read.schema(declared).parquet(f"{base}/raw")


@query(
    """
    SELECT o_orderstatus, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY 1
    """
)
def full_refresh(t: Tables) -> DataFrame:
    """The same table refreshed twice holds its rows once."""
    path = scratch_path(t.spark, "refresh")
    replace_rows(t.orders, path)
    return replace_rows(t.orders, path).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query(
    """
    SELECT c_custkey AS customer, c_name AS name, true AS is_new, CAST(NULL AS DATE) AS since FROM customer
    UNION ALL SELECT s_suppkey, s_name, CAST(NULL AS BOOLEAN), CAST(NULL AS DATE) FROM supplier
    """
)
def declared_schema(t: Tables) -> DataFrame:
    """Frames of different shape brought to one declared schema and stacked, an empty one included."""
    declared = StructType(
        [
            StructField("customer", LongType()),
            StructField("name", StringType()),
            StructField("is_new", BooleanType()),
            StructField("since", DateType()),
        ]
    )
    a = t.customer.select(F.col("c_name").alias("NAME"), F.lit("true").alias("Is_New"), F.col("c_custkey").alias("CUSTOMER"))
    b = t.supplier.select(F.col("s_suppkey").cast("string").alias("customer"), F.col("s_name").alias("name"))
    return union_sources([conform_to(a, declared), conform_to(b, declared), empty_frame(t.spark, declared)])


@query(
    """
    SELECT 'events_' || event_type AS origin, event_id, user_id,
           CASE WHEN event_type = 'purchase' THEN value WHEN event_type = 'error' THEN -value END AS value
    FROM events
    """
)
def catalog_union(t: Tables) -> DataFrame:
    """Tables and a view of a schema, found by name pattern, stacked over their superset.

    Every event type is a table; that of the errors, refreshed once more, is read through a view, which keeps its query
    in the catalog. A table of old clicks is excluded by name.
    """
    base, schema = scratch_path(t.spark, "catalog"), f"starloom_{uuid.uuid4().hex[:12]}".upper()

    def publish_type(kind: str, name: str) -> None:
        rows = t.events.filter(F.col("event_type") == kind).select("event_id", "user_id", *(["value"] if kind in ("purchase", "error") else []))
        publish(rows, schema, name, location=f"{base}/{name}", schema_location=f"{base}/schema")

    for kind in ("click", "purchase", "signup", "view"):
        publish_type(kind, f"events_{kind}")
    publish_type("click", "events_click_old")
    publish_type("error", "problems")
    publish_type("error", "problems")
    publish_view(t.spark, schema, "events_error", f"SELECT event_id, user_id, -value AS value FROM `{schema}`.problems")
    found = matching_tables(t.spark, schema, "EVENTS_%", exclude="%_old")
    tables = {name.split(".")[1]: df for name, df in open_tables(t.spark, found).items()}
    stacked = union_relations(tables, source_column="origin")
    # The frames have read the catalog; the files stay.
    t.spark.sql(f"DROP DATABASE `{schema}` CASCADE")
    return stacked


def _land_three_feeds(t: Tables, landing: str) -> None:
    text, lang = F.col("text"), F.col("lang")
    flat = F.struct(
        F.col("p_partkey").alias("id"),
        F.concat(F.lit(" Data Engineer "), "p_type", F.lit(" ")).alias("position"),
        F.col("p_brand").alias("company"),
        F.nullif(F.col("p_type"), F.lit("PROMO")).alias("location"),
        F.col("p_size").alias("salary_min"),
        (F.col("p_size") * 2).alias("salary_max"),
        F.lit("2026-05-30T10:00:00+00:00").alias("date"),
        F.split("p_name", " ").alias("tags"),
    )
    structs = F.struct(
        F.col("doc_id").alias("id"),
        F.concat(F.lit("Senior Writer "), lang).alias("title"),
        F.struct(F.col("source").alias("display_name")).alias("company"),
        F.lit("2026-05-31T08:00:00Z").alias("created"),
        text.alias("description"),
    )
    pay = F.struct(
        F.col("o_totalprice").cast("string").alias("MinimumRange"),
        F.when(F.col("o_orderstatus") == "F", "PA").otherwise("PH").alias("RateIntervalCode"),
    )
    nested = F.struct(
        F.col("o_orderkey").alias("MatchedObjectId"),
        F.struct(
            F.concat(F.lit("Clerk "), "o_orderpriority").alias("PositionTitle"),
            F.col("o_orderpriority").alias("OrganizationName"),
            F.array(pay).alias("PositionRemuneration"),
            F.date_format(add_units("o_orderdate", "year", 24), "yyyy-MM-dd'T'HH:mm:ss").alias("PublicationStartDate"),
            F.lit("Telework; SQL").alias("QualificationSummary"),
        ).alias("MatchedObjectDescriptor"),
    )
    for rows, key, element, mapping, size in (
        (t.part, "p_partkey", flat, FLAT, KEYS_PER_FILE),
        (t.documents, "doc_id", structs, STRUCTS, LONG_TEXTS_PER_FILE),
        (t.orders, "o_orderkey", nested, NESTED, KEYS_PER_FILE),
    ):
        (
            payload_files(rows, key, element, mapping.source, size)
            .write.mode("append")
            .option("maxRecordsPerFile", 1)
            .options(**PACKED)
            .partitionBy("source", "ingestion_date")
            .text(landing)
        )


def _whole_day(t: Tables) -> DayResult:
    base, name = scratch_path(t.spark, "day"), uuid.uuid4().hex[:12].upper()
    _land_three_feeds(t, f"{base}/landing")
    result = run_day(t.spark, base, DAY, landing=f"{base}/landing", schema=f"marts_{name}", staging_schema=f"staging_{name}")
    for schema in (f"MARTS_{name}", f"STAGING_{name}"):  # the frames have read the catalog; the files stay
        t.spark.sql(f"DROP DATABASE `{schema}` CASCADE")
    return result


@query(
    """
    WITH j AS (
        SELECT 'RemoteOK' AS source, 'Data Engineer' AS role_family, 'Mid' AS seniority_level, true AS is_remote, 2026 AS year,
               CASE WHEN p_size > 0 THEN CAST(p_size * 1.5 AS DECIMAL(12, 2)) END AS pay FROM part
        UNION ALL
        SELECT 'Adzuna', 'Other', 'Senior', contains(lower(text), 'remote'), 2026, CAST(NULL AS DECIMAL(12, 2)) FROM documents
        UNION ALL
        SELECT 'USAJobs', 'Other', 'Mid', true, CASE WHEN year(o_orderdate) + 24 BETWEEN 2020 AND 2030 THEN year(o_orderdate) + 24 END,
               CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(12, 2)) END FROM orders)
    SELECT source, role_family, seniority_level, is_remote, CAST(year AS INTEGER) AS year, CAST(count(*) AS BIGINT) AS postings,
           CAST(sum(pay) AS DOUBLE) AS pay_total
    FROM j GROUP BY ALL
    """
)
def medallion_day(t: Tables) -> DataFrame:
    """L13 with A1-A10, B3, L1-L10: three landed feeds go through every layer; the posting fact is then rolled up."""
    tables = _whole_day(t).tables
    rolled = star_rollup(
        tables["fact_job_posting"],
        [
            Path("source_key", tables["dim_source"], {"source": "source_name"}),
            Path(
                "role_key",
                tables["dim_role"],
                {"role_family": "role_family", "seniority_level": "seniority_level"},
            ),
            Path("date_key", tables["dim_date"], {"year": "year"}),
        ],
        {"postings": F.lit(1), "pay_total": F.col("salary_avg_usd")},
        degenerate=["is_remote"],
    )
    return rolled.withColumn("pay_total", F.col("pay_total").cast("double"))


@query(
    f"""
    WITH s AS (
        SELECT p_brand AS company_name, CASE WHEN p_type = 'PROMO' THEN 'Remote' ELSE p_type END AS location_name,
               unnest(list_distinct(list_filter(string_split(lower(p_name), ' '), lambda w: w <> ''))) AS skill_name FROM part
        UNION ALL
        SELECT source, 'Unknown', unnest({tagged_sql("text")}) FROM documents
        UNION ALL
        SELECT o_orderpriority, 'Unknown', 'sql' FROM orders)
    SELECT skill_name, company_name, location_name, CAST(count(*) AS BIGINT) AS postings FROM s GROUP BY ALL
    """
)
def medallion_skills(t: Tables) -> DataFrame:
    """L13 with L6-L8, L11: after the same day, postings by skill, company and place, through the bridge."""
    tables = _whole_day(t).tables
    fact = tables["fact_job_posting"].select("job_posting_key", "company_key", "location_key")
    return star_rollup(
        tables["fact_job_skill"].select("job_posting_key", "skill_key").join(fact, "job_posting_key"),
        [
            Path("skill_key", tables["dim_skill"], {"skill_name": "skill_name"}),
            Path("company_key", tables["dim_company"], {"company_name": "company_name"}),
            Path("location_key", tables["dim_location"], {"location_name": "location_name"}),
        ],
        {"postings": F.lit(1)},
    )


@query(
    f"""
    WITH counted AS (
        SELECT unnest({[*SUITE_PASSES, "relationships fact_job_skill.job_posting_key -> fact_job_posting.job_posting_key"]}) AS "check", 0 AS failures
        UNION ALL
        SELECT 'relationships fact_job_posting.date_key -> dim_date.date_key', count(*) FROM orders WHERE year(o_orderdate) + 24 NOT BETWEEN 2020 AND 2030)
    SELECT "check", CAST(failures AS BIGINT) AS failures, CASE WHEN failures <> 0 THEN 'error' ELSE 'pass' END AS status FROM counted
    """
)
def medallion_verdicts(t: Tables) -> DataFrame:
    """The verdicts of the same day; postings outside the stored calendar are its only orphans."""
    return _whole_day(t).verdicts
