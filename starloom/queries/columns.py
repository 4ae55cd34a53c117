"""Column functions and blanket projections over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starloom.functions.dates import add_units, date_key, parse_timestamp, units_between
from starloom.functions.keys import hash_key, member, namespaced, surrogate_key
from starloom.functions.numeric import (
    haversine,
    midpoint,
    positive,
    safe_add,
    safe_divide,
    safe_subtract,
    width_bucket,
)
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
    tag_terms,
)
from starloom.functions.text import blank_to_null, mentions, slugify, url_host, url_parameter, url_path
from starloom.operators.columns import group_by_first, nullcheck, star
from starloom.queries.labels import ROLES, SKILLS
from starloom.queries.registry import Tables, query
from starloom.sources.lake import column_or_null

# Words that occur in the given texts, for queries on the tagger and the mention flag.
TEXT_TERMS = ["the", "tion", "und", "que", "con", "go", "etl", "ing", "schaft", "mente"]


@query(
    """
    SELECT o_orderkey,
           md5(o_orderkey::VARCHAR) AS plain_key,
           md5(nullif(o_orderpriority, '5-LOW')) AS nullable_key,
           md5(concat_ws('-', coalesce(o_orderkey::VARCHAR, '_dbt_utils_surrogate_key_null_'),
                              coalesce(nullif(o_orderpriority, '5-LOW'), '_dbt_utils_surrogate_key_null_'),
                              coalesce((o_orderstatus = 'F')::VARCHAR, '_dbt_utils_surrogate_key_null_'))) AS row_key,
           md5(concat_ws('-', coalesce(nullif(o_orderstatus, 'P'), ''), o_custkey::VARCHAR)) AS legacy_key
    FROM orders
    """
)
def surrogate_keys(t: Tables) -> DataFrame:
    """Single and composite hash keys, nulls marked or (legacy) empty."""
    priority = F.nullif(F.col("o_orderpriority"), F.lit("5-LOW"))
    return t.orders.select(
        "o_orderkey",
        hash_key(F.col("o_orderkey").cast("string")).alias("plain_key"),
        hash_key(priority).alias("nullable_key"),
        surrogate_key(["o_orderkey", priority, F.col("o_orderstatus") == "F"]).alias("row_key"),
        surrogate_key(
            [F.nullif(F.col("o_orderstatus"), F.lit("P")), "o_custkey"], nulls_as_empty=True
        ).alias("legacy_key"),
    )


@query(
    """
    WITH x AS (SELECT l_orderkey, l_linenumber, l_quantity, l_tax,
                      nullif(l_discount, 0.05) AS gap, l_extendedprice AS price FROM lineitem)
    SELECT l_orderkey, l_linenumber, price,
           l_quantity + coalesce(gap, 0) + l_tax AS added,
           l_quantity - coalesce(gap, 0) - l_tax AS subtracted,
           price / nullif(gap, 0) AS divided,
           (price + l_tax) / nullif(gap - gap, 0) AS by_zero
    FROM x
    """
)
def safe_math(t: Tables) -> DataFrame:
    """H12, H13."""
    gap = F.nullif(F.col("l_discount"), F.lit(0.05))
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_extendedprice").alias("price"),
        safe_add(["l_quantity", gap, "l_tax"]).alias("added"),
        safe_subtract(["l_quantity", gap, "l_tax"]).alias("subtracted"),
        safe_divide("l_extendedprice", gap).alias("divided"),
        safe_divide(F.col("l_extendedprice") + F.col("l_tax"), gap - gap).alias("by_zero"),
    )


@query(
    """
    SELECT l_orderkey, l_linenumber, l_extendedprice,
           CAST(CASE WHEN l_extendedprice < 10000 THEN 0 WHEN l_extendedprice >= 90000 THEN 9
                     ELSE floor((l_extendedprice - 10000) / 10000) + 1 END AS BIGINT) AS bucket
    FROM lineitem
    """
)
def width_buckets(t: Tables) -> DataFrame:
    """Eight equal bins with an open bin on either side."""
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_extendedprice",
        width_bucket("l_extendedprice", 10000, 90000, 8).alias("bucket"),
    )


@query(
    """
    WITH x AS (SELECT l_orderkey, l_linenumber, l_quantity AS lat1, l_discount * 1000 AS lon1,
                      l_tax * 500 AS lat2, l_quantity * 3 - 75 AS lon2 FROM lineitem),
         d AS (SELECT *, 2 * 3961 * asin(sqrt(power(sin(radians((lat2 - lat1) / 2)), 2)
                   + cos(radians(lat1)) * cos(radians(lat2)) * power(sin(radians((lon2 - lon1) / 2)), 2))) AS mi
               FROM x)
    SELECT l_orderkey, l_linenumber, round(lon1, 6) AS lon1, round(mi, 6) AS miles, round(mi * 1.60934, 6) AS km
    FROM d
    """
)
def haversine_miles(t: Tables) -> DataFrame:
    """Points made from the measures of each line."""
    points = t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_quantity").alias("lat1"),
        (F.col("l_discount") * 1000).alias("lon1"),
        (F.col("l_tax") * 500).alias("lat2"),
        (F.col("l_quantity") * 3 - 75).alias("lon2"),
    )
    ends = ("lat1", "lon1", "lat2", "lon2")
    return points.select(
        "l_orderkey",
        "l_linenumber",
        F.round("lon1", 6).alias("lon1"),
        F.round(haversine(*ends), 6).alias("miles"),
        F.round(haversine(*ends, unit="km"), 6).alias("km"),
    )


@query(
    """
    WITH x AS (SELECT page_id, url,
                      replace(replace(replace(url, 'android-app://', ''), 'http://', ''), 'https://', '') AS bare,
                      replace(replace(url, 'http://', ''), 'https://', '') AS web FROM pages)
    SELECT page_id,
           split_part(split_part(bare, '/', 1), '?', 1) AS host,
           split_part(right(web, length(web) - coalesce(nullif(strpos(web, '/'), 0), strpos(web, '?') - 1)), '?', 1) AS path,
           nullif(split_part(split_part(url, 'utm_source=', 2), '&', 1), '') AS utm_source,
           nullif(split_part(split_part(url, 'e=', 2), '&', 1), '') AS any_e
    FROM x
    """
)
def url_parts(t: Tables) -> DataFrame:
    """H16-H18."""
    return t.pages.select(
        "page_id",
        url_host("url").alias("host"),
        url_path("url").alias("path"),
        url_parameter("url", "utm_source").alias("utm_source"),
        url_parameter("url", "e").alias("any_e"),
    )


@query(
    """
    WITH x AS (SELECT doc_id, regexp_replace(regexp_replace(lower(text), '[ -]+', '_', 'g'), '[^a-z0-9_]+', '', 'g') AS s
               FROM documents)
    SELECT doc_id, length(s2) AS slug_length, md5(s2) AS slug_hash
    FROM (SELECT doc_id, CASE WHEN regexp_matches(s, '^[0-9]') THEN '_' || s ELSE s END AS s2 FROM x)
    """
)
def slugs(t: Tables) -> DataFrame:
    """H19 over whole texts; the slug of a text is shown by its length and hash."""
    slug = t.documents.select("doc_id", slugify("text").alias("s"))
    return slug.select("doc_id", F.length("s").cast("bigint").alias("slug_length"), F.md5("s").alias("slug_hash"))


@query(
    """
    WITH x AS (SELECT doc_id, lower(concat_ws(' ', source, lang, text)) AS body FROM documents)
    SELECT doc_id, contains(body, 'remote') AS says_remote,
           regexp_matches(body, 'remote|telework') AS says_telework,
           regexp_matches(body, 'thth|eaux') AS says_known
    FROM x
    """
)
def text_flags(t: Tables) -> DataFrame:
    """H1, H2, H5 over whole texts."""
    body = ["source", "lang", "text"]
    return t.documents.select(
        "doc_id",
        mentions(body, "remote").alias("says_remote"),
        mentions(body, "remote|telework").alias("says_telework"),
        mentions(body, "thth|eaux").alias("says_known"),
    )


@query(
    """
    SELECT doc_id, term FROM (
        SELECT doc_id, unnest(list_filter(
            ['the', 'tion', 'und', 'que', 'con', 'go', 'etl', 'ing', 'schaft', 'mente'],
            lambda w: contains(lower(text), w))) AS term
        FROM documents)
    """
)
def vocab_bridge(t: Tables) -> DataFrame:
    """Document-term pairs by plain containment in the whole text."""
    pairs = t.documents.select("doc_id", F.explode_outer(tag_terms("text", TEXT_TERMS)).alias("term"))
    return pairs.filter(F.col("term").isNotNull())


@query(
    r"""
    WITH w AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+[+#]*') AS words FROM documents)
    SELECT doc_id, term FROM (
        SELECT doc_id, unnest(list_concat(
            list_filter(['in', 'the', 'go', 'as', 'c++', 'que', 'con'], lambda t: list_contains(words, t)),
            list_filter(['and the', 'of the the', 'to'], lambda t: contains(' ' || array_to_string(words, ' ') || ' ', ' ' || t || ' ')))) AS term
        FROM w)
    """
)
def vocab_words(t: Tables) -> DataFrame:
    """H6 by whole words and phrases, over whole texts: `as` isn't found in `was`."""
    terms = ["in", "the", "go", "as", "C++", "que", "con", "and the", "of  the, the", "to"]
    names = {"C++": "c++", "of  the, the": "of the the"}
    label = F.coalesce(*[F.when(F.col("term") == k, F.lit(v)) for k, v in names.items()], F.col("term"))
    pairs = t.documents.select("doc_id", F.explode_outer(tag_terms("text", terms, whole_word=True)).alias("term"))
    return pairs.filter(F.col("term").isNotNull()).withColumn("term", label)


@query(
    """
    WITH x AS (SELECT l_orderkey, l_linenumber, nullif(l_quantity - 25, 3) AS low, nullif(l_quantity, 7) AS high FROM lineitem),
         y AS (SELECT l_orderkey, l_linenumber, CASE WHEN low > 0 THEN low END AS pay_low,
                      CASE WHEN high > 0 THEN high END AS pay_high FROM x)
    SELECT l_orderkey, l_linenumber, pay_low, pay_high,
           CASE WHEN pay_low IS NOT NULL AND pay_high IS NOT NULL THEN (pay_low + pay_high) / 2.0
                ELSE coalesce(pay_low, pay_high) END AS pay_mid
    FROM y
    """
)
def salary_rule(t: Tables) -> DataFrame:
    """Only positive pay counts; the middle, or the bound that exists."""
    bounds = t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        positive(F.nullif(F.col("l_quantity") - 25, F.lit(3))).alias("pay_low"),
        positive(F.nullif(F.col("l_quantity"), F.lit(7))).alias("pay_high"),
    )
    return bounds.withColumn("pay_mid", midpoint("pay_low", "pay_high"))


@query(
    f"""
    WITH x AS (SELECT p_partkey, p_brand, CASE p_type
                   WHEN 'ECONOMY' THEN 'Senior Data Engineer' WHEN 'STANDARD' THEN 'ML Engineer, Internal Tools'
                   WHEN 'MEDIUM' THEN 'Staff Software Engineer (contract)' WHEN 'SMALL' THEN 'Entry Data Science, part-time'
                   WHEN 'LARGE' THEN 'Senior Lead DevOps' ELSE p_name END AS role FROM part)
    SELECT p_partkey, p_brand || ' ' || role AS title, coalesce(role_family, 'Other') AS role_family,
           coalesce(seniority_level, 'Mid') AS seniority_level, coalesce(employment_type, 'Full-time') AS employment_type
    FROM x LEFT JOIN {ROLES} USING (role)
    """
)
def rule_classifier(t: Tables) -> DataFrame:
    """Titles by keyword, first rule first."""
    kind = F.col("p_type")
    role = (
        F.when(kind == "ECONOMY", "Senior Data Engineer")
        .when(kind == "STANDARD", "ML Engineer, Internal Tools")
        .when(kind == "MEDIUM", "Staff Software Engineer (contract)")
        .when(kind == "SMALL", "Entry Data Science, part-time")
        .when(kind == "LARGE", "Senior Lead DevOps")
        .otherwise(F.col("p_name"))
    )
    return t.part.select("p_partkey", F.concat_ws(" ", "p_brand", role).alias("title")).select(
        "p_partkey",
        "title",
        classify_by_keyword("title", ROLE_FAMILIES, ROLE_FAMILY_DEFAULT).alias("role_family"),
        classify_by_keyword("title", SENIORITY_LEVELS, SENIORITY_DEFAULT).alias("seniority_level"),
        classify_by_keyword("title", EMPLOYMENT_TYPES, EMPLOYMENT_DEFAULT).alias("employment_type"),
    )


@query(
    f"""
    WITH x AS (SELECT event_id, CASE event_type WHEN 'view' THEN 'aws' WHEN 'click' THEN 'go'
                   WHEN 'signup' THEN 'spark' WHEN 'error' THEN 'redis' ELSE 'excel' END AS skill FROM events)
    SELECT event_id, skill, skill_category FROM x LEFT JOIN {SKILLS} USING (skill)
    """
)
def value_classifier(t: Tables) -> DataFrame:
    """Labels by membership in value lists."""
    kind = F.col("event_type")
    skill = (
        F.when(kind == "view", "aws")
        .when(kind == "click", "go")
        .when(kind == "signup", "spark")
        .when(kind == "error", "redis")
        .otherwise("excel")
    )
    return t.events.select("event_id", skill.alias("skill")).withColumn(
        "skill_category", classify_by_value("skill", SKILL_CATEGORIES, SKILL_CATEGORY_DEFAULT)
    )


@query(
    """
    SELECT event_id, 'clicks' AS source, true AS is_remote,
           CASE WHEN event_type = 'error' THEN NULL ELSE date_trunc('second', ts) END AS seen_at,
           CASE WHEN event_type = 'view' THEN NULL ELSE value END AS amount,
           CAST(NULL AS VARCHAR) AS absent,
           CAST(CASE WHEN event_type = 'error' THEN NULL ELSE strftime(ts, '%Y%m%d') END AS INTEGER) AS date_key
    FROM events
    """
)
def typed_projection(t: Tables) -> DataFrame:
    """Text back to types, where bad text is null and missing columns are typed."""
    kind = F.col("event_type")
    as_text = t.events.select(
        "event_id",
        F.when(kind == "error", "not a time").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).alias("seen"),
        F.when(kind == "view", "n/a").otherwise(F.col("value").cast("string")).alias("amount_text"),
        "props",
    )
    seen_at = parse_timestamp("seen", "yyyy-MM-dd'T'HH:mm:ss").cast("timestamp_ntz")
    return as_text.select(
        "*",
        F.lit("clicks").alias("source"),
        F.lit(True).alias("is_remote"),
        seen_at.alias("seen_at"),
        F.col("amount_text").try_cast("double").alias("amount"),
        column_or_null(as_text, "absent", "string").alias("absent"),
        date_key(seen_at).alias("date_key"),
    ).drop("seen", "amount_text", "props")


@query(
    """
    SELECT 'doc-' || nullif(doc_id, n_chars)::VARCHAR AS posting_id,
           'doc-' || CASE WHEN lang = 'es' THEN NULL ELSE doc_id END::VARCHAR AS maybe_id,
           md5(trim(text)) AS text_hash, length(trim(text)) AS text_length
    FROM documents WHERE nullif(lang, 'fr') IS NOT NULL
    """
)
def namespaced_key(t: Tables) -> DataFrame:
    """Prefixed ids, null when the id is; rows without a title dropped."""
    return (
        t.documents.filter(F.nullif(F.col("lang"), F.lit("fr")).isNotNull())
        .select(
            namespaced("doc-", F.nullif(F.col("doc_id"), F.col("n_chars"))).alias("posting_id"),
            namespaced("doc-", F.when(F.col("lang") != "es", F.col("doc_id"))).alias("maybe_id"),
            F.md5(F.trim("text")).alias("text_hash"),
            F.length(F.trim("text")).cast("bigint").alias("text_length"),
        )
    )


@query(
    """
    SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_quantity END AS first_qty,
           CASE WHEN l_linestatus = 'F' AND l_returnflag <> 'R' THEN l_extendedprice END AS first_price_if_final
    FROM lineitem
    """
)
def first_element(t: Tables) -> DataFrame:
    """A field of the first array element, null for an empty array, kept on a condition."""
    offer = F.struct(
        F.col("l_quantity").alias("qty"), F.col("l_extendedprice").alias("price"), F.col("l_linestatus").alias("code")
    )
    offers = t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.filter(F.array(offer), lambda o: F.col("l_returnflag") != "R").alias("offers"),
    )
    first = F.get("offers", F.lit(0))
    return offers.select(
        "l_orderkey",
        "l_linenumber",
        first["qty"].alias("first_qty"),
        F.when(first["code"] == "F", first["price"]).alias("first_price_if_final"),
    )


@query(
    """
    SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'Unknown' ELSE c_mktsegment END AS segment,
           coalesce(nullif(c_mktsegment, 'MACHINERY'), 'none') AS other_default
    FROM customer
    """
)
def default_member(t: Tables) -> DataFrame:
    """B15."""
    return t.customer.select(
        "c_custkey",
        member(F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))).alias("segment"),
        member(F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY")), "none").alias("other_default"),
    )


@query(
    """
    SELECT c_custkey, c_name, c_mktsegment, n.n_name AS nation_n_name_key, n.n_regionkey AS nation_n_regionkey_key
    FROM customer JOIN nation n ON c_nationkey = n.n_nationkey
    """
)
def star_select(t: Tables) -> DataFrame:
    """All columns but some, those of the joined table renamed by prefix and suffix."""
    joined = t.customer.alias("c").join(t.nation.alias("n"), F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select(
        *star(t.customer, exclude=["C_NATIONKEY", "c_acctbal"], relation_alias="c"),
        *star(t.nation, exclude=["n_nationkey"], prefix="nation_", suffix="_key", relation_alias="n"),
    )


@query(
    """
    SELECT p_partkey, nullif(CASE WHEN p_type = 'PROMO' THEN '' ELSE p_name END, '') AS p_name,
           nullif(CASE WHEN p_type = 'SMALL' THEN ' ' ELSE p_brand END, '') AS p_brand, p_size
    FROM part
    """
)
def nullcheck_columns(t: Tables) -> DataFrame:
    """Empty text to null in all string columns; a blank is not empty."""
    kind = F.col("p_type")
    return nullcheck(
        t.part.select(
            "p_partkey",
            F.when(kind == "PROMO", "").otherwise(F.col("p_name")).alias("p_name"),
            F.when(kind == "SMALL", " ").otherwise(F.col("p_brand")).alias("p_brand"),
            "p_size",
        )
    )


@query(
    """
    SELECT l_returnflag, l_linestatus, CAST(count(*) AS BIGINT) AS n,
           CAST(sum(CAST(l_quantity AS DECIMAL(12, 2))) AS DOUBLE) AS qty
    FROM lineitem GROUP BY 1, 2
    """
)
def group_by_n(t: Tables) -> DataFrame:
    """Grouped on the first two columns of the projection."""
    rows = t.lineitem.select("l_returnflag", "l_linestatus", "l_quantity")
    return group_by_first(rows, 2).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("decimal(12,2)")).cast("double").alias("qty")
    )


@query(
    """
    SELECT event_id, ts + INTERVAL 36 HOUR AS in_36_hours, ts - INTERVAL 2 MONTH AS two_months_ago,
           date_diff('day', ts, ts + INTERVAL 36 HOUR) AS days_passed,
           date_diff('month', ts, ts + INTERVAL 36 HOUR) AS months_passed,
           date_trunc('hour', ts) AS hour_start
    FROM events
    """
)
def date_arithmetic(t: Tables) -> DataFrame:
    """H9."""
    later = add_units("ts", "hour", 36)
    return t.events.select(
        "event_id",
        later.alias("in_36_hours"),
        add_units("ts", "month", -2).alias("two_months_ago"),
        units_between("day", "ts", later).alias("days_passed"),
        units_between("month", "ts", later).alias("months_passed"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour_start"),
    )


@query(
    """
    SELECT conv_id, turn, (role = 'user')::VARCHAR AS is_user, TRY_CAST(role AS INTEGER) AS not_a_number,
           split_part(role, 's', 2) AS after_s, CAST(strpos(role, 's') AS INTEGER) AS s_at, right(role, 3) AS tail,
           md5(nullif(trim(text), '')) AS body_hash
    FROM conversations
    """
)
def text_helpers(t: Tables) -> DataFrame:
    """Boolean as text, tolerant cast, part, position, right."""
    from starloom.functions.text import bool_to_text

    return t.conversations.select(
        "conv_id",
        "turn",
        bool_to_text(F.col("role") == "user").alias("is_user"),
        F.col("role").try_cast("int").alias("not_a_number"),
        F.split_part("role", F.lit("s"), F.lit(2)).alias("after_s"),
        F.locate("s", "role").alias("s_at"),
        F.right("role", F.lit(3)).alias("tail"),
        F.md5(blank_to_null(F.trim("text"))).alias("body_hash"),
    )
