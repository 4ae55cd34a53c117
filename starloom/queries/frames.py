"""Relational helpers: deduplicate, union, pivot, spines, single values."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starloom.functions.keys import hash_key
from starloom.operators.compare import two_way_except
from starloom.operators.dedupe import deduplicate, distinct_pairs, drop_duplicate_keys, natural_join
from starloom.operators.ordered import with_neighbour, with_neighbours
from starloom.operators.reshape import columnwise, pivot, union_relations, unpivot
from starloom.operators.spine import date_spine, number_series, with_days
from starloom.operators.values import column_values, single_value, value_list
from starloom.queries.registry import Tables, query


@query(
    """
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey, l_suppkey,
                  l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) AS rn FROM lineitem)
    WHERE rn = 1
    """
)
def dedup_lines(t: Tables) -> DataFrame:
    """The newest line per order and number."""
    return deduplicate(t.lineitem, ["l_orderkey", "l_linenumber"], [F.desc("l_shipdate")])


@query(
    """
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY value DESC, event_id) AS rn FROM events)
    WHERE rn = 1
    """
)
def dedup_by_expression(t: Tables) -> DataFrame:
    """E2 with an expression among the keys: the largest value per user and day."""
    return deduplicate(t.events, ["user_id", F.to_date("ts")], [F.desc("value")], ["event_id"])


@query(
    """
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_suppkey, l_linenumber, l_quantity,
                  l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS rn FROM lineitem)
    WHERE rn = 1
    """
)
def drop_duplicates(t: Tables) -> DataFrame:
    """One line per part, the same in every run."""
    return drop_duplicate_keys(t.lineitem, ["l_partkey"])


@query("SELECT DISTINCT conv_id, lower(trim(role)) AS role FROM conversations")
def clean_pairs(t: Tables) -> DataFrame:
    """G5."""
    return distinct_pairs(t.conversations, F.col("conv_id"), F.lower(F.trim("role")).alias("role"))


@query(
    """
    WITH a AS (SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation, c_acctbal AS balance, c_mktsegment AS segment FROM customer),
         b AS (SELECT s_suppkey AS id, s_name AS name, s_nationkey AS nation, s_acctbal AS balance FROM supplier)
    SELECT 'customer' AS origin, id, name, nation::VARCHAR AS nation, balance, segment FROM a WHERE balance > 0
    UNION ALL
    SELECT 'supplier', id, name, nation::VARCHAR, balance, CAST(NULL AS VARCHAR) FROM b WHERE balance > 0
    """
)
def union_superset(t: Tables) -> DataFrame:
    """G1: columns of both tables, the missing one as typed null, one type overridden, filtered before the union."""
    a = t.customer.toDF("id", "name", "nation", "balance", "segment")
    b = t.supplier.toDF("id", "name", "nation", "balance")
    return union_relations(
        {"customer": a, "supplier": b},
        column_override={"nation": "string"},
        source_column="origin",
        where="balance > 0",
    )


@query(
    """
    SELECT o_orderkey AS "key", o_orderdate AS moment FROM orders
    UNION ALL SELECT l_orderkey, l_shipdate FROM lineitem
    """
)
def union_included(t: Tables) -> DataFrame:
    """G1: an include list, and no lineage column."""
    orders = t.orders.withColumnsRenamed({"o_orderkey": "key", "o_orderdate": "moment"})
    lines = t.lineitem.withColumnsRenamed({"l_orderkey": "key", "l_shipdate": "moment"})
    return union_relations({"o": orders, "l": lines}, include=["KEY", "MOMENT"], source_column=None)


@query(
    """
    SELECT p_partkey, field, val FROM (
        SELECT p_partkey, p_name AS p_name, nullif(p_brand, 'Brand#1') AS p_brand, p_size::VARCHAR AS p_size,
               (p_size > 25)::VARCHAR AS is_large FROM part)
    UNPIVOT INCLUDE NULLS (val FOR field IN (p_name, p_brand, p_size, is_large))
    """
)
def unpivot_long(t: Tables) -> DataFrame:
    """All columns but the key as text rows, booleans and nulls included; two columns removed."""
    rows = t.part.withColumns(
        {"p_brand": F.nullif(F.col("p_brand"), F.lit("Brand#1")), "is_large": F.col("p_size") > 25}
    )
    return unpivot(rows, exclude=["p_partkey"], remove=["P_TYPE", "p_retailprice"], field_name="field", value_name="val")


@query(
    """
    SELECT o_orderstatus,
           CAST(sum(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS BIGINT) AS "1-URGENT",
           CAST(sum(CASE WHEN o_orderpriority = '2-HIGH' THEN 1 ELSE 0 END) AS BIGINT) AS "2-HIGH",
           CAST(sum(CASE WHEN o_orderpriority = '3-MEDIUM' THEN 1 ELSE 0 END) AS BIGINT) AS "3-MEDIUM",
           CAST(sum(CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 1 ELSE 0 END) AS BIGINT) AS "4-NOT SPECIFIED",
           CAST(sum(CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 0 END) AS BIGINT) AS "5-LOW"
    FROM orders GROUP BY 1
    """
)
def pivot_counts(t: Tables) -> DataFrame:
    """One count per value found in the table."""
    values = sorted(value_list(t.orders, "o_orderpriority", max_values=100))
    return t.orders.groupBy("o_orderstatus").agg(*pivot("o_orderpriority", values))


@query(
    """
    SELECT l_linestatus,
           CAST(sum(CASE WHEN l_returnflag = 'A' THEN CAST(l_extendedprice AS DECIMAL(12, 2)) ELSE 0 END) AS DOUBLE) AS price_a_sum,
           CAST(sum(CASE WHEN l_returnflag = 'N' THEN CAST(l_extendedprice AS DECIMAL(12, 2)) ELSE 0 END) AS DOUBLE) AS price_n_sum,
           CAST(sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(12, 2)) ELSE 0 END) AS DOUBLE) AS price_r_sum,
           max(CASE WHEN l_returnflag >= 'N' THEN l_quantity ELSE 0 END) AS "from N",
           CAST(count(DISTINCT CASE WHEN l_returnflag <> 'A' THEN l_partkey END) AS BIGINT) AS "parts not A"
    FROM lineitem GROUP BY 1
    """
)
def pivot_amounts(t: Tables) -> DataFrame:
    """Other aggregates, comparisons and aliases, with distinct."""
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    sums = pivot(
        "l_returnflag",
        ["A", "N", "R"],
        then_value=price,
        else_value=F.lit(0).cast("decimal(12,2)"),
        prefix="Price ",
        suffix=" Sum",
        quote_identifiers=False,
    )
    out = t.lineitem.groupBy("l_linestatus").agg(
        *sums,
        *pivot("l_returnflag", ["N"], agg="max", cmp=">=", then_value=F.col("l_quantity"), prefix="from "),
        *pivot(
            "l_returnflag",
            ["A"],
            agg="count",
            cmp="<>",
            then_value=F.col("l_partkey"),
            else_value=F.lit(None),
            prefix="parts not ",
            distinct=True,
        ),
    )
    return out.select(
        "l_linestatus",
        *[F.col(c).cast("double").alias(c) for c in ("price_a_sum", "price_n_sum", "price_r_sum")],
        "from N",
        "parts not A",
    )


@query("SELECT user_id AS value FROM events GROUP BY 1 ORDER BY count(*) DESC, user_id LIMIT 10")
def column_values_topk(t: Tables) -> DataFrame:
    """the ten most frequent values."""
    return column_values(t.events, "user_id", max_records=10)


@query(
    """
    SELECT l_suppkey AS value FROM lineitem WHERE l_returnflag = 'R'
    GROUP BY 1 ORDER BY min(l_shipdate) ASC, max(l_quantity) DESC, l_suppkey LIMIT 25
    """
)
def column_values_where(t: Tables) -> DataFrame:
    """F1 with a filter and an order by other aggregates."""
    return column_values(
        t.lineitem,
        "l_suppkey",
        order_by=[(F.min("l_shipdate"), "asc"), (F.max("l_quantity"), "desc")],
        max_records=25,
        where="l_returnflag = 'R'",
    )


@query(
    """
    SELECT CAST(n AS BIGINT) AS generated_number
    FROM (SELECT unnest(generate_series(1, (SELECT max(o_orderkey) FROM orders))) AS n)
    WHERE n NOT IN (SELECT l_orderkey FROM lineitem)
    """
)
def number_gaps(t: Tables) -> DataFrame:
    """Numbers up to the largest order key for which there is no line."""
    upper = t.orders.agg(F.max("o_orderkey").alias("n")).first().n
    used = t.lineitem.select(F.col("l_orderkey").alias("generated_number")).distinct()
    return number_series(t.spark, upper).join(used, "generated_number", "left_anti")


@query(
    """
    WITH s AS (SELECT CAST(unnest(generate_series(lo, hi - INTERVAL 1 MONTH, INTERVAL 1 MONTH)) AS DATE) AS date_month
               FROM (SELECT date_trunc('month', min(o_orderdate)) AS lo, date_trunc('month', max(o_orderdate)) AS hi FROM orders))
    SELECT date_month, CAST(count(o_orderkey) AS BIGINT) AS orders
    FROM s LEFT JOIN orders ON date_trunc('month', o_orderdate) = date_month GROUP BY 1
    """
)
def date_spine_months(t: Tables) -> DataFrame:
    """Whole months from the first up to, not including, the last, with the orders of each."""
    month = F.date_trunc("month", "o_orderdate").cast("date")
    span = t.orders.agg(F.min(month).alias("lo"), F.max(month).alias("hi")).first()
    per_month = t.orders.groupBy(month.alias("date_month")).agg(F.count("o_orderkey").alias("orders"))
    return (
        date_spine(t.spark, "month", span.lo, span.hi)
        .join(per_month, "date_month", "left")
        .select("date_month", F.coalesce("orders", F.lit(0)).cast("bigint").alias("orders"))
    )


@query(
    """
    WITH m AS (SELECT user_id, CAST(min(ts) AS DATE) AS lo, CAST(max(ts) AS DATE) AS hi FROM events GROUP BY 1),
         g AS (SELECT user_id, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS full_date FROM m),
         e AS (SELECT user_id, CAST(ts AS DATE) AS full_date, count(*) AS n FROM events GROUP BY 1, 2)
    SELECT user_id, full_date, CAST(coalesce(n, 0) AS BIGINT) AS events FROM g LEFT JOIN e USING (user_id, full_date)
    """
)
def member_calendar_grid(t: Tables) -> DataFrame:
    """Every user on every day between the first and last event, with the day's count."""
    day = F.to_date("ts")
    members = t.events.groupBy("user_id").agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    counts = t.events.groupBy("user_id", day.alias("full_date")).agg(F.count(F.lit(1)).alias("n"))
    return (
        with_days(members, F.col("lo"), F.col("hi"))
        .join(counts, ["user_id", "full_date"], "left")
        .select("user_id", "full_date", F.coalesce("n", F.lit(0)).cast("bigint").alias("events"))
    )


@query(
    """
    WITH a AS (SELECT o_orderkey, o_custkey, nullif(o_orderpriority, '5-LOW') AS priority FROM orders),
         b AS (SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS priority, o_totalprice FROM orders)
    SELECT * FROM a NATURAL JOIN b
    """
)
def natural_self_join(t: Tables) -> DataFrame:
    """Rows with a null in a shared column are lost."""
    priority = F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("priority")
    return natural_join(
        t.orders.select("o_orderkey", "o_custkey", priority), t.orders.select("o_orderkey", priority, "o_totalprice")
    ).select("o_orderkey", "o_custkey", "priority", "o_totalprice")


@query(
    """
    SELECT o_orderkey, o_totalprice, (SELECT max(l_extendedprice) FROM lineitem) AS top_line,
           CAST('1990-01-01' AS TIMESTAMP) AS fallback
    FROM orders WHERE o_totalprice > (SELECT avg(CAST(o_totalprice AS DECIMAL(12, 2))) FROM orders)
    """
)
def scalar_threshold(t: Tables) -> DataFrame:
    """Values of other queries inside this one; a query without rows gives its default."""
    mean = single_value(t.orders.agg(F.avg(F.col("o_totalprice").cast("decimal(12,2)")).cast("double").alias("m")))
    none = single_value(t.orders.filter("o_orderkey < 0").select("o_orderdate"), "1990-01-01")
    return t.orders.filter(F.col("o_totalprice") > mean).select(
        "o_orderkey",
        "o_totalprice",
        single_value(t.lineitem.agg(F.max("l_extendedprice"))).alias("top_line"),
        none.alias("fallback"),
    )


@query(
    """
    WITH g AS (SELECT o_orderpriority, nullif(o_orderpriority, '3-MEDIUM') AS label, count(*) AS n FROM orders GROUP BY 1)
    SELECT array_to_string(list(o_orderpriority ORDER BY o_orderpriority), '|') AS o_orderpriority,
           array_to_string(list(coalesce(label, 'null') ORDER BY o_orderpriority), '|') AS label,
           array_to_string(list(n ORDER BY o_orderpriority), '|') AS n
    FROM g
    """
)
def columnwise_collect(t: Tables) -> DataFrame:
    """A small aggregate turned into one array per column, nulls kept; shown as joined text."""
    small = t.orders.groupBy("o_orderpriority").agg(
        F.first(F.nullif(F.col("o_orderpriority"), F.lit("3-MEDIUM"))).alias("label"), F.count(F.lit(1)).alias("n")
    )
    columns = columnwise(small, ["o_orderpriority"])
    return columns.select(*[F.array_join(F.col(c).cast("array<string>"), "|", "null").alias(c) for c in columns.columns])


@query(
    """
    WITH a AS (SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'A'),
         b AS (SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R')
    SELECT 'a_minus_b' AS which_diff, * FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
    UNION ALL SELECT 'b_minus_a', * FROM (SELECT * FROM b EXCEPT SELECT * FROM a)
    """
)
def two_way_difference(t: Tables) -> DataFrame:
    """Part-supplier pairs on one side only, both directions in one grouping."""
    pairs = t.lineitem.select("l_partkey", "l_suppkey", "l_returnflag")
    a = pairs.filter("l_returnflag = 'A'").drop("l_returnflag")
    return two_way_except(a, pairs.filter("l_returnflag = 'R'").drop("l_returnflag"))


@query(
    """
    WITH d AS (SELECT DISTINCT user_id, ts FROM events)
    SELECT user_id, ts, lead(ts) OVER w AS next_ts, lag(ts) OVER w AS previous_ts, lead(ts) OVER w IS NULL AS is_last
    FROM d WINDOW w AS (PARTITION BY user_id ORDER BY ts)
    """
)
def neighbours(t: Tables) -> DataFrame:
    """Next and previous event time per user, both from one pass over the slices."""
    times = t.events.select("user_id", "ts").distinct()
    both = with_neighbours(times, ["user_id"], ["ts"], following="_next", previous="_previous")
    return both.select(
        "user_id",
        "ts",
        F.col("_next.o0").alias("next_ts"),
        F.col("_previous.o0").alias("previous_ts"),
        F.col("_next").isNull().alias("is_last"),
    )


@query(
    """
    WITH d AS (SELECT DISTINCT ts FROM events)
    SELECT ts, lead(ts) OVER w AS next_ts FROM d WINDOW w AS (ORDER BY ts)
    """
)
def neighbours_sliced(t: Tables) -> DataFrame:
    """E3 over the whole table as one group: slices of a second, of a day, and their edges."""
    times = t.events.select("ts").distinct()
    ahead = with_neighbour(times, [], ["ts"], "_next")
    return ahead.select("ts", F.col("_next.o0").alias("next_ts"))


@query("SELECT DISTINCT source, lang, md5(source) AS source_key FROM documents")
def distinct_members(t: Tables) -> DataFrame:
    """D1, H10."""
    return distinct_pairs(t.documents, F.col("source"), F.col("lang"), hash_key("source").alias("source_key"))
