"""Every check on a failing case (its violations as rows), and verdicts for passing and turned-around ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starloom import checks as k
from starloom.queries.registry import Tables, query


def _missing_segment():
    return F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))


@query("SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS segment FROM customer WHERE c_mktsegment = 'BUILDING'")
def chk_not_null(t: Tables) -> DataFrame:
    """K1."""
    return k.not_null(t.customer.select("c_custkey", _missing_segment().alias("segment")), "segment").violations


@query("SELECT o_custkey AS unique_field, count(*) AS n_records FROM orders WHERE o_custkey > 10 GROUP BY 1 HAVING count(*) > 1")
def chk_unique(t: Tables) -> DataFrame:
    """K2; a null never repeats."""
    return k.unique(t.orders, F.when(F.col("o_custkey") > 10, F.col("o_custkey"))).violations


@query(
    """
    SELECT l_suppkey AS id, CAST(NULL AS BIGINT) AS right_id FROM lineitem
    WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)
    """
)
def chk_relationships(t: Tables) -> DataFrame:
    """Every line of a supplier that the other side lacks."""
    return k.relationships(t.lineitem, "l_suppkey", t.supplier.filter("s_acctbal > 0"), "s_suppkey").violations


@query(
    """
    SELECT nullif(event_type, 'view') AS value_field, count(*) AS n_records FROM events
    WHERE nullif(event_type, 'view') NOT IN ('click', 'signup') GROUP BY 1
    """
)
def chk_accepted_values(t: Tables) -> DataFrame:
    """K4; null passes."""
    return k.accepted_values(
        t.events, F.nullif(F.col("event_type"), F.lit("view")), ["click", "signup"]
    ).violations


@query(
    """
    SELECT o_custkey AS id, CAST(NULL AS BIGINT) AS right_id FROM orders WHERE o_orderstatus <> 'F'
      AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'MACHINERY')
    """
)
def chk_relationships_where(t: Tables) -> DataFrame:
    """K5."""
    return k.relationships_where(
        t.orders,
        "o_custkey",
        t.customer,
        "c_custkey",
        from_condition="o_orderstatus <> 'F'",
        to_condition="c_mktsegment <> 'MACHINERY'",
    ).violations


@query(
    """
    SELECT l_orderkey, nullif(l_linenumber, 3) AS line FROM lineitem GROUP BY ALL HAVING count(*) > 1
    """
)
def chk_unique_combination(t: Tables) -> DataFrame:
    """Nulls equal each other."""
    rows = t.lineitem.select("l_orderkey", F.nullif(F.col("l_linenumber"), F.lit(3)).alias("line"))
    return k.unique_combination_of_columns(rows, ["l_orderkey", "line"]).violations


@query(
    """
    WITH a AS (SELECT l_partkey, count(*) AS num_rows FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1),
         b AS (SELECT l_partkey, count(*) AS num_rows FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)
    (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL (SELECT * FROM b EXCEPT SELECT * FROM a)
    """
)
def chk_cardinality_equality(t: Tables) -> DataFrame:
    """K7, G4."""
    return k.cardinality_equality(
        t.lineitem, "l_partkey", t.lineitem.filter("l_returnflag = 'R'"), "l_partkey", where="l_returnflag = 'A'"
    ).violations


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE NOT (nullif(l_quantity, 50) + l_tax <= 49)")
def chk_expression_is_true(t: Tables) -> DataFrame:
    """K8: the column form; a null expression passes."""
    return (
        k.expression_is_true(t.lineitem, "+ l_tax <= 49", column="nullif(l_quantity, 50)")
        .violations.select("l_orderkey", "l_linenumber", "l_quantity")
    )


@query(
    """
    WITH a AS (SELECT nullif(o_orderpriority, '5-LOW') AS p, count(*) AS count_a FROM orders GROUP BY 1),
         b AS (SELECT nullif(o_orderpriority, '5-LOW') AS p, count(*) AS count_b FROM orders
               WHERE o_orderstatus <> 'P' AND o_orderpriority <> '1-URGENT' GROUP BY 1)
    SELECT a.p AS p_a, b.p AS p_b, count_a, count_b, abs(count_a - count_b) AS diff_count FROM a FULL JOIN b ON a.p = b.p
    """
)
def chk_equal_rowcount(t: Tables) -> DataFrame:
    """K9, C4: one-sided and null groups have no difference."""
    rows = t.orders.withColumn("p", F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")))
    other = rows.filter("o_orderstatus <> 'P' AND o_orderpriority <> '1-URGENT'")
    return k.equal_rowcount(rows, other, ["p"]).violations


@query(
    """
    WITH a AS (SELECT l_returnflag AS f, count(*) AS n FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1),
         b AS (SELECT l_returnflag AS f, count(*) AS m FROM lineitem WHERE l_linestatus = 'O' AND l_returnflag <> 'N' GROUP BY 1)
    SELECT a.f AS f_a, b.f AS f_b, n AS count_our_model, m AS count_comparison_model,
           CASE WHEN n > m THEN n - m WHEN n = m THEN 1 ELSE 0 END AS row_count_delta
    FROM a FULL JOIN b ON a.f = b.f
    """
)
def chk_fewer_rows_than(t: Tables) -> DataFrame:
    """K10."""
    lines = t.lineitem.withColumnRenamed("l_returnflag", "f")
    return k.fewer_rows_than(
        lines, lines.filter("l_linestatus = 'O' AND f <> 'N'"), ["f"], where="l_linestatus = 'F'"
    ).violations


@query(
    """
    WITH a AS (SELECT l_orderkey, l_partkey, round(l_extendedprice, 1) AS l_extendedprice FROM lineitem),
         b AS (SELECT l_orderkey, l_partkey, round(CASE WHEN l_linenumber = 2 THEN l_extendedprice + 1 ELSE l_extendedprice END, 1) AS l_extendedprice
               FROM lineitem WHERE l_linenumber <> 7)
    SELECT 'a_minus_b' AS which_diff, * FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
    UNION ALL SELECT 'b_minus_a', * FROM (SELECT * FROM b EXCEPT SELECT * FROM a)
    """
)
def chk_equality(t: Tables) -> DataFrame:
    """Chosen columns, rounded."""
    changed = t.lineitem.filter("l_linenumber <> 7").withColumn(
        "l_extendedprice",
        F.when(F.col("l_linenumber") == 2, F.col("l_extendedprice") + 1).otherwise(F.col("l_extendedprice")),
    )
    return k.equality(
        t.lineitem, changed, compare_columns=["l_orderkey", "l_partkey", "l_extendedprice"], precision=1
    ).violations


@query(
    """
    SELECT user_id, max(ts) AS most_recent, TIMESTAMP '2024-01-30 12:00:00' AS threshold FROM events
    GROUP BY 1 HAVING max(ts) < TIMESTAMP '2024-01-30 12:00:00'
    """
)
def chk_recency(t: Tables) -> DataFrame:
    """Users without an event in the twelve hours before the moment given."""
    as_of = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    return k.recency(t.events, "ts", "hour", 12, group_by=["user_id"], as_of=as_of).violations


@query(
    """
    SELECT c_nationkey, c_mktsegment, CAST(count(CASE WHEN c_acctbal < 0 THEN c_acctbal END) AS BIGINT) AS filler_column
    FROM customer GROUP BY 1, 2 HAVING count(CASE WHEN c_acctbal < 0 THEN c_acctbal END) = 0
    """
)
def chk_at_least_one(t: Tables) -> DataFrame:
    """Groups of customers none of whom is in debt."""
    rows = t.customer.withColumn("debt", F.when(F.col("c_acctbal") < 0, F.col("c_acctbal")))
    return k.at_least_one(rows, "debt", ["c_nationkey", "c_mktsegment"]).violations


@query(
    """
    SELECT l_orderkey, CAST(count(DISTINCT nullif(l_returnflag, 'A')) AS BIGINT) AS filler_column FROM lineitem
    GROUP BY 1 HAVING count(DISTINCT nullif(l_returnflag, 'A')) = 1
    """
)
def chk_not_constant(t: Tables) -> DataFrame:
    """K14, D3."""
    rows = t.lineitem.select("l_orderkey", F.nullif(F.col("l_returnflag"), F.lit("A")).alias("flag"))
    return k.not_constant(rows, "flag", ["l_orderkey"]).violations


@query(
    """
    SELECT l_suppkey, round(p, 8) AS not_null_proportion
    FROM (SELECT l_suppkey, count(nullif(l_returnflag, 'A')) / count(*) AS p FROM lineitem GROUP BY 1)
    WHERE p < 0.66 OR p > 0.7
    """
)
def chk_not_null_proportion(t: Tables) -> DataFrame:
    """K15, D5."""
    found = k.not_null_proportion(
        t.lineitem, F.nullif(F.col("l_returnflag"), F.lit("A")), 0.66, 0.7, ["l_suppkey"]
    ).violations
    return found.withColumn("not_null_proportion", F.round("not_null_proportion", 8))


@query("SELECT DISTINCT event_type AS value_field FROM events WHERE event_type IN ('error', 'crash')")
def chk_not_accepted_values(t: Tables) -> DataFrame:
    """K16."""
    return k.not_accepted_values(t.events, "event_type", ["error", "crash"]).violations


@query("SELECT trim(CASE WHEN lang = 'de' THEN '   ' WHEN lang = 'fr' THEN NULL ELSE text END) AS body FROM documents WHERE lang = 'de'")
def chk_not_empty_string(t: Tables) -> DataFrame:
    """K17."""
    lang = F.col("lang")
    body = F.when(lang == "de", F.lit("   ")).when(lang != "fr", F.col("text"))
    return k.not_empty_string(t.documents.select(body.alias("body")), "body").violations


@query(
    """
    SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
    WHERE l_returnflag <> 'N' AND (NOT (nullif(l_quantity, 1) > 2) OR NOT (nullif(l_quantity, 1) < l_linenumber * 10))
    """
)
def chk_accepted_range(t: Tables) -> DataFrame:
    """Exclusive bounds, one of them a column; a pre-filter; null passes."""
    return k.accepted_range(
        t.lineitem,
        F.nullif(F.col("l_quantity"), F.lit(1)),
        min_value=2,
        max_value=F.col("l_linenumber") * 10,
        inclusive=False,
        where="l_returnflag <> 'N'",
    ).violations.select("l_orderkey", "l_linenumber", "l_quantity")


@query(
    """
    WITH w AS (SELECT user_id, CAST(ts AS DATE) AS "day", lag(CAST(ts AS DATE)) OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE)) AS previous_day
               FROM events)
    SELECT * FROM w WHERE NOT ("day" = previous_day + INTERVAL 1 DAY)
    """
)
def chk_sequential_values(t: Tables) -> DataFrame:
    """Days per user that do not follow the day before, repeated days included."""
    days = t.events.select("user_id", F.to_date("ts").alias("day"))
    return k.sequential_values(days, "day", 1, "day", ["user_id"]).violations


@query(
    """
    WITH w AS (SELECT o_custkey, lag(o_custkey) OVER (ORDER BY o_custkey) AS previous_o_custkey FROM orders)
    SELECT * FROM w WHERE NOT (o_custkey = previous_o_custkey + 1)
    """
)
def chk_sequential_values_ungrouped(t: Tables) -> DataFrame:
    """K19 over the whole table as one sequence, spread over slices."""
    return k.sequential_values(t.orders, "o_custkey").violations


@query(
    """
    WITH w AS (SELECT o_custkey AS partition_by_col, o_orderdate AS lower_bound,
                      o_orderdate + INTERVAL 60 DAY AS upper_bound FROM orders),
         x AS (SELECT *, lead(lower_bound) OVER (PARTITION BY partition_by_col ORDER BY lower_bound, upper_bound) AS next_lower_bound,
                      lead(1) OVER (PARTITION BY partition_by_col ORDER BY lower_bound, upper_bound) IS NULL AS is_last_record FROM w),
         y AS (SELECT *, coalesce(lower_bound < upper_bound, false) AS lower_bound_less_than_upper_bound,
                      coalesce(upper_bound <= next_lower_bound, is_last_record, false) AS upper_bound_less_than_or_equal_to_next_lower_bound FROM x)
    SELECT * FROM y WHERE NOT (lower_bound_less_than_upper_bound AND upper_bound_less_than_or_equal_to_next_lower_bound)
    """
)
def chk_exclusive_ranges(t: Tables) -> DataFrame:
    """Order periods of sixty days that overlap the customer's next one."""
    return k.mutually_exclusive_ranges(
        t.orders, "o_orderdate", "o_orderdate + INTERVAL 60 DAY", partition_by="o_custkey"
    ).violations


@query(
    """
    WITH w AS (SELECT l_shipdate AS lower_bound, CASE WHEN l_linenumber = 7 THEN NULL ELSE l_shipdate + INTERVAL 1 DAY * l_linenumber END AS upper_bound
               FROM lineitem),
         x AS (SELECT *, lead(lower_bound) OVER (ORDER BY lower_bound NULLS LAST, upper_bound NULLS LAST) AS next_lower_bound,
                      lead(1) OVER (ORDER BY lower_bound NULLS LAST, upper_bound NULLS LAST) IS NULL AS is_last_record FROM w),
         y AS (SELECT *, coalesce(lower_bound <= upper_bound, false) AS lower_bound_less_than_or_equal_to_upper_bound,
                      coalesce(upper_bound = next_lower_bound, is_last_record, false) AS upper_bound_equal_to_next_lower_bound FROM x)
    SELECT * FROM y WHERE NOT (lower_bound_less_than_or_equal_to_upper_bound AND upper_bound_equal_to_next_lower_bound)
    """
)
def chk_exclusive_ranges_sliced(t: Tables) -> DataFrame:
    """K20 without gaps over the whole table as one partition, with open ends and equal ranges, spread over slices."""
    return k.mutually_exclusive_ranges(
        t.lineitem,
        "l_shipdate",
        "CASE WHEN l_linenumber <> 7 THEN l_shipdate + l_linenumber * INTERVAL 1 DAY END",
        gaps="not_allowed",
        zero_length_range_allowed=True,
    ).violations


@query(
    """
    SELECT doc_id, n_chars, CAST(length(text) AS BIGINT) AS expected FROM documents
    WHERE nullif(n_chars, 100) <> CASE WHEN lang <> 'fr' THEN length(text) ELSE NULL END + CASE WHEN lang = 'es' THEN 1 ELSE 0 END
    """
)
def chk_assert_equal(t: Tables) -> DataFrame:
    """K21; null on either side passes."""
    lang = F.col("lang")
    return k.assert_equal(
        t.documents.withColumn("expected", F.length("text").cast("bigint")),
        F.nullif(F.col("n_chars"), F.lit(100)),
        F.when(lang != "fr", F.col("expected")) + F.when(lang == "es", 1).otherwise(0),
    ).violations.select("doc_id", "n_chars", "expected")


@query(
    """
    WITH f("check", failures) AS (
        SELECT 'orders key', (SELECT count(*) - count(DISTINCT o_orderkey) FROM orders)
        UNION ALL SELECT 'lines have orders', (SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders))
        UNION ALL SELECT 'same table', 0
        UNION ALL SELECT 'row surplus', (SELECT (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM orders))
        UNION ALL SELECT 'turned around', (SELECT count(*) FROM customer WHERE c_mktsegment = 'BUILDING')
        UNION ALL SELECT 'warn only', (SELECT count(*) FROM lineitem WHERE l_discount > 0.09)
        UNION ALL SELECT 'old events', 0
        UNION ALL SELECT 'some value', 0
        UNION ALL SELECT 'no value', 1
        UNION ALL SELECT 'columns', 2)
    SELECT "check", CAST(failures AS BIGINT) AS failures,
           CASE WHEN "check" = 'turned around' THEN CASE WHEN failures < 1 THEN 'error' ELSE 'pass' END
                WHEN "check" = 'warn only' THEN CASE WHEN failures > 100 THEN 'warn' ELSE 'pass' END
                WHEN failures <> 0 THEN 'error' ELSE 'pass' END AS status
    FROM f
    """
)
def chk_verdicts(t: Tables) -> DataFrame:
    """K23 with K2, K3, K10-K13, K18, K22, C5, F2: passing checks, thresholds, severity, and a check turned around."""
    segment = t.customer.select(_missing_segment().alias("segment"))
    return k.verdicts(
        [
            k.unique(t.orders, "o_orderkey").verdict(label="orders key"),
            k.relationships(t.lineitem, "l_orderkey", t.orders, "o_orderkey").verdict(label="lines have orders"),
            k.equality(t.customer, t.customer).verdict(label="same table"),
            k.fewer_rows_than(t.lineitem, t.orders).verdict(label="row surplus"),
            k.not_null(segment, "segment").verdict(error_if="<1", warn_if="<0", label="turned around"),
            k.accepted_range(t.lineitem, "l_discount", max_value=0.09).verdict(
                severity="warn", warn_if="> 100", label="warn only"
            ),
            k.recency(
                t.events, "ts", "day", 1, ignore_time_component=True, as_of=F.lit("2024-01-31").cast("timestamp_ntz")
            ).verdict(label="old events"),
            k.at_least_one(t.orders, "o_totalprice").verdict(label="some value"),
            k.at_least_one(t.orders, "o_totalprice", where="o_totalprice < 0").verdict(label="no value"),
            k.expect_table_columns_to_match_set(t.region, ["R_REGIONKEY", "r_label"]).verdict(label="columns"),
        ]
    )
