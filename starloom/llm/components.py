"""Connected components by alternating large and small stars, each round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.session import scratch_path


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """`edges` has two long columns, a and b. Returns node, component (the smallest node reachable).

    Nodes without an edge to another node are left out. Nodes of high degree are split by adaptive execution in
    the joins and pre-aggregated in the groupings. Each round is written, so a lost executor costs one round.
    """
    spark = edges.sparkSession

    def written(df: DataFrame) -> DataFrame:
        path = scratch_path(spark, "components")
        df.write.parquet(path)
        return spark.read.parquet(path)

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))")).first())

    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = mark(now)
    for _ in range(most_rounds):
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select("b", "a"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, F.col("u") == F.col("k")).select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "k")
        small = large.join(low, F.col("a") == F.col("k"))
        small = small.select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        now = written(small.select("e.a", "e.b").where("a <> b").distinct())
        done, seen = mark(now) == seen, mark(now)
        if done:
            roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
