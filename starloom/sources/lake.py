"""Paths, sinks and the catalog (A5, A6, A8, A10, A11); full refreshes are in `sources.versions`."""

from __future__ import annotations

import re
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from starloom.operators.columns import quoted
from starloom.sources.versions import current_path, replace_rows

PARTITIONS = ["source", "ingestion_date"]


def day_path(root: str, source: str, day: date) -> str:
    """Folder of one source and day under any base URI (`file://`, `s3a://`, `hdfs://`, ...).

    Credentials and committers of object stores are session settings (`spark.hadoop.fs.s3a.*`).
    """
    return f"{root.rstrip('/')}/source={source}/ingestion_date={day.isoformat()}"


def write_day(df: DataFrame, root: str, source: str, day: date) -> None:
    """A5: replace one source and day; an empty result empties the day."""
    df.drop(*PARTITIONS).write.mode("overwrite").parquet(day_path(root, source, day))


def write_partitions(df: DataFrame, root: str) -> None:
    """A5 for many sources and days at once: only the partitions present in `df` are replaced.

    Rows are first brought together by partition, so a task writes few folders. Adaptive execution
    splits a day that is much larger than the others.
    """
    (
        df.hint("rebalance", *[F.col(c) for c in PARTITIONS])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PARTITIONS)
        .parquet(root)
    )


def conform_to(df: DataFrame, schema: StructType) -> DataFrame:
    """The declared columns in declared order, matched by name without regard to case."""
    by_name = {c.lower(): c for c in df.columns}
    return df.select(
        [
            (F.col(by_name[f.name.lower()]) if f.name.lower() in by_name else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in schema
        ]
    )


def clustered(df: DataFrame, column: str) -> DataFrame:
    """Rows of like values close together, so that file statistics let readers skip files.

    Worth its shuffle for facts of many million rows that are read by date. Adaptive execution splits a
    value that is much more frequent than the others.
    """
    return df.hint("rebalance", F.col(column)).sortWithinPartitions(column)


def enforced(df: DataFrame, schema: StructType, table: str) -> DataFrame:
    """A10: the declared columns, where a null in a column that is declared NOT NULL stops the job that writes it.

    The test is part of the write's own projection: no scan of its own, and no row that breaks the declaration is
    ever committed.
    """
    rows = conform_to(df, schema)
    return rows.select(
        [
            F.col(f.name)
            if f.nullable
            else F.coalesce(F.col(f.name), F.raise_error(F.lit(f"null in {table}.{f.name}, declared NOT NULL"))).alias(f.name)
            for f in schema
        ]
    )


def create_schema(spark: SparkSession, schema: str, location: str | None = None) -> str:
    """Make the schema, named verbatim but trimmed and upper-cased; returns the name."""
    schema = schema.strip().upper()
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(schema)}{at}")
    return schema


def publish(
    df: DataFrame, schema: str, name: str, location: str | None = None, schema_location: str | None = None
) -> DataFrame:
    """Materialize as a table of the schema named, which is taken upper-cased and verbatim.

    With a `location`, rows are written aside as a new version of the table there, and the catalog entry is switched
    to it when they are complete. Without one, Spark's catalog keeps the rows, written aside under another name first.
    """
    spark = df.sparkSession
    schema = create_schema(spark, schema, schema_location)
    table = f"{quoted(schema)}.{quoted(name)}"
    if location:
        replace_rows(df, location)
        at = current_path(spark, location)
        known = spark.catalog.getTable(table).tableType if spark.catalog.tableExists(table) else None
        if known == "EXTERNAL" and spark.table(table).dtypes == df.dtypes:
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{at.replace(chr(39), chr(92) + chr(39))}'")
            spark.catalog.refreshTable(table)
            return spark.table(table)
        spark.sql(f"DROP TABLE IF EXISTS {table}")  # an external table keeps its files
        spark.catalog.createTable(table, path=at, source="parquet", schema=df.schema)
        return spark.table(table)
    if not spark.catalog.tableExists(table):
        df.write.saveAsTable(table)
        return spark.table(table)
    aside = f"{quoted(schema)}.{quoted(name + '__next')}"
    df.write.mode("overwrite").saveAsTable(aside)
    spark.sql(f"DROP TABLE {table}")
    spark.sql(f"ALTER TABLE {aside} RENAME TO {table}")
    return spark.table(table)


def publish_view(spark: SparkSession, schema: str, name: str, query: str, schema_location: str | None = None) -> DataFrame:
    """A view of the catalog, which stores the query and evaluates it whenever the view is read."""
    schema = create_schema(spark, schema, schema_location)
    view = f"{quoted(schema)}.{quoted(name)}"
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS {query}")
    return spark.table(view)


def publish_staging(df: DataFrame, schema: str, name: str, location: str, schema_location: str | None = None) -> DataFrame:
    """Staging as a view of its schema over its newest version; replacing the view is the switch."""
    written = replace_rows(df, location)
    at = current_path(df.sparkSession, location).replace("`", "``")
    publish_view(df.sparkSession, schema, name, f"SELECT * FROM parquet.`{at}`", schema_location)
    return written


def like_pattern(pattern: str) -> re.Pattern:
    """A LIKE pattern, with `\\` before a sign that stands for itself, as a regular expression in any case."""
    signs = re.findall(r"\\.|.", pattern, re.S)
    parts = [re.escape(c[-1]) if len(c) > 1 else {"%": ".*", "_": "."}.get(c, re.escape(c)) for c in signs]
    return re.compile("".join(parts), re.I | re.S)


def matching_tables(
    spark: SparkSession, schema_pattern: str, table_pattern: str, exclude: str = ""
) -> DataFrame:
    """Catalog tables whose schema and name match LIKE patterns in any case, minus an exclude pattern."""
    wanted = like_pattern(schema_pattern)
    rows = [
        (db.name, t.name, {"MANAGED": "table", "EXTERNAL": "external"}.get(t.tableType, "view"))
        for db in spark.catalog.listDatabases()
        if wanted.fullmatch(db.name)  # other databases aren't asked for their tables
        for t in spark.catalog.listTables(db.name)
        if not t.isTemporary
    ]
    listed = spark.createDataFrame(rows, "table_schema string, table_name string, table_type string")
    return listed.filter(
        F.ilike("table_schema", F.lit(schema_pattern))
        & F.ilike("table_name", F.lit(table_pattern))
        & ~F.ilike("table_name", F.lit(exclude))
    ).distinct()


def tables_with_prefix(spark: SparkSession, schema: str, prefix: str, exclude: str = "") -> DataFrame:
    """The same by the beginning of the name."""
    return matching_tables(spark, schema, f"{prefix}%", exclude)


def open_tables(spark: SparkSession, found: DataFrame) -> dict[str, DataFrame]:
    """The frames behind the rows of `matching_tables`, by qualified name (names only reach the driver)."""
    names = [f"{r.table_schema}.{r.table_name}" for r in found.orderBy("table_schema", "table_name").collect()]
    return {n: spark.table(".".join(f"`{p}`" for p in n.split("."))) for n in names}


def column_or_null(df: DataFrame, name: str, kind: str) -> Column:
    """B1: the column, or a typed null where the frame lacks it."""
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def field_or_null(df: DataFrame, parent: str, child: str, kind: str) -> Column:
    """B2: a nested field, or a typed null where the frame lacks the parent.

    A parent without that child is a mistake of the caller and stays an error.
    """
    return F.col(f"{parent}.{child}") if parent in df.columns else F.lit(None).cast(kind)


def require_root(df: DataFrame, name: str) -> DataFrame:
    """Stop when the feed lacks its root field, in the schema or in every row.

    The row test looks for one non-null value only.
    """
    if name not in df.columns or df.filter(F.col(name).isNotNull()).isEmpty():
        raise ValueError(f"expected '{name}' in the feed; got columns {df.columns}")
    return df


def empty_frame(spark: SparkSession, schema: StructType) -> DataFrame:
    """No rows, declared types."""
    return spark.createDataFrame([], schema)


def union_sources(frames: list[DataFrame]) -> DataFrame:
    """Frames of one shape, matched by name."""
    return reduce(lambda a, b: a.unionByName(b), frames)
