"""Incremental load of new silver files into the raw tables."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from starloom.schemas import RAW_JOBS, RAW_SKILLS
from starloom.sources.lake import PARTITIONS, day_path
from starloom.sources.versions import delete_folder, make_folder

# A stream of files drops, without a word, what is older than this against the newest file.
NO_AGE_LIMIT = "365000d"

RAW_TABLES = {
    "raw_jobs": ("jobs", RAW_JOBS),
    "raw_job_skills": ("job_skills", RAW_SKILLS),
}


def _replace_partitions(spark: SparkSession, folder: str, target: str, schema: StructType, touched: list) -> None:
    """The partitions named, as the folder holds them now, in place of those of the target."""
    keys = [c for c in PARTITIONS if c in schema.fieldNames()]
    same = [reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.lit(row[k])) for k in keys]) for row in touched]
    rows = spark.read.schema(schema).parquet(folder).filter(reduce(lambda a, b: a | b, same))
    (
        rows.hint("rebalance", *keys)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(target)
    )


def load_new_files(
    spark: SparkSession,
    folder: str,
    target: str,
    progress: str,
    schema: StructType,
    files_per_batch: int = 1000,
) -> None:
    """Bring every source and day under `folder` that has files which earlier runs have not seen into `target`.

    The stream's progress log remembers files; a batch of new ones says which sources and days have changed, and these
    are written again as the folder holds them. So a day that was written again replaces its rows and doesn't add to
    them, a day whose files come in several batches is whole at the end, and a batch that is repeated after a failure
    changes nothing. Each overwrite is committed as a whole. Columns are matched by name in any case; a broken file
    stops the load. A backlog is taken in batches of bounded size, which also bounds the days that a batch names.

    A file's age never matters: late feeds, backfills and copies that keep their times are loaded too. The
    price is that the progress log keeps the name of every file ever loaded. A day that was emptied has no file with
    rows: see `drop_days`.
    """
    keys = [c for c in PARTITIONS if c in schema.fieldNames()]

    def replace(batch: DataFrame, batch_id: int) -> None:
        touched = batch.select(*keys).distinct().collect()
        if touched:
            _replace_partitions(spark, folder, target, schema, touched)

    query = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("maxFileAge", NO_AGE_LIMIT)
        .parquet(folder)
        .writeStream.foreachBatch(replace)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def drop_days(spark: SparkSession, target: str, days: list[tuple[str, date]]) -> None:
    """Take sources and days out of a raw table, whose feeds have become empty."""
    for source, day in days:
        delete_folder(spark, day_path(target, source, day))


def load_raw(spark: SparkSession, base: str, emptied: dict[str, list[tuple[str, date]]] | None = None) -> dict[str, DataFrame]:
    """L4: both raw tables brought up to date, then opened. `emptied` names, by table, days without rows."""
    out = {}
    for table, (folder, schema) in RAW_TABLES.items():
        target = f"{base}/raw/{table}"
        load_new_files(spark, f"{base}/silver/{folder}", target, f"{base}/raw/_progress/{table}", schema)
        drop_days(spark, target, (emptied or {}).get(table, []))
        make_folder(spark, target)
        out[table] = spark.read.schema(schema).parquet(target)
    return out
