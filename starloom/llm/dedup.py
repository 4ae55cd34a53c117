"""Exact deduplication with a streaming state that never expires (operator 9).

The texts are read as a file stream. Its keyed state lives on disk (RocksDB, checkpointed to the shared
folder) and holds, for each SHA-256 digest, how many rows have it, and of the row that stays its identifier
and its content locator (file and row number). The state is then read back as a table, and each row whose
digest occurs more than once is compared in full with the text at that locator. Rows that only share the
digest are grouped by their whole text instead, so the result doesn't rest on the digest.

Everything is DataFrame code. Rows of one digest are counted before they are shuffled; the join of rows with
the state has one state row per digest, and adaptive execution splits hot digests on the other side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.session import scratch_path
from starloom.sources.versions import delete_folder

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def sha256_digest(text: Column) -> Column:
    """The 32 bytes of SHA-256 of the text in UTF-8."""
    return F.unhex(F.sha2(text, 256))


def _located(df: DataFrame, id_col: str, text_col: str, digest) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return df.select(
        digest(text).alias("digest"),
        F.struct(
            F.col(id_col).alias("id"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.row_index").alias("row"),
        ).alias("place"),
    )


def collect_state(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    checkpoint: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest=sha256_digest,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Feed all new Parquet files below `path` into the state at `checkpoint`; the state as a table.

    Columns: digest, place (id, file, row of the row with the largest id; a null id is the smallest; among
    equal ids the last file and row), n. Called again with the same checkpoint, only files that have come
    since are read, and the state goes on. `files_per_batch` bounds one micro-batch; None takes all at once.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    # many small stores: no space is set aside in advance, and a commit writes its changes only
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage", "true")
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB", "256")
    # stores of an ended query are closed at the next round, so that later stages have their memory
    own.conf.set("spark.sql.streaming.stateStore.maintenanceInterval", "10s")
    own.conf.set("spark.sql.session.timeZone", "UTC")
    own.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    reader = own.readStream.schema(schema).option("maxFileAge", "36500d")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # a file stream takes a folder or a pattern; as a pattern, the path may also name a single file
    path = path.rstrip("/")
    rows = _located(reader.parquet(f"{path[:-1]}[{path[-1]}]"), id_col, text_col, digest)
    groups = rows.groupBy("digest").agg(F.max("place").alias("place"), F.count(F.lit(1)).alias("n"))
    query = (
        groups.writeStream.outputMode("update")
        .format("noop")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    state = spark.read.format("statestore").option("path", checkpoint).load()
    return state.select(
        F.col("key.digest").alias("digest"),
        F.col("value.max").alias("place"),
        F.col("value.count").alias("n"),
    )


def mark_copies(
    spark: SparkSession,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest=sha256_digest,
    checkpoint: str | None = None,
    files_per_batch: int | None = None,
    columns: list[str] | None = None,
    prefix: str = "dup_",
) -> DataFrame:
    """Every row of the Parquet files at `path` with its `columns` (None: all), and four more.

    `dup_digest` (binary), `dup_keep_id` (id of the row that stays), `dup_group_size`, `dup_kept` (true for
    exactly one row of each group of equal texts: the one with the largest id, and of repeated ids the last
    in file order). A null text counts as empty; a null id is smaller than any other. No rows give no rows.
    The four names begin with `prefix` and must not be among `columns`.
    """
    docs = spark.read.parquet(path)
    names = docs.columns if columns is None else columns
    taken = {f"{prefix}{c}" for c in ("digest", "keep_id", "group_size", "kept")} & {c.lower() for c in names}
    if taken:
        raise ValueError(f"columns {sorted(taken)} are in the table already")
    checkpoint = checkpoint or scratch_path(spark, "dedup-state")
    state = collect_state(spark, path, docs.schema, checkpoint, id_col, text_col, digest, files_per_batch)
    state = state.select(F.col("digest").alias("s_digest"), F.col("place").alias("s_place"), F.col("n").alias("s_n"))

    text = F.coalesce(F.col(text_col), F.lit(""))
    within = text_col in names  # then the text moves as one of the columns, and not twice
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("r"),
        *([] if within else [text.alias("text")]),
        digest(text).alias("digest"),
        F.struct(
            F.col(id_col).alias("id"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.row_index").alias("row"),
        ).alias("place"),
    )
    matched = rows.join(state, rows.digest == state.s_digest).drop("s_digest")
    moved = F.coalesce(F.col("r").getField(text_col), F.lit("")) if within else F.col("text")
    matched = matched.withColumn("text", F.when(F.col("s_n") > 1, moved))  # only hits are compared
    stored = scratch_path(spark, "dedup-rows")
    matched.write.parquet(stored)
    matched = spark.read.parquet(stored)

    # hits only: the full text of each against the text at the locator
    r_text = F.col("text")
    hits = matched.where("s_n > 1")
    kept_text = hits.where(F.col("place") == F.col("s_place")).select(
        F.col("digest").alias("k_digest"), r_text.alias("k_text")
    )
    checked = hits.join(kept_text, F.col("digest") == F.col("k_digest"))
    odd = checked.where(r_text != F.col("k_text"))
    odd_groups = (
        odd.groupBy("digest", r_text.alias("o_text"))
        .agg(F.max("place").alias("o_place"), F.count(F.lit(1)).alias("o_n"))
        .withColumnRenamed("digest", "o_digest")
    )
    odd_sums = odd_groups.groupBy("o_digest").agg(F.sum("o_n").alias("o_all")).withColumnRenamed("o_digest", "a_digest")

    def finished(df: DataFrame, place: Column, n: Column) -> DataFrame:
        return df.select(
            *[F.col(f"r.`{c}`").alias(c) for c in names],
            F.col("digest").alias(f"{prefix}digest"),
            place["id"].alias(f"{prefix}keep_id"),
            n.cast("long").alias(f"{prefix}group_size"),
            (F.col("place") == place).alias(f"{prefix}kept"),
        )

    alone = finished(matched.where("s_n = 1"), F.col("s_place"), F.col("s_n"))
    same = checked.where(r_text == F.col("k_text")).join(odd_sums, F.col("digest") == F.col("a_digest"), "left")
    same = finished(same, F.col("s_place"), F.col("s_n") - F.coalesce(F.col("o_all"), F.lit(0)))
    other = odd.join(odd_groups, (F.col("digest") == F.col("o_digest")) & (r_text == F.col("o_text")))
    other = finished(other, F.col("o_place"), F.col("o_n"))
    return alone.unionByName(same).unionByName(other)


def drop_copies(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with its columns.

    The rows are written once, since locators need files; that copy goes when the rows are beside their locators.
    """
    stored = scratch_path(spark, "dedup-input")
    docs.write.parquet(stored)
    prefix = "dup_"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix = f"_{prefix}"
    marked = mark_copies(spark, stored, id_col, text_col, prefix=prefix)
    delete_folder(spark, stored)  # what `marked` reads was written from it
    return marked.where(F.col(f"{prefix}kept")).select(*[F.col(f"`{c}`") for c in docs.columns])
