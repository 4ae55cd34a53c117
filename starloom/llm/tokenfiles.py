"""Token counts by scanning flat token files for the end-of-document id (operator 1).

A token file is a flat run of ids (little-endian unsigned 16 bits) with an end id behind each document and no
index. It is stored as numbered blocks of fixed size, cut wherever the size says. The scan finds the end ids of
each block by a vectorised search; a document that spans blocks is stitched by prefix sums over the blocks of
its file: how many ids and ends lie before a block, and where the last end before it is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.encode import encoder, text_groups
from starloom.llm.words import lean
from starloom.session import scratch_path

BLOCK_IDS = 1 << 19  # 1 MB
STORED = "file long, block long, ids binary, first_ordinal long, doc_ids array<long>"
TOKENIZER = "byte_bpe_50k.json"
END_ID = 50256


def write_token_files(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, tokenizer: str = TOKENIZER, block_ids: int = BLOCK_IDS
) -> None:
    """One token file for each task. Rows with `ids` are its blocks; rows with `doc_ids` name its documents in order.

    The names are no index: they say nothing of lengths or places. A null text counts as empty: its end alone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = TaskContext.get().partitionId()
        encode = encoder(tokenizer).encode
        rest, block, ordinal = np.zeros(0, "<u2"), 0, 0
        end = np.array([end_id], "<u4").tobytes()

        def rows(ids: list[bytes | None], first: int | None, names: pa.Array | None) -> pa.RecordBatch:
            n = len(ids)
            lists = pa.array([names.to_pylist() if names is not None else None] * n, pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays(
                [pa.array([file] * n, pa.int64()), pa.array([block + i if x is not None else None for i, x in enumerate(ids)], pa.int64()), pa.array(ids, pa.binary()), pa.array([first] * n, pa.int64()), lists],
                names=["file", "block", "ids", "first_ordinal", "doc_ids"],
            )

        for batch in batches:
            texts = batch.column(1).to_pylist()
            for lo, hi in text_groups(texts):
                content = end.join([*encode(texts[lo:hi]), b""])
                rest = np.append(rest, np.frombuffer(content, "<u4").astype("<u2"))
                yield rows([None], ordinal, batch.column(0).slice(lo, hi - lo))
                ordinal += hi - lo
                full = len(rest) // block_ids
                if full:
                    yield rows([rest[k * block_ids : (k + 1) * block_ids].tobytes() for k in range(full)], None, None)
                    block += full
                    rest = rest[full * block_ids :]
        encoder(tokenizer).forget()  # the worker stays, and later stages have its memory
        if len(rest):
            yield rows([rest.tobytes()], None, None)

    docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(lambda batches: lean(run(batches)), STORED).write.option("compression", "zstd").parquet(path)


def scan_blocks(blocks: DataFrame, end_id: int = END_ID) -> DataFrame:
    """file, ordinal (from 0), start (in the file), n_tokens (with the end id), ended of every document in `blocks`.

    `blocks` has file, block (ascending within a file) and ids. A file whose last id is no end has one more
    document, with `ended` false. Blocks may be of any size, also empty.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends, size = [], []
            for content in batch.column(2):
                ids = np.frombuffer(content.as_py() or b"", "<u2")
                ends.append(np.flatnonzero(ids == end_id))
                size.append(len(ids))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(size, pa.int64()), pa.array(ends, pa.list_(pa.int64()))], names=["file", "block", "size", "ends"]
            )

    found = blocks.select("file", "block", "ids").mapInArrow(search, "file long, block long, size long, ends array<long>")
    summed = found.selectExpr(
        "*",
        "sum(size) over (partition by file order by block) - size as begin",
        "sum(size(ends)) over (partition by file order by block) - size(ends) as n_before",
        "lead(block) over (partition by file order by block) is null as is_last",
    )
    # where the document that is open at the beginning of the block began: behind the last end of earlier blocks
    summed = summed.selectExpr(
        "*",
        "coalesce(max(if(size(ends) > 0, begin + element_at(ends, -1) + 1, null)) over "
        "(partition by file order by block rows between unbounded preceding and 1 preceding), 0L) as open_from",
    )
    closed = summed.select("file", "begin", "n_before", "open_from", "ends", F.posexplode("ends").alias("k", "at")).selectExpr(
        "file",
        "n_before + k as ordinal",
        "if(k = 0, open_from, begin + ends[k - 1] + 1) as start",
        "begin + at + 1 as stop",
    )
    tail = summed.where("is_last").selectExpr(
        "file",
        "n_before + size(ends) as ordinal",
        "if(size(ends) > 0, begin + element_at(ends, -1) + 1, open_from) as start",
        "begin + size as stop",
    )
    rows = closed.withColumn("ended", F.lit(True)).union(tail.where("stop > start").withColumn("ended", F.lit(False)))
    return rows.selectExpr("file", "ordinal", "start", "stop - start as n_tokens", "ended")


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the token files of `docs`, scan them, and name the documents: doc_id, file, ordinal, start, n_tokens.

    A null or empty text has 1 token, its end. Repeated rows and null ids are counted each for itself.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "token-files")
    write_token_files(docs, path, id_col, text_col)
    stored = spark.read.schema(STORED).parquet(path)
    counts = scan_blocks(stored.where("ids is not null"))
    names = stored.where("doc_ids is not null").select("file", "first_ordinal", F.posexplode("doc_ids").alias("k", id_col))
    names = names.select(F.col("file").alias("f"), (F.col("first_ordinal") + F.col("k")).alias("o"), id_col)
    joined = counts.join(names, (F.col("file") == F.col("f")) & (F.col("ordinal") == F.col("o")))
    return joined.select(id_col, "file", "ordinal", "start", "n_tokens")
