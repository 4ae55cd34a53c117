"""Token ids in compressed, checksummed blocks: an adaptive context-mixing range coder (operator 8).

A block holds the ids of whole documents and can be read without any other. Its ids are cut into up to LANES
equal lanes that are coded in step, so one numpy operation codes an id of every lane; all lanes share one
model, which starts anew in each block and learns from all of them after each step. Each id is coded as

* whether it is the id last seen after the same two ids (order 2) or after the same one (order 1), with
  frequencies from a mix of adaptive counts for how sure both predictions have been; and if neither,
* by order 0: its high byte, then its low byte given the high one, with adaptive frequencies.

A record of the file: magic, version, number of ids, lanes, crc32 of the ids, length of each lane's code, the
codes. The records are stored as rows of a Parquet file, in ascending order of documents, with the documents'
ids and numbers of tokens beside them, so that any store that Spark writes to will do.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.encode import encoder, text_groups
from starloom.llm.words import lean
from starloom.session import scratch_path

MAGIC = b"SLRC"
VERSION = 2
LANES = 4096
BLOCK_IDS = 1 << 18
HEAD = struct.Struct("<4sHHIII")
#: Low end and range have 48 bits and leave in words of 16. Below 2^53, float division gives the exact quotient.
WORD, TOP, BOTTOM, FULL = 16, 1 << 32, 1 << 17, (1 << 48) - 1
CONTEXT_BITS = 17
STORED = "file long, block long, doc_ids array<long>, doc_tokens array<long>, record binary"
TOKENIZER = "byte_bpe_50k.json"


class Model:
    """The adaptive state of one block; coder and decoder make the same calls in the same order."""

    def __init__(self, lanes: int):
        #: id * 4 + how sure (0 to 3) behind each context; -4: none yet
        self.two = np.full(1 << CONTEXT_BITS, -4, np.int32)
        self.one = np.full(1 << 16, -4, np.int32)
        self.kind = np.tile(np.array([[4], [4], [8]], np.int64), 32)
        self.high = np.ones(256, np.int64)
        self.low = np.ones(1 << 16, np.int64)
        self.last = np.zeros(lanes, np.int32)
        self.last2 = np.zeros(lanes, np.int32)
        self.steps = 0
        self.high_cum = np.zeros(257, np.int64)
        #: one rising sequence for all rows, to search in: row h starts at h << 17
        self.row = (np.arange(256, dtype=np.int64) << 17)[:, None]
        self.low_cum = np.empty((256, 257), np.int64)
        self.low_cum[:, :1] = self.row
        self.low_flat = self.low_cum.ravel()
        self.refresh()

    def refresh(self) -> None:
        low = self.low.reshape(256, 256)
        while self.high.sum() > 50_000:
            self.high = (self.high + 1) >> 1
        while (over := low.sum(1) > 50_000).any():
            low[over] = (low[over] + 1) >> 1
        np.cumsum(self.high, out=self.high_cum[1:])
        self.high_of = np.repeat(np.arange(256), self.high)
        np.cumsum(low, axis=1, out=self.low_cum[:, 1:])
        self.low_cum[:, 1:] += self.row

    def predict(self) -> tuple[np.ndarray, ...]:
        """Order-2 and order-1 ids (-1: none) and the frequencies (order 2, order 1, neither) of each lane."""
        u, v = self.last2.view(np.uint32), self.last.view(np.uint32)
        self.place = (u * np.uint32(40503) + v * np.uint32(2654435761)) >> np.uint32(32 - CONTEXT_BITS)
        self.seen2, self.seen1 = self.two[self.place], self.one[self.last]
        a, b = self.seen2 >> 2, self.seen1 >> 2
        same = a == b
        self.context = (self.seen2 & 3) * 8 + (self.seen1 & 3) * 2 + same
        f0, f1, f2 = self.kind[:, self.context]
        return a, b, f0 * (a >= 0), f1 * ((b >= 0) & ~same), f2

    def order0(self, hi: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and frequency of the low byte, given the high one."""
        at = hi * 257 + lo
        start = self.low_flat[at]
        return start - (hi << 17), self.low_flat[at + 1] - start

    def total0(self, hi: np.ndarray) -> np.ndarray:
        return self.low_flat[hi * 257 + 256] - (hi << 17)

    def learn(self, ids: np.ndarray, kind: np.ndarray) -> None:
        self.kind += np.bincount(self.context + 32 * kind, minlength=96).reshape(3, 32) * 24
        while (over := self.kind.sum(0) > 50_000).any():
            self.kind[:, over] = (self.kind[:, over] + 1) >> 1
        for table, at, seen in ((self.two, self.place, self.seen2), (self.one, self.last, self.seen1)):
            # of lanes with one context the last one counts
            table[at] = np.where(seen >> 2 == ids, seen + ((seen & 3) < 3), ids << 2)
        miss = ids[kind == 2]
        self.high += np.bincount(miss >> 8, minlength=256) * 16
        np.add.at(self.low, miss, 16)
        self.last2, self.last = self.last, ids
        self.steps += 1
        if self.steps < 16 or self.steps % 4 == 0:
            self.refresh()


def _settle(low: np.ndarray, rng: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Shift ranges that are too narrow, in place; gives the places and the words that leave, round by round."""
    need = np.flatnonzero(rng < TOP)
    while len(need):
        x, r = low[need], rng[need]
        same = (x ^ (x + r)) < TOP
        go = np.flatnonzero(same | (r < BOTTOM))
        if not len(go):
            return
        need, x = need[go], x[go]
        r = np.where(same[go], r[go], -x & (BOTTOM - 1)) << WORD
        low[need], rng[need] = (x << WORD) & FULL, r
        yield need, x >> 32
        need = need[r < TOP]


class RangeEncoder:
    def __init__(self, lanes: int, most: int):
        self.low = np.zeros(lanes, np.int64)
        self.range = np.full(lanes, FULL, np.int64)
        self.out = np.zeros((lanes, most), "<u2")
        self.n = np.zeros(lanes, np.int64)

    def put(self, at: np.ndarray | slice, start: np.ndarray, freq: np.ndarray, total: np.ndarray | int) -> None:
        unit = (self.range[at] / total).astype(np.int64)
        low, rng = self.low[at] + unit * start, unit * freq
        for need, word in _settle(low, rng):
            lane = need if isinstance(at, slice) else at[need]
            n = self.n[lane]
            self.out[lane, n] = word
            self.n[lane] = n + 1
        self.low[at], self.range[at] = low, rng

    def finish(self) -> list[bytes]:
        # a range is never under 2^17, so two words settle it, whatever follows them
        value = self.low + (BOTTOM >> 1) - 1
        every = np.arange(len(self.n))
        self.out[every, self.n] = value >> 32
        self.out[every, self.n + 1] = (value >> WORD) & 0xFFFF
        return [row[:n].tobytes() for row, n in zip(self.out, (self.n + 2).tolist(), strict=True)]


class RangeDecoder:
    def __init__(self, words: np.ndarray, begin: np.ndarray):
        self.words = np.append(words, np.zeros(4, "<u2")).astype(np.int64)
        self.at = begin.copy()
        self.low = np.zeros(len(begin), np.int64)
        self.range = np.full(len(begin), FULL, np.int64)
        self.code = np.zeros(len(begin), np.int64)
        for _ in range(3):
            self.code = (self.code << WORD) | self.words[self.at]
            self.at += 1

    def target(self, at: np.ndarray | slice, total: np.ndarray | int) -> np.ndarray:
        self.unit = (self.range[at] / total).astype(np.int64)
        # the bounds matter for damaged records only
        return np.clip(((self.code[at] - self.low[at]) / self.unit).astype(np.int64), 0, total - 1)

    def take(self, at: np.ndarray | slice, start: np.ndarray, freq: np.ndarray) -> None:
        low, rng = self.low[at] + self.unit * start, self.unit * freq
        for need, _ in _settle(low, rng):
            lane = need if isinstance(at, slice) else at[need]
            place = self.at[lane]
            # a damaged record may ask for more than there is; its checksum then fails
            self.code[lane] = ((self.code[lane] << WORD) & FULL) | self.words[np.minimum(place, len(self.words) - 1)]
            self.at[lane] = place + 1
        self.low[at], self.range[at] = low, rng


def _shape(n: int) -> tuple[int, int]:
    """Lanes and steps for n ids."""
    lanes = max(1, min(LANES, n // 32))
    return lanes, -(-n // lanes)


def encode_block(ids: np.ndarray) -> bytes:
    """A record of the ids (unsigned, below 65536)."""
    ids = np.ascontiguousarray(ids, "<u4")
    n = len(ids)
    lanes, steps = _shape(n)
    grid = np.zeros(lanes * steps, np.int32)
    grid[:n] = ids
    grid = np.ascontiguousarray(grid.reshape(lanes, steps).T)
    # a put takes at most 16 bits from a range and 17 when it is cut: 99 bits an id are under 7 words
    model, coder = Model(lanes), RangeEncoder(lanes, 7 * steps + 8)
    every = slice(None)
    for x in grid:
        a, b, f0, f1, f2 = model.predict()
        is0 = x == a
        is1 = (x == b) & ~is0
        kind = np.where(is0, 0, 2 - is1)
        f01 = f0 + f1
        coder.put(every, np.where(is0, 0, np.where(is1, f0, f01)), np.where(is0, f0, np.where(is1, f1, f2)), f01 + f2)
        at = np.flatnonzero(kind == 2)
        if len(at):
            hi, lo = x[at] >> 8, x[at] & 255
            start = model.high_cum[hi]
            coder.put(at, start, model.high_cum[hi + 1] - start, int(model.high_cum[-1]))
            coder.put(at, *model.order0(hi, lo), model.total0(hi))
        model.learn(x, kind)
    codes = coder.finish()
    sizes = np.array([len(c) for c in codes], "<u4").tobytes()
    return HEAD.pack(MAGIC, VERSION, 0, n, lanes, zlib.crc32(ids)) + sizes + b"".join(codes)


def decode_block(record: bytes) -> np.ndarray:
    """The ids of a record; raises ValueError if it is no record or its checksum differs."""
    if len(record) < HEAD.size:
        raise ValueError("a record is cut off")
    magic, version, _, n, lanes, crc = HEAD.unpack_from(record)
    if magic != MAGIC or version != VERSION or lanes != _shape(n)[0]:
        raise ValueError("not a record of this format")
    steps = _shape(n)[1]
    if len(record) < HEAD.size + 4 * lanes:
        raise ValueError("a record is cut off")
    sizes = np.frombuffer(record, "<u4", lanes, HEAD.size).astype(np.int64)
    if len(record) - HEAD.size - 4 * lanes != sizes.sum() or (sizes % 2).any():
        raise ValueError("a record is cut off")
    words = np.frombuffer(record, "<u2", offset=HEAD.size + 4 * lanes)
    model, coder = Model(lanes), RangeDecoder(words, np.append(0, np.cumsum(sizes)[:-1]) // 2)
    grid = np.zeros((steps, lanes), np.int32)
    every = slice(None)
    for x in grid:
        a, b, f0, f1, f2 = model.predict()
        f01 = f0 + f1
        got = coder.target(every, f01 + f2)
        is0 = got < f0
        is1 = (got < f01) & ~is0
        kind = np.where(is0, 0, 2 - is1)
        coder.take(every, np.where(is0, 0, np.where(is1, f0, f01)), np.where(is0, f0, np.where(is1, f1, f2)))
        x[:] = np.where(is0, a, b)
        at = np.flatnonzero(kind == 2)
        if len(at):
            hi = model.high_of[coder.target(at, int(model.high_cum[-1]))]
            start = model.high_cum[hi]
            coder.take(at, start, model.high_cum[hi + 1] - start)
            got = coder.target(at, model.total0(hi))
            lo = np.searchsorted(model.low_flat, got + (hi << 17), "right") - 1 - hi * 257
            coder.take(at, *model.order0(hi, lo))
            x[at] = (hi << 8) | lo
        model.learn(x, kind)
    ids = grid.T.ravel()[:n].astype("<u4")
    if zlib.crc32(ids) != crc:
        raise ValueError("a record's checksum differs")
    return ids


def write_blocks(docs: DataFrame, path: str, id_col: str, text_col: str, end_id: int, tokenizer: str = TOKENIZER, block_ids: int = BLOCK_IDS) -> None:
    """Encode and compress all texts in ascending order of the id; file numbers and block numbers rise with it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = TaskContext.get().partitionId()
        encode = encoder(tokenizer, marks=True).encode
        end = np.array([end_id], "<u4").tobytes()
        held: list[bytes] = []
        names: list[int | None] = []
        size = block = 0

        def record() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([file], pa.int64()),
                    pa.array([block], pa.int64()),
                    pa.array([names], pa.list_(pa.int64())),
                    pa.array([[len(x) // 4 for x in held]], pa.list_(pa.int64())),
                    pa.array([encode_block(np.frombuffer(b"".join(held), "<u4"))], pa.binary()),
                ],
                names=["file", "block", "doc_ids", "doc_tokens", "record"],
            )

        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lo, hi in text_groups(texts):
                for i, x in zip(ids[lo:hi], encode(texts[lo:hi]), strict=True):
                    held.append(x + end)
                    names.append(i)
                    size += len(x) // 4 + 1
                    if size >= block_ids:
                        yield record()
                        held, names, size, block = [], [], 0, block + 1
        encoder(tokenizer, marks=True).forget()  # the worker stays, and later stages have its memory
        if held:
            yield record()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(n, "id").sortWithinPartitions("id", "text")
    ordered.mapInArrow(lambda batches: lean(run(batches)), STORED).write.option("compression", "none").parquet(path)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, file, block, k (place in the block), n_tokens, ids_crc32 of every document, all from decoded records."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(len(batch)):
                file, block, names, sizes, record = (batch.column(k)[r] for k in range(5))
                ids = decode_block(record.as_py())
                n = np.array(sizes.as_py(), np.int64)
                stop = np.cumsum(n)
                if stop[-1] != len(ids):
                    raise ValueError("a record doesn't hold the tokens of its documents")
                crc = [zlib.crc32(ids[b - a : b]) for a, b in zip(n.tolist(), stop.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [names.values, pa.array([file.as_py()] * len(n)), pa.array([block.as_py()] * len(n)), pa.array(np.arange(len(n))), pa.array(n), pa.array(crc, pa.int64())],
                    names=["doc_id", "file", "block", "k", "n_tokens", "ids_crc32"],
                )

    stored = spark.read.schema(STORED).parquet(path)
    return stored.mapInArrow(run, "doc_id long, file long, block long, k long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0) -> DataFrame:
    """Write the blocks of `docs` and read them back: id, start, n_tokens, ids_crc32.

    A null or empty text is its end id. Null ids come first; repeated ids stand side by side, in text order.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "token-blocks")
    write_blocks(docs, path, id_col, text_col, end_id)
    rows = read_blocks(spark, path)
    sizes = spark.read.schema(STORED).parquet(path).selectExpr("file", "block", "aggregate(doc_tokens, 0L, (a, x) -> a + x) as n")
    per_file = sizes.groupBy("file").agg(F.sum("n").alias("n"))  # as many rows as files
    before_file = per_file.selectExpr("file as f1", "sum(n) over (order by file) - n as files_before")
    before = sizes.selectExpr("file as f2", "block as b2", "sum(n) over (partition by file order by block) - n as blocks_before")
    before = before.join(before_file, F.col("f1") == F.col("f2")).selectExpr("f2", "b2", "files_before + blocks_before as before")
    joined = rows.join(before, (F.col("file") == F.col("f2")) & (F.col("block") == F.col("b2")))
    return joined.selectExpr(
        f"doc_id as `{id_col}`",
        "before + sum(n_tokens) over (partition by file, block order by k) - n_tokens as start",
        "n_tokens",
        "ids_crc32",
    )
