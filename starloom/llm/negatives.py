"""Hard-negative mining by Fagin's threshold algorithm (operator 12).

Components are quantised to integers, scores are integer inner products. The rows are dealt over blocks by a hash of
their place; in a block, each dimension has its list of rows sorted by value. An anchor reads all lists at once, from
the large end where its own component is positive and from the small end where it is negative (sorted access), scores
what it meets in full (random access), and stops when the threshold, the score of a row that would have the last read
value in every list, falls strictly below the k-th score of each of its windows: no unread row can enter or tie.

First the positives (same label, one window without bounds), then the negatives (other labels, one window for each
positive). Anchors come in chunks; each chunk meets each block once, in a task that holds one of both. Every task
hands on at most k rows for an anchor and window, and the best k of all blocks are taken by a window.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.session import scratch_path

BLOCK_ROWS = 4096
CHUNK_ANCHORS = 1024
FIRST_DEPTH = 16
DEEPER = 4  # each round reads so many times the depth
EXACT = float(1 << 53)
LONG = (1 << 63) - 1


@dataclass(frozen=True)
class Rules:
    """What is mined: so many positives, so many negatives for each, scores between two shares of the positive's."""

    positives: int = 5
    negatives: int = 10
    low_percent: int = 30
    high_percent: int = 90


def quantised(values: np.ndarray) -> np.ndarray:
    """floor(256 * x) of each component; whole numbers, held as doubles."""
    return np.floor(256.0 * values.astype(np.float64))


def inner(rows: np.ndarray, anchor: np.ndarray, largest: float) -> np.ndarray:
    """Integer inner products of rows without a component above `largest`.

    Where they could pass 2**53, in whole numbers of any size, cut to the range of a long.
    """
    if largest * np.abs(anchor).sum() < EXACT:
        return (rows @ anchor).astype(np.int64)
    own = [int(x) for x in anchor]
    found = [sum(int(x) * y for x, y in zip(row, own, strict=True)) for row in rows]
    return np.array([max(-LONG, min(LONG, s)) for s in found], np.int64)


class Lists:
    """The rows of a block, in the order of their ids, with one sorted list for each dimension."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        self.largest = float(np.abs(rows).max()) if rows.size else 0.0
        self.lists = np.argsort(rows, axis=0, kind="stable").T.astype(np.int32)  # dimension x rank, ascending

    def best(self, anchor: np.ndarray, windows: list[tuple[int, int]], k: int, taken: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, int]:
        """For each window the first k rows in it, scores, and how many rows were scored.

        Windows are the least and the greatest score. Rows that are `taken` out are passed over. Higher scores come
        first, of equal ones the earlier row.
        """
        n = len(self.rows)
        score = np.zeros(n, np.int64)
        seen = np.zeros(n, bool)
        on = np.flatnonzero(anchor)
        lists = self.lists[on]
        signs = anchor[on] > 0
        lo, depth = 0, FIRST_DEPTH
        if not len(on):  # every row scores 0
            seen[:] = True
        while True:
            hi = min(depth, n)
            if len(on):
                up, down = lists[~signs, lo:hi], lists[signs, n - hi : n - lo]
                met = np.zeros(n, bool)
                met[up.ravel()] = True
                met[down.ravel()] = True
                new = np.flatnonzero(met & ~seen)
                score[new] = inner(self.rows[new], anchor, self.largest)
                seen[new] = True
            at = np.flatnonzero(seen & ~taken)
            at = at[np.argsort(-score[at], kind="stable")]
            ranked = -score[at]
            found = [at[a : min(a + k, b)] for a, b in self._spans(ranked, windows)]
            if hi >= n or seen.all():
                return found, score, int(seen.sum())
            last = np.where(signs, lists[:, n - hi], lists[:, hi - 1])
            threshold = sum(int(a) * int(x) for a, x in zip(anchor[on], self.rows[last, on], strict=True))
            if all(threshold < (int(score[f[-1]]) if len(f) == k else w[0]) or w[0] > w[1] for f, w in zip(found, windows, strict=True)):
                return found, score, int(seen.sum())
            lo, depth = hi, depth * DEEPER

    @staticmethod
    def _spans(ranked: np.ndarray, windows: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
        for least, most in windows:
            a = int(np.searchsorted(ranked, max(-most, -LONG), "left"))
            yield a, max(a, int(np.searchsorted(ranked, min(-least, LONG), "right")))


def _matrix(column: pa.ChunkedArray, kind: str) -> np.ndarray:
    content = b"".join(x.as_py() for x in column)
    return np.frombuffer(content, kind).reshape(len(column), -1)


def _prepared(vectors: DataFrame, id_col: str, vector_col: str, label: Column, kind: str) -> DataFrame:
    """row (a number of its own), id, label, size, v (the components as bytes) of the rows that take part, stored."""
    x = F.col(f"`{vector_col}`")
    whole = x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), label.cast("long").alias("label"), x.alias("x"), whole.alias("whole"))
    rows = rows.where("whole and id is not null and label is not null").select("id", "label", "x")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            at = lists.offsets.to_numpy()
            values = lists.values.to_numpy(zero_copy_only=False).astype(kind)
            content = [values[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
            sizes = pa.array(np.diff(at).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), sizes, pa.array(content, pa.binary())], names=["id", "label", "size", "v"])

    spark = vectors.sparkSession
    path = scratch_path(spark, "negatives-rows")
    packed = rows.mapInArrow(pack, "id long, label long, size int, v binary")
    packed.withColumn("row", F.monotonically_increasing_id()).write.parquet(path)
    return spark.read.parquet(path)


def mine(
    vectors: DataFrame,
    anchors: str,
    label: Column | None = None,
    rules: Rules = Rules(),
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    `anchors` is a condition on `id` (the long id) that picks the anchors; `label` replaces the label column.
    An anchor's positives are the first rows of its label but itself; its negatives rows of other labels whose scores
    lie in the window that the positive's score gives. Higher scores come first, ties by smaller id.

    Rows with a null id, a null label, a null vector or a null or non-finite component take no part; vectors of
    another length than the anchor's are not compared with it. Rows with one id are rows of their own, and each
    is an anchor if its id is one. No anchors or no positives give no rows.
    """
    spark = vectors.sparkSession
    element = vectors.schema[vector_col].dataType.elementType.typeName()
    kind = "<f4" if element == "float" else "<f8"
    rows = _prepared(vectors, id_col, vector_col, F.col(f"`{label_col}`") if label is None else label, kind)
    counts = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.expr(anchors)).alias("a")).first()
    blocks = max(1, -(-counts.n // block_rows))
    chunks = max(1, -(-counts.a // CHUNK_ANCHORS))
    every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    every_chunk = F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))
    block = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")
    chunk = F.pmod(F.xxhash64("row", F.lit(1)), F.lit(chunks)).cast("int")
    picked = rows.where(anchors)
    windows = "array<struct<least:long,most:long>>"

    def meet(own: DataFrame, task, schema: str) -> DataFrame:
        """`task` for each chunk of anchors and each block of rows; `own` are the anchors with their windows."""
        left = own.select("size", F.col("chunk"), every_block.alias("block"), "row", "id", "label", "v", "windows")
        right = rows.select(
            "size", every_chunk.alias("chunk"), block.alias("block"), "row", "id", "label", "v", F.lit(None).cast(windows).alias("windows")
        )
        return left.unionByName(right).groupBy("size", "chunk", "block").applyInArrow(task, schema)

    def parts(group: pa.Table):
        """Anchors (row, label, vector, windows), and the block's rows in the order of their ids."""
        # the anchors' rows have windows, a block's rows have none
        mine_ = group.filter(pc.is_valid(group.column("windows")))
        there = group.filter(pc.is_null(group.column("windows"))).sort_by([("id", "ascending"), ("row", "ascending")])
        vector = quantised(_matrix(mine_.column("v"), kind)) if len(mine_) else np.zeros((0, 0))
        own = zip(mine_.column("row").to_pylist(), mine_.column("label").to_pylist(), vector, mine_.column("windows").to_pylist(), strict=True)
        rows_ = quantised(_matrix(there.column("v"), kind)) if len(there) else np.zeros((0, 0))
        return list(own), rows_, *(there.column(c).to_numpy() for c in ("row", "id", "label"))

    def result(found: list[tuple], names: list[str], kinds: list[type]) -> pa.Table:
        columns = list(zip(*found, strict=True)) or [()] * len(names)
        return pa.table({n: np.concatenate(c).astype(t) if c else np.zeros(0, t) for n, c, t in zip(names, columns, kinds, strict=True)})

    def positives(group: pa.Table) -> pa.Table:
        own, there, row, ids, labels = parts(group)
        by_label = {}
        found = []
        for a, label_, vector, _ in own:
            if label_ not in by_label:
                at = np.flatnonzero(labels == label_)
                by_label[label_] = at, Lists(there[at]) if len(at) else None
            at, lists = by_label[label_]
            if lists is None:
                continue
            (best,), score, _ = lists.best(vector, [(-LONG, LONG)], rules.positives, row[at] == a)
            found.append((np.full(len(best), a), row[at[best]], ids[at[best]], score[best]))
        return result(found, ["anchor", "row", "id", "score"], [np.int64] * 4)

    unbounded = F.array(F.struct(F.lit(-LONG).alias("least"), F.lit(LONG).alias("most")))
    first = picked.select("size", chunk.alias("chunk"), "row", "id", "label", "v", unbounded.alias("windows"))
    near = meet(first, positives, "anchor long, row long, id long, score long")
    order = Window.partitionBy("anchor").orderBy(F.col("score").desc(), "id", "row")
    near = near.withColumn("k", F.row_number().over(order)).where(F.col("k") <= rules.positives)
    path = scratch_path(spark, "negatives-positives")
    near.write.parquet(path)
    near = spark.read.parquet(path)

    score = F.col("score").cast("decimal(38,0)")
    least = F.ceil(score * rules.low_percent / 100).cast("long")
    most = F.floor(score * rules.high_percent / 100).cast("long")
    bounds = near.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("k", least.alias("least"), most.alias("most")))).alias("w"))
    bounds = bounds.select(F.col("anchor").alias("a"), F.transform("w", lambda w: F.struct(w["least"], w["most"])).cast(windows).alias("windows"))
    second = picked.join(bounds, F.col("row") == F.col("a")).select("size", chunk.alias("chunk"), "row", "id", "label", "v", "windows")

    def negatives(group: pa.Table) -> pa.Table:
        own, there, row, ids, labels = parts(group)
        lists = Lists(there) if len(there) else None
        found = []
        for a, label_, vector, wanted in own if lists else []:
            spans = [(w["least"], w["most"]) for w in wanted]
            best, score_, _ = lists.best(vector, spans, rules.negatives, labels == label_)
            for k, f in enumerate(best, 1):
                found.append((np.full(len(f), a), np.full(len(f), k), row[f], ids[f], score_[f]))
        return result(found, ["anchor", "k", "row", "id", "score"], [np.int64, np.int32, *[np.int64] * 3])

    far = meet(second, negatives, "anchor long, k int, row long, id long, score long")
    order = Window.partitionBy("anchor", "k").orderBy(F.col("score").desc(), "id", "row")
    far = far.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= rules.negatives)
    far = far.select(F.col("anchor").alias("a"), F.col("k").alias("p"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    names = picked.select(F.col("row").alias("r"), F.col("id").alias("anchor_id"))
    pairs = near.select("anchor", "k", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    pairs = pairs.join(names, F.col("anchor") == F.col("r"))
    out = far.join(pairs, (F.col("a") == F.col("anchor")) & (F.col("p") == F.col("k")))
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
