"""LM scoring with a log-frequency Bloom filter (operator 5).

Counts of word pairs are gathered over all training texts, quantised to levels, and put into a Bloom filter: a pair of
level q is inserted q times, once for each level up to q. The filter is broadcast; a worker finds the level by probing
level after level until one is missing. Pairs of level 1 have bits of their own, so that few are taken for more. Its size is
bounded: where it would be over-full, pairs of the lowest levels are
left out of it, so it never fills up, and stay in a filter in parts, one for each range of hashes, which isn't broadcast:
blocks send it the pairs that the broadcast one doesn't know and get their levels back. A training text's pair has
level 1 at least, so only what is over that comes back for it, and it isn't asked for where the broadcast filter has all
pairs from level 2 on. How much a pair weighs against its word alone is fitted on all training texts, their own
occurrences left out: every text is scored with each weight, and the sums over all of them say which weight counts.

Exact word counts, for the base score and as the pairs' context, are not broadcast, as the vocabulary grows with the
corpus. Files are cut into blocks of rows; each block asks for its own distinct words, gets their totals by one shuffle on
the word, and its texts meet them in one group per block. A frequent word has one row per block, never one per use.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.words import LOWER, give_back, hashes, lean, mix, text_slices, words
from starloom.session import scratch_path

END = np.uint64(0x1D8E4E27C47D124F)  # the hash of the end token, which no word has by rule
BLOCK_ROWS = 2048
KEY_BITS = 40
MOST_BITS = 1 << 28  # of the filter: 32 MB
PROBES = 3  # bits of one insertion
SEGMENT_GRAMS = 2_000_000  # n-grams counted together, about
TOGETHER = 16  # factors of up to some 1e12 that are multiplied before their logarithm is taken
WEIGHTS = (0.02, 0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.45, 0.5, 0.6, 0.7, 0.8, 0.9)


def _levels() -> np.ndarray:
    """The smallest count of each level; neighbours differ by a fifth, or by one."""
    out, x = [1], 1.0
    while out[-1] < 1 << 50:
        x = max(x * 1.2, out[-1] + 1)
        out.append(int(x))
    return np.array(out, np.int64)


LEVELS = _levels()
#: What a level stands for: the middle of its counts.
VALUE = np.append(0.0, np.sqrt(LEVELS[:-1].astype(float) * np.maximum(LEVELS[1:] - 1, LEVELS[:-1])))


def tokens(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For runs of texts: first row, number of rows, row and hash of each token, the end of each text included."""
    for first, data, offsets in text_slices(column):
        data = LOWER[data]
        n = len(offsets) - 1
        start, end, row = words(data, offsets)
        h = hashes(data, start, end)
        at = np.searchsorted(row, np.arange(n), "right")
        yield first, n, np.insert(row, at, np.arange(n)), np.insert(h, at, END)


def pairs(rows: np.ndarray, h: np.ndarray) -> np.ndarray:
    """A hash of each token with the one before it; the first of a text comes after an end."""
    before = np.append(END, h[:-1])
    before[np.append(True, rows[1:] != rows[:-1])] = END
    return mix(before * np.uint64(0xD6E8FEB86659FD93) + h)


def _packed(h: np.ndarray, count: np.ndarray, segments: int) -> tuple[np.ndarray, list[bytes]]:
    """Keys and counts as one blob for each segment (the top bits of the hash)."""
    shift = np.uint64(64 - (segments.bit_length() - 1)) if segments > 1 else None
    seg = (h >> shift).astype(np.int64) if segments > 1 else np.zeros(len(h), np.int64)
    order = np.argsort(h, kind="stable")
    seg, h, count = seg[order], h[order], count[order]
    low = (h & np.uint64((1 << KEY_BITS) - 1)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
    edge = np.flatnonzero(np.append(True, seg[1:] != seg[:-1])) if len(seg) else np.zeros(0, np.int64)
    ends = np.append(edge[1:], len(seg))
    blobs = [
        low[a:b].tobytes() + np.minimum(count[a:b], 2**32 - 1).astype("<u4").tobytes() for a, b in zip(edge, ends, strict=True)
    ]
    return seg[edge], blobs


def _unpacked_keys(blob: bytes) -> np.ndarray:
    low = np.zeros((len(blob) // 5, 8), np.uint8)
    low[:, :5] = np.frombuffer(blob, np.uint8).reshape(-1, 5)
    return low.view("<u8").ravel()


def _unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(blob) // 9
    return _unpacked_keys(blob[: 5 * n]), np.frombuffer(blob, "<u4", n, 5 * n).astype(np.int64)


@dataclass
class Filter:
    """bits: whole bytes per segment, one after the other; behind those of all segments come those of the pairs of level 1."""

    bits: np.ndarray
    segments: int
    segment_bits: int
    total: int
    distinct: int
    texts: int  # that were learnt from, so many ends
    pair_weight: float = 0.1
    lowest: int = 1  # level; pairs under it are in the parts alone
    part_bits: int = 0  # of each segment for pairs of level 1, which are broadcast if `lowest` is 1
    counts: str = ""  # folder of the counted pairs, a row for each segment

    def levels(self, h: np.ndarray) -> np.ndarray:
        """The level of each n-gram, 0 if the filter doesn't have it; never under the true one."""
        out = np.zeros(len(h), np.int64)
        live = np.arange(len(h))
        shift = np.uint64(64 - (self.segments.bit_length() - 1)) if self.segments > 1 else None
        seg = (h >> shift).astype(np.int64) if self.segments > 1 else np.zeros(len(h), np.int64)
        base = seg * self.segment_bits
        key = h & np.uint64((1 << KEY_BITS) - 1)
        for level in range(1, len(LEVELS)):
            if not len(live):
                break
            at = places(key[live], level, self.segment_bits) + base[live]
            hit = ((self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(0)
            live = live[hit]
            out[live] = level
        if self.lowest == 1 and self.part_bits:
            one = np.flatnonzero(out < 2)
            at = places(key[one], 1, self.part_bits) + self.segments * self.segment_bits + seg[one] * self.part_bits
            out[one] = ((self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(0)
        return out

    def places_of(self, h: np.ndarray) -> np.ndarray:
        """Segment and key of each n-gram as one number: all that a filter knows of it."""
        seg = h >> np.uint64(64 - (self.segments.bit_length() - 1)) if self.segments > 1 else np.zeros(len(h), np.uint64)
        return seg << np.uint64(KEY_BITS) | h & np.uint64((1 << KEY_BITS) - 1)

    def all_levels(self, h: np.ndarray, rare: tuple[np.ndarray, np.ndarray] | None) -> np.ndarray:
        """The level of each n-gram; `rare` are places, ascending, and levels of those that the parts know."""
        out = self.levels(h)
        if rare is not None:
            low = np.flatnonzero(out < self.lowest)
            out[low] = 0
            if len(rare[0]):
                place = self.places_of(h[low])
                at = np.minimum(np.searchsorted(rare[0], place), len(rare[0]) - 1)
                out[low] = np.where(rare[0][at] == place, rare[1][at], 0)
        return out

    def parts(
        self,
        h: np.ndarray,
        rows: np.ndarray,
        count: np.ndarray,
        own: int = 0,
        rare: tuple[np.ndarray, np.ndarray] | None = None,
        learnt: np.ndarray | int = 0,
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each token: its probability alone, its share after the token before it, and how often that one occurs.

        `count` are the tokens' exact counts. With `own` 1, an occurrence of the token itself is left out everywhere.
        `learnt`: 1 for tokens of training texts, whose pairs have been counted, whatever `rare` says of them.
        """
        return self.shares(self.pair_levels(h, rows, rare, learnt), rows, count, own)

    def pair_levels(
        self, h: np.ndarray, rows: np.ndarray, rare: tuple[np.ndarray, np.ndarray] | None = None, learnt: np.ndarray | int = 0
    ) -> np.ndarray:
        """The level of each token with the one before it."""
        two, where = np.unique(pairs(rows, h), return_inverse=True)
        return np.maximum(self.all_levels(two, rare)[where], learnt)

    def shares(self, level: np.ndarray, rows: np.ndarray, count: np.ndarray, own: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """`parts` of tokens whose pairs have these levels."""
        both = np.maximum(VALUE[level] - own, 0.0)
        before = np.append(self.texts, count[:-1]).astype(float)
        before[np.append(True, rows[1:] != rows[:-1])] = self.texts
        before = np.maximum(before - own, 0.0)
        alone = (np.maximum(count - own, 0) + 0.5) / (self.total + 0.5 * (self.distinct + 1))
        return alone, np.where(before > 0, np.minimum(both / np.maximum(before, 1e-9), 1.0), 0.0), before

    def log10_sums(
        self, level: np.ndarray, rows: np.ndarray, count: np.ndarray, n: int, weights: tuple[float, ...], own: int = 0
    ) -> np.ndarray:
        """For each of n texts and each weight, log10 of the product of its tokens' smoothed probabilities.

        A probability is that of the token alone times 1 + weight * (share / alone - 1), or that of the token alone
        after one that doesn't occur. TOGETHER of the second factors are multiplied before their logarithm is taken.
        """
        alone, after, before = self.shares(level, rows, count, own)
        gain = np.where(before > 0, after / alone, 1.0) - 1.0
        first = np.flatnonzero(np.append(True, rows[1:] != rows[:-1])) if len(rows) else np.zeros(0, np.int64)
        place = np.arange(len(rows)) - np.repeat(first, np.diff(np.append(first, len(rows))))
        edge = np.flatnonzero(place % TOGETHER == 0)
        out = np.zeros((n, len(weights)))
        if len(rows):
            out += np.bincount(rows, np.log10(alone), n)[:, None]
            for k, weight in enumerate(weights):
                out[:, k] += np.bincount(rows[edge], np.log10(np.multiply.reduceat(weight * gain + 1.0, edge)), n)
        return out


def places(key: np.ndarray, level: int, segment_bits: int) -> np.ndarray:
    """Bit positions of an insertion, one row for each of PROBES."""
    h = mix(key * np.uint64(0x9E3779B97F4A7C15) + np.uint64(level))
    step = mix(h) | np.uint64(1)
    return np.stack([((h + np.uint64(i) * step) % np.uint64(segment_bits)).astype(np.int64) for i in range(PROBES)])


def filled_bits(key: np.ndarray, level: np.ndarray, n_bits: int) -> np.ndarray:
    """The bytes of a filter of `n_bits` bits with these keys, each once for every level up to its own."""
    bits = np.zeros(n_bits, np.uint8)
    for q in range(1, int(level.max()) + 1 if len(level) else 1):
        bits[places(key[level >= q], q, n_bits).ravel()] = 1
    return np.packbits(bits, bitorder="little")


def read_blocks(spark: SparkSession, path: str, id_col: str, text_col: str, train: str) -> DataFrame:
    """id, text, train (boolean), blk of the rows of the Parquet files at `path`."""
    return spark.read.parquet(path).select(
        F.col(id_col).cast("long").alias("id"),
        F.col(text_col).alias("text"),
        F.coalesce(F.expr(train), F.lit(True)).alias("train"),
        F.xxhash64(F.col("_metadata.file_path"), F.floor(F.col("_metadata.row_index") / BLOCK_ROWS)).alias("blk"),
    )


def word_totals(rows: DataFrame) -> DataFrame:
    """blk, h, c (occurrences in training texts), one (true for one row of each h): the words of every block."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            train, blk = (batch.column(k).to_numpy(zero_copy_only=False) for k in (2, 3))
            held: list[tuple] = []
            for first, n, row, h in tokens(batch.column(1)):
                b = blk[first : first + n][row]
                for one in np.unique(blk[first : first + n]):
                    on = b == one
                    unit, where = np.unique(h[on], return_inverse=True)
                    held.append((np.full(len(unit), one), unit, np.bincount(where, train[first : first + n][row[on]], len(unit))))
            if held:
                b, h, c = (np.concatenate(x) for x in zip(*held, strict=True))
                order = np.lexsort((h, b))
                b, h, c = b[order], h[order], c[order]
                edge = np.flatnonzero(np.append(True, (b[1:] != b[:-1]) | (h[1:] != h[:-1])))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(b[edge]), pa.array(h[edge].view(np.int64)), pa.array(np.add.reduceat(c, edge).astype(np.int64))],
                    names=["blk", "h", "c"],
                )

    found = rows.mapInArrow(lambda batches: lean(count(batches)), "blk long, h long, c long")
    return found.selectExpr("blk", "h", "sum(c) over (partition by h) c", "row_number() over (partition by h order by blk) = 1 one")


def build_filter(rows: DataFrame, totals: DataFrame, most_bits: int = MOST_BITS, pair_weight: float = 0.1) -> Filter:
    """Count word pairs, choose the cut-off, insert. Only the filter itself comes to the driver."""
    spark = rows.sparkSession
    ends = F.sum(F.when(F.col("h") == F.lit(int(END.astype(np.int64))), F.col("c")))
    total, distinct, texts = (x or 0 for x in totals.where("one and c > 0").agg(F.sum("c"), F.count(F.lit(1)), ends).first())
    segments = 1 << max(6, (max(1, 2 * total // SEGMENT_GRAMS) - 1).bit_length())

    def pair_blobs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for _, _, row, h in tokens(batch.column(0)):
                held.append(pairs(row, h))
                size += len(held[-1])
                if size >= 4_000_000:
                    yield from blobs(*np.unique(np.concatenate(held), return_counts=True))
                    held, size = [], 0
        if held:
            yield from blobs(*np.unique(np.concatenate(held), return_counts=True))

    def blobs(h: np.ndarray, c: np.ndarray) -> Iterator[pa.RecordBatch]:
        seg, content = _packed(h, c, segments)
        yield pa.RecordBatch.from_arrays([pa.array(seg), pa.array(content, pa.binary())], names=["seg", "blob"])

    def summed(key: tuple, table: pa.Table) -> pa.Table:
        parts = [_unpacked(b.as_py()) for b in table.column("blob")]
        k, c = (np.concatenate(x) for x in zip(*parts, strict=True))
        k, where = np.unique(k, return_inverse=True)
        c = np.bincount(where, c).astype(np.int64)
        level = np.searchsorted(LEVELS, c, "right")
        del parts, where
        give_back()
        return pa.table(
            {
                "seg": [key[0].as_py()],
                "keys": [k.tobytes()],
                "levels": [level.astype(np.uint8).tobytes()],
                "pairs": [np.bincount(level, minlength=256).tolist()],
            }
        )

    both = rows.where("train").select("text").mapInArrow(lambda batches: lean(pair_blobs(batches)), "seg long, blob binary")
    counted = both.groupBy("seg").applyInArrow(
        summed, "seg long, keys binary, levels binary, pairs array<long>"
    )
    path = scratch_path(spark, "ngram-counts")
    counted.write.parquet(path)
    counted = spark.read.parquet(path)
    seen = np.zeros(256)
    for level, n in counted.select(F.posexplode("pairs").alias("level", "n")).groupBy("level").agg(F.sum("n")).collect():  # 256 numbers
        seen[level] = n
    bits_of = seen * np.arange(256) * PROBES * 1.5
    lowest = next((k for k in range(1, 256) if bits_of[k:].sum() <= most_bits), 256)
    segment_bits, part_bits = (int(max(x // segments // 8 + 1, 256)) * 8 for x in (bits_of[max(lowest, 2) :].sum(), bits_of[1]))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, single = [], []
            for keys, levels in zip(batch.column(1), batch.column(2), strict=True):
                k, level = np.frombuffer(keys.as_py(), np.uint64), np.frombuffer(levels.as_py(), np.uint8)
                on = level >= max(lowest, 2)
                out.append(filled_bits(k[on], level[on], segment_bits).tobytes())
                single.append(filled_bits(k[level == 1], level[level == 1], part_bits).tobytes() if lowest == 1 else b"")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary()), pa.array(single, pa.binary())], names=["seg", "bits", "single"])

    sizes = [segments * segment_bits // 8, segments * part_bits // 8 if lowest == 1 else 0]
    bits = np.zeros(sum(sizes), np.uint8)
    filled = counted.select("seg", "keys", "levels").mapInArrow(fill, "seg long, bits binary, single binary").toArrow()  # most_bits in all
    for seg, content, single in zip(filled["seg"].to_pylist(), filled["bits"], filled["single"], strict=True):
        bits[seg * segment_bits // 8 : (seg + 1) * segment_bits // 8] = np.frombuffer(content.as_buffer(), np.uint8)
        if lowest == 1:
            bits[sizes[0] + seg * part_bits // 8 : sizes[0] + (seg + 1) * part_bits // 8] = np.frombuffer(single.as_buffer(), np.uint8)
    return Filter(bits, segments, segment_bits, total, distinct, texts, pair_weight, lowest, part_bits, path)


def rare_levels(rows: DataFrame, model: Filter) -> DataFrame:
    """blk, seg, keys, levels: what the parts know of the pairs that each block has and the broadcast filter doesn't.

    A pair of a block is asked for once for each batch of its rows, as five bytes, in training and in other texts apart.
    Answered are those over the level that is known without asking: 1 in training texts, as they have been counted, and 0
    in others. Where the broadcast filter lacks pairs of level 1 alone, training texts have nothing to ask.
    """
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            train, blk = (batch.column(k).to_numpy(zero_copy_only=False) for k in (1, 2))
            held = [(blk[f : f + n][row], train[f : f + n][row], pairs(row, h)) for f, n, row, h in tokens(batch.column(0))]
            if not held:
                continue
            b, t, two = (np.concatenate(x) for x in zip(*held, strict=True))
            for one in np.unique(b):
                for learnt in (False, True):
                    mine = np.unique(two[(b == one) & (t == learnt)])
                    place = m.places_of(mine[m.levels(mine) < m.lowest])  # ascending by segment
                    if not len(place):
                        continue
                    seg = (place >> np.uint64(KEY_BITS)).astype(np.int64)
                    low = place.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : KEY_BITS // 8]
                    edge = np.flatnonzero(np.append(True, seg[1:] != seg[:-1]))
                    keys = [low[x:y].tobytes() for x, y in zip(edge, np.append(edge[1:], len(seg)), strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(edge), one)), pa.array(seg[edge]), pa.array(np.full(len(edge), learnt)), pa.array(keys, pa.binary())],
                        names=["blk", "seg", "learnt", "keys"],
                    )

    def answer(counted: pa.Table, asked: pa.Table) -> pa.Table:
        """With no counted pairs in the segment, none is known."""
        part = None
        for keys, levels in zip(counted.column("keys"), counted.column("levels"), strict=True):
            k, level = np.frombuffer(keys.as_py(), np.uint64), np.frombuffer(levels.as_py(), np.uint8)
            more = (level >= 2) & (level < lowest)  # what the broadcast filter has isn't asked for
            more_bits = int(max(level[more].sum() * PROBES * 1.5 // 8 + 1, 256)) * 8
            one = filled_bits(k[level == 1], level[level == 1], model_bits)
            part = Filter(np.append(filled_bits(k[more], level[more], more_bits), one), 1, more_bits, 0, 0, 0, part_bits=model_bits)
        keys_of, levels_of = [], []
        for learnt, blob in zip(asked.column("learnt").to_pylist(), asked.column("keys"), strict=True):
            key = _unpacked_keys(blob.as_py())
            level = part.levels(key) if part else np.zeros(len(key), np.int64)
            over = level > learnt
            keys_of.append(key[over].astype("<u8").view(np.uint8).reshape(-1, 8)[:, : KEY_BITS // 8].tobytes())
            levels_of.append(level[over].astype(np.uint8).tobytes())
        part = None
        give_back()
        some = pa.array([len(x) > 0 for x in levels_of])
        answers = {"keys": pa.array(keys_of, pa.binary()), "levels": pa.array(levels_of, pa.binary())}
        return pa.table({"blk": asked.column("blk"), "seg": asked.column("seg"), **answers}).filter(some)

    model_bits, lowest = model.part_bits, model.lowest
    asking = rows.where("not train") if model.lowest <= 2 else rows
    asked = asking.select("text", "train", "blk").mapInArrow(lambda batches: lean(ask(batches)), "blk long, seg long, learnt boolean, keys binary")
    counted = spark.read.parquet(model.counts).select("seg", "keys", "levels")
    return (
        counted.groupBy("seg").cogroup(asked.groupBy("seg")).applyInArrow(answer, "blk long, seg long, keys binary, levels binary")
    )


def score(
    spark: SparkSession, path: str, train: str, id_col: str = "doc_id", text_col: str = "text", most_bits: int = MOST_BITS
) -> DataFrame:
    """One row per row of the Parquet files at `path`: id, train, n_tokens, n_known, train_tokens, base_score, score.

    `train` is a SQL condition on the rows; where it is null, the row is a training row. A null or empty text is
    the end token alone. The pairs' weight is the best of WEIGHTS for all training rows. Repeated rows and ids are scored
    each for itself. With no training text, every probability is the smoothed one of an unseen token. No rows give no rows.
    """
    rows = read_blocks(spark, path, id_col, text_col, train)
    at = scratch_path(spark, "word-totals")
    word_totals(rows).write.parquet(at)
    totals = spark.read.parquet(at)
    model = build_filter(rows, totals, most_bits)
    unfitted = spark.sparkContext.broadcast(model)  # at most most_bits

    known_of, weights = totals.select("blk", "h", "c"), WEIGHTS
    bounded = model.lowest > 1
    if bounded:
        rare_at = scratch_path(spark, "rare-pairs")
        rare_levels(rows, model).write.parquet(rare_at)
        known_of = known_of.unionByName(spark.read.parquet(rare_at), allowMissingColumns=True)

    def counts_of(known: pa.Table) -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray] | None]:
        """Words, ascending, with their counts, and what the filter's parts know, if there are any."""
        rare = None
        if bounded:
            of_parts = known.filter(known.column("keys").is_valid())
            known = known.filter(known.column("h").is_valid())
            place, level = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint8)]
            for seg, keys, levels in zip(*[of_parts.column(c).to_pylist() for c in ("seg", "keys", "levels")], strict=True):
                place.append(np.uint64(seg << KEY_BITS) | _unpacked_keys(keys))
                level.append(np.frombuffer(levels, np.uint8))
            at, first = np.unique(np.concatenate(place), return_index=True)
            rare = at, np.concatenate(level)[first].astype(np.int64)
        h = known.column("h").to_numpy().view(np.uint64)
        order = np.argsort(h)
        return h[order], known.column("c").to_numpy()[order], rare

    def finish(texts: pa.Table, known: pa.Table) -> pa.Table:
        """Scores with each weight; in the block's first row, the sums over its training texts without their own occurrences."""
        h, c, rare = counts_of(known)
        m = unfitted.value
        n_tokens, n_known = (np.zeros(len(texts), np.int64) for _ in range(2))
        base, scores, fit = np.zeros(len(texts)), np.zeros((len(texts), len(weights))), np.zeros(len(weights))
        learnt = texts.column("train").to_numpy().astype(np.int64)
        for first, n, row, t in tokens(texts.column("text").combine_chunks()):
            count = c[np.searchsorted(h, t)]
            part = slice(first, first + n)
            own = learnt[part][row]
            level = m.pair_levels(t, row, rare, own)
            n_tokens[part] = np.bincount(row, minlength=n)
            n_known[part] = np.bincount(row, count > 0, n)
            base[part] = np.bincount(row, np.log10((count + 0.5) / (m.total + 0.5 * (m.distinct + 1))), n)
            scores[part] = m.log10_sums(level, row, count, n, weights)
            on = own == 1
            fit += m.log10_sums(level[on], row[on], count[on], n, weights, own=1).sum(0)
        give_back()
        ends = np.arange(0, scores.size + 1, len(weights), dtype=np.int32)
        return pa.table(
            {
                "id": texts.column("id"),
                "train": texts.column("train"),
                "n_tokens": n_tokens,
                "n_known": n_known,
                "train_tokens": np.full(len(texts), m.total, np.int64),
                "base_score": base,
                "scores": pa.ListArray.from_arrays(ends, scores.ravel()),
                "fit": pa.array([fit.tolist(), *[None] * (len(texts) - 1)], pa.list_(pa.float64()))[: len(texts)],
            }
        )

    scored_at = scratch_path(spark, "scores")  # a number for each row and weight; texts are read and met with their words once
    rows.groupBy("blk").cogroup(known_of.groupBy("blk")).applyInArrow(
        finish,
        "id long, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, scores array<double>, fit array<double>",
    ).write.parquet(scored_at)
    scored = spark.read.parquet(scored_at)
    fits = scored.select(F.posexplode("fit").alias("k", "fit")).groupBy("k").agg(F.sum("fit").alias("fit")).orderBy("k").collect()
    best = max((r.fit for r in fits), default=0.0)
    weight = next((r.k for r in fits if model.total and r.fit >= best - 1e-9 * abs(best)), int(np.abs(np.subtract(weights, model.pair_weight)).argmin()))
    return scored.select("id", "train", "n_tokens", "n_known", "train_tokens", "base_score", F.col("scores")[weight].alias("score"))
