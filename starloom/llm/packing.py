"""Best-fit packing by a configuration linear program (operator 4).

Documents become token ids, long ones are cut into pieces of the sequence length. Only the histogram of piece
lengths (at most as many numbers as the sequence has tokens) decides which lengths share a sequence:

1. The covering program over configurations (multisets of lengths that fit a sequence) is solved by
   multiplicative weights. A length's price is its weight over its count. Each round takes the configuration that is
   worth most, covers a little of each of its lengths, and multiplies their weights down by what they got. Now and
   then knapsack dynamic programming over the full capacity finds the best configuration of all for the prices, which
   joins the known ones if it is worth more. At the end everything is scaled so that every length is covered.
2. The fractional cover is rounded down to whole sequences, and what is left is priced again.
3. What is left then, and all small lengths, which the program leaves out, are placed best-fit by decreasing
   length, into the room of rounded sequences first. Where that takes more sequences than best-fit alone, smaller
   shares of the cover are rounded too, and the rounding with the fewest sequences is taken.

The plan is a list of patterns with multiplicities. Pieces are numbered within their length by counts per
salted part and a running sum, so no length, however common, meets in one task, and each piece looks up its
sequence and offset in the plan, whose size is bounded by the sequence length and not by the data.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.encode import encoder, text_groups
from starloom.llm.words import lean
from starloom.session import scratch_path

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
TOKENIZER = "word_bpe_49k.json"
GROUPS = 96  # sizes that the linear program tells apart
ROUNDS = 200
SHARES = tuple(2.0**-k for k in range(11))  # of the cover, that are rounded where the whole takes too many sequences
AGAIN = 4  # times that what rounding leaves is priced again, at most
SMALL = 16  # lengths up to the sequence length over this are small
PART_ROWS = 200_000  # pieces that are numbered together, about


def cut(ids: np.ndarray, limit: int) -> list[tuple[int, int, int]]:
    """(start, length, crc32) of the pieces of one document."""
    return [(lo, min(limit, len(ids) - lo), zlib.crc32(ids[lo : lo + limit])) for lo in range(0, len(ids), limit)]


def token_pieces(docs: DataFrame, id_col: str, text_col: str, limit: int, end_id: int, tokenizer: str) -> DataFrame:
    """The pieces of every document. A null text counts as empty and is one piece with the end id alone."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, marks=True).encode
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for lo, hi in text_groups(texts):
                found = [cut(np.frombuffer(x + end, "<u4"), limit) for x in encode(texts[lo:hi])]
                n = np.array([len(f) for f in found])
                flat = np.array([p for f in found for p in f], np.int64).reshape(-1, 3)
                owner = np.repeat(np.arange(lo, hi), n)
                number = np.arange(len(owner)) - np.repeat(np.append(0, np.cumsum(n)[:-1]), n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(owner)), pa.array(number, pa.int32()), *[pa.array(flat[:, k]) for k in range(3)]],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )
        encoder(tokenizer, marks=True).forget()  # the worker stays, and later stages have its memory

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(lambda batches: lean(run(batches)), PIECES)


def price_configuration(sizes: np.ndarray, value: np.ndarray, most: np.ndarray, limit: int) -> np.ndarray:
    """How many of each size the most valuable multiset has that fits `limit`, with at most `most` of each.

    Dynamic programming over the whole capacity. Copies of a size come in bundles of 1, 2, 4, ... and a rest, which make
    every number up to the most; of equal values the one that fills more is found.
    """
    bundles: list[tuple[int, int]] = []
    for j in np.flatnonzero(value > 0).tolist():
        copies, k = min(int(most[j]), limit // int(sizes[j])), 1
        while copies > 0:
            bundles.append((j, min(k, copies)))
            copies -= k
            k *= 2
    fill = 1e-9 * float((value / sizes).max()) if len(sizes) else 0.0  # of a token's worth, for ties
    best = np.zeros(limit + 1)
    taken = np.zeros((len(bundles), limit + 1), bool)
    for i, (j, k) in enumerate(bundles):
        size = k * int(sizes[j])
        got = best[: limit + 1 - size] + k * (value[j] + fill * sizes[j])
        np.greater(got, best[size:], out=taken[i, size:])
        np.maximum(best[size:], got, out=best[size:])
    out = np.zeros(len(sizes), np.int64)
    room = limit
    for i in range(len(bundles) - 1, -1, -1):
        if taken[i, room]:
            j, k = bundles[i]
            out[j] += k
            room -= k * int(sizes[j])
    return out


def solve_program(
    sizes: np.ndarray, count: np.ndarray, limit: int, rounds: int = ROUNDS, eta: float = 0.05, steps: int = 50
) -> list[tuple[np.ndarray, float]]:
    """Configurations and how often each is used: a fractional cover of `count`.

    `rounds` is how often the knapsack prices, with `steps` steps among known configurations in between.
    """
    sizes, count = np.asarray(sizes, np.int64), np.asarray(count, np.int64)
    at = np.flatnonzero(count > 0)
    own, need = sizes[at], count[at].astype(float)
    if not len(at) or not rounds:
        return []
    most = np.maximum(count[at], 1)
    weight = np.ones(len(at))
    covered = np.zeros(len(at))  # as a share of the need
    known = np.zeros((0, len(at)), np.int64)
    used = np.zeros(0)
    for _ in range(rounds):
        price = weight / need
        config = price_configuration(own, price, most, limit)
        if not len(known) or config @ price > (known @ price).max() * (1 + 1e-9):
            known, used = np.vstack([known, config]), np.append(used, 0.0)
        share = known / need
        for _ in range(steps):
            k = int((share @ weight).argmax())
            step = 1 / share[k].max()
            used[k] += step
            gain = step * share[k]
            covered += gain
            weight *= np.exp(-eta * gain)
        weight /= weight.max()
    scale = 1 / max(float(covered.min()), float(covered.mean()) / 2)  # what the rounds hardly reached is priced again later
    out = []
    for k in np.argsort(-used, kind="stable"):
        if used[k] > 0:
            config = np.zeros(len(sizes), np.int64)
            config[at] = known[k]
            out.append((config, float(used[k] * scale)))
    return out


class Pattern:
    """A number of sequences with the same content: pairs of length and how many, in order."""

    __slots__ = ("content", "room", "times")

    def __init__(self, content: tuple, room: int, times: int):
        self.content, self.room, self.times = content, room, times


def plan_patterns(lengths: dict[int, int], limit: int, groups: int = GROUPS, rounds: int = ROUNDS) -> list[Pattern]:
    """Patterns that hold every piece of the histogram exactly once.

    The program always runs. Where rounding its whole cover takes more sequences than best-fit alone, other roundings are
    tried, and the fewest sequences win; no rounds is best-fit alone.
    """
    plain = _plan(lengths, limit, groups, 0)
    if not rounds:
        return plain
    covers: dict[bytes, list] = {}
    found = _plan(lengths, limit, groups, rounds, covers=covers)
    for share in SHARES:
        for tight in (False, True):
            if sequences(found) <= sequences(plain):
                return found
            found = min(found, _plan(lengths, limit, groups, rounds, share, tight, covers), key=sequences)
    return found


def sequences(patterns: list[Pattern]) -> int:
    return sum(p.times for p in patterns)


def _plan(lengths: dict[int, int], limit: int, groups: int, rounds: int, share: float = 1.0, tight: bool = False, covers: dict | None = None) -> list[Pattern]:
    """Rounded configurations, as far as there are rounds, and best-fit for the rest.

    With a `share` under 1, that much of the cover is rounded, once; what is `tight` leaves no room and no small length
    is used up for it. `covers` remembers the program's solutions for other roundings.
    """
    covers = {} if covers is None else covers
    left = {n: c for n, c in sorted(lengths.items(), reverse=True) if c}
    patterns: list[Pattern] = []
    if limit in left:
        patterns.append(Pattern(((limit, 1),), 0, left.pop(limit)))
    small = {n: c for n, c in left.items() if n <= limit // SMALL}
    left = {n: c for n, c in left.items() if n > limit // SMALL}
    if left:
        own = np.array(sorted(left), np.int64)
        weight = np.cumsum([left[n] for n in own.tolist()])
        mark = np.minimum((weight * groups - 1) // max(int(weight[-1]), 1), groups - 1) if len(own) > groups else np.arange(len(own))
        ends = np.flatnonzero(np.append(mark[1:] != mark[:-1], True))
        sizes = own[ends]  # the largest length of a group stands for it
        low = np.append(0, sizes[:-1])  # group g has the lengths over low[g] up to sizes[g]
        stock = np.zeros(limit + 1, np.int64)
        for n, c in (*left.items(), *small.items()):
            stock[n] = c

        def longest(over: int, upto: int) -> int:
            at = np.flatnonzero(stock[over + 1 : upto + 1])
            return int(at[-1]) + over + 1 if len(at) else 0

        def lay(config: np.ndarray, times: int) -> int:
            """Sequences of a configuration with lengths in stock, up to so many; how many there were."""
            wanted = [g for g in range(len(config) - 1, -1, -1) for _ in range(config[g])]
            laid = 0
            while laid < times:  # each turn ends the times or uses up a length
                content: dict[int, int] = {}
                room = limit
                for k, g in enumerate(wanted):
                    # the last place takes whatever length fills the sequence best
                    n = longest(limit // SMALL if tight else 0, room) if k == len(wanted) - 1 else longest(int(low[g]), min(int(sizes[g]), room))
                    if not n:
                        break
                    content[n] = content.get(n, 0) + 1
                    stock[n] -= 1
                    room -= n
                whole = sum(content.values()) == len(wanted) and not (tight and room)
                for n, k in content.items():
                    stock[n] += k
                if not whole:  # a length is used up: what is left is priced again
                    break
                runs = min([times - laid, *[int(stock[n]) // k for n, k in content.items()]])
                for n, k in content.items():
                    stock[n] -= k * runs
                patterns.append(Pattern(tuple(content.items()), room, runs))
                laid += runs
            return laid

        for _ in range((AGAIN if share == 1 else 1) if rounds else 0):
            count = np.array([stock[a + 1 : b + 1].sum() for a, b in zip(low, sizes, strict=True)])
            if count.tobytes() not in covers:
                covers[count.tobytes()] = solve_program(sizes, count, limit, rounds)
            if not sum([lay(config, int(use * share + 1e-6)) for config, use in covers[count.tobytes()]]):
                break
        left = {int(n): int(stock[n]) for n in np.flatnonzero(stock)}
    else:
        left = small
    rooms: dict[int, list[Pattern]] = {}
    for p in patterns:
        rooms.setdefault(p.room, []).append(p)
    free = np.zeros(limit + 1, bool)
    for r in rooms:
        free[r] = True
    for n in sorted(left, reverse=True):
        c = left[n]
        while c:
            at = np.flatnonzero(free[n:])
            r = int(at[0]) + n if len(at) else limit
            if r == limit and not rooms.get(limit):
                fresh = Pattern((), limit, -(-c // (limit // n)))
                patterns.append(fresh)
                rooms.setdefault(limit, []).append(fresh)
            p = rooms[r].pop()
            if not rooms[r]:
                free[r] = False
            each = min(r // n, c)
            runs = min(p.times, c // each)
            if runs < p.times:
                rest = Pattern(p.content, r, p.times - runs)
                patterns.append(rest)
                rooms[r].append(rest)
                free[r] = True
            p.content, p.room, p.times = (*p.content, (n, each)), r - n * each, runs
            rooms.setdefault(p.room, []).append(p)
            free[p.room] = True
            c -= runs * each
    return [p for p in patterns if p.content]


def slots(patterns: list[Pattern]) -> dict[int, np.ndarray]:
    """For each length, rows (first rank, how many in a sequence, first sequence, offset), by rank."""
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    filled: dict[int, int] = {}
    first = 0
    for p in patterns:
        offset = 0
        for n, k in p.content:
            rank = filled.get(n, 0)
            rows.setdefault(n, []).append((rank, k, first, offset))
            filled[n] = rank + k * p.times
            offset += n * k
        first += p.times
    return {n: np.array(r, np.int64) for n, r in rows.items()}


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096, end_id: int = 1, tokenizer: str = TOKENIZER
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is one piece that holds the end id alone. Repeated rows and ids are packed each for
    itself; a null id stays null. No rows give no rows. Sequences are filled from offset 0 without a gap.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "pieces")
    token_pieces(docs, id_col, text_col, limit, end_id, tokenizer).write.parquet(path)
    pieces = spark.read.parquet(path)
    histogram = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}  # at most `limit` rows
    plan = spark.sparkContext.broadcast(slots(plan_patterns(histogram, limit)))

    parts = max(1, -(-sum(histogram.values()) // PART_ROWS))
    # a place in the written files: the same on every reading, also with repeated rows
    placed = pieces.select(
        "*",
        F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(parts)).cast("int").alias("part"),
    )
    counts = placed.groupBy("part", "length").count()
    before = counts.selectExpr(
        "part as p", "length as n", "sum(count) over (partition by length order by part) - count as before"
    )

    def number(key: tuple, rows: pa.Table) -> pa.Table:
        order = rows.sort_by([(c, "ascending") for c in ("length", "doc_id", "piece", "start", "ids_crc32")])
        length = order.column("length").to_numpy()
        new = np.append(True, length[1:] != length[:-1])
        at = np.flatnonzero(new)
        rank = order.column("before").to_numpy() + np.arange(len(length)) - at[np.cumsum(new) - 1]
        sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
        for lo, hi in zip(at, np.append(at[1:], len(length)), strict=True):
            n = int(length[lo])
            table = plan.value[n]
            k = np.searchsorted(table[:, 0], rank[lo:hi], "right") - 1
            inner = rank[lo:hi] - table[k, 0]
            sequence[lo:hi] = table[k, 2] + inner // table[k, 1]
            offset[lo:hi] = table[k, 3] + inner % table[k, 1] * n
        out = order.select(["doc_id", "piece", "start", "length", "ids_crc32"])
        return out.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    joined = placed.join(before, (placed.part == before.p) & (placed.length == before.n)).drop("p", "n")
    return joined.groupBy("part").applyInArrow(number, f"{PIECES}, sequence_id long, offset long")
