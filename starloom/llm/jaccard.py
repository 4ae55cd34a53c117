"""N-gram Jaccard join with a prefix tree (operator 6).

A text's n-gram set is kept in one global order, that of the n-grams' hashes. Three steps find all links:

1. Routing. The order is cut into so many segments that two linked sets must have an equal segment (more
   segments than n-grams in which they can differ). Equal segments of two or more n-grams give candidates;
   sets with too few such segments also meet by single n-grams of their prefix. A passage that many texts
   share fills whole segments of few of them, so it makes few candidates. Equal sets meet as one. Candidates that
   hang together by what many texts share can be one component of millions of n-grams, though few are links; such a
   component is looked at again: the sets of each signature are compared by parities of their n-grams, which two linked
   sets can't differ in by more than they differ themselves, and what is left falls into small components.
2. Prefix-tree join. The sets of a candidate component come together, large components in pairs of blocks. The
   sets are stored in a path-compressed trie; the traversal shares the overlap of a common beginning, and
   leaves a subtree as soon as the n-grams that remain on either side can't give the required overlap, or
   all its sets are known to be connected with the probing set.
3. Links become components. Within a task only the links that connect are handed on, never all pairs.

All links count in full: 100 * intersection >= 80 * union on whole sets. Two different n-grams count as equal
with a chance of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.components import components
from starloom.llm.words import LOWER, give_back, hashes, lean, mix, text_slices, windows, words
from starloom.session import scratch_path

GRAM = 5
RATIO = 1.5  # of the upper bounds of neighbouring size classes
MOST_MARKS = 1 << 27  # bits of the bitmap of candidates: 16 MB
SLICE_BYTES = 1 << 18  # of texts whose n-grams are made together, about; they take some fifty times that
BLOCK_GRAMS = 2_000_000  # n-grams of the sets that one task holds at a time, about
PARITIES = 512  # of a set: bits that say by which parts of the hashes its n-grams are odd in number
MOST_PARITIES = 1200  # n-grams of a set whose parities still tell something
MOST_COMPARED = 20_000  # sets of one signature that are compared each with each


def _bounds() -> np.ndarray:
    out = [4]
    while out[-1] < 1 << 40:
        out.append(int(out[-1] * RATIO))
    return np.array(out, np.int64)


UPPER = _bounds()


def gram_sets(column: pa.Array, size: int = GRAM) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For runs of texts: first row, row of each distinct n-gram, its hash; ordered by row and hash.

    A text with fewer than `size` words has its whole word sequence as its one n-gram, one without words none.
    """
    for first, data, offsets in text_slices(column, SLICE_BYTES):
        data = LOWER[data]
        n = len(offsets) - 1
        start, end, row = words(data, offsets)
        hashed = hashes(data, start, end)
        gram, gram_row = windows(hashed, row, size)
        count = np.bincount(row, minlength=n)
        for k in range(1, size):
            some = (count == k)[row]
            if some.any():
                g, r = windows(hashed[some], row[some], k)
                gram, gram_row = np.append(gram, mix(g + np.uint64(k))), np.append(gram_row, r)
        order = np.lexsort((gram, gram_row))
        gram, gram_row = gram[order], gram_row[order]
        keep = np.ones(len(gram), bool)
        keep[1:] = (gram[1:] != gram[:-1]) | (gram_row[1:] != gram_row[:-1])
        yield first, gram_row[keep], gram[keep]


def fingerprints(rows: np.ndarray, grams: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Size of each of n sets and a hash of the set; 0 and 0 for an empty one."""
    size = np.bincount(rows, minlength=n).astype(np.int64)
    sums = np.zeros(n, np.uint64)
    at = np.flatnonzero(size)
    if len(at):
        sums[at] = mix(np.add.reduceat(mix(grams ^ np.uint64(0x5851F42D4C957F2D)), np.searchsorted(rows, at)) + size[at].astype(np.uint64)) | np.uint64(1)
    return size, sums.view(np.int64)


def signatures(rows: np.ndarray, grams: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, signature): two sets that are linked and differ have one in common."""
    out_row, out_sig = [], []
    own = np.searchsorted(UPPER, size)
    weak = np.zeros(len(size), bool)
    mixed = mix(grams)
    first_of = np.searchsorted(rows, np.arange(len(size)))
    for up in (0, 1):
        cls = own + up
        top = UPPER[cls]
        partner = np.minimum(top, size * 5 // 4)  # the largest set of this class that could be linked
        on = (size > 0) & (partner > (UPPER[np.maximum(cls - 1, 0)] if up else -1))
        differ = 2 * top // 9
        parts = (differ * 5) // 4 + 2
        mine = on[rows]
        r, g, m = rows[mine], grams[mine], mixed[mine]
        if not len(r):
            continue
        part = ((g >> np.uint64(32)) * parts[r].astype(np.uint64)) >> np.uint64(32)
        edge = np.flatnonzero(np.append(True, (r[1:] != r[:-1]) | (part[1:] != part[:-1])))
        count = np.diff(np.append(edge, len(r)))
        sig = mix(np.add.reduceat(m, edge) + part[edge] * np.uint64(0x9E3779B97F4A7C15) + cls[r[edge]].astype(np.uint64))
        good = count >= 2
        out_row.append(r[edge][good])
        out_sig.append(sig[good])
        enough = np.bincount(r[edge][good], minlength=len(size)) > (size + partner) // 9
        weak |= on & ~enough
    few = np.flatnonzero(weak)
    if len(few):  # the prefix: all but so many n-grams as a link needs, and one
        length = size[few] - -(-4 * size[few] // 5) + 1
        at = np.repeat(first_of[few] - np.append(0, np.cumsum(length)[:-1]), length) + np.arange(length.sum())
        out_row.append(np.repeat(few, length))
        out_sig.append(mix(grams[at] ^ np.uint64(0xA5A5A5A5A5A5A5A5)))
    if not out_row:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(out_row), np.concatenate(out_sig).view(np.int64)


def parities(rows: np.ndarray, grams: np.ndarray, size: np.ndarray) -> list[bytes]:
    """PARITIES bits of each set, or nothing for an empty one and for one of over MOST_PARITIES n-grams."""
    out = [b""] * len(size)
    for lo in range(0, len(size), 1024):
        some = size[lo : lo + 1024]
        a, b = np.searchsorted(rows, (lo, lo + len(some)))
        odd = np.bincount((rows[a:b] - lo) * PARITIES + (grams[a:b] % np.uint64(PARITIES)).astype(np.int64), minlength=len(some) * PARITIES) & 1
        packed = np.packbits(odd.astype(np.uint8).reshape(len(some), PARITIES), axis=1)
        for i in np.flatnonzero((some > 0) & (some <= MOST_PARITIES)):
            out[lo + i] = packed[i].tobytes()
    return out


def near_pairs(size: np.ndarray, bits: np.ndarray, marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that connect all sets that may be linked, directly or over others; sizes and parities rule the rest out.

    Linked sets have at most a ninth of their n-grams, counted together, for themselves, and differ in no more parities.
    `marked`: which sets have parities.
    """
    left, out_a, out_b = np.arange(len(size)), [], []
    while len(left) > 1:
        stack, left = [left[0]], left[1:]
        while stack and len(left):
            i = stack.pop()
            n = size[left]
            ok = (4 * n <= 5 * size[i]) & (4 * size[i] <= 5 * n)
            if marked[i]:
                ok &= (9 * np.bitwise_count(bits[left] ^ bits[i]).sum(1, dtype=np.int64) <= n + size[i]) | ~marked[left]
            hit = left[ok]
            out_a.append(hit)
            out_b.append(np.full(len(hit), i))
            left = left[~ok]
            stack.extend(hit)
    none = np.zeros(0, np.int64)
    return (np.concatenate(out_a), np.concatenate(out_b)) if out_a else (none, none)


class Union:
    """Which of n things are connected."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        up = self.up
        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            while up[x] != x:
                up[x] = up[up[x]]
                x = up[x]
            while up[y] != y:
                up[y] = up[up[y]]
                y = up[y]
            if x != y:
                up[max(x, y)] = min(x, y)

    def roots(self) -> np.ndarray:
        while True:
            new = self.up[self.up]
            if (new == self.up).all():
                return new
            self.up = new


class PrefixTree:
    """Ordered sets in a path-compressed trie. Sets are ids 0.. with tokens as sorted small integers."""

    def __init__(self, sets: list[np.ndarray], full_size: np.ndarray):
        keys = [s.astype(">u4").tobytes() for s in sets]
        self.order = np.array(sorted(range(len(sets)), key=keys.__getitem__), np.int64)
        self.tokens = [sets[i] for i in self.order]
        n = len(sets)
        seg_set, seg_from, seg_to, first, last, parent = [], [], [], [], [], []
        stack: list[tuple[int, int]] = []  # (node, depth at its end)

        def node(owner: int, start: int, end: int, up: int) -> int:
            seg_set.append(owner)
            seg_from.append(start)
            seg_to.append(end)
            first.append(owner)
            last.append(owner)
            parent.append(up)
            return len(seg_set) - 1

        self.root = node(0, 0, 0, -1)
        stack.append((self.root, 0))
        self.leaf = np.zeros(n, np.int64)  # the node at which each set ends
        for k in range(n):
            now = self.tokens[k]
            common = 0
            if k:
                before = self.tokens[k - 1]
                m = min(len(before), len(now))
                differs = np.flatnonzero(before[:m] != now[:m])
                common = int(differs[0]) if len(differs) else m
            while stack[-1][1] > common:
                top, _ = stack.pop()
                below = stack[-1][1]
                if below < common:  # cut the segment in two
                    upper = node(seg_set[top], seg_from[top], common, parent[top])
                    first[upper] = first[top]
                    seg_from[top], parent[top] = common, upper
                    stack.append((upper, common))
                    break
            if len(now) > common:
                stack.append((node(k, common, len(now), stack[-1][0]), len(now)))
            self.leaf[k] = stack[-1][0]
            for v, _ in stack:
                last[v] = k
        self.seg_set, self.seg_from, self.seg_to = (np.array(x, np.int64) for x in (seg_set, seg_from, seg_to))
        self.first, self.last, self.parent = (np.array(x, np.int64) for x in (first, last, parent))
        by = np.argsort(self.parent[1:], kind="stable") + 1
        self.child = by
        self.child_at = np.searchsorted(self.parent[by], np.arange(len(seg_set) + 1))
        size = full_size[self.order]
        self.size = size
        length = np.array([len(t) for t in self.tokens], np.int64)
        self.small, self.large, self.rest = (np.zeros(len(seg_set), np.int64) for _ in range(3))
        for v in range(len(seg_set)):
            a, b = self.first[v], self.last[v] + 1
            self.small[v], self.large[v] = size[a:b].min(), size[a:b].max()
            self.rest[v] = length[a:b].max() - self.seg_to[v]
        self.flat = np.concatenate(self.tokens) if n else np.zeros(0, np.int64)
        self.flat_at = np.append(0, np.cumsum(length))
        ends = np.argsort(self.leaf, kind="stable")
        self.end_set = ends
        self.end_at = np.searchsorted(self.leaf[ends], np.arange(len(seg_set) + 1))

    def links(self, probes: list[np.ndarray], probe_size: np.ndarray, probe_root: np.ndarray, roots: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(probe, set) pairs that are linked, but for those whose roots are known to be equal.

        `width`: more than any token. `roots`: of the tree's sets, by their ids.
        """
        root = roots[self.order]
        low = np.minimum.reduceat(np.append(root, root[-1:]), np.stack([self.first, self.last + 1], 1).ravel())[::2]
        high = np.maximum.reduceat(np.append(root, root[-1:]), np.stack([self.first, self.last + 1], 1).ravel())[::2]
        length = np.array([len(p) for p in probes], np.int64)
        keys = np.concatenate([p.astype(np.int64) + i * width for i, p in enumerate(probes)])
        ends = np.cumsum(length)
        p = np.arange(len(probes))
        v = np.full(len(p), self.root)
        overlap = np.zeros(len(p), np.int64)
        found_p, found_s = [], []
        while len(p):
            seg = self.seg_to[v] - self.seg_from[v]
            some = np.flatnonzero(seg)
            last = np.zeros(len(p), np.int64)  # how many of the probe's tokens come up to here
            if len(some):
                n = seg[some]
                begin = self.flat_at[self.seg_set[v[some]]] + self.seg_from[v[some]]
                offset = np.append(0, np.cumsum(n)[:-1])
                at = np.repeat(begin - offset, n) + np.arange(n.sum())
                want = np.repeat(p[some], n) * width + self.flat[at]
                pos = np.searchsorted(keys, want, "right")
                overlap[some] += np.add.reduceat((keys[np.maximum(pos - 1, 0)] == want).astype(np.int64), offset)
                last[some] = pos[offset + n - 1]
                rest = ends[p] - np.where(seg > 0, last, 0)
                rest[seg == 0] = length[p[seg == 0]]
            else:
                rest = length[p]
            x = probe_size[p]
            alive = 9 * (overlap + np.minimum(rest, self.rest[v])) >= 4 * (x + self.small[v])
            alive &= (5 * self.large[v] >= 4 * x) & (4 * self.small[v] <= 5 * x)
            alive &= ~((low[v] == high[v]) & (low[v] == probe_root[p]))
            p, v, overlap = p[alive], v[alive], overlap[alive]
            n = self.end_at[v + 1] - self.end_at[v]
            if n.any():
                at = np.repeat(self.end_at[v] - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())
                s, q, o = self.end_set[at], np.repeat(p, n), np.repeat(overlap, n)
                on = (9 * o >= 4 * (probe_size[q] + self.size[s])) & (root[s] != probe_root[q])
                found_p.append(q[on])
                found_s.append(self.order[s[on]])
            n = self.child_at[v + 1] - self.child_at[v]
            at = np.repeat(self.child_at[v] - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())
            p, overlap, v = np.repeat(p, n), np.repeat(overlap, n), self.child[at]
        none = np.zeros(0, np.int64)
        return (np.concatenate(found_p), np.concatenate(found_s)) if found_p else (none, none)


def connected(sets: list[np.ndarray], left: np.ndarray | None = None) -> np.ndarray:
    """The root of each of `sets` (sorted hashes) by links; with `left`, only links between left and the others count.

    N-grams that only one set has can't be shared and are left out of the tree; sizes stay the full ones.
    """
    size = np.array([len(s) for s in sets], np.int64)
    union = Union(len(sets))
    flat = np.concatenate(sets)
    unique, which, count = np.unique(flat, return_inverse=True, return_counts=True)
    rank = np.empty(len(unique), np.int64)
    rank[np.lexsort((unique, -count))] = np.arange(len(unique))  # common ones first: more of the tree is shared
    shared = (count > 1)[which]
    place = rank[which]
    ends = np.cumsum(size)
    small = []
    for k in range(len(sets)):
        part = slice(ends[k] - size[k], ends[k])
        small.append(np.sort(place[part][shared[part]]))
    inside = np.flatnonzero(~left) if left is not None else np.arange(len(sets))
    probing = np.flatnonzero(left) if left is not None else inside
    if not len(inside) or not len(probing):
        return union.roots()
    tree = PrefixTree([small[i] for i in inside], size[inside])
    budget, at, step = 4_000_000, 0, 8
    mean = max(1, int(sum(len(small[i]) for i in inside)))
    while at < len(probing):
        now = probing[at : at + step]
        at += step
        step = max(1, min(2 * step, budget // mean * 8 + 1))
        roots = union.roots()
        p, s = tree.links([small[i] for i in now], size[now], roots[now], roots[inside], len(unique) + 1)
        a, b = now[p], inside[s]
        union.join(a[a != b], b[a != b])
    return union.roots()


def set_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, n, fp and parities of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, mark = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            bits = [b""] * len(batch)
            for first, rows, grams in gram_sets(batch.column(1)):
                n = int(rows[-1]) + 1 if len(rows) else 0
                size[first : first + n], mark[first : first + n] = fingerprints(rows, grams, n)
                bits[first : first + n] = parities(rows, grams, size[first : first + n])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size), pa.array(mark), pa.array(bits, pa.binary())], names=["id", "n", "fp", "bits"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(lambda batches: lean(run(batches)), "id long, n long, fp long, bits binary")


def _candidates(docs: DataFrame, text_col: str) -> DataFrame:
    """sig, a, b: fingerprints of sets with a common signature, as a star around the smallest of each signature."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, rows, grams in gram_sets(batch.column(0)):
                if not len(rows):
                    continue
                size, mark = fingerprints(rows, grams, int(rows[-1]) + 1)
                _, one = np.unique(mark, return_index=True)  # copies at hand sign once
                first = np.zeros(len(size), bool)
                first[one] = True
                keep = first[rows]
                row, sig = signatures(rows[keep], grams[keep], np.where(first, size, 0))
                yield pa.RecordBatch.from_arrays([pa.array(sig), pa.array(mark[row])], names=["sig", "fp"])

    def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sig = hub = fp = None
        for batch in batches:
            s, f = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            if not len(s):
                continue
            new = np.append(s[0] != sig, s[1:] != s[:-1])
            at = np.maximum.accumulate(np.where(new, np.arange(len(s)), -1))
            hubs = np.where(at < 0, hub if hub is not None else 0, f[np.maximum(at, 0)])
            on = (f != hubs) & (new | np.append(f[0] != fp, f[1:] != f[:-1]))  # a repeated set is one
            yield pa.RecordBatch.from_arrays([pa.array(x[on]) for x in (s, f, hubs)], names=["sig", "a", "b"])
            sig, hub, fp = s[-1], hubs[-1], f[-1]

    signed = docs.select(F.col(text_col).alias("text")).mapInArrow(lambda batches: lean(sign(batches)), "sig long, fp long")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return signed.repartition(n, "sig").sortWithinPartitions("sig", "fp").mapInArrow(lambda batches: lean(stars(batches)), "sig long, a long, b long")


def _refined(shared: DataFrame, big: DataFrame, table: DataFrame) -> DataFrame:
    """a, b: candidates among the sets `big` (fp), as pairs that connect those of a signature that may be linked.

    `shared` are stars of signatures, whose hubs are in the components of their other members.
    """
    spark = shared.sparkSession
    mine = shared.join(big, F.col("a") == F.col("fp"), "left_semi")
    members = mine.select("sig", F.col("a").alias("member")).union(mine.select("sig", F.col("b").alias("member")).distinct())
    marks = table.where("n > 0").join(big, "fp", "left_semi").dropDuplicates(["fp"]).select("fp", "n", "bits")

    def compare(sig: np.ndarray, fp: np.ndarray, size: np.ndarray, bits: pa.Array) -> pa.RecordBatch:
        """Whole signatures, ascending."""
        out_a, out_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        edge = np.append(np.flatnonzero(np.append(True, sig[1:] != sig[:-1])), len(sig))
        marked = pc.binary_length(bits).to_numpy(zero_copy_only=False) > 0
        content = np.zeros((len(sig), PARITIES // 64), np.uint64)
        if marked.any():
            content[marked] = np.frombuffer(b"".join(bits.filter(pa.array(marked)).to_pylist()), np.uint64).reshape(-1, PARITIES // 64)
        for a, b in zip(edge[:-1], edge[1:], strict=True):
            _, one = np.unique(fp[a:b], return_index=True)
            at = a + one
            if len(at) > MOST_COMPARED:
                x, y = np.arange(1, len(at)), np.zeros(len(at) - 1, np.int64)
            else:
                x, y = near_pairs(size[at], content[at], marked[at])
            out_a.append(fp[at[x]])
            out_b.append(fp[at[y]])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # the last ones, which may go on with a signature

        def whole(up_to: int | None = None) -> pa.RecordBatch:
            rows = pa.Table.from_batches(held).slice(0, up_to).combine_chunks()
            columns = [rows.column(c).to_numpy() for c in range(3)]
            return compare(*columns, rows.column(3).combine_chunks())

        for batch in batches:
            if not batch.num_rows:
                continue
            sig = batch.column(0).to_numpy()
            start = int(np.searchsorted(sig, sig[-1]))  # of the batch's last signature
            if start or (held and held[-1].column(0)[-1].as_py() != sig[0]):
                held.append(batch.slice(0, start))
                yield whole()
                held.clear()
            held.append(batch.slice(start))
        if held:
            yield whole()

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    joined = members.join(marks, F.col("member") == F.col("fp")).select("sig", "member", "n", "bits")
    dealt = joined.repartition(n, "sig").sortWithinPartitions("sig")
    return dealt.mapInArrow(lambda batches: lean(run(batches)), "a long, b long").where("a <> b")


def _routed(shared: DataFrame, table: DataFrame, sets: DataFrame) -> DataFrame:
    """fp, id, n, grp, blocks: sets with the component that they are a candidate in, and how many blocks it takes."""
    spark = table.sparkSession

    def weighed(routed: DataFrame) -> DataFrame:
        weight = routed.groupBy("grp").agg(F.sum("n").alias("w")).select(F.col("grp").alias("g"), F.ceil(F.col("w") / BLOCK_GRAMS).cast("int").alias("blocks"))
        path = scratch_path(spark, "jaccard-groups")
        routed.join(weight, F.col("grp") == F.col("g")).drop("g").write.parquet(path)
        return spark.read.parquet(path)

    def of_groups(groups: DataFrame) -> DataFrame:
        return groups.join(sets, groups.node == sets.fp).select("fp", "id", "n", F.col("component").alias("grp"))

    routed = weighed(of_groups(components(shared.select("a", "b"))))
    big = routed.where("blocks > 1")
    if big.isEmpty():
        return routed
    parted = weighed(of_groups(components(_refined(shared, big.select("fp"), table))))
    return routed.where("blocks = 1").union(parted)


def _chosen_texts(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """mark (the hash of the text's set) and text of rows (d, text) whose d may be among the ids of `chosen`: of all that are, and few others.

    A bitmap of hashed ids, of at most MOST_MARKS bits, goes to the workers, so that texts without a candidate
    are left out before the join shuffles any. Where it is too small for the ids it lets more rows through.
    Both happen in one walk over the rows, as each of two would hold a Python worker of its own in every task.
    """
    spark = rows.sparkSession
    size = max(1 << 15, min(MOST_MARKS, 1 << (16 * chosen.count()).bit_length()))
    place = F.pmod(F.xxhash64("id"), F.lit(size))
    pages = (
        chosen.select(place.alias("at"))
        .groupBy(F.shiftright("at", 15).alias("page"))
        .agg(F.expr("bitmap_construct_agg(at & 32767)").alias("bits"))
        .toArrow()  # at most size / 2**15 rows of 4 KB
    )
    marks = np.zeros(size // 8, np.uint8)
    for page, bits in zip(pages["page"].to_pylist(), pages["bits"].to_pylist(), strict=True):
        marks[page * 4096 : (page + 1) * 4096] = np.frombuffer(bits, np.uint8)
    shared = spark.sparkContext.broadcast(marks)

    def with_mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(1).to_numpy()
            on = (shared.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1
            texts = batch.column(0).filter(pa.array(on.astype(bool)))
            for first, own, grams in gram_sets(texts):
                if not len(own):
                    continue
                n = int(own[-1]) + 1
                sizes, mark = fingerprints(own, grams, n)
                ok = np.flatnonzero(sizes > 0)
                part = texts.slice(first, n).take(pa.array(ok))
                yield pa.RecordBatch.from_arrays([pa.array(mark[ok]), part], names=["mark", "text"])

    placed = rows.select("text", F.pmod(F.xxhash64("d"), F.lit(size)).alias("at"))
    return placed.mapInArrow(lambda batches: lean(with_mark(batches)), "mark long, text string")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: the id, `n_shingles` and `component_id`, the smallest id reachable by links.

    A null or wordless text has 0 n-grams and is a component of its own, as is a row without any link. Rows
    with a null id take part in links; a component without any id has null. Repeated rows give repeated rows.
    """
    spark = docs.sparkSession

    def written(df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(spark, label)
        df.write.parquet(path)
        return spark.read.parquet(path)

    table = written(set_table(docs, id_col, text_col), "jaccard-sets")
    shared = written(_candidates(docs, text_col), "jaccard-shared")
    sets = table.where("n > 0").groupBy("fp").agg(F.min("id").alias("id"), F.max("n").alias("n"))
    routed = _routed(shared, table, sets)
    total = routed.where("blocks = 1").agg(F.sum("n")).first()[0] or 0
    bundles = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-2 * total // BLOCK_GRAMS))
    routed = routed.withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))

    def read_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            want = batch.column(0).to_numpy()
            for first, rows, grams in gram_sets(batch.column(4)):
                if not len(rows):
                    continue
                n = int(rows[-1]) + 1
                size, mark = fingerprints(rows, grams, n)
                ok = np.flatnonzero((mark == want[first : first + n]) & (size > 0))
                at = np.searchsorted(rows, np.arange(n + 1))
                part = batch.slice(first, n).take(pa.array(ok))
                content = pa.array([grams[at[i] : at[i + 1]].tobytes() for i in ok], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns[:4], content], names=["fp", "grp", "blocks", "block", "grams"])

    # a text comes to its set by the set's own hash, once however often it is there and whatever its ids are
    text = _chosen_texts(docs.select(F.col(id_col).cast("long").alias("d"), F.col(text_col).alias("text")), routed.select("id"))
    text = text.dropDuplicates(["mark"])
    content = routed.join(text, routed.fp == text.mark).select("fp", "grp", "blocks", "block", "text")
    content = content.mapInArrow(lambda batches: lean(read_sets(batches)), "fp long, grp long, blocks int, block int, grams binary")
    content = content.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    content = content.select(
        "fp",
        "grp",
        "block",
        "grams",
        F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("grp"), F.lit(bundles))).otherwise(F.col("grp")).alias("k"),
        F.when(F.col("blocks") == 1, -1).otherwise(F.least("block", "other")).alias("lo"),
        F.when(F.col("blocks") == 1, -1).otherwise(F.greatest("block", "other")).alias("hi"),
    )

    def join_block(key: tuple, block: pa.Table) -> pa.Table:
        fp, grp, side = (block.column(c).to_numpy() for c in ("fp", "grp", "block"))
        raw = block.column("grams")
        out_a, out_b = [], []
        order = np.lexsort((fp, grp))
        edges = np.append(np.flatnonzero(np.append(True, grp[order][1:] != grp[order][:-1])), len(order))
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            at = order[a:b]
            at = at[np.append(True, fp[at][1:] != fp[at][:-1])]  # a repeated id may bring a set twice
            if len(at) < 2:
                continue
            sets = [np.frombuffer(raw[int(i)].as_buffer(), np.uint64) for i in at]
            lo, hi = key[1].as_py(), key[2].as_py()
            roots = connected(sets, side[at] == lo if lo != hi else None)
            on = roots != np.arange(len(at))
            out_a.append(fp[at][on])
            out_b.append(fp[at][roots[on]])
        give_back()
        none = np.zeros(0, np.int64)
        return pa.table({"a": np.concatenate(out_a) if out_a else none, "b": np.concatenate(out_b) if out_b else none})

    links = content.groupBy("k", "lo", "hi").applyInArrow(join_block, "a long, b long")
    linked = components(links)
    label = linked.join(sets.select("fp", "id"), F.col("node") == F.col("fp"))
    label = label.groupBy("component").agg(F.min("id").alias("low")).join(linked, "component").select("node", "low")
    first = sets.select(F.col("fp").alias("f"), F.col("id").alias("own"))
    ids = first.join(label, F.col("f") == F.col("node"), "left").select("f", F.coalesce("low", "own").alias("low"))
    out = table.join(ids, (table.fp == ids.f) & (table.n > 0), "left")
    return out.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("low")).otherwise(F.col("id")).alias("component_id"),
    )
