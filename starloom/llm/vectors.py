"""Near-duplicate vectors by a subspace pigeonhole join (operator 11).

Unit vectors with a cosine of `least` or more lie within a squared distance of 2 - 2 * least. Vectors are rotated and
split into blocks of dimensions; two close vectors are, in one block at least, within that block's share of the squared
distance, in proportion to its dimensions. So a range join in each block finds every link:

1. Equal vectors become one node with a count. Its rotated unit vector is kept as small whole numbers, so that block
   distances are exact in any task and order; the share of a block is widened by what the rounding can add.
2. In each block, nodes are numbered by their first coordinate and cut into tiles of so many nodes. A tile meets itself
   and the later tiles whose first coordinate comes within the block's radius, some at a time: a task holds one tile
   and a few partners, however many nodes share a place.
3. A pair within the block's share is a candidate. It is passed over if an earlier block has found it already, and
   verified by its cosine in double precision. Links are counted where they are found, and only a spanning forest of a
   task's links goes on to the components: no pairs are written, however large a group of close vectors is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.components import components
from starloom.llm.merkle import number_rows
from starloom.session import scratch_path

BLOCKS = 4
TILE = 8192
PARTNERS = 4  # tiles that a task holds beside its own, at most
SCALE = 2048  # of rotated components; squared distances of blocks then fit 24 bits, which single precision adds exactly
CELLS = 1 << 22  # of a distance matrix that is held at a time
DENSE = 0.05  # share of candidates from which a part of the matrix is verified as a whole
SOME = 1 << 15


def block_edges(size: int, blocks: int = BLOCKS) -> np.ndarray:
    """Where the blocks of dimensions begin and end."""
    blocks = max(1, min(blocks, size))
    return np.array([size * k // blocks for k in range(blocks + 1)])


def budgets(size: int, least: float, blocks: int = BLOCKS) -> np.ndarray:
    """The greatest squared distance, in whole numbers, that makes a candidate in each block.

    Rounding moves a component of a difference by 1 at most, so the whole by the root of its dimensions.
    """
    whole = (SCALE * np.sqrt(max(0.0, 2 - 2 * least)) * (1 + 1e-9) + np.sqrt(size)) ** 2
    return np.floor(whole * np.diff(block_edges(size, blocks)) / size + 1e-6).astype(np.int64)


def rotation(size: int) -> np.ndarray:
    """A fixed random rotation of so many dimensions."""
    q, r = np.linalg.qr(np.random.default_rng(size).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def units(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1, in double precision."""
    x = vectors.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def whole(turned: np.ndarray) -> np.ndarray:
    """Rotated unit vectors as whole numbers."""
    return np.rint(turned * SCALE).astype(np.int16)


class Forest:
    """Sets of connected nodes, numbered from 0."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            x, y = self.root[a], self.root[b]
            lo, hi = np.minimum(x, y), np.maximum(x, y)
            apart = lo != hi
            a, b, lo, hi = a[apart], b[apart], lo[apart], hi[apart]
            np.minimum.at(self.root, hi, lo)
            while True:
                up = self.root[self.root]
                if (up == self.root).all():
                    break
                self.root = up


def join_tiles(q: np.ndarray, u: np.ndarray, weight: np.ndarray, home: np.ndarray, own: bool, at: int, limit: np.ndarray, edges: np.ndarray, least: float):
    """Links of a tile, found in block `at`: how many each node has (by weight), and the nodes' roots.

    `home` are the nodes of the tile, the others its partners; with `own`, pairs within the tile count too.
    """
    n = len(q)
    inside, beyond = np.flatnonzero(home), np.flatnonzero(~home)
    partners = np.concatenate([inside, beyond]) if own else beyond
    links = np.zeros(n, np.int64)
    forest = Forest(n)
    sides = []
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        x = q[:, lo:hi].astype(np.float32)
        length = (x * x).sum(axis=1, keepdims=True)
        one = np.ones_like(length)
        # the product of a left and a right row is minus their squared distance
        sides.append((np.hstack([2 * x, -length, -one]), np.hstack([x, one, length])))

    def near(k: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return sides[k][0][a] @ sides[k][1][b].T >= -limit[k]

    def near_pairs(k: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        d = q[a, edges[k] : edges[k + 1]].astype(np.int64) - q[b, edges[k] : edges[k + 1]]
        return (d * d).sum(axis=1) <= limit[k]

    def found(a: np.ndarray, b: np.ndarray) -> None:
        np.add.at(links, a, weight[b])
        np.add.at(links, b, weight[a])
        forest.link(a, b)

    step = max(1, CELLS // max(1, len(partners)))
    for lo in range(0, len(inside), step):
        rows = inside[lo : lo + step]
        ok = near(at, rows, partners)
        if own:  # of a pair within the tile, the first row comes first
            ok[:, : len(inside)] &= np.arange(len(inside))[None, :] > np.arange(lo, lo + len(rows))[:, None]
        if np.count_nonzero(ok) > DENSE * ok.size:
            for k in range(at):
                ok &= ~near(k, rows, partners)
            ok &= u[rows] @ u[partners].T >= least
            i, j = np.nonzero(ok)
            found(rows[i], partners[j])
            continue
        i, j = np.nonzero(ok)
        for part in range(0, len(i), SOME):
            a, b = rows[i[part : part + SOME]], partners[j[part : part + SOME]]
            for k in range(at):
                new = ~near_pairs(k, a, b)
                a, b = a[new], b[new]
            linked = np.einsum("ij,ij->i", u[a], u[b]) >= least
            found(a[linked], b[linked])
    return links, forest.root


def near_vectors(
    vectors: DataFrame, least: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding", blocks: int = BLOCKS, tile: int = TILE
) -> DataFrame:
    """One row for each row of `vectors`: its id, n_links, component_id, kept.

    Two vectors are linked if their cosine is `least` or more. n_links counts the other rows that a row is linked with,
    component_id is the smallest id reachable by links, kept says whether that is the row's own.

    Vectors that are null, empty or zero, or that hold a null or a number that isn't finite, are linked with nothing, and
    vectors of different length never with each other. Rows with a null id take part in links; a component without any
    id has null and keeps its rows. Rows with one id are rows of their own.
    """
    spark = vectors.sparkSession

    def written(df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(spark, label)
        df.write.parquet(path)
        return spark.read.parquet(path)

    x = F.col(f"`{vector_col}`")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    usable = x.isNotNull() & finite & F.exists(x, lambda c: c != 0)
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), F.when(usable, x).alias("x"))
    element = vectors.schema[vector_col].dataType.elementType.typeName()
    kind = "<f4" if element == "float" else "<f8"

    # 1. nodes
    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: dict[int, np.ndarray] = {}
        for batch in batches:
            lists = batch.column(0)
            at = lists.offsets.to_numpy()
            values = lists.values.to_numpy(zero_copy_only=False)
            size = np.diff(at)
            v, q = [b""] * len(size), [b""] * len(size)
            for d in np.unique(size).tolist():
                if d not in turns:
                    turns[d] = rotation(d)
                own = np.flatnonzero(size == d)
                picked = values[at[own][:, None] + np.arange(d)]
                if kind == "<f8":  # so that no square overflows
                    picked = picked / np.abs(picked).max(axis=1, keepdims=True)
                for k, a, b in zip(own.tolist(), picked.astype(kind), whole(units(picked) @ turns[d]), strict=True):
                    v[k], q[k] = a.tobytes(), b.tobytes()
            columns = [pa.array(v, pa.binary()), pa.array(q, pa.binary()), pa.array(size.astype(np.int32)), lists, batch.column(1), batch.column(2)]
            yield pa.RecordBatch.from_arrays(columns, names=["v", "q", "size", "x", "low", "copies"])

    nodes = rows.where("x is not null").groupBy("x").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("copies"))
    kinds = dict(rows.dtypes)
    turned = nodes.select("x", "low", "copies").mapInArrow(turn, f"v binary, q binary, size int, x {kinds['x']}, low {kinds['id']}, copies long")
    nodes = written(turned.withColumn("node", F.monotonically_increasing_id()), "near-nodes")

    # 2. tiles: blk names the length of the vectors and the block of dimensions
    sizes = [r[0] for r in nodes.select("size").distinct().collect()]  # lengths of vectors
    edges = {d: block_edges(d, blocks) for d in sizes}
    limits = {d: budgets(d, least, blocks) for d in sizes}

    def first_coordinates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, size = (batch.column(c).to_numpy() for c in (0, 1))
            out: list[tuple] = []
            for k, q in enumerate(batch.column(2)):
                d = int(size[k])
                first = np.frombuffer(q.as_py(), np.int16)[edges[d][:-1]]
                out += [(node[k], d * blocks + b, y) for b, y in enumerate(first.tolist())]
            columns = zip(*out, strict=True) if out else ([], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int32()), strict=True)], names=["node", "blk", "y"])

    places = nodes.select("node", "size", "q").mapInArrow(first_coordinates, "node long, blk long, y int")
    members = written(
        number_rows(places, "blk", ["y", "node"]).select("node", "blk", "y", F.floor(F.col("idx") / tile).alias("tile")), "near-tiles"
    )
    spans = members.groupBy("blk", "tile").agg(F.min("y").alias("lo"), F.max("y").alias("hi"))
    radius = {d * blocks + b: int(np.sqrt(x)) + 1 for d in sizes for b, x in enumerate(limits[d].tolist())}
    reach = F.lit(0).cast("int")
    for blk, r in radius.items():
        reach = F.when(F.col("blk") == blk, F.lit(r)).otherwise(reach)
    spans = spans.withColumn("reach", reach)
    step = F.greatest("reach", F.lit(1))
    here = spans.select("blk", "tile", "hi", "reach", F.explode(F.sequence(F.floor(F.col("lo") / step), F.floor((F.col("hi") + F.col("reach")) / step))).alias("bin"))
    there = spans.select(F.col("blk").alias("blk2"), F.col("tile").alias("other"), F.col("lo").alias("begin"), F.floor(F.col("lo") / step).alias("bin2"))
    met = here.join(there, (F.col("blk") == F.col("blk2")) & (F.col("bin") == F.col("bin2")) & (F.col("other") >= F.col("tile")))
    met = met.where(F.col("begin") - F.col("hi") <= F.col("reach"))
    met = met.select("blk", "tile", "other", F.floor((F.col("other") - F.col("tile")) / PARTNERS).alias("part"))
    met = written(met, "near-pairs")
    # what each task gets: partners, and its own tile; part 0 holds the pair of the tile with itself
    sends = met.where("other > tile").select("blk", "tile", "part", F.col("other").alias("sent"), F.lit(False).alias("home"))
    sends = sends.union(met.select("blk", "tile", "part", F.col("tile").alias("sent"), F.lit(True).alias("home")).distinct())
    sends = sends.select(F.col("blk").alias("blk1"), F.col("tile").alias("tile1"), "part", "sent", "home")
    dealt = members.select("node", "blk", "tile").join(sends, (F.col("blk") == F.col("blk1")) & (F.col("tile") == F.col("sent")))
    dealt = dealt.select("blk", F.col("tile1").alias("tile"), "part", "home", F.col("node").alias("n"))
    content = dealt.join(nodes.select("node", "copies", "size", "v", "q"), F.col("n") == F.col("node")).drop("n")

    # 3. links
    def link(key: tuple, group: pa.Table) -> pa.Table:
        node, weight, home = (group.column(c).to_numpy() for c in ("node", "copies", "home"))
        d, part = group.column("size")[0].as_py(), key[2].as_py()
        q = np.frombuffer(b"".join(x.as_py() for x in group.column("q")), np.int16).reshape(-1, d)
        u = units(np.frombuffer(b"".join(x.as_py() for x in group.column("v")), kind).reshape(-1, d))
        links, root = join_tiles(q, u, weight, home.astype(bool), part == 0, key[0].as_py() % blocks, limits[d], edges[d], least)
        on = np.flatnonzero(links)
        return pa.table({"node": node[on], "links": links[on], "root": node[root[on]]})

    found = content.groupBy("blk", "tile", "part").applyInArrow(link, "node long, links long, root long")
    found = written(found, "near-links")
    counts = found.groupBy("node").agg(F.sum("links").alias("links")).withColumnRenamed("node", "counted")
    linked = components(found.select(F.col("node").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "member")
    named = linked.join(nodes.select("node", "low"), F.col("member") == F.col("node"))
    least_id = named.groupBy("component").agg(F.min("low").alias("lowest")).withColumnRenamed("component", "c")
    named = linked.join(least_id, F.col("component") == F.col("c")).select("member", "lowest")

    known = nodes.select(F.col("node"), F.col("x").alias("nx"), "low", "copies")
    known = known.join(counts, F.col("node") == F.col("counted"), "left").join(named, F.col("node") == F.col("member"), "left")
    known = known.select("nx", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.when(F.col("member").isNull(), F.col("low")).otherwise(F.col("lowest")).alias("lowest"))
    out = rows.where("x is not null").join(known, F.col("x") == F.col("nx")).select("id", "n_links", "lowest")
    alone = rows.where("x is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("lowest"))
    out = out.unionByName(alone)
    return out.select(
        F.col("id").alias(id_col), "n_links", F.col("lowest").alias("component_id"), F.col("id").eqNullSafe(F.col("lowest")).alias("kept")
    )
