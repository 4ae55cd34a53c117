"""A Merkle manifest of a dataset: one tree for each source, one over the sources (operator 13).

Rows become leaves, the digests of their fields. Within a source leaves stand in the order of their ids; while
more than one node is left, every `arity` consecutive ones become the digest of their hex texts, so a run may be
shorter at the end. What is left is the source's subroot; the subroots in the order of the sources make a tree of
the same kind, whose end is the root.

Each level is one equijoin of its nodes with computed sibling indices: a node in slot 0 knows where its siblings are
(`index XOR 1` for binary trees, its index and all slot offsets otherwise), meets them there, and emits the parent,
with the run that it stands for. Proofs are then handed down from the root: a child's proof is its parent's run, with
the slot that the child has in it, and its parent's proof. One expression folds it per leaf.

Texts are hashed where they are read; only digests move. Rows are numbered after a range partitioning by source,
id and digest, stored once, so that a source with most of the rows is spread over all tasks. Each level is written
to the shared folder: a lost executor costs a task of one level.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.session import scratch_path

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 16


def digest_of_fields(values: list[Column]) -> Column:
    """SHA-256 of the fields: `-` for a null, else its length in UTF-8 bytes, a colon and the value."""
    parts = []
    for v in values:
        text = v.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def hex_text(digests: Column) -> Column:
    return F.lower(F.hex(digests))


@dataclass
class Manifest:
    """`leaves`: gid, idx (place in the source), n (leaves of the source), leaf, and what was carried along.

    `subroots`: gid (place of the source, from 0), subroot. `levels` and `top`: the nodes of each level above the leaves
    of the sources' trees, and of the tree over the sources: gid, idx, n (nodes of the level in that tree), run (the
    digests below the node, end to end) and h. `root` is None for no rows.
    """

    leaves: DataFrame
    subroots: DataFrame
    levels: list[DataFrame]
    top: list[DataFrame]
    root: str | None


def _written(df: DataFrame, label: str) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.parquet(path)


def number_rows(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """`rows` with gid (number of the group in ascending order, nulls first), idx (place in the group), n (its size).

    Both count from 0. The rows are range-partitioned by group and order and stored; a task's rows are counted, and
    sums over the counts (as many as tasks and groups) say where each task goes on. Rows that are equal in group and
    order are told apart by a number that only decides which of them comes first.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.withColumn("tie", F.xxhash64(F.monotonically_increasing_id()))
    keys = [F.col(c).asc_nulls_first() for c in (group, *order, "tie")]
    placed = _written(rows.repartitionByRange(parts, *keys).withColumn("part", F.spark_partition_id()), "merkle-rows")
    counts = placed.groupBy("part", F.col(group).alias("g")).agg(F.count(F.lit(1)).alias("here"))
    groups = counts.groupBy("g").agg(F.min("part").alias("first_part"), F.sum("here").alias("n"))
    per_part = groups.groupBy("first_part").agg(F.count(F.lit(1)).alias("m"))  # a row for each task at most
    before = per_part.selectExpr("first_part as p", "sum(m) over (order by first_part) - m as before")
    groups = groups.join(before, F.col("first_part") == F.col("p")).selectExpr(
        "g as g1", "n", "before + row_number() over (partition by first_part order by g asc nulls first) - 1 as gid"
    )
    counts = counts.selectExpr("part as part1", "g", "sum(here) over (partition by g order by part) - here as offset")
    starts = counts.join(groups, F.col("g").eqNullSafe(F.col("g1"))).drop("g1")
    inside = Window.partitionBy("part", group).orderBy(*keys)
    joined = placed.join(starts, (F.col("part") == F.col("part1")) & F.col(group).eqNullSafe(F.col("g")))
    return joined.withColumn("idx", F.col("offset") + F.row_number().over(inside) - 1).drop("part", "part1", "g", "offset", "tie")


def _level(nodes: DataFrame, arity: int) -> DataFrame:
    """gid, idx, n, run and h of the parents of `nodes` (gid, idx, n, h)."""
    if arity == 2:
        siblings = F.array(F.col("idx"), F.col("idx").bitwiseXOR(F.lit(1)))
    else:
        siblings = F.transform(F.array(*[F.lit(o) for o in range(arity)]), lambda o: F.col("idx") + o)
    first = nodes.where(F.col("idx") % arity == 0).select("gid", "idx", "n", F.explode(siblings).alias("sibling"))
    other = nodes.select(F.col("gid").alias("g"), F.col("idx").alias("i"), "h")
    met = first.where("sibling < n").join(other, (F.col("gid") == F.col("g")) & (F.col("sibling") == F.col("i")))
    runs = met.groupBy("gid", "idx", "n").agg(F.sort_array(F.collect_list(F.struct("sibling", "h"))).alias("run"))
    joined = runs.select(
        "gid",
        F.floor(F.col("idx") / arity).alias("idx"),
        F.ceil(F.col("n") / arity).alias("n"),
        F.aggregate("run", F.lit(b""), lambda a, x: F.concat(a, x["h"])).alias("run"),
    )
    return joined.withColumn("h", F.unhex(F.sha2(hex_text(F.col("run")), 256)))


def _climb(nodes: DataFrame, arity: int, label: str) -> tuple[list[DataFrame], DataFrame]:
    """All levels above `nodes` (gid, idx, n, h), and what remains of each tree: gid, subroot."""
    levels: list[DataFrame] = []
    most = nodes.agg(F.max("n")).first()[0] or 0
    ends = [nodes]
    while most > 1:
        levels.append(_written(_level(ends[-1].where("n > 1"), arity), label))
        ends.append(levels[-1].select("gid", "idx", "n", "h"))
        most = -(-most // arity)
    return levels, reduce(DataFrame.unionAll, [x.where("n = 1").select("gid", F.col("h").alias("subroot")) for x in ends])


def build(rows: DataFrame, group: str, order: str, leaf: str, arity: int = ARITY) -> Manifest:
    """The manifest of `rows`, whose column `leaf` holds their digests (32 bytes).

    Null ids come first in their source, rows with one id follow their digests, and equal rows are equal leaves;
    the null source comes first. Other columns are carried along. The names gid, idx, n, tie, part, g, g1, part1,
    offset, h must be free.
    """
    if arity < 2:
        raise ValueError("a run has two nodes at least")
    leaves = _written(number_rows(rows, group, [order, leaf]), "merkle-leaves")
    nodes = leaves.select("gid", "idx", "n", F.col(leaf).alias("h"))
    levels, ends = _climb(nodes, arity, "merkle-level")
    subroots = _written(ends, "merkle-subroots")  # a row for each source
    sources = subroots.count()
    nodes = subroots.select(F.lit(0).cast("long").alias("gid"), F.col("gid").alias("idx"), F.lit(sources).cast("long").alias("n"), F.col("subroot").alias("h"))
    top, last = _climb(nodes, arity, "merkle-top")
    found = last.select(hex_text(F.col("subroot"))).first()  # one row
    return Manifest(leaves, subroots, levels, top, found[0] if found else None)


def _handed_down(nodes: DataFrame, parents: DataFrame, arity: int) -> DataFrame:
    """`nodes` with path: the run and the slot in it, and so on up, from their parents (gid, idx, run, path)."""
    above = parents.select(F.col("gid").alias("g"), F.col("idx").alias("i"), F.col("run").alias("above"), F.col("path").alias("rest"))
    met = nodes.join(above, (F.col("gid") == F.col("g")) & (F.floor(F.col("idx") / arity) == F.col("i")))
    own = F.struct(F.col("above").alias("run"), (F.col("idx") % arity).cast("int").alias("slot"))
    return met.withColumn("path", F.concat(F.array(own), F.col("rest"))).drop("g", "i", "above", "rest")


def with_paths(manifest: Manifest, arity: int = ARITY) -> DataFrame:
    """The leaves with subroot (hex) and path: the run and the slot in it, for each level up to the root."""
    none = F.array().cast("array<struct<run:binary,slot:int>>")
    if manifest.root is None:
        return manifest.leaves.withColumn("subroot", F.lit(None).cast("string")).withColumn("path", none)
    sources = manifest.subroots.select(F.lit(0).cast("long").alias("gid"), F.col("gid").alias("idx"))
    parents = None
    for level in reversed(manifest.top):
        parents = level.withColumn("path", none) if parents is None else _handed_down(level, parents, arity)
    ends = sources.withColumn("path", none) if parents is None else _handed_down(sources, parents, arity)
    ends = _written(ends.select(F.col("idx").alias("tree"), F.col("path").alias("up")), "merkle-ends")

    def located(nodes: DataFrame, parents: DataFrame | None) -> DataFrame:
        """`nodes` with path; those alone in their level are the ends of their trees."""
        last = nodes.where("n = 1").join(ends, F.col("gid") == F.col("tree")).withColumnRenamed("up", "path").drop("tree")
        return last if parents is None else last.unionByName(_handed_down(nodes.where("n > 1"), parents, arity))

    parents = None
    for k, level in reversed([*enumerate(manifest.levels)]):
        parents = located(level.drop("h"), parents)
        if k:  # the lowest is read once
            parents = _written(parents, "merkle-paths")
    leaves = located(manifest.leaves, parents)
    subroot = manifest.subroots.select(F.col("gid").alias("g"), hex_text(F.col("subroot")).alias("subroot"))
    return leaves.join(subroot, F.col("gid") == F.col("g")).drop("g")


def _sides(x: Column) -> tuple[Column, Column]:
    """What stands before and behind a slot of a run, as hex text."""
    before = F.substring(x["run"], F.lit(1), x["slot"] * 32)
    after = F.substring(x["run"], x["slot"] * 32 + 33, F.octet_length(x["run"]))
    return hex_text(before), hex_text(after)


def fold(leaf: Column, path: Column) -> Column:
    """The root (hex) that a leaf (hex) and the siblings on its path give."""

    def up(acc: Column, x: Column) -> Column:
        before, after = _sides(x)
        return F.sha2(F.concat(before, acc, after), 256)

    return F.aggregate(path, leaf, up)


def proof_digest(path: Column) -> Column:
    """SHA-256 of all siblings on the path as hex text, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda x: F.concat(*_sides(x))), ""), 256)


def document_leaves(docs: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """doc_id, source, leaf, and checked: the digest of the row as it is found later.

    Rows whose id has a CRC-32 divisible by 5 are found with the letters A-Z of their text in lower case.
    """
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    own = digest_of_fields([F.col(c) for c in fields])
    changed = digest_of_fields([F.translate(F.col(c), upper, lower) if c == "text" else F.col(c) for c in fields])
    return docs.select("doc_id", "source", own.alias("leaf"), F.when(hit, changed).otherwise(own).alias("checked"))


def verified_manifest(spark: SparkSession, docs: DataFrame, arity: int = ARITY) -> DataFrame:
    """Build the manifest of `docs`, find some rows changed, and verify every row by its proof.

    Columns: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified. No rows give no rows; null fields and
    null ids are part of the manifest, and repeated rows are leaves of their own. A single leaf has an empty proof.
    """
    rows = _written(document_leaves(docs), "merkle-digests")
    manifest = build(rows, "source", "doc_id", "leaf", arity)
    found = with_paths(manifest, arity)
    out = found.select(
        "doc_id",
        hex_text(F.col("leaf")).alias("leaf"),
        "subroot",
        F.lit(manifest.root).cast("string").alias("root"),
        proof_digest(F.col("path")).alias("proof_sha256"),
        fold(hex_text(F.col("checked")), F.col("path")).alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
