"""From documents to packed training sequences: five stages, each written as Parquet and read again by the next.

Every stage works on all rows that its predecessor kept. Nulls count as empty texts. Documents are judged row by
row, whatever their ids: in the near-duplicate stage one row of each group of linked texts stays, that with the
smallest id (a null id counts as the largest; of equal ids the first in file order), and every row without links stays.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm import dedup, jaccard, packing, quality, toxicity
from starloom.llm.queries import quality_rules, table, toxicity_model
from starloom.session import scratch_path

MOST_FILES = 50_000  # whose names are broadcast: some MB
PAGE_BITS = 15  # rows of a page of bits: 4 KB
MOST_PAGES = 1 << 14  # that are broadcast: 64 MB, of half a billion rows at least


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score under 0.5."""
    model = toxicity_model(docs, table(spark, sf_dir, "labels"))
    name = fresh("toxicity", docs)
    return toxicity.score(docs, model, score_col=name).where(F.col(name) < 0.5).drop(name)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither fail the base rules nor are covered by a learned one."""
    rules = quality_rules(docs, table(spark, sf_dir, "labels"))
    prefix = fresh("quality_", docs)
    counted = quality.with_statistics(docs, prefix=prefix)
    return quality.with_verdict(counted, rules, prefix).where(F.col(f"{prefix}kept")).select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id."""
    return dedup.drop_copies(spark, docs)


def numbered(spark: SparkSession, docs: DataFrame, name: str) -> DataFrame:
    """`docs` with a number that is each row's own, from its file and its place there.

    Rows that come from no file are written first, since only a stored row has a place that stays.
    """
    place = ["_metadata.file_path", "_metadata.row_index"]
    try:
        docs.select(*place)
    except AnalysisException:
        path = scratch_path(spark, "numbered")
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
    file, at = fresh("row_file", docs), fresh("row_place", docs)
    placed = docs.withColumns({file: F.col(place[0]), at: F.col(place[1])})
    number = fresh("file_number", docs)
    files = placed.select(F.col(file).alias(f"{file}_")).distinct()
    files = files.withColumn(number, F.row_number().over(Window.orderBy(f"{file}_")))  # a row for each file
    if files.count() <= MOST_FILES:  # else the rows are shuffled to the names
        files = F.broadcast(files)
    joined = placed.join(files, F.col(file) == F.col(f"{file}_"))
    return joined.withColumn(name, F.col(number) * F.lit(1 << 40) + F.col(at)).drop(file, f"{file}_", at, number)


def without(spark: SparkSession, rows: DataFrame, leave: DataFrame, key: str) -> DataFrame:
    """`rows` but for those whose number `key` is among the numbers `member` of `leave`.

    The numbers become pages of bits, one for each row of a file, which go to the rows; so no text is shuffled.
    """
    path = scratch_path(spark, "leaving-rows")
    page = F.shiftright("member", PAGE_BITS).alias("leaving_page")
    bits = F.expr(f"bitmap_construct_agg(member & {(1 << PAGE_BITS) - 1})").alias("leaving_bits")
    leave.groupBy(page).agg(bits).write.parquet(path)
    pages = spark.read.parquet(path)
    if pages.count() <= MOST_PAGES:  # else the rows are shuffled to the pages
        pages = F.broadcast(pages)
    joined = rows.join(pages, F.shiftright(key, PAGE_BITS) == F.col("leaving_page"), "left")
    byte = f"substring(leaving_bits, cast(shiftright({key} & {(1 << PAGE_BITS) - 1}, 3) as int) + 1, 1)"
    leaves = F.expr(f"getbit(cast(conv(hex({byte}), 16, 10) as int), cast({key} & 7 as int)) = 1")
    return joined.where(F.col("leaving_bits").isNull() | ~leaves)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked documents, the one with the smallest id."""
    key = fresh("row_number", docs)
    rows = numbered(spark, docs, key)
    path = scratch_path(spark, "near-copies")
    jaccard.near_duplicates(rows.select(key, "text"), id_col=key).write.parquet(path)
    groups = spark.read.parquet(path).where("n_shingles > 0").select(F.col(key).alias("member"), F.col("component_id").alias("component"))
    ids = rows.select(F.col("doc_id").alias("id"), F.col(key).alias("k"))
    first = Window.partitionBy("component").orderBy(F.col("id").asc_nulls_last(), "k")
    stays = groups.join(ids, F.col("member") == F.col("k")).withColumn("n", F.row_number().over(first)).where("n = 1")
    leave = groups.join(stays.select(F.col("k").alias("stays")), F.col("member") == F.col("stays"), "left_anti").select("member")
    return without(spark, rows, leave, key).select(*[F.col(f"`{c}`") for c in docs.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequence and offset."""
    return packing.pack(docs)


def fresh(base: str, docs: DataFrame) -> str:
    """`base`, with as many underscores in front as keep it apart from the columns of `docs`."""
    while any(c.lower().startswith(base.lower()) for c in docs.columns):
        base = f"_{base}"
    return base


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_rules", drop_low_quality),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("best_fit_packing", pack_sequences),
]

#: The learned stages have no SQL; the tests hold every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the documents table on."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return out
        path = scratch_path(spark, f"stage-{name}")
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
