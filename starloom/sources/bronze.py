"""Landing and reading raw JSON feeds (A1-A4)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.classic.column import Column as JvmColumn
from pyspark.sql.types import ArrayType, StructType

from starloom.operators.columns import fresh_name, quoted
from starloom.sources.lake import PARTITIONS, day_path


# For layers that only Spark reads: JSON shrinks to a tenth or so, and hardly a second is lost on it.
PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
LINES_PER_FILE = 20_000  # of packed lines, as a packed file isn't split


def read_feed(
    spark: SparkSession,
    base: str,
    source: str,
    days: list[date] | date,
    schema: StructType,
) -> DataFrame:
    """A1/A2: one row per element of the JSON arrays of these days, with `source` and `ingestion_date`.

    Only the folders of the days asked for are listed, so the cost does not grow with the history. A field
    of another kind than declared is null; a file that is not exactly one JSON array stops the read: also
    a bare object, one object per line, or anything after the array.

    Files are read as whole texts and parsed from memory. The multi-line JSON reader would go back to the
    file for every number that is declared as text: one more read, or one more request to an object
    store, per value. A file is one value of one task here: this suits files of some hundred MB. Feeds that
    came through the gate are better read by `read_elements`, which splits a file over tasks.
    """
    days = [days] if isinstance(days, date) else list(days)
    paths = [day_path(f"{base}/bronze", source, d) for d in days]
    files = spark.read.option("basePath", f"{base}/bronze").text(paths, wholetext=True)
    elements = F.coalesce(
        F.when(_is_array(F.col("value")), F.from_json("value", ArrayType(schema))),
        F.raise_error(F.concat(F.lit("not a JSON array: "), F.col("_metadata.file_path"))),
    )
    return files.select(F.inline(elements), "source", "ingestion_date")


def split_elements(
    spark: SparkSession, base: str, source: str, day: date, root: str | None = None, packed: bool = False
) -> DataFrame:
    """A1: beside the unchanged payloads of a day, the same elements one per line, as they are written there.

    This is the only step that holds a whole file, one at a time in a task. What reads the elements afterwards reads
    lines, which Spark splits by size whatever the file they came from. A line break inside an element can only be
    space between its parts, and becomes a blank. A rerun replaces the day. `packed` lines take a tenth or so of the disk,
    in files of LINES_PER_FILE lines, each of which is read by one task.

    B3: with `root`, one of the lines must have that field, which ends the search; none is an error. Returns the lines.
    """
    files = spark.read.option("basePath", f"{base}/bronze").text(day_path(f"{base}/bronze", source, day), wholetext=True)
    broken = F.contains("element", F.lit("\n")) | F.contains("element", F.lit("\r"))  # hardly ever
    joined = F.when(broken, F.regexp_replace("element", r"[\r\n]+", " ")).otherwise(F.col("element"))
    element = F.coalesce(joined, F.lit("null"))
    raw = F.coalesce(
        F.when(_is_array(F.col("value")), F.from_json("value", "array<string>")),
        F.raise_error(F.concat(F.lit("not a JSON array: "), F.col("_metadata.file_path"))),
    )
    lines = files.select(F.explode(raw).alias("element")).select(element.alias("value"))
    path = day_path(f"{base}/elements", source, day)
    lines.write.mode("overwrite").options(**({**PACKED, "maxRecordsPerFile": LINES_PER_FILE} if packed else {})).text(path)
    written = spark.read.text(path)
    if root and written.filter(F.get_json_object("value", f"$['{root}']").isNotNull()).isEmpty():
        raise ValueError(f"expected '{root}' in the feed of {source}; no element has it")
    return written


def read_elements(spark: SparkSession, base: str, source: str, days: list[date] | date, schema: StructType) -> DataFrame:
    """A1/A2: the rows of `read_feed`, from the lines that `split_elements` wrote, so by as many tasks as their size asks for.

    An element that is no object is a row of nulls.
    """
    days = [days] if isinstance(days, date) else list(days)
    lines = spark.read.option("basePath", f"{base}/elements").text([day_path(f"{base}/elements", source, d) for d in days])
    # as rows of a generator, below which Spark moves no filter: it would parse every line once more for it
    return lines.select(F.inline_outer(F.array(F.from_json("value", schema))), *PARTITIONS)


def _same_form(path: Column) -> Column:
    """File names come as `file:/x` or `file:///x`, depending on who lists them."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def _listed(scan: DataFrame) -> DataFrame:
    """path of every file of a scan, those of zero length too, which Spark lists but leaves out of its tasks.

    The list is that of the scan's own file index and stays on its side.
    """
    spark = scan.sparkSession
    names = JvmColumn(spark._jvm.org.apache.spark.sql.functions.lit(scan._jdf.inputFiles()))
    return spark.range(0, 1, 1, 1).select(F.explode(names).alias("name")).select(_same_form(F.col("name")).alias("path")).distinct()


def _alone(body: Column) -> Column:
    """The parser stops after the first value, so the text is counted as the single element of an array around it."""
    return F.json_array_length(F.concat(F.lit("["), body, F.lit("]"))) == 1


def _array_length(body: Column) -> Column:
    """The number of elements if the text is one JSON array and nothing else, else null."""
    return F.when(_alone(body), F.json_array_length(body))


def _is_array(body: Column) -> Column:
    """Whether `_array_length` isn't null, without counting: a single value that begins like an array is one."""
    return _alone(body) & F.startswith(F.ltrim(body, F.lit(" \t\r\n")), F.lit("["))


def judge_payloads(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """A3: adds `n_records`, `reason` and `accepted`; only a JSON array with an element passes.

    The array must be the whole payload.
    """
    body = F.col(payload)

    def verdict(n: Column) -> Column:
        reason = F.when(body.isNull() | (body == ""), "empty body").when(n.isNull(), "not a JSON array").when(n == 0, "no records")
        return F.struct(n.alias("n_records"), reason.alias("reason"))

    # the length is bound once as a lambda variable: written into every test, the payload would be parsed for each
    judged = fresh_name(payloads, "_judged")
    found = payloads.withColumn(judged, F.transform(F.array(_array_length(body)), verdict)[0])
    return found.withColumns(
        {
            "n_records": F.col(judged)["n_records"],
            "reason": F.col(judged)["reason"],
            "accepted": F.col(judged)["reason"].isNull(),
        }
    ).drop(judged)


def landed_payloads(spark: SparkSession, landing: str) -> DataFrame:
    """path, partition columns and payload of the landed files that hold anything."""
    bodies = spark.read.text(landing, wholetext=True)
    lineage = [c for c in bodies.columns if c != "value"]
    return bodies.select(_same_form(F.col("_metadata.file_path")).alias("path"), *lineage, F.col("value").alias("payload"))


def landing_report(spark: SparkSession, landing: str) -> DataFrame:
    """A3: one row per landed file: path, partition columns, payload, and the verdict on it.

    A whole file is one value, which is what a feed file is: one response of one source. The gate judges files as a
    whole, so a file must fit the memory of a task, and can't be larger than 2 GB.
    """
    read = landed_payloads(spark, landing)
    unread = _listed(spark.read.text(landing, wholetext=True)).join(read.select("path"), "path", "left_anti")
    return judge_payloads(read.unionByName(unread, allowMissingColumns=True))


def promote(report: DataFrame, base: str, packed: bool = False) -> None:
    """A2: accepted payloads, unchanged, to `bronze/source=/ingestion_date=`; a rerun replaces the day. Files may be `packed`."""
    (
        report.filter("accepted")
        .select("payload", "source", "ingestion_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", 1)
        .options(**(PACKED if packed else {}))
        .partitionBy("source", "ingestion_date")
        .text(f"{base}/bronze")
    )


def flatten_pages(
    pages: DataFrame,
    items: str,
    page: str = "page",
    keys: list[str] | None = None,
) -> DataFrame:
    """A4: the items of all pages before the first empty page of their feed, one row per item.

    A page whose `items` array is missing or empty ends its feed, also when later pages hold items.
    The first empty page is one small row per feed, aggregated before any shuffle. A null key is a feed
    like any other.
    """
    keys = keys or []
    name = fresh_name(pages, "_stop")
    empty = F.coalesce(F.size(items), F.lit(0)) <= 0
    stops = pages.groupBy(*keys).agg(F.min(F.when(empty, F.col(page))).alias(name))
    if keys:
        ends = stops.toDF(*[fresh_name(pages, f"_key{i}") for i in range(len(keys))], name)
        same = [F.col(quoted(k)).eqNullSafe(F.col(e)) for k, e in zip(keys, ends.columns)]
        kept = pages.join(ends, same, "left")
        stop = F.col(name)
    else:
        kept = pages
        stop = stops.select(name).scalar()
    return (
        kept.filter(stop.isNull() | (F.col(page) < stop))
        .select(*keys, page, F.explode(items).alias("item"))
    )
