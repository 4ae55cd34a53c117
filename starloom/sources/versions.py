"""Tables that are refreshed aside and then switched to.

A table is a folder of versions, each written by one job into a folder of its own. A version counts from the moment
its job has committed, which Spark marks by a `_SUCCESS` file written last; until then, and after a killed refresh,
readers find the version before. Names of versions begin with an underscore, so that no reader takes the folder of a
table for one large table of all its versions.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

VERSION = re.compile(r"_v(\d{9})$")
DONE = "_SUCCESS"


def _folder(spark: SparkSession, path: str):
    """The file system of a path and the path as it names it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, at = _folder(spark, path)
    return fs.exists(at)


def make_folder(spark: SparkSession, path: str) -> None:
    """An empty folder, which reads as no rows, unless there is one."""
    fs, at = _folder(spark, path)
    fs.mkdirs(at)


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, at = _folder(spark, path)
    fs.delete(at, True)


def _versions(spark: SparkSession, path: str) -> dict[int, bool]:
    """Numbers of the versions there are, and whether each is complete."""
    fs, at = _folder(spark, path)
    if not fs.exists(at):
        return {}
    found = {}
    for status in fs.listStatus(at):  # a few folders, see `keep`
        if named := VERSION.search(status.getPath().getName()):
            found[int(named[1])] = fs.exists(spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), DONE))
    return found


def _at(path: str, number: int) -> str:
    return f"{path.rstrip('/')}/_v{number:09}"


def current_path(spark: SparkSession, path: str) -> str:
    """The folder of the newest complete version; the path itself, if it has no versions."""
    done = [n for n, complete in _versions(spark, path).items() if complete]
    return _at(path, max(done)) if done else path


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """The newest complete version."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(current_path(spark, path))


def replace_rows(df: DataFrame, path: str, keep: int = 2) -> DataFrame:
    """A full refresh; reruns leave no duplicates, and the old rows stay readable until the new ones are whole.

    Returns the new version. The `keep` newest complete versions stay, for readers that have opened them; older and
    broken ones go. Two refreshes at once don't mix: the later one to start its job fails.
    """
    spark = df.sparkSession
    before = _versions(spark, path)
    number = max(before, default=0) + 1
    df.write.mode("errorifexists").parquet(_at(path, number))
    stay = sorted([number, *(n for n, complete in before.items() if complete)])[-max(1, keep) :]
    for old in before:
        if old not in stay:
            delete_folder(spark, _at(path, old))
    return spark.read.schema(df.schema).parquet(_at(path, number))
