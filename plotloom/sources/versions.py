"""A stored table whose updates rewrite only the files they touch.

The table is a folder of data files and a folder of manifests; a manifest lists the files of one
version and is written last, in one small file, so readers see a version whole or not at all.  An update reads the
key column of all files beside the name of the file, finds the files that hold a key to be updated, writes
their rows anew, and lists the new files in place of the old ones.

An update is known by its name: one that has a manifest is not made again, and one that was killed
before is made again in place of what it left.  There is one writer at a time; a second one fails when it
writes the same version.  The driver sees the names of files, not rows.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plotloom.operators.keys import only_known
from plotloom.sources.tables import update_column
from plotloom.sources.unit import unit_key

MANIFEST = "version long, name string, files array<string>"


def _manifests(spark: SparkSession, path: str) -> list:
    return sorted(spark.read.schema(MANIFEST).parquet(f"{path}/_manifests/*").collect(), key=lambda row: row["version"])


def _commit(spark: SparkSession, path: str, version: int, name: str, files: list[str]) -> None:
    manifest = spark.createDataFrame([(version, name, sorted(files))], MANIFEST)
    manifest.coalesce(1).write.mode("errorifexists").parquet(f"{path}/_manifests/{version:08d}")


def _written(spark: SparkSession, folder: str) -> list[str]:
    return [unquote(file) for file in spark.read.parquet(folder).inputFiles()]


def create(df: DataFrame, path: str, name: str = "created") -> None:
    """The first version of a table."""
    folder = f"{path}/data/{unit_key(name)}"
    df.write.mode("overwrite").parquet(folder)
    _commit(df.sparkSession, path, 0, name, _written(df.sparkSession, folder))


def files(spark: SparkSession, path: str) -> list[str]:
    """The files of the latest version."""
    return list(_manifests(spark, path)[-1]["files"])


def read(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the latest version."""
    return spark.read.parquet(*files(spark, path))


def update(spark: SparkSession, path: str, name: str, updates: DataFrame, key: str, column: str) -> list[str]:
    """Set ``column`` from ``updates`` (key, column; one row per key) where it has the key, a null value included.

    Null keys are keys like others.  Returns the files that were written anew; none if no key is stored.
    """
    known = _manifests(spark, path)
    if any(row["name"] == name for row in known):
        return []
    now = list(known[-1]["files"])
    table = spark.read.parquet(*now)
    # Listings and scans may write a path's beginning differently; folder and name are enough.
    short = F.array_join(F.slice(F.split("_metadata.file_path", "/"), -2, 2), "/")
    held = table.select(F.col(key), short.alias("__file"))
    hit = {row["__file"] for row in only_known(held, updates, [key]).select("__file").distinct().collect()}
    touched = [file for file in now if "/".join(file.split("/")[-2:]) in hit]
    if touched:
        folder = f"{path}/data/{unit_key(name)}"
        changed = update_column(spark.read.schema(table.schema).parquet(*touched), updates, key, column)
        changed.select(table.columns).write.mode("overwrite").parquet(folder)
        new = _written(spark, folder)
    else:
        new = []
    _commit(spark, path, known[-1]["version"] + 1, name, [file for file in now if file not in touched] + new)
    return new
