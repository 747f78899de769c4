"""Tables: reading by name, writing, verifying."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plotloom.operators.keys import lookup


def read_tables(spark: SparkSession, location: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """Parquet tables by name, lazily: pruning and filters reach each scan."""
    return {name: spark.read.parquet(f"{location}/{name}") for name in names}


def read_jdbc_tables(
    spark: SparkSession, url: str, names: Iterable[str], properties: Mapping[str, str], id_column: str = "id",
    bounds: tuple[int, int] | None = None, partitions: int = 64,
) -> dict[str, DataFrame]:
    """The same from a database whose driver jar is supplied; split by id range if bounds are given."""
    if bounds is None:
        return {name: spark.read.jdbc(url, name, properties=dict(properties)) for name in names}
    return {
        name: spark.read.jdbc(
            url, name, column=id_column, lowerBound=bounds[0], upperBound=bounds[1],
            numPartitions=partitions, properties=dict(properties),
        )
        for name in names
    }


def list_tables(spark: SparkSession, database: str | None = None) -> list[str]:
    return sorted(table.name for table in spark.catalog.listTables(database))


def append(df: DataFrame, path: str) -> None:
    """One atomic write; the committer publishes files only when the whole job is done."""
    df.write.mode("append").parquet(path)


def replace(df: DataFrame, path: str) -> None:
    """Write a recomputed table to a path of its own; readers switch once it is complete."""
    df.write.mode("errorifexists").parquet(path)


def update_column(target: DataFrame, updates: DataFrame, key: str, column: str) -> DataFrame:
    """``target`` with ``column`` taken from ``updates`` (one row per key) where it has the key,
    a null value included."""
    marked = updates.withColumns({"__hit": F.lit(True), "__order": F.lit(0)})
    found = lookup(target, marked, key, key, {"__new": column, "__hit": "__hit"}, ["__order"])
    return found.withColumn(column, F.when(F.col("__hit"), F.col("__new")).otherwise(F.col(column))).drop("__new", "__hit")


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; quotes inside quoted cells are doubled, as the sheet reader expects them."""
    df.write.mode("errorifexists").options(header=True, escape='"').csv(path)


def verify_load(spark: SparkSession, path: str) -> DataFrame:
    """Read a table back after a write: its row count and number of columns."""
    stored = spark.read.parquet(path)
    return stored.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(stored.columns)))


def peek(df: DataFrame, count: int = 6, order: Sequence | None = None) -> DataFrame:
    """The first rows in a stated order (a display, hence the limit)."""
    return (df if order is None else df.orderBy(*order)).limit(count)


def dimensions(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def load_report(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Rows added per table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows_added")).select(F.lit(table).alias("target"), "rows_added")
        for table, df in frames.items()
    ]
    stacked = counts[0]
    for count in counts[1:]:
        stacked = stacked.unionByName(count)
    return stacked
