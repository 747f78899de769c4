"""One unit of work over several tables: all its rows become visible together, or none.

A table is a folder of units, ``<location>/<table>/unit=<key>``.  Readers look only at units that
have a commit marker, so rows of a load that was killed are never seen.  A unit writes the rows of each
table to the table's folder, then a journal row that says so, and last, in one small file, the marker.

Run again under the same name, a unit that was committed does nothing; one that was not takes up
the tables whose journal row exists, as long as nothing else has been committed since it began,
and writes the others again in place of what is there.  So a load that was killed at any point and
is run again leaves the same tables.

There is one writer at a time: a commit fails if another unit was committed after this one began.
The list of committed units is read into the driver; it has one row per load.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plotloom.plans.common import LoadResult

COMMITS = "unit string, name string, base string, targets array<string>"
JOURNAL = "target string, base string, rows_added long, rejected long"


def unit_key(name: str) -> str:
    """A name's key, fit for a folder."""
    return "u" + hashlib.sha256(name.encode()).hexdigest()[:24]


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A small table that may not be there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def committed(spark: SparkSession, location: str) -> list[tuple[str, list[str]]]:
    """(unit, tables) of every commit, in order of the units' keys."""
    return sorted((row["unit"], row["targets"]) for row in _read(spark, f"{location}/_commits/*", COMMITS).collect())


def read_committed(spark: SparkSession, location: str, table: str) -> DataFrame:
    """The rows of all committed units of a table."""
    paths = [f"{location}/{table}/unit={unit}" for unit, targets in committed(spark, location) if table in targets]
    if not paths:
        raise KeyError(f"no committed rows of {table}")
    return spark.read.parquet(*paths)


class UnitOfWork:
    """Appends to several tables that become visible together; ``name`` identifies the load."""

    def __init__(self, spark: SparkSession, location: str, name: str):
        self.spark, self.location, self.name, self.key = spark, location, name, unit_key(name)
        commits = committed(spark, location)
        self.done = self.key in [unit for unit, _ in commits]
        self._before = [(unit, targets) for unit, targets in commits if unit != self.key]
        self.base = hashlib.sha256("".join(unit for unit, _ in self._before).encode()).hexdigest()
        rows = _read(spark, self._journal("*"), JOURNAL).collect()
        self._staged = {row["target"]: row for row in rows if self.done or row["base"] == self.base}

    def _rows(self, table: str) -> str:
        return f"{self.location}/{table}/unit={self.key}"

    def _journal(self, table: str) -> str:
        return f"{self.location}/_journal/{self.key}/{table}"

    def _rejects(self, table: str) -> str:
        return f"{self.location}/_rejects/{self.key}/{table}"

    def read(self, table: str) -> DataFrame:
        """The committed rows of a table and those that this unit has staged."""
        paths = [f"{self.location}/{table}/unit={unit}" for unit, targets in self._before if table in targets]
        paths += [self._rows(table)] if table in self._staged else []
        if not paths:
            raise KeyError(f"no rows of {table}")
        return self.spark.read.parquet(*paths)

    def tables(self, names: Iterable[str]) -> dict[str, DataFrame]:
        return {name: self.read(name) for name in names}

    def stage(self, table: str, make: Callable[[], LoadResult]) -> DataFrame:
        """Write the rows and rejects of a load, and return the table as this unit sees it.

        ``make`` is called only if an earlier run of this unit has not staged the table.  Rows, rejects and
        their numbers come from one evaluation.
        """
        if table not in self._staged:
            result = make().evaluated()
            rows = result.new_rows
            if any(table in targets for _, targets in self._before):
                stored = self.read(table).schema
                missing = [f.name for f in stored if f.name not in rows.columns]
                rows = rows.withColumns({name: F.lit(None) for name in missing})
                rows = rows.select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in stored])
            rows.write.mode("overwrite").parquet(self._rows(table))
            result.rejects.write.mode("overwrite").parquet(self._rejects(table))
            self._write_journal(table)
        return self.read(table)

    def put(self, table: str, rows: DataFrame) -> None:
        """Stage rows as they are, such as the first content of a table."""
        self.stage(table, lambda: LoadResult(table, rows, rows.limit(0)))

    def _write_journal(self, table: str) -> None:
        added = self.spark.read.parquet(self._rows(table)).count()
        rejected = self.spark.read.parquet(self._rejects(table)).count()
        row = (table, self.base, added, rejected)
        journal = self.spark.createDataFrame([row], JOURNAL)
        journal.coalesce(1).write.mode("overwrite").parquet(self._journal(table))
        self._staged[table] = journal.first()

    def commit(self) -> None:
        """Make all staged rows visible; nothing is done if they are already."""
        if self.done:
            return
        now = [unit for unit, _ in committed(self.spark, self.location)]
        if now != [unit for unit, _ in self._before]:
            raise RuntimeError(f"another unit was committed since {self.name} began: run it again")
        marker = self.spark.createDataFrame([(self.key, self.name, self.base, sorted(self._staged))], COMMITS)
        marker.coalesce(1).write.mode("overwrite").parquet(f"{self.location}/_commits/{self.key}")
        self.done = True

    def report(self) -> DataFrame:
        """(target, rows_added, rejected) of the staged tables."""
        rows = [(row["target"], row["rows_added"], row["rejected"]) for row in self._staged.values()]
        return self.spark.createDataFrame(sorted(rows), "target string, rows_added long, rejected long")

    def rejects(self, table: str) -> DataFrame:
        return self.spark.read.parquet(self._rejects(table))


def run_unit(
    spark: SparkSession, location: str, name: str, steps: Mapping[str, Callable[[UnitOfWork], LoadResult]]
) -> UnitOfWork:
    """Stage one load per table in the order given, each seeing the rows of those before it, and commit."""
    unit = UnitOfWork(spark, location, name)
    if not unit.done:
        for table, step in steps.items():
            unit.stage(table, lambda step=step: step(unit))
        unit.commit()
    return unit
