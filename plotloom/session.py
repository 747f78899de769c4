"""Session settings the jobs rely on, and the folder used to cut lineage."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution sizes the reduce side, turns small sides into broadcasts from
# measured sizes and splits hot join partitions.  The forced skew split costs one more
# exchange where a later step wanted the same partitioning, which is cheap next to
# one task holding a third of the rows.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(master: str = "local[8]", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(master)
        .appName("plotloom")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    for key, value in RUNTIME_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the folder the cluster names; choose one only for a local master."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        current = context._jsc.sc().getCheckpointDir()
        if current.isDefined():
            return current.get()
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="plotloom-checkpoint-")
    context.setCheckpointDir(configured)
    return configured


# Rows that go to Python at once while a stage is materialised; whole texts in the default of ten times as
# many take some hundred megabytes on either side.
BATCH_ROWS = 1000


@contextmanager
def short_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of at most ``BATCH_ROWS`` rows for what runs inside; the session's own setting holds again after it."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    own = int(spark.conf.get(name))
    spark.conf.set(name, str(min(own, BATCH_ROWS) if own > 0 else BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(name, str(own))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise a stage in the shared folder, so a lost executor costs no recomputation."""
    ensure_checkpoint_dir(df.sparkSession)
    with short_batches(df.sparkSession):
        return df.checkpoint()
