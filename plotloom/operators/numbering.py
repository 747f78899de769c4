"""Dense numbering without sorting everything in one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plotloom.session import cut_lineage, shuffle_partitions

# Copies of one row are written in runs of this length, so that the copies of a hot
# row are written by many tasks.
RUN_LENGTH = 100_000


def bucket_offsets(counted: DataFrame, bucket: str, size: str = "__n") -> DataFrame:
    """Rows in all earlier buckets, per bucket; the input has one row per bucket."""
    before = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return counted.select(bucket, F.coalesce(F.sum(size).over(before), F.lit(0)).alias("__offset"))


def number_distinct(df: DataFrame, bucket: Column, order: Sequence[str], out: str, start: Column | int = 0) -> DataFrame:
    """``start + 1, start + 2, ...`` by (bucket, order) for rows that differ in ``order``.

    ``bucket`` must have a fixed number of values (65,536 here and below): the offsets
    are at most that many rows, hence the broadcast, and every bucket is numbered on its own.
    """
    marked = df.withColumn("__bucket", bucket)
    counts = marked.groupBy("__bucket").agg(F.count(F.lit(1)).alias("__n"))
    offsets = bucket_offsets(counts, "__bucket").withColumnRenamed("__bucket", "__b")
    within = F.row_number().over(Window.partitionBy("__bucket").orderBy(*order))
    start = F.lit(start) if isinstance(start, int) else start
    numbered = marked.withColumn("__row", within).join(
        F.broadcast(offsets), F.col("__bucket").eqNullSafe(F.col("__b"))
    )
    return numbered.withColumn(out, start + F.col("__offset") + F.col("__row")).drop(
        "__bucket", "__b", "__row", "__offset"
    )


def hash_bucket(columns: Sequence[str]) -> Column:
    """One of 65,536 buckets from the md5 of the columns."""
    parts = [F.coalesce(F.col(column).cast("string"), F.lit("")) for column in columns]
    return F.substring(F.md5(F.concat_ws("|", *parts)), 1, 4)


def range_bucket(df: DataFrame, position: str, buckets: int = 65536) -> Column:
    """One of ``buckets`` equal ranges of a whole-number position, in position order."""
    low = df.agg(F.min(position)).scalar()
    high = df.agg(F.max(position)).scalar()
    width = F.greatest(F.lit(1), F.ceil((high - low + F.lit(1)) / F.lit(buckets)))
    return F.floor((F.col(position) - low) / width)


def assign_ids(df: DataFrame, existing: DataFrame, id_column: str = "id") -> DataFrame:
    """Add ids following the largest stored id, dense and repeatable.

    Equal rows are collapsed to one row with a count before the shuffle and expanded
    again afterwards, so that many copies of one row never sit in one bucket.
    """
    columns = df.columns
    start = existing.agg(F.coalesce(F.max(id_column), F.lit(0)).cast("long")).scalar()
    packed = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("__copies")).withColumn("__bucket", hash_bucket(columns))
    first = _first_ids(packed, columns, start)
    ordinary = first.where(F.col("__copies") <= RUN_LENGTH)
    single = ordinary.withColumn("__copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__copies") - 1)))

    # The copies of a row with very many are split into runs that many tasks write; ids and
    # order are the same.
    step = F.lit(RUN_LENGTH).cast("long")
    hot = first.where(F.col("__copies") > RUN_LENGTH)
    runs = hot.withColumn("__run", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__copies") - 1, step)))
    spread = runs.repartition(shuffle_partitions(df.sparkSession), "__first", "__run")
    last = F.least(F.col("__run") + RUN_LENGTH, F.col("__copies")) - 1
    many = spread.withColumn("__copy", F.explode(F.sequence(F.col("__run"), last)))

    numbered = [frame.select((F.col("__first") + F.col("__copy")).alias(id_column), *columns) for frame in (single, many)]
    return numbered[0].unionByName(numbered[1])


def _first_ids(packed: DataFrame, columns: Sequence[str], start: Column) -> DataFrame:
    """The id of the first copy of every distinct row."""
    counts = packed.groupBy("__bucket").agg(F.sum("__copies").alias("__n"))
    offsets = bucket_offsets(counts, "__bucket").withColumnRenamed("__bucket", "__b")
    before = Window.partitionBy("__bucket").orderBy(*columns).rowsBetween(Window.unboundedPreceding, -1)
    counted = packed.withColumn("__before", F.coalesce(F.sum("__copies").over(before), F.lit(0)))
    placed = counted.join(F.broadcast(offsets), F.col("__bucket") == F.col("__b"))
    return placed.withColumn("__first", start + F.col("__offset") + F.col("__before") + 1)


def in_ranges(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """The rows sorted into ranges, each with its range ``__part`` and its place in it ``__at`` (from 0).

    Materialised, so the ranges stay what they are.  Rows that are equal in ``order`` are of one range.
    """
    dealt = df.repartitionByRange(shuffle_partitions(df.sparkSession), *order).sortWithinPartitions(*order)
    # Partition number above 33 bits, place in the partition below.
    kept = cut_lineage(dealt.withColumn("__place", F.monotonically_increasing_id()))
    part = F.shiftright("__place", 33).cast("int")
    return kept.withColumns({"__part": part, "__at": F.col("__place").bitwiseAND(F.lit((1 << 33) - 1))}).drop("__place")


def with_previous(df: DataFrame, keys: Sequence[str], x: str, values: Mapping[str, str]) -> DataFrame:
    """Add columns (new name -> column) of the row before in ``x`` with the same keys; null for a first row.

    Every range of rows is gone through on its own, and its first row looks at the last row of the
    range before: one row per range, however long a group is.
    """
    ranged = in_ranges(df, [*keys, x])
    window = Window.partitionBy("__part", *keys).orderBy(x)
    within = ranged.withColumns({out: F.lag(column).over(window) for out, column in values.items()})
    row = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keys)], *[F.col(c).alias(f"v{i}") for i, c in enumerate(values.values())])
    lasts = ranged.groupBy("__part").agg(F.max_by(row, "__at").alias("row")).select("__part", "row.*")
    known = sorted(lasts.collect(), key=lambda r: r["__part"])  # one row per range
    carried = [(after["__part"], *before[1:]) for before, after in zip(known, known[1:])]
    schema = lasts.schema
    ahead = df.sparkSession.createDataFrame(carried, schema).withColumnRenamed("__part", "__p")
    joined = within.join(F.broadcast(ahead), (F.col("__part") == F.col("__p")) & (F.col("__at") == 0), "left")
    same = F.col("__p").isNotNull()
    for i, key in enumerate(keys):
        same = same & F.col(key).eqNullSafe(F.col(f"k{i}"))
    filled = {out: F.when(same, F.col(f"v{i}")).otherwise(F.col(out)) for i, out in enumerate(values)}
    extra = ["__part", "__at", "__p", *[f"k{i}" for i in range(len(keys))], *[f"v{i}" for i in range(len(values))]]
    return joined.withColumns(filled).drop(*extra)


def number_rows(df: DataFrame, order: Sequence[Column | str], out: str, start: int = 0) -> DataFrame:
    """Row number after ``start`` in the given order, in ranges: only the ranges' sizes are added up in one place."""
    ranged = in_ranges(df, order)
    sizes = sorted((row["__part"], row["count"]) for row in ranged.groupBy("__part").count().collect())
    offsets, so_far = [], start
    for part, size in sizes:  # one row per range
        offsets.append((part, so_far))
        so_far += size
    before = df.sparkSession.createDataFrame(offsets, "__p int, __offset long")
    placed = ranged.join(F.broadcast(before), F.col("__part") == F.col("__p"))
    number = (F.col("__offset") + F.col("__at") + 1).cast("int")
    return placed.withColumn(out, number).drop("__part", "__at", "__p", "__offset")
