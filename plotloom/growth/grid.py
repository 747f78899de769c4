"""Likelihood search of the power law over a grid of its three parameters."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plotloom.growth.boxes import SLACK, Search, bounded, errors, lower_bounds, quarters
from plotloom.growth.points import ARRAY_LIMIT, compress, pack, point_arrays, point_matrix
from plotloom.operators.keys import join_same
from plotloom.operators.reshape import union_all
from plotloom.operators.stats import best_by, log_lik
from plotloom.session import cut_lineage, shuffle_partitions

AXES = ("M0", "r", "beta")
POSITION = ("i", "j", "k")
# Ranges of the first axis into which a group's search is dealt out.
RANGES = 8
# Packs of boxes in which a long group's search is dealt out.
PACKS = 64
Axes = Mapping[str, tuple[float, float, int]]


def _axis(low: float, high: float, count: int, position: str, name: str) -> Column:
    """An array of (position, value) along one axis."""
    step = (high - low) / (count - 1) if count > 1 else 0.0
    steps = F.sequence(F.lit(0), F.lit(count - 1))
    return F.transform(steps, lambda i: F.struct(i.alias(position), (F.lit(low) + i * F.lit(step)).alias(name)))


def _plane(m0: float, r: np.ndarray, beta: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Squared error over the (r, beta) plane for one initial mass; NaN where undefined."""
    left = 1 - beta[None, :]
    total = np.zeros((len(r), len(beta)))
    with np.errstate(all="ignore"):
        base, power = np.power(m0, left), 1 / left
        slope = r[:, None] * left
        for x, n, y, within in points:
            gap = y - np.power(base + slope * x, power)
            total += n * gap * gap + within
    return total


def _planes(batches: Iterator[pd.DataFrame], keys: list[str], axes) -> Iterator[pd.DataFrame]:
    m0, r, beta = _values(axes)
    for batch in batches:
        for _, row in batch.iterrows():
            points = point_matrix(row).T
            for i in range(row["first"], row["last"] + 1):
                total = _plane(m0[i], r, beta, points).ravel()
                at = np.arange(len(total))
                out = {key: [row[f"key{place}"]] * len(at) for place, key in enumerate(keys)}
                out.update(i=i, j=at // len(beta), k=at % len(beta), M0=m0[i])
                out.update(r=r[at // len(beta)], beta=beta[at % len(beta)], rss=total, n=points[:, 1].sum())
                yield pd.DataFrame(out)


def _values(axes: Axes) -> list[np.ndarray]:
    """The numbers on each axis."""
    found = []
    for low, high, count in (axes[name] for name in AXES):
        step = (high - low) / (count - 1) if count > 1 else 0.0
        found.append(low + np.arange(count) * step)
    return found


def _ranged(packed: DataFrame, keys: Sequence[str], axes: Axes) -> DataFrame:
    """Every group array once per range of the first axis, of which there are ``RANGES`` at most."""
    count = axes["M0"][2]
    edges = [count * part // RANGES for part in range(RANGES + 1)]
    ranges = [(begin, end - 1) for begin, end in zip(edges, edges[1:]) if begin < end]
    listed = F.array(*[F.struct(F.lit(a).alias("first"), F.lit(b).alias("last")) for a, b in ranges])
    named = [F.col(key).alias(f"key{at}") for at, key in enumerate(keys)]
    rows = packed.withColumn("__a", F.explode(listed)).select(*named, "chunk", "__a.first", "__a.last", *point_arrays())
    by = [f"key{at}" for at in range(len(keys))]
    return rows.repartition(shuffle_partitions(packed.sparkSession), *by, "chunk", "first")


def _fields(packed: DataFrame, keys: Sequence[str]) -> list[T.StructField]:
    fields = [packed.schema[key] for key in keys]
    fields += [T.StructField(name, T.IntegerType()) for name in POSITION]
    return fields + [T.StructField(name, T.DoubleType()) for name in (*AXES, "rss", "n")]


def _squares(packed: DataFrame, keys: Sequence[str], axes) -> DataFrame:
    """Squared error per grid point, one task row per group, chunk and range of the first axis."""
    key_list, given = list(keys), dict(axes)
    schema = T.StructType(_fields(packed, keys))
    return _ranged(packed, keys, axes).mapInPandas(lambda it: _planes(it, key_list, given), schema)


def _summed(packed: DataFrame, keys: Sequence[str], axes) -> DataFrame:
    """Squared error of groups held in several arrays, added per grid point."""
    columns = [*keys, *POSITION, *AXES]
    parts = _squares(packed.where(F.col("chunks") > 1), keys, axes)
    return parts.groupBy(*columns).agg(F.sum("rss").alias("rss"), F.sum("n").alias("n"))


def _likelihood(squares: DataFrame, keys: Sequence[str]) -> DataFrame:
    error = F.when(~F.isnan("rss"), F.col("rss"))
    return squares.select(*keys, *POSITION, *AXES, log_lik(F.col("n"), error).alias("LL"))


def grid_values(
    df: DataFrame,
    keys: Sequence[str],
    axes: Axes,
    x: str = "x",
    y: str = "y",
    array_limit: int = ARRAY_LIMIT,
) -> DataFrame:
    """(keys, i, j, k, M0, r, beta, LL) for every grid point and group.

    A group travels as an array of distinct times, with a range of the first axis.  Each value
    of it is one numpy plane over the other two, so no pair of grid point and observation ever becomes a row.
    """
    packed = pack(compress(df, keys, x, y), keys, array_limit)
    whole = _squares(packed.where(F.col("chunks") == 1), keys, axes)
    parts = _summed(packed, keys, axes)
    return _likelihood(union_all([whole.select(parts.columns), parts]), keys)


def _searched(batches: Iterator[pd.DataFrame], keys: list[str], axes, positive_mass: bool) -> Iterator[pd.DataFrame]:
    values = _values(axes)
    for batch in batches:
        for _, row in batch.iterrows():
            points = point_matrix(row).T
            found = Search(values, points, positive_mass).run(row["first"], row["last"] + 1)
            if found is not None:
                out = {key: [row[f"key{place}"]] for place, key in enumerate(keys)}
                out |= dict(zip(POSITION, found[1:])) | {name: axis[at] for name, axis, at in zip(AXES, values, found[1:])}
                yield pd.DataFrame(out | {"rss": found[0], "n": points[:, 1].sum()})


def _best(df: DataFrame, keys: Sequence[str], axes: Axes, x: str, y: str, array_limit: int, positive_mass: bool) -> DataFrame:
    packed = pack(compress(df, keys, x, y), keys, array_limit)
    key_list, given = list(keys), dict(axes)
    whole = _ranged(packed.where(F.col("chunks") == 1), keys, axes)
    found = whole.mapInPandas(lambda it: _searched(it, key_list, given, positive_mass), T.StructType(_fields(packed, keys)))
    long = cut_lineage(packed.where(F.col("chunks") > 1))
    if not long.isEmpty():
        found = found.unionByName(_best_of_long(long, keys, axes, positive_mass))
    return best_by(_likelihood(found, keys), keys, "LL", POSITION)


def _best_of_long(packed: DataFrame, keys: Sequence[str], axes: Axes, positive_mass: bool) -> DataFrame:
    """The best points of groups held in several arrays.

    Boxes are cut and bounded level by level: bounds and corner points are computed for each array
    and added per box, and what a level leaves goes to the next.  A level cuts sides into four, so a
    hundred values per axis take four levels.
    """
    values = _values(axes)
    spark, key_list = packed.sparkSession, list(keys)
    key_fields = [packed.schema[key] for key in keys]
    box = T.ArrayType(T.IntegerType())

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, row in batch.iterrows():
                cuts = quarters(np.array([row["box"]]))
                yield pd.DataFrame({key: [row[key]] * len(cuts) for key in key_list} | {"box": list(cuts)})

    def bound(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, row in batch.iterrows():
                points = point_matrix(row).T
                several = np.stack(row["several"])
                corner = [axis[several[:, 2 * i]] for i, axis in enumerate(values)]
                low = lower_bounds(several, values, points) if bounded(points, values) else np.zeros(len(several))
                error = errors(*corner, points)
                out = {key: [row[key]] * len(several) for key in key_list} | {"box": list(several)}
                yield pd.DataFrame(out | {"low": low, "error": error, "n": points[:, 1].sum(), "scale": (points[:, 1] * points[:, 2] ** 2).sum()})

    sums = [T.StructField(name, T.DoubleType()) for name in ("low", "error", "n", "scale")]
    cut_schema = T.StructType([*key_fields, T.StructField("box", box)])
    bound_schema = T.StructType([*key_fields, T.StructField("box", box), *sums])
    whole = F.array(*[F.lit(v).cast("int") for axis in values for v in (0, len(axis) - 1)])
    boxes = packed.select(*keys).distinct().withColumn("box", whole)
    arrays = packed.select(*keys, *point_arrays())
    seen = None
    for _ in range(max(len(axis) for axis in values).bit_length() // 2 + 1):
        pieces = boxes.repartition(shuffle_partitions(spark)).mapInPandas(cut, cut_schema)
        # Boxes of a group travel in packs, each of which meets all arrays of the group.
        packs = pieces.withColumn("__pack", F.pmod(F.xxhash64("box"), F.lit(PACKS)))
        packs = packs.groupBy(*keys, "__pack").agg(F.collect_list("box").alias("several")).drop("__pack")
        parts = join_same(packs, arrays, keys).mapInPandas(bound, bound_schema)
        total = cut_lineage(parts.groupBy(*keys, "box").agg(*[F.sum(f.name).alias(f.name) for f in sums]))
        found = total.where(~F.isnan("error")).withColumn("at", F.transform(F.array(*[F.lit(i) for i in (0, 2, 4)]), lambda i: F.get("box", i)))
        if positive_mass:
            found = found.where(F.get(F.array(*[F.lit(float(v)) for v in values[0]]), F.get("at", F.lit(0))) != 0)
        best = found.groupBy(*keys).agg(F.min(F.struct("error", "at", "n", "scale")).alias("best")).select(*keys, "best.*")
        seen = best if seen is None else seen.unionByName(best)
        seen = cut_lineage(seen.groupBy(*keys).agg(F.min(F.struct("error", "at", "n", "scale")).alias("best")).select(*keys, "best.*"))
        limit = seen.select(*keys, (F.col("error") * (1 + SLACK) + F.col("scale") * SLACK**2).alias("limit"))
        left = join_same(total, limit, keys, "left").where(F.col("limit").isNull() | (F.col("low") <= F.col("limit")))
        boxes = left.where("box[0] < box[1] or box[2] < box[3] or box[4] < box[5]").select(*keys, "box")
    named = [F.get("at", F.lit(i)).alias(name) for i, name in enumerate(POSITION)]
    numbers = [
        F.get(F.array(*[F.lit(float(v)) for v in axis]), F.get("at", F.lit(i))).alias(name)
        for i, (name, axis) in enumerate(zip(AXES, values))
    ]
    return seen.select(*keys, *named, *numbers, F.col("error").alias("rss"), "n")


def grid_search(
    df: DataFrame, keys: Sequence[str], axes: Axes, x: str = "x", y: str = "y", array_limit: int = ARRAY_LIMIT
) -> DataFrame:
    """The most likely grid point per group; ties go to the first in axis order.

    Found by branch and bound (``boxes``), so only a few hundredths of the points are computed.
    """
    return _best(df, keys, axes, x, y, array_limit, False)


def two_step_search(df: DataFrame, keys: Sequence[str], coarse: Axes, fine: Axes, x: str = "x", y: str = "y") -> DataFrame:
    """Best point of the pooled coarse and fine grids; coarse points without initial mass
    are left out, and each grid is reduced to its best point before pooling."""
    first = _best(df, keys, coarse, x, y, ARRAY_LIMIT, True)
    second = _best(df, keys, fine, x, y, ARRAY_LIMIT, False)
    pooled = union_all([first.withColumn("step", F.lit(0)), second.withColumn("step", F.lit(1))])
    return best_by(pooled, keys, "LL", ("step", *POSITION))


def param_grid(anchor: DataFrame, axes: Axes) -> DataFrame:
    """Every combination of the axis values for every row of ``anchor``."""
    grid = anchor
    for name, (low, high, count) in axes.items():
        grid = grid.withColumn(f"__{name}", F.explode(_axis(low, high, count, "at", name))).withColumn(
            name, F.col(f"__{name}.{name}")
        ).drop(f"__{name}")
    return grid
