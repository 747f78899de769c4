"""Least-squares fits of all groups in one Spark job."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plotloom.functions.scalar import finite
from plotloom.growth.long_groups import fit_chunked
from plotloom.growth.models import MODELS, add_natural
from plotloom.growth.points import (
    ARRAY_LIMIT,
    compress,
    initial_values,
    pack,
    point_arrays,
    point_matrix,
)
from plotloom.growth.solver import solve
from plotloom.operators.keys import join_same
from plotloom.operators.sizing import cut_lineage
from plotloom.operators.stats import aic
from plotloom.session import shuffle_partitions

# Padded cells held at once by one task.
CELLS = 400_000


def _result_schema(points: DataFrame, keys: Sequence[str], model: str) -> T.StructType:
    spec = MODELS[model]
    fields = [points.schema[key] for key in keys]
    fields += [T.StructField(name, T.DoubleType()) for name in spec.raw + spec.fixed]
    fields += [
        T.StructField("converged", T.BooleanType()),
        *[T.StructField(name, T.DoubleType()) for name in ("n", "rss", "mss", "ll", "delta")],
        T.StructField("cov", T.ArrayType(T.DoubleType())),
    ]
    return T.StructType(fields)


def _null_if_bad(values: np.ndarray) -> list:
    return [float(v) if np.isfinite(v) else None for v in values]


def _fit_batches(batches: Iterator[pd.DataFrame], keys, model, variance) -> Iterator[pd.DataFrame]:
    spec = MODELS[model]
    for batch in batches:
        lengths = batch["point_x"].map(len).to_numpy()
        order = np.argsort(lengths, kind="stable")
        begin = 0
        while begin < len(order):
            end = begin + 1
            while end < len(order) and (end + 1 - begin) * lengths[order[end]] <= CELLS:
                end += 1
            rows = batch.iloc[order[begin:end]]
            width = max(int(lengths[order[end - 1]]), 1)
            grids = np.zeros((4, len(rows), width))
            for i, (_, row) in enumerate(rows.iterrows()):
                block = point_matrix(row)
                grids[:, i, : block.shape[1]] = block
            x, w, y, within = grids
            start = rows[list(spec.raw)].to_numpy(dtype=float)
            fixed = {name: rows[name].to_numpy(dtype=float) for name in spec.fixed}
            found = solve(model, start, fixed, x, y, w, within, variance)
            out = {key: rows[key].to_numpy() for key in keys}
            out.update({name: _null_if_bad(found["theta"][:, i]) for i, name in enumerate(spec.raw)})
            out.update({name: fixed[name] for name in spec.fixed})
            out["converged"] = found["converged"]
            out.update({name: _null_if_bad(found[name]) for name in ("n", "rss", "mss", "ll", "delta")})
            out["cov"] = [list(row) if np.isfinite(row).all() else None for row in found["cov"]]
            yield pd.DataFrame(out)
            begin = end


def fit(
    df: DataFrame,
    keys: Sequence[str],
    model: str,
    x: str = "x",
    y: str = "y",
    fixed: Mapping[str, float] | None = None,
    variance: str | None = None,
    array_limit: int = ARRAY_LIMIT,
) -> DataFrame:
    """One row per group: raw and natural parameters, convergence, statistics, covariance.

    Observations are first reduced to one row per group and distinct time.  A group of
    ordinary length is then solved from one array, many groups per numpy call; one with
    more distinct times than ``array_limit`` goes through steps by the same rules to the same
    tolerance, with its sums taken in Spark.  A group without usable observations gets a row that
    has not converged.
    """
    fixed = dict(fixed or {})
    points = cut_lineage(compress(df, keys, x, y))
    spec = MODELS[model]
    starts = cut_lineage(initial_values(points, keys, model))
    for name, value in fixed.items():
        starts = starts.withColumn(name, F.lit(float(value)))
    schema = _result_schema(points, keys, model)
    all_packed = cut_lineage(pack(points, keys, array_limit))
    packed = all_packed.where(F.col("chunks") == 1)
    ready = join_same(packed, starts, keys).repartition(shuffle_partitions(df.sparkSession), *keys)
    columns = [*keys, *spec.raw, *spec.fixed, *point_arrays()]
    chosen = ready.select(*columns)
    key_list = list(keys)
    solved = chosen.mapInPandas(lambda it: _fit_batches(it, key_list, model, variance), schema)
    long_groups = all_packed.where(F.col("chunks") > 1)
    if not long_groups.isEmpty():
        # The same steps from nearer by: the fit of the group's bin means, where that has converged.
        rough = join_same(pack(_bin_means(points, long_groups, keys), keys), starts, keys).select(*columns)
        rough = rough.mapInPandas(lambda it: _fit_batches(it, key_list, model, None), schema).where("converged")
        near = join_same(starts, rough.select(*keys, *[F.col(c).alias(f"__{c}") for c in spec.raw]), keys, "left")
        near = cut_lineage(near.withColumns({c: F.coalesce(f"__{c}", c) for c in spec.raw}).select(starts.columns))
        solved = solved.unionByName(fit_chunked(long_groups, key_list, model, near, variance, schema))
    return finish(solved.unionByName(_without_points(df, points, keys, x, y, schema)), model)


def _bin_means(points: DataFrame, long_groups: DataFrame, keys: Sequence[str], bins: int = 512) -> DataFrame:
    """Points of long groups averaged in time bins: only used to place the start of the exact fit."""
    ends = join_same(points, long_groups.select(*keys).distinct(), keys, "left_semi")
    ranges = ends.groupBy(*keys).agg(F.min("x").alias("__lo"), F.max("x").alias("__hi"))
    placed = join_same(ends, ranges, keys)
    place = F.floor(F.try_divide(F.col("x") - F.col("__lo"), F.col("__hi") - F.col("__lo")) * (bins - 1))
    weighted = lambda name: F.sum(F.col("n") * F.col(name)) / F.sum("n")
    return placed.withColumn("__bin", place).groupBy(*keys, "__bin").agg(
        weighted("x").alias("__x"), weighted("y").alias("__y"), F.sum("n").alias("__n")
    ).select(*keys, F.col("__x").alias("x"), F.col("__n").alias("n"), F.col("__y").alias("y"), F.lit(0.0).alias("within"))


def _without_points(df: DataFrame, points: DataFrame, keys: Sequence[str], x: str, y: str, schema: T.StructType) -> DataFrame:
    """One row, not converged, for each group that has no usable observation."""
    usable = finite(F.col(x).cast("double")).isNotNull() & finite(F.col(y).cast("double")).isNotNull()
    empty = df.groupBy(*keys).agg(F.count_if(usable).alias("__n")).where("__n = 0")
    given = {"converged": F.lit(False), "n": F.lit(0.0)}
    rest = [given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema if f.name not in keys]
    return empty.select(*keys, *rest)


def finish(solved: DataFrame, model: str) -> DataFrame:
    spec = MODELS[model]
    extra = F.when(F.col("delta") != 0, 1).otherwise(0)
    return add_natural(solved, model).withColumns(
        {
            "aic": aic(F.col("ll"), extra + len(spec.raw)),
            "r2": F.try_divide(F.col("mss"), F.col("mss") + F.col("rss")),
            "root_rss": F.sqrt("rss"),
        }
    )


def fit_linear(df: DataFrame, keys: Sequence[str], x: str = "x", y: str = "y") -> DataFrame:
    """Straight line by regression sums: one aggregate, no iteration."""
    usable = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    return usable.groupBy(*keys).agg(
        F.regr_slope(F.col(y), F.col(x)).alias("a"), F.regr_intercept(F.col(y), F.col(x)).alias("M0"), F.count(F.lit(1)).alias("n")
    )


def fit_origin(df: DataFrame, keys: Sequence[str], x: str = "x", y: str = "y") -> DataFrame:
    """Line through the origin."""
    usable = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    products = usable.groupBy(*keys).agg(
        F.sum(F.col(x) * F.col(y)).alias("__xy"), F.sum(F.col(x) * F.col(x)).alias("__xx"), F.count(F.lit(1)).alias("n")
    )
    return products.select(*keys, F.try_divide("__xy", "__xx").alias("a"), "n")


def compare_models(fits: Mapping[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """Number of groups, share that converged and spread of the log-likelihood per model."""
    stacked = None
    for name, frame in fits.items():
        part = frame.select(F.lit(name).alias("model"), *keys, "converged", "ll")
        stacked = part if stacked is None else stacked.unionByName(part)
    good = F.when(F.col("converged"), F.col("ll"))
    return stacked.groupBy("model").agg(
        F.count(F.lit(1)).alias("groups"),
        F.count_if("converged").alias("converged"),
        F.avg(good).alias("mean_ll"), F.min(good).alias("min_ll"), F.max(good).alias("max_ll"),
    )
