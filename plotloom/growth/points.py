"""Observations reduced to what a growth fit needs.

All models depend on time only, so the squared error of a group is
``sum over x of n(x) * (f(x) - mean(x))^2 + within(x)``.  Counting, averaging and the
within-x sum are one partially aggregated shuffle, after which a group has one row per
distinct time, however many observations it had.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotloom.functions.scalar import divide, finite
from plotloom.operators.keys import join_same

# The parts of a point, each an array of its own when a group is handed to Python.
PARTS = ("x", "n", "y", "within")

# Distinct times a group may have to be held as one array; longer ones are chunked
# (grid search) or summed in Spark (fits).
ARRAY_LIMIT = 4096


def compress(df: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    """(keys, x, n, y, within): one row per group and distinct time."""
    usable = df.where(finite(F.col(x).cast("double")).isNotNull() & finite(F.col(y).cast("double")).isNotNull())
    grouped = usable.groupBy(*keys, F.col(x).cast("double").alias("x"))
    return grouped.agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        F.avg(y).alias("y"),
        (F.var_pop(y) * F.count(F.lit(1))).alias("within"),
    )


def pack(points: DataFrame, keys: Sequence[str], limit: int = ARRAY_LIMIT) -> DataFrame:
    """(keys, chunk, chunks, points): the times of a group in arrays of at most about ``limit``."""
    sizes = points.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / F.lit(limit)).cast("int").alias("chunks"))
    marked = join_same(points, sizes, keys)
    chunk = F.when(F.col("chunks") > 1, F.pmod(F.xxhash64("x"), F.col("chunks"))).otherwise(0).cast("int")
    return (
        marked.withColumn("chunk", chunk)
        .groupBy(*keys, "chunk", "chunks")
        .agg(F.sort_array(F.collect_list(F.struct("x", "n", "y", "within"))).alias("points"))
    )


def point_arrays() -> list:
    return [F.col(f"points.{part}").alias(f"point_{part}") for part in PARTS]


def point_matrix(row) -> np.ndarray:
    """(parts, times) of one packed group."""
    return np.stack([np.asarray(row[f"point_{part}"], dtype=float) for part in PARTS])


def initial_values(points: DataFrame, keys: Sequence[str], model: str) -> DataFrame:
    """Starting values of the raw parameters per group, from regressions on a linearised curve.

    Linear, exponential and power models follow the slope of the means, on the log where
    the model grows by ratio.  Limited models take the upper limit a little above the
    largest mean and regress the transformed remainder on time.  The power law needs four
    distinct times; a group without a usable start has null values.
    """
    count = F.count(F.lit(1)).alias("distinct_x")
    if model in ("linear", "origin", "exponential", "power", "power2"):
        ratio = model not in ("linear", "origin")
        response = F.when(F.col("y") > 0, F.ln("y")) if ratio else F.col("y")
        start = points.groupBy(*keys).agg(
            F.regr_slope(response, F.col("x")).alias("__slope"), F.min("y").alias("__low"), count
        )
        enough = F.col("distinct_x") >= 4
        chosen = {
            "linear": {"a": F.col("__slope"), "M0": F.col("__low")},
            "origin": {"a": F.col("__slope")},
            "exponential": {"M0": F.col("__low"), "r": F.col("__slope")},
            "power": {
                "M0": F.when(enough, F.col("__low")),
                "r": F.when(enough, F.col("__slope")),
                "beta": F.when(enough, F.lit(0.9)),
            },
            "power2": {"r": F.when(enough, F.col("__slope")), "beta": F.when(enough, F.lit(0.9))},
        }[model]
        return start.select(*keys, *[value.alias(name) for name, value in chosen.items()], "distinct_x")

    ranges = points.groupBy(*keys).agg(F.min("y").alias("__min"), F.max("y").alias("__max"))
    spread = F.col("__max") - F.col("__min")
    marked = join_same(points, ranges, keys)
    if model == "logistic":
        share = divide("y", F.col("__max") + spread * 0.05)
        response = F.ln(divide(share, 1 - share))
    elif model == "gompertz":
        share = divide("y", F.col("__max") + spread * 0.05)
        response = F.ln(-F.ln(F.when((share > 0) & (share < 1), share)))
    elif model == "fpl":
        share = divide(F.col("y") - (F.col("__min") - spread * 0.05), spread * 1.1)
        response = F.ln(divide(share, 1 - share))
    elif model == "monomolecular":
        response = F.ln(F.col("__max") + spread * 0.25 - F.col("y"))
    else:
        raise ValueError(f"unknown model {model}")
    line = marked.groupBy(*keys, "__min", "__max").agg(
        F.regr_slope(response, F.col("x")).alias("__slope"),
        F.regr_intercept(response, F.col("x")).alias("__at0"),
        count,
    )
    slope, at0 = F.col("__slope"), F.col("__at0")
    middle, scale = divide(-at0, slope), divide(F.lit(1.0), slope)
    upper = F.col("__max") + spread * 0.05
    chosen = {
        "logistic": {"Asym": upper, "xmid": middle, "scal": scale},
        "fpl": {"A": F.col("__min") - spread * 0.05, "B": upper, "xmid": middle, "scal": scale},
        "gompertz": {"Asym": upper, "b2": F.exp(at0), "b3": F.exp(slope)},
        "monomolecular": {
            "Asym": F.col("__max") + spread * 0.25,
            "R0": F.col("__max") + spread * 0.25 - F.exp(at0),
            "lrc": F.ln(F.when(slope < 0, -slope)),
        },
    }[model]
    return line.select(*keys, *[value.alias(name) for name, value in chosen.items()], "distinct_x")
