"""Locally weighted quadratics from power sums of blocks of days.

Tricube weights are a polynomial in the distance on either side of a step, so what a whole
block of days adds to a step's weighted sums follows from the block's power sums, re-centred to the
step.  Only the few blocks that a window's edge or middle may lie in are looked at day by
day.  A group's days are spread over the tasks by block, and work grows with days plus steps.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plotloom.growth.points import compress
from plotloom.operators.keys import join_same
from plotloom.session import cut_lineage, shuffle_partitions

# Days of a block, and steps that one task places.
BLOCK_DAYS, STEPS = 256, 16
# Tricube: the weight is the sum of these times the distance to these powers.
TRICUBE = {0: 1.0, 3: -3.0, 6: 3.0, 9: -1.0}
# Powers needed for the sums of the weights (to z^4) and of the weighted values (to z^2).
POWERS, VALUE_POWERS = 14, 12


def _block_sums(points: DataFrame, keys: Sequence[str], width: int) -> DataFrame:
    """Counts, ends and power sums about the middle of each block, distances in block widths."""
    z = (F.col("x") - (F.col("block") + 0.5) * width) / width
    return points.groupBy(*keys, "block").agg(
        F.sum("n").alias("n"),
        F.min("x").alias("first"),
        F.max("x").alias("last"),
        *[F.sum(F.col("n") * F.pow(z, F.lit(j))).alias(f"s{j}") for j in range(POWERS)],
        *[F.sum(F.col("n") * F.col("y") * F.pow(z, F.lit(j))).alias(f"v{j}") for j in range(VALUE_POWERS)],
    )


def _recentred(sums: np.ndarray, middle: np.ndarray, width: float, t: float, scale: float) -> np.ndarray:
    """Power sums of blocks (one row each) about t, distances in ``scale``, added up."""
    shift, shrink = (middle - t) / scale, width / scale
    out = np.zeros(sums.shape[1])
    for j in range(sums.shape[1]):
        for i in range(j + 1):
            out[j] += comb(j, i) * float((sums[:, i] * shrink**i * shift ** (j - i)).sum())
    return out


def _place(batches: Iterator[pd.DataFrame], keys: list[str], count: int, span: float, width: int) -> Iterator[pd.DataFrame]:
    """Per step the blocks to be looked at by day, and the sums of those that are surely within the window."""
    for batch in batches:
        for _, row in batch.iterrows():
            blocks = np.stack([np.asarray(block, dtype=float) for block in row["blocks"]])
            name, n, first, last = blocks[:, :4].T
            sums = blocks[:, 4:]
            low, high, total = first.min(), last.max(), n.sum()
            q = min(np.floor(total * span), total)
            found = []
            for step in range(row["begin"], min(row["begin"] + STEPS, count)):
                t = low + step / (count - 1.0) * (high - low)
                near = np.maximum(np.maximum(first - t, t - last), 0)
                far = np.maximum(np.abs(first - t), np.abs(last - t))
                least, most = (_reach(d, n, q) for d in (near, far))
                middle = (name + 0.5) * width
                scale, sides = most or 1.0, []
                for side in (last < t, first > t):
                    own = side & (far < least)
                    sides += [_recentred(part[own], middle[own], width, t, scale) for part in (sums[:, :POWERS], sums[:, POWERS:])]
                within = (far < least) & ((last < t) | (first > t))
                look = name[~within & (near <= most)].astype(int)
                found.append((step, t, q, scale, float(n[within].sum()), np.concatenate(sides), look.tolist()))
            columns = list(zip(*found))
            out = {key: [row[key]] * len(found) for key in keys}
            yield pd.DataFrame(out | dict(zip(("step", "t", "q", "scale", "counted", "sums", "look"), map(list, columns))))


def _reach(distance: np.ndarray, n: np.ndarray, q: float) -> float:
    """The least distance within which there are q measurements."""
    order = np.argsort(distance, kind="stable")
    at = np.searchsorted(np.cumsum(n[order]), q)
    return float(distance[order][min(at, len(order) - 1)])


def _solve(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        values = [_smooth(row) for _, row in batch.iterrows()]
        yield pd.DataFrame({key: batch[key] for key in keys} | {"step": batch["step"], "t": batch["t"], "smooth": values})


def _smooth(row) -> float:
    x, n, y = (np.asarray(row[name], dtype=float) for name in ("x", "n", "y"))
    z = x - row["t"]
    order = np.argsort(np.abs(z), kind="stable")
    at = np.searchsorted(row["counted"] + np.cumsum(n[order]), row["q"])
    h = float(np.abs(z)[order][min(at, len(order) - 1)])
    if row["q"] <= 0 or h == 0:
        return np.nan
    scale = row["scale"]
    u = np.abs(z) / h
    w = np.where(u < 1, n * (1 - u**3) ** 3, 0.0)
    z = z / scale
    s = [float((w * z**k).sum()) for k in range(5)]
    b = [float((w * y * z**k).sum()) for k in range(3)]
    known = np.asarray(row["sums"], dtype=float)
    for sign, at in ((-1.0, 0), (1.0, POWERS + VALUE_POWERS)):
        own, with_y = known[at : at + POWERS], known[at + POWERS : at + POWERS + VALUE_POWERS]
        for m, weight in TRICUBE.items():
            factor = weight * (sign * scale / h) ** m
            for k in range(5):
                s[k] += factor * own[m + k]
            for k in range(3):
                b[k] += factor * with_y[m + k]
    whole = s[0] * (s[2] * s[4] - s[3] * s[3]) - s[1] * (s[1] * s[4] - s[2] * s[3]) + s[2] * (s[1] * s[3] - s[2] * s[2])
    value = b[0] * (s[2] * s[4] - s[3] * s[3]) - s[1] * (b[1] * s[4] - b[2] * s[3]) + s[2] * (b[1] * s[3] - b[2] * s[2])
    return value / whole if whole else np.nan


def local_smooth(
    df: DataFrame, keys: Sequence[str], day: str, y: str, span: float = 0.75, count: int = 80, width: int = BLOCK_DAYS
) -> DataFrame:
    """Locally weighted quadratic through each of ``count`` evenly spaced days.

    The axis is whole days, so a group is at most one point per calendar day however many
    measurements it has.  Weights are tricube over the nearest ``span`` share of the
    measurements; the weighted quadratic is solved from sums of moments.
    """
    points = compress(df.withColumn(day, F.floor(day)), keys, day, y)
    points = cut_lineage(points.select(*keys, "x", "n", "y", F.floor(F.col("x") / width).alias("block")))
    blocks = _block_sums(points, keys, width)
    parts = ["block", "n", "first", "last", *[f"s{j}" for j in range(POWERS)], *[f"v{j}" for j in range(VALUE_POWERS)]]
    numbers = [F.col(name).cast("double").alias(name) for name in parts]
    packed = blocks.groupBy(*keys).agg(F.collect_list(F.array(*numbers)).alias("blocks"))
    begins = F.sequence(F.lit(0), F.lit(count - 1), F.lit(STEPS))
    rows = packed.withColumn("begin", F.explode(begins)).repartition(shuffle_partitions(df.sparkSession), *keys, "begin")
    key_list = list(keys)
    key_fields = [df.schema[key] for key in keys]
    place = [("step", T.IntegerType()), ("t", T.DoubleType()), ("q", T.DoubleType()), ("scale", T.DoubleType())]
    place += [("counted", T.DoubleType()), ("sums", T.ArrayType(T.DoubleType())), ("look", T.ArrayType(T.LongType()))]
    schema = T.StructType(key_fields + [T.StructField(name, kind) for name, kind in place])
    placed = cut_lineage(rows.mapInPandas(lambda it: _place(it, key_list, count, span, width), schema))
    looked = placed.select(*keys, "step", F.explode("look").alias("block"))
    days = join_same(looked, points, [*keys, "block"])
    # A window touches a few blocks only, so these lists are short.
    lists = days.groupBy(*keys, "step").agg(*[F.collect_list(F.col(name)).alias(name) for name in ("x", "n", "y")])
    whole = join_same(placed.drop("look"), lists, [*keys, "step"])
    out = T.StructType(key_fields + [T.StructField("step", T.IntegerType())] + [T.StructField(n, T.DoubleType()) for n in ("t", "smooth")])
    return whole.mapInPandas(lambda it: _solve(it, key_list), out)
