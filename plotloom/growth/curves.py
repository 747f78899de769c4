"""Rate tables, simulated intervals and contrasts between groups."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plotloom.functions.scalar import even_steps, finite, standard_normal
from plotloom.growth.draws import Draws, quantiles
from plotloom.growth.models import (
    MODELS,
    NumpyMath,
    SparkMath,
    add_curves,
    curve_arrays,
    curve_columns,
    mass_rate,
)
from plotloom.operators.keys import join_same
from plotloom.operators.numbering import hash_bucket, number_distinct
from plotloom.session import shuffle_partitions

METRICS = ["M", "AGR", "RGRt", "RGRm"]
# Steps of a curve that one task computes for one group.
STEPS = 25
DIFFERENCES = ["diffM", "diffAGR", "diffRGRt", "diffRGRm"]


def rate_grid(params: DataFrame, low: Column | float, high: Column | float, count: int = 100, t: str = "t") -> DataFrame:
    """Every parameter row at ``count`` evenly spaced times (generated, not joined)."""
    low = F.lit(float(low)) if isinstance(low, (int, float)) else low
    high = F.lit(float(high)) if isinstance(high, (int, float)) else high
    return params.withColumn(t, F.explode(even_steps(low, high, count)))


def rate_table(params: DataFrame, model: str, observations: DataFrame, x: str = "x", count: int = 100, log_scale: bool = False) -> DataFrame:
    """Curves of every fitted group over the time span shared by all observations."""
    low = observations.agg(F.min(x).cast("double")).scalar()
    high = observations.agg(F.max(x).cast("double")).scalar()
    spanned = params.withColumns({"__low": low, "__high": high})
    return add_curves(rate_grid(spanned, F.col("__low"), F.col("__high"), count), model, "t", log_scale).drop("__low", "__high")


def positive_mass(curves: DataFrame) -> DataFrame:
    """Curve points with a predicted mass above zero: a line may start below it."""
    return curves.where(F.col("M") > 0)


def _draw_columns(model: str, keys: Sequence, seed: str, prefix: str = "") -> tuple[list[dict[str, Column]], dict[str, Column]]:
    """Levels of helper columns (Cholesky factor, then draws) for one set of parameters.

    Each level refers to columns of earlier levels, so no expression is repeated.
    """
    spec = MODELS[model]
    p = len(spec.raw)
    at = lambda i, j: F.get(F.col(f"{prefix}cov"), F.lit(i * p + j))
    name = lambda i, j: f"__{prefix}l{i}{j}"
    levels: list[dict[str, Column]] = []
    for j in range(p):
        known = F.lit(0.0)
        for k in range(j):
            known = known + F.col(name(j, k)) * F.col(name(j, k))
        # rounding can leave a tiny negative remainder, which means no spread
        levels.append({name(j, j): F.sqrt(F.greatest(at(j, j) - known, F.lit(0.0)))})
        below = {}
        for i in range(j + 1, p):
            mixed = F.lit(0.0)
            for k in range(j):
                mixed = mixed + F.col(name(i, k)) * F.col(name(j, k))
            below[name(i, j)] = F.coalesce(F.try_divide(at(i, j) - mixed, F.col(name(j, j))), F.lit(0.0))
        if below:
            levels.append(below)
    levels.append({f"__{prefix}z{i}": standard_normal(F.lit(seed), *keys, F.col("draw"), F.lit(i)) for i in range(p)})
    drawn = {}
    for i, raw in enumerate(spec.raw):
        value = F.col(f"{prefix}{raw}")
        for k in range(i + 1):
            value = value + F.col(name(i, k)) * F.col(f"__{prefix}z{k}")
        drawn[f"__{prefix}d_{raw}"] = value
    levels.append(drawn)
    raw_draws = {raw: F.col(f"__{prefix}d_{raw}") for raw in spec.raw}
    raw_draws.update({raw: F.col(f"{prefix}{raw}") for raw in spec.fixed})
    natural = {raw: finite(value) for raw, value in spec.transform(SparkMath, raw_draws).items()}
    return levels, natural


def parameter_draws(
    params: DataFrame, keys: Sequence[str], model: str, draws: int, seed: str, named: Sequence[str] | None = None
) -> DataFrame:
    """(keys, draw, natural parameters): normal draws around the raw parameters.

    The numbers depend on seed, group (``named``, by default the keys) and draw only.  Draws of one group are spread
    over the tasks before anything is computed from them.
    """
    numbered = params.withColumn("draw", F.explode(F.sequence(F.lit(1), F.lit(draws))))
    spread = numbered.repartition(shuffle_partitions(params.sparkSession), *keys, "draw")
    levels, natural = _draw_columns(model, [F.col(key) for key in (named or keys)], seed)
    for level in levels:
        spread = spread.withColumns(level)
    return spread.select(*keys, "draw", *[value.alias(name) for name, value in natural.items()])


def _interval_schema(df: DataFrame, keys: Sequence[str], position: Sequence[T.StructField], values: Sequence[str]) -> T.StructType:
    fields = [df.schema[key] for key in keys] + list(position)
    return T.StructType(fields + [T.StructField(f"{v}_{end}", T.DoubleType()) for v in values for end in ("lo", "hi")])


def _group_text(seed: str, keys: Sequence[Column]) -> Column:
    """What a group's draws are made from besides their number."""
    return F.concat_ws("|", F.lit(seed), *[key.cast("string") for key in keys])


def _in_parts(rows: DataFrame, count: int, by: Sequence[str]) -> DataFrame:
    """Every row once per ``STEPS`` steps of its curve, dealt out to the tasks: the only exchange."""
    parts = F.sequence(F.lit(0), F.lit((count - 1) // STEPS))
    return rows.withColumn("__part", F.explode(parts)).repartition(shuffle_partitions(rows.sparkSession), *by, "__part")


def _steps(part: int, count: int) -> np.ndarray:
    return np.arange(part * STEPS, min((part + 1) * STEPS, count))


def _share(steps: np.ndarray, count: int) -> np.ndarray:
    return steps / (count - 1.0)


def _curve_intervals(batches: Iterator[pd.DataFrame], keys, model, count, draws, alpha, log_scale) -> Iterator[pd.DataFrame]:
    spec = MODELS[model]
    for batch in batches:
        for _, row in batch.iterrows():
            made = Draws(spec, row["__group"], row, row["cov"], draws)
            steps = _steps(row["__part"], count)
            times = row["__low"] + _share(steps, count) * (row["__high"] - row["__low"])

            def curves(times=times, made=made) -> Iterator[np.ndarray]:
                for begin, end in made.spans():
                    found = curve_arrays(spec, made.block(begin, end), times[None, :], log_scale)
                    yield np.hstack([np.broadcast_to(found[m], (end - begin, len(times))) for m in METRICS])

            ends = quantiles(curves, alpha, len(METRICS) * len(steps)).reshape(2, len(METRICS), len(steps))
            out = {key: [row[key]] * len(steps) for key in keys} | {"step": steps, "t": times}
            for i, name in enumerate(METRICS):
                out[f"{name}_lo"], out[f"{name}_hi"] = ends[0, i], ends[1, i]
            yield pd.DataFrame(out)


def _simulated(params, keys, model, low, high, count, draws, seed, alpha, log_scale) -> DataFrame:
    spec = MODELS[model]
    low = F.lit(float(low)) if isinstance(low, (int, float)) else low
    high = F.lit(float(high)) if isinstance(high, (int, float)) else high
    numbers = [F.col(name).cast("double").alias(name) for name in [*spec.raw, *spec.fixed] if name not in keys]
    group = _group_text(seed, [F.col(key) for key in keys])
    rows = params.select(*keys, *numbers, "cov", low.alias("__low"), high.alias("__high"), group.alias("__group"))
    position = [T.StructField("step", T.IntegerType()), T.StructField("t", T.DoubleType())]
    schema = _interval_schema(params, keys, position, METRICS)
    key_list = list(keys)
    return _in_parts(rows, count, keys).mapInPandas(
        lambda it: _curve_intervals(it, key_list, model, count, draws, alpha, log_scale), schema
    )


def simulate(
    params: DataFrame,
    keys: Sequence[str],
    model: str,
    low: float | Column,
    high: float | Column,
    count: int = 100,
    draws: int = 1000,
    seed: str = "1",
    alpha: float = 0.05,
    log_scale: bool = False,
) -> DataFrame:
    """Interval of every curve at every time from simulated parameters.

    Parameters are dealt out by group and stretch of times; draws and curves exist block by
    block inside a task, however many draws there are.
    """
    return _simulated(params, keys, model, low, high, count, draws, seed, alpha, log_scale).drop("step")


def rates_with_intervals(params: DataFrame, keys: Sequence[str], model: str, low, high, count=100, draws=1000, seed="1", alpha=0.05, log_scale=False) -> DataFrame:
    """Point curves beside their intervals, joined on group and step."""
    low = F.lit(float(low)) if isinstance(low, (int, float)) else low
    high = F.lit(float(high)) if isinstance(high, (int, float)) else high
    grid = params.select("*", F.posexplode(even_steps(low, high, count)).alias("step", "t"))
    curves = add_curves(grid, model, "t", log_scale).select(*keys, "step", "t", *METRICS)
    ranges = _simulated(params, keys, model, low, high, count, draws, seed, alpha, log_scale).drop("t")
    return join_same(curves, ranges, [*keys, "step"], "left").drop("step")


def level_pairs(params: DataFrame, key: str) -> DataFrame:
    """All pairs a < b of the levels of a treatment.

    The pairs themselves are what is asked for.  Every level generates the numbers of
    its partners, which are found by an equi-join; nothing else is paired.  Pass a pair
    table of your own to the contrasts when only some are wanted.
    """
    levels = params.select(F.col(key).alias("level")).distinct()
    numbered = number_distinct(levels, hash_bucket(["level"]), ["level"], "index")
    size = levels.agg(F.count(F.lit(1))).scalar()
    later = numbered.where(F.col("index") < size).select(
        F.col("level").alias("one"), F.explode(F.sequence(F.col("index") + 1, size)).alias("partner")
    )
    named = numbered.select(F.col("level").alias("other"), F.col("index").alias("partner"))
    return later.join(named, "partner").select(F.least("one", "other").alias("a"), F.greatest("one", "other").alias("b"))


def _both_sides(params: DataFrame, pairs: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    sides = pairs
    for side in ("a", "b"):
        own = params.select(F.col(key).alias(side), *[F.col(c).alias(f"{side}_{c}") for c in columns])
        sides = join_same(sides, own, [side])
    return sides


def _mass_ends(model: str, p: Mapping[str, Column], low: Column, high: Column, count: int) -> tuple[Column, Column]:
    spec = MODELS[model]
    masses = F.transform(even_steps(low, high, count), lambda t: finite(spec.mass(SparkMath, p, t)))
    return F.array_min(masses), F.array_max(masses)


def contrasts(
    params: DataFrame,
    key: str,
    model: str,
    low: float,
    high: float,
    count: int = 100,
    log_scale: bool = False,
    pairs: DataFrame | None = None,
) -> DataFrame:
    """Differences of the curves of two groups.

    Mass, absolute rate and relative rate are compared at the same time, the rate by mass
    at equal mass over the range both groups reach.  One row per pair and step.
    """
    spec = MODELS[model]
    pairs = level_pairs(params, key) if pairs is None else pairs
    sides = _both_sides(params, pairs, key, spec.natural)
    low, high = F.lit(float(low)), F.lit(float(high))
    p = {side: {name: F.col(f"{side}_{name}") for name in spec.natural} for side in ("a", "b")}
    ends = {}
    for side in ("a", "b"):
        ends[f"__{side}lo"], ends[f"__{side}hi"] = _mass_ends(model, p[side], low, high, count)
    sides = sides.withColumns(ends)
    step = F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    share = F.col("step") / F.lit(float(count - 1))
    mass_low, mass_high = F.greatest("__alo", "__blo"), F.least("__ahi", "__bhi")
    rows = sides.withColumn("step", step).withColumns(
        {"t": low + share * (high - low), "mass": mass_low + share * (mass_high - mass_low)}
    )
    curves = {side: curve_columns(spec, p[side], F.col("t"), log_scale) for side in ("a", "b")}
    differences = {f"diff{m}": curves["a"][m] - curves["b"][m] for m in ("M", "AGR", "RGRt")}
    differences["diffRGRm"] = finite(
        mass_rate(spec, p["a"], F.col("mass"), log_scale) - mass_rate(spec, p["b"], F.col("mass"), log_scale)
    )
    return rows.withColumns(differences).select("a", "b", "step", "t", "mass", *DIFFERENCES)


def contrast_intervals(
    params: DataFrame,
    key: str,
    model: str,
    low: float,
    high: float,
    count: int = 100,
    draws: int = 1000,
    seed: str = "1",
    alpha: float = 0.05,
    log_scale: bool = False,
    pairs: DataFrame | None = None,
) -> DataFrame:
    """Intervals of the contrasts from independent draws of both groups."""
    spec = MODELS[model]
    pairs = level_pairs(params, key) if pairs is None else pairs
    columns = list(dict.fromkeys([*spec.raw, *spec.fixed, *spec.natural]))
    sides = _both_sides(params, pairs, key, [*columns, "cov"])
    first, last = F.lit(float(low)), F.lit(float(high))
    ends = {}
    for side in ("a", "b"):
        p = {name: F.col(f"{side}_{name}") for name in spec.natural}
        ends[f"__{side}lo"], ends[f"__{side}hi"] = _mass_ends(model, p, first, last, count)
    # Masses that both groups reach.
    reached = {"__from": F.greatest("__alo", "__blo"), "__to": F.least("__ahi", "__bhi")}
    groups = {f"__{side}group": _group_text(seed, [F.col("a"), F.col("b"), F.lit(side)]) for side in ("a", "b")}
    rows = sides.withColumns(ends).withColumns(reached | groups)
    schema = _interval_schema(pairs, ["a", "b"], [T.StructField("step", T.IntegerType())], DIFFERENCES)
    span = (float(low), float(high))
    return _in_parts(rows, count, ["a", "b"]).mapInPandas(
        lambda it: _difference_intervals(it, model, span, count, draws, alpha, log_scale), schema
    )


def _difference_intervals(batches: Iterator[pd.DataFrame], model, span, count, draws, alpha, log_scale) -> Iterator[pd.DataFrame]:
    spec = MODELS[model]
    rate = spec.rgrm_log if log_scale else spec.rgrm
    names = [*spec.raw, *spec.fixed]
    for batch in batches:
        for _, row in batch.iterrows():
            made = {
                side: Draws(spec, row[f"__{side}group"], {n: row[f"{side}_{n}"] for n in names}, row[f"{side}_cov"], draws)
                for side in ("a", "b")
            }
            steps = _steps(row["__part"], count)
            times = span[0] + _share(steps, count) * (span[1] - span[0])
            masses = row["__from"] + _share(steps, count) * (row["__to"] - row["__from"])

            def apart(times=times, masses=masses, made=made) -> Iterator[np.ndarray]:
                for begin, end in made["a"].spans():
                    p = {side: made[side].block(begin, end) for side in made}
                    curves = {side: curve_arrays(spec, p[side], times[None, :], log_scale) for side in p}
                    values = [curves["a"][m] - curves["b"][m] for m in ("M", "AGR", "RGRt")]
                    with np.errstate(all="ignore"):
                        by_mass = rate(NumpyMath, p["a"], masses[None, :]) - rate(NumpyMath, p["b"], masses[None, :])
                    values.append(np.where(np.isfinite(by_mass), by_mass, np.nan))
                    yield np.hstack([np.broadcast_to(v, (end - begin, len(times))) for v in values])

            ends = quantiles(apart, alpha, len(DIFFERENCES) * len(steps)).reshape(2, len(DIFFERENCES), len(steps))
            out = {"a": [row["a"]] * len(steps), "b": [row["b"]] * len(steps), "step": steps}
            for i, name in enumerate(DIFFERENCES):
                out[f"{name}_lo"], out[f"{name}_hi"] = ends[0, i], ends[1, i]
            yield pd.DataFrame(out)
