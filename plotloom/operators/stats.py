"""Grouped statistics.  Everything here aggregates partially before it shuffles."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotloom.functions.scalar import divide
from plotloom.operators.numbering import number_distinct, range_bucket, with_previous
from plotloom.operators.sizing import attach


def mean_strict(value: str) -> Column:
    """Mean that is null as soon as one value is null."""
    return F.when(F.count(value) == F.count(F.lit(1)), F.avg(value))


def mean_by(df: DataFrame, keys: Sequence[str], value: str, out: str = "mean") -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(value).alias(out))


def freq(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def range_of(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.min(value).alias("low"), F.max(value).alias("high"))


def vocabulary(df: DataFrame, value: str, position: str) -> DataFrame:
    """Distinct non-null values with the 0-based index of their first sighting.

    Sightings are numbered range by range, so the word list may be of any length.
    """
    firsts = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.min(position).cast("long").alias("first_pos"))
    numbered = number_distinct(firsts, range_bucket(firsts, "first_pos"), ["first_pos", value], "index", F.lit(-1).cast("long"))
    return numbered.select(value, "first_pos", "index")


def interval(draws: DataFrame, keys: Sequence[str], values: Sequence[str], alpha: float = 0.05) -> DataFrame:
    """Two-sided quantile interval of simulated draws; nulls are left out.

    A group holds the draws of one point, whose number is the simulation parameter.
    """
    points = F.array(F.lit(alpha / 2), F.lit(1 - alpha / 2))
    wide = draws.groupBy(*keys).agg(*[F.percentile(v, points).alias(f"__{v}") for v in values])
    columns = []
    for v in values:
        columns += [F.get(f"__{v}", F.lit(0)).alias(f"{v}_lo"), F.get(f"__{v}", F.lit(1)).alias(f"{v}_hi")]
    return wide.select(*keys, *columns)


def log_lik(n: Column, rss: Column) -> Column:
    """Gaussian log-likelihood at the best error variance, from residuals; an exact fit is infinitely likely."""
    finite = -n * (F.lit(math.log(2 * math.pi) + 1) - F.ln(n) + F.ln(rss)) / 2
    return F.when(rss == 0, F.lit(float("inf"))).otherwise(finite)


def aic(ll: Column, parameters: int | Column, count_variance: bool = True) -> Column:
    """Akaike criterion; the error variance counts as one more parameter unless told not to."""
    parameters = F.lit(parameters) if isinstance(parameters, int) else parameters
    return F.lit(-2.0) * ll + F.lit(2.0) * (parameters + (1 if count_variance else 0))


def fit_stats(residuals: DataFrame, keys: Sequence[str], parameters: int, fitted: str = "fitted", resid: str = "resid") -> DataFrame:
    """R2, residual sums, log-likelihood and AIC per group in one pass."""
    n = F.count(resid).cast("double")
    sums = residuals.groupBy(*keys).agg(
        n.alias("n"),
        (F.var_pop(fitted) * n).alias("mss"),
        F.sum(F.col(resid) * F.col(resid)).alias("rss"),
    )
    ll = log_lik(F.col("n"), F.col("rss"))
    return sums.withColumns(
        {
            "r2": divide("mss", F.col("mss") + F.col("rss")),
            "root_rss": F.sqrt("rss"),
            "rmse": F.sqrt(divide("rss", "n")),
            "ll": ll,
            "aic": aic(ll, parameters),
        }
    )


def best_by(df: DataFrame, keys: Sequence[str], score: str, order: Sequence[str]) -> DataFrame:
    """The row with the highest score per group; ties go to the smallest ``order``.

    Rows without a score never win.
    """
    others = [c for c in df.columns if c not in keys]
    rank = F.struct((-F.col(score)).alias("s"), *order)
    scored = df.where(F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")))
    best = scored.groupBy(*keys).agg(F.min_by(F.struct(*others), rank).alias("__best"))
    return best.select(*keys, *[F.col(f"__best.{c}").alias(c) for c in others])


def peak(rates: DataFrame, keys: Sequence[str], time: str = "t", value: str = "AGR") -> DataFrame:
    """Largest value per group and the first time it is reached."""
    return rates.groupBy(*keys).agg(
        F.max(value).alias("peak"),
        F.min_by(time, F.struct((-F.col(value)).alias("s"), F.col(time))).alias("peak_time"),
    )


def rel_diff(first: str | Column, second: str | Column) -> Column:
    """(first - second) / first."""
    first = F.col(first) if isinstance(first, str) else first
    second = F.col(second) if isinstance(second, str) else second
    return divide(first - second, first)


def histogram(df: DataFrame, keys: Sequence[str], value: str, bins: int) -> DataFrame:
    """Counts in equal-width bins from minimum to maximum; the maximum is in the last bin."""
    present = df.where(F.col(value).isNotNull())
    if keys:
        ranges = present.groupBy(*keys).agg(F.min(value).alias("__lo"), F.max(value).alias("__hi"))
        marked = attach(present.select(*keys, value), ranges, keys)
    else:
        marked = present.select(
            value,
            present.agg(F.min(value)).scalar().alias("__lo"),
            present.agg(F.max(value)).scalar().alias("__hi"),
        )
    share = divide(F.col(value) - F.col("__lo"), F.col("__hi") - F.col("__lo"))
    bin_index = F.least(F.floor(F.coalesce(share, F.lit(0.0)) * bins), F.lit(bins - 1)).cast("int")
    return marked.withColumn("bin", bin_index).groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("n"))


def slope_init(df: DataFrame, keys: Sequence[str], x: str, y: str, log: bool = False) -> DataFrame:
    """Slope over the mean of y per x, optionally on the log, with the smallest mean."""
    means = df.groupBy(*keys, x).agg(F.avg(y).alias("__y"))
    response = F.ln("__y") if log else F.col("__y")
    return means.groupBy(*keys).agg(
        F.regr_slope(response, F.col(x)).alias("slope"),
        F.min("__y").alias("low"),
        F.count(F.lit(1)).alias("points"),
    )


def stepwise_rgr(df: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    """Growth rate between successive means: difference of log y over difference of x."""
    means = df.groupBy(*keys, x).agg(F.avg(y).alias("mean_y"))
    both = with_previous(means, keys, x, {"__x": x, "__y": "mean_y"})
    rate = divide(F.ln("mean_y") - F.ln("__y"), F.col(x) - F.col("__x"))
    return both.withColumn("rgr", rate).drop("__x", "__y")


def classic_rgr(df: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    """Growth rate over the whole span from the first and last mean."""
    means = df.groupBy(*keys, x).agg(F.avg(y).alias("__y"))
    ends = means.groupBy(*keys).agg(
        F.min(x).alias("x_first"),
        F.max(x).alias("x_last"),
        F.min_by("__y", x).alias("y_first"),
        F.max_by("__y", x).alias("y_last"),
    )
    return ends.withColumn("rgr", divide(F.ln(divide("y_last", "y_first")), F.col("x_last") - F.col("x_first")))


def sample_groups(df: DataFrame, keys: Sequence[str], count: int, seed: str) -> DataFrame:
    """All rows of ``count`` groups chosen by the md5 of key and seed (repeatable).

    The count is the sample size asked for; the semi-join keeps the rows whole.
    """
    text = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys], F.lit(seed))
    chosen = df.select(*keys).distinct().orderBy(F.md5(text), *keys).limit(count)
    condition = None
    renamed = chosen.withColumnsRenamed({k: f"__s_{k}" for k in keys})
    for k in keys:
        same = F.col(k).eqNullSafe(F.col(f"__s_{k}"))
        condition = same if condition is None else condition & same
    return df.join(renamed, condition, "left_semi")
