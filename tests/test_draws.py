"""Draws by counter and quantiles by narrowing, against sorting all draws."""

import tracemalloc
import warnings

import numpy as np
import pytest
from pyspark.sql import functions as F

from plotloom.growth import curves as C
from plotloom.growth import draws as D
from plotloom.growth.models import MODELS

SCHEMA = "g string, h double, Asym double, xmid double, scal double, cov array<double>"
COV = [0.04, 0.02, 0.01, 0.02, 0.5, 0.1, 0.01, 0.1, 0.3]


@pytest.mark.parametrize("kind", ["plain", "ties", "one value", "missing", "wide"])
@pytest.mark.parametrize("n", [1, 2, 40, 5000, 150_000])
def test_quantiles_are_those_of_all_values_sorted(kind, n):
    draw = np.random.default_rng(n)
    x = draw.standard_normal((n, 4))
    if kind == "ties":
        x = np.round(x)
    elif kind == "one value":
        x[:] = 0.1
    elif kind == "missing":
        x[draw.random(x.shape) < 0.5] = np.nan
        x[:, 2] = np.nan
    elif kind == "wide":
        x = np.sign(x) * 10 ** (60 * x)
    found = D.quantiles(lambda: (x[i : i + 30_000] for i in range(0, n, 30_000)), 0.1, 4)
    with warnings.catch_warnings():
        warnings.simplefilter("ignore", RuntimeWarning)
        assert np.array_equal(found, np.nanquantile(x, [0.05, 0.95], axis=0), equal_nan=True)


def test_the_same_draws_as_in_rows(spark):
    params = spark.createDataFrame([("a", 0.5, 5.0, 30.0, 6.0, COV), (None, 2.0, 5.0, 30.0, 6.0, COV)], SCHEMA)
    rows = C.parameter_draws(params, ["g", "h"], "logistic", 40, "7").collect()
    texts = {r["g"]: r["t"] for r in params.select("g", C._group_text("7", [F.col("g"), F.col("h")]).alias("t")).collect()}
    for g in ("a", None):
        own = D.Draws(MODELS["logistic"], texts[g], {"Asym": 5.0, "xmid": 30.0, "scal": 6.0}, COV, 40).block(0, 40)
        want = sorted((r["draw"], r["K"], r["r"], r["M0"]) for r in rows if r["g"] == g)
        assert np.allclose([w[1:] for w in want], np.hstack([own[n] for n in ("K", "r", "M0")]), rtol=1e-12)


def test_intervals_are_quantiles_of_the_draws(spark, monkeypatch):
    params = spark.createDataFrame([("a", 0.5, 5.0, 30.0, 6.0, COV)], SCHEMA)
    found = C.simulate(params, ["g"], "logistic", 10.0, 50.0, 60, 300).collect()
    rows = C.parameter_draws(params, ["g"], "logistic", 300, "1").collect()
    drawn = {n: np.array([r[n] for r in rows])[:, None] for n in ("K", "r", "M0")}
    times = np.array([r["t"] for r in found])
    assert np.allclose(np.sort(times), np.linspace(10, 50, 60))
    mass = drawn["K"] / (1 + (drawn["K"] / drawn["M0"] - 1) * np.exp(-drawn["r"] * times))
    ends = np.quantile(mass, [0.025, 0.975], axis=0)
    assert np.allclose([[r["M_lo"], r["M_hi"]] for r in found], ends.T, rtol=1e-9)


def test_very_many_draws_take_no_more_memory(monkeypatch):
    monkeypatch.setattr(D, "KEPT", 0)
    monkeypatch.setattr(D, "BLOCK", 5000)
    monkeypatch.setattr(D, "uniforms", lambda prefix, begin, end, index, tail: np.random.default_rng([begin, index, ord(tail)]).random(end - begin))
    peaks = []
    for count in (50_000, 1_000_000):
        made = D.Draws(MODELS["logistic"], "x", {"Asym": 5.0, "xmid": 30.0, "scal": 6.0}, COV, count)
        tracemalloc.start()
        D.quantiles(lambda: (made.block(b, e)["K"] for b, e in made.spans()), 0.05, 1)  # noqa: B023
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] < 1.5 * peaks[0] + 1e5


def test_one_exchange_after_the_parameters(spark):
    params = spark.createDataFrame([("a", 0.5, 5.0, 30.0, 6.0, COV)], SCHEMA)
    plan = C.simulate(params, ["g"], "logistic", 10.0, 50.0, 60, 300)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_a_failed_fit_has_missing_intervals(spark):
    params = spark.createDataFrame([("a", 0.5, None, None, None, None), ("b", 0.5, 5.0, 30.0, 6.0, COV)], SCHEMA)
    found = C.simulate(params, ["g"], "logistic", 10.0, 50.0, 3, 50).collect()
    assert {r["g"] for r in found if r["M_lo"] is None} == {"a"} and len(found) == 6
