"""Variance growing with the fitted curve, on groups of one array and of several."""

import numpy as np
import pytest

from plotloom.growth import long_groups
from plotloom.growth.fit import fit


@pytest.mark.parametrize("times, limit", [(600, 250), (4097, 4096)])
def test_long_groups_take_few_passes_to_the_same_fit(spark, monkeypatch, times, limit):
    draw = np.random.default_rng(times)
    x = np.sort(draw.uniform(0, 100, times))
    curve = 5 * np.exp(-3 * 0.94**x)
    y = curve + draw.normal(0, 0.05, times) * np.exp(0.3 * curve)
    data = spark.createDataFrame([("g", float(a), float(b)) for a, b in zip(x, y)], "g string, x double, y double")
    passes = []
    results = long_groups.LongFit.results
    monkeypatch.setattr(long_groups.LongFit, "results", lambda self, *a: passes.append(self.passes) or results(self, *a))
    (short,) = fit(data, ["g"], "gompertz", variance="exp", array_limit=10**6).collect()
    assert not passes
    (long,) = fit(data, ["g"], "gompertz", variance="exp", array_limit=limit).collect()
    assert passes[0] <= 30
    assert short["converged"] and long["converged"]
    for name in ("Asym", "b2", "b3", "delta", "ll", "rss", "mss", "aic"):
        assert long[name] == pytest.approx(short[name], rel=1e-5)
    assert short["delta"] == pytest.approx(0.3, abs=0.05)
