"""Branch and bound against whole grids."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from plotloom.growth import boxes as B
from plotloom.growth.grid import _values, grid_search, grid_values, two_step_search
from plotloom.operators.stats import best_by

SERIES = "g string, x double, y double"


def series(draw, times, start=0.0):
    m0, r, beta = draw.uniform(0.01, 0.9), draw.uniform(0.02, 0.19), draw.uniform(0.1, 0.9)
    x = np.sort(draw.uniform(start, 120, times))
    y = (m0 ** (1 - beta) + r * (1 - beta) * np.maximum(x, 0)) ** (1 / (1 - beta)) * np.exp(draw.normal(0, 0.2, times))
    return x, y


@pytest.mark.parametrize("seed", range(8))
@pytest.mark.parametrize("axes", [[(0, 1, 60), (0, 0.2, 50), (0, 0.99, 40)], [(0, 1, 30), (0, 0.2, 30), (-1, 0.9, 30)], [(0.3, 0.3, 1), (0, 0.2, 70), (0.5, 0.9, 3)]])
def test_the_best_point_is_that_of_the_whole_grid(seed, axes):
    draw = np.random.default_rng(seed)
    x, y = series(draw, int(draw.integers(2, 40)))
    points = np.stack([x, draw.integers(1, 4, len(x)), y, draw.uniform(0, 0.1, len(x))], axis=1)
    values = [np.linspace(*axis) for axis in axes]
    triples = np.stack([a.ravel() for a in np.meshgrid(*[np.arange(len(v)) for v in values], indexing="ij")], axis=1)
    total = B.errors(*(v[triples[:, i]] for i, v in enumerate(values)), points)
    at = int(np.nanargmin(total))
    search = B.Search(values, points)
    assert search.run(0, len(values[0])) == (total[at], *(int(v) for v in triples[at]))
    if len(triples) > 1e5:
        assert search.evaluated < 0.05 * len(triples)
    parts = [B.Search(values, points).run(a, min(a + 7, len(values[0]))) for a in range(0, len(values[0]), 7)]
    assert min(p for p in parts if p) == (total[at], *(int(v) for v in triples[at]))
    positive = B.Search(values, points, True).run(0, len(values[0]))
    defined = np.where(np.isnan(total) | (values[0][triples[:, 0]] == 0), np.inf, total)
    assert positive == (defined.min(), *(int(v) for v in triples[int(np.argmin(defined))]))


@pytest.mark.parametrize("seed", range(6))
def test_bounds_hold_for_every_point_of_a_box(seed):
    draw = np.random.default_rng(seed)
    x, y = series(draw, 12)
    points = np.stack([x, np.ones(12), y, np.zeros(12)], axis=1)
    values = [np.linspace(0, 3, 20), np.linspace(0, 0.2, 20), np.linspace(-0.5, 0.95, 20)]
    for _ in range(60):
        ends = np.sort(draw.integers(0, 20, (3, 2)), axis=1).ravel()[None, :]
        bound = B.lower_bounds(ends, values, points)[0]
        triples = B.members(ends)
        total = B.errors(*(v[triples[:, i]] for i, v in enumerate(values)), points)
        assert bound <= np.nanmin(total) * (1 + 1e-9) + 1e-9


def test_grids_beyond_the_bounds_are_searched_whole():
    draw = np.random.default_rng(3)
    x, y = series(draw, 10, -20.0)
    points = np.stack([x, np.ones(10), y, np.zeros(10)], axis=1)
    values = [np.linspace(0, 1, 10), np.linspace(-0.1, 0.2, 12), np.linspace(0, 1.5, 11)]
    triples = np.stack([a.ravel() for a in np.meshgrid(*[np.arange(len(v)) for v in values], indexing="ij")], axis=1)
    total = B.errors(*(v[triples[:, i]] for i, v in enumerate(values)), points)
    assert not B.bounded(points, values)
    assert B.Search(values, points).run(0, 10)[0] == np.nanmin(total)


def test_long_groups_are_searched_level_by_level(spark):
    draw = np.random.default_rng(5)
    rows = []
    for g in "abc":
        x, y = series(draw, 30)
        rows += [(g, float(a), float(b)) for a, b in zip(x, y)]
    data = spark.createDataFrame(rows, SERIES)
    axes = {"M0": (0.0, 1.0, 13), "r": (0.0, 0.2, 21), "beta": (0.0, 0.95, 12)}
    whole = best_by(grid_values(data, ["g"], axes), ["g"], "LL", ["i", "j", "k"])
    want = {r["g"]: (r["i"], r["j"], r["k"], r["LL"]) for r in whole.collect()}
    for limit in (4096, 7):
        got = {r["g"]: (r["i"], r["j"], r["k"], r["LL"]) for r in grid_search(data, ["g"], axes, array_limit=limit).collect()}
        assert {g: v[:3] for g, v in got.items()} == {g: v[:3] for g, v in want.items()}
        assert all(got[g][3] == pytest.approx(want[g][3], rel=1e-9) for g in want)


def test_the_shuffle_does_not_grow_with_the_axes(spark):
    data = spark.createDataFrame([("g", 1.0, 2.0), ("g", 5.0, 3.0)], SERIES)
    rows = []
    for count in (20, 500):
        axes = {"M0": (0.0, 1.0, count), "r": (0.0, 0.2, 3), "beta": (0.0, 0.9, 3)}
        from plotloom.growth.grid import _ranged
        from plotloom.growth.points import compress, pack

        rows.append(_ranged(pack(compress(data, ["g"], "x", "y"), ["g"]), ["g"], axes).count())
    assert rows == [8, 8]


def test_groups_without_a_defined_point(spark):
    data = spark.createDataFrame([("g", None, 2.0), ("h", 1.0, 2.0)], SERIES)
    axes = {"M0": (0.0, 1.0, 3), "r": (0.0, 0.2, 3), "beta": (0.0, 0.9, 3)}
    assert [r["g"] for r in two_step_search(data, ["g"], axes, axes).collect()] == ["h"]
    assert [len(v) for v in _values(axes)] == [3, 3, 3]
    assert data.where(F.col("g") == "g").count() == 1
