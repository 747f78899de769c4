import numpy as np
import pytest
from growth_data import SEED_MASS, series
from pyspark.sql import functions as F

from plotloom.growth import curves as C
from plotloom.growth.fit import compare_models, fit, fit_linear, fit_origin
from plotloom.growth.grid import grid_search, grid_values, two_step_search
from plotloom.growth.models import MODELS, NumpyMath, add_curves, add_residuals
from plotloom.growth.patterns import trajectory_groups
from plotloom.growth.smoothing import local_smooth
from plotloom.growth.points import compress, initial_values
from plotloom.operators.stats import fit_stats, peak


def one(frame):
    rows = frame.collect()
    assert len(rows) == 1
    return rows[0]


# Published comparisons -----------------------------------------------------------------


def test_delta_aic_of_the_limited_models(spark):
    """0 / 1 / 1.9 / 33.2 for logistic, Gompertz, four-parameter and monomolecular."""
    data = series(spark, "CER")
    aic = {m: one(fit(data, ["g"], m, variance="exp"))["aic"] for m in ("logistic", "gompertz", "fpl")}
    aic["monomolecular"] = one(fit(data, ["g"], "monomolecular"))["aic"]
    delta = {m: round(v - aic["logistic"], 1) for m, v in aic.items()}
    assert delta["gompertz"] == pytest.approx(1.0, abs=0.11)
    assert delta["fpl"] == pytest.approx(1.9, abs=0.11)
    assert delta["monomolecular"] == pytest.approx(33.2, abs=0.11)


def test_delta_aic_of_the_unlimited_models(spark):
    """0 / 12.5 / 25 / 39.6 for power law, exponential, linear and line through the origin."""
    data = series(spark, "holcus")
    best = one(fit(data, ["g"], "power2", fixed={"M0": SEED_MASS}))["aic"]
    delta = {m: one(fit(data, ["g"], m))["aic"] - best for m in ("exponential", "linear", "origin")}
    assert delta["exponential"] == pytest.approx(12.5, abs=0.06)
    assert delta["linear"] == pytest.approx(25, abs=0.1)
    assert delta["origin"] == pytest.approx(39.6, abs=0.06)


def test_delta_aic_on_the_log_scale(spark):
    """0 / 13.2 / 20.2 / 55.4 for four-parameter, Gompertz, monomolecular and logistic."""
    logged = series(spark, "holcus").withColumn("y", F.ln("y"))
    milligrams = series(spark, "holcus").withColumn("y", F.ln(F.col("y") * 1000))
    best = one(fit(logged, ["g"], "fpl", variance="exp"))["aic"]
    assert one(fit(milligrams, ["g"], "gompertz", variance="exp"))["aic"] - best == pytest.approx(13.2, abs=0.1)
    assert one(fit(logged, ["g"], "monomolecular"))["aic"] - best == pytest.approx(20.2, abs=0.1)
    assert one(fit(logged, ["g"], "logistic", variance="exp"))["aic"] - best == pytest.approx(55.4, abs=0.1)


def test_peak_growth_of_two_species(spark):
    """The peaks lie 45 days apart and differ by 28 per cent."""
    fits = fit(series(spark, "CER", "GER"), ["g"], "logistic")
    rates = add_curves(C.rate_grid(fits, 14.0, 189.0, 100), "logistic")
    peaks = {r["g"]: r for r in peak(rates, ["g"]).collect()}
    assert abs(peaks["GER"]["peak_time"] - peaks["CER"]["peak_time"]) == pytest.approx(45, abs=1)
    assert peaks["GER"]["peak"] / peaks["CER"]["peak"] - 1 == pytest.approx(0.28, abs=0.01)


def test_grid_search_and_its_distance_to_the_fixed_mass_fit(spark):
    data = series(spark, "holcus")
    fine = {"M0": (0.0, 0.002, 500), "r": (0.0, 0.2, 100), "beta": (0.2, 0.8, 100)}
    best = one(grid_search(data, ["g"], fine))
    assert best["M0"] == pytest.approx(3.206413e-05, rel=1e-6)
    assert best["r"] == pytest.approx(0.0888889, rel=1e-6)
    assert best["beta"] == pytest.approx(0.6303030, rel=1e-6)
    assert best["LL"] == pytest.approx(-39.773572, abs=1e-6)
    fixed = one(fit(data, ["g"], "power2", fixed={"M0": SEED_MASS}))
    assert fixed["converged"] and fixed["rss"] == pytest.approx(39.0323, abs=1e-3)
    assert (best["r"] - fixed["r"]) / best["r"] == pytest.approx(0.013, abs=5e-4)
    assert (best["beta"] - fixed["beta"]) / best["beta"] == pytest.approx(-0.009, abs=5e-4)


# Fits ----------------------------------------------------------------------------------


def test_linear_fits_agree_with_the_regression_sums(spark):
    data = series(spark, "holcus", "CER")
    closed = {r["g"]: r for r in fit_linear(data, ["g"]).collect()}
    for row in fit(data, ["g"], "linear").collect():
        assert row["a"] == pytest.approx(closed[row["g"]]["a"], rel=1e-8)
        assert row["M0"] == pytest.approx(closed[row["g"]]["M0"], rel=1e-8)
    origin = {r["g"]: r["a"] for r in fit_origin(data, ["g"]).collect()}
    for row in fit(data, ["g"], "origin").collect():
        assert row["a"] == pytest.approx(origin[row["g"]], rel=1e-8)


@pytest.mark.parametrize("model, fixed", [("logistic", {}), ("exponential", {}), ("power2", {"M0": SEED_MASS})])
def test_groups_with_many_times_give_the_same_fit(spark, model, fixed):
    data = series(spark, "holcus") if model != "logistic" else series(spark, "CER", "GER")
    short = {r["g"]: r for r in fit(data, ["g"], model, fixed=fixed).collect()}
    long = {r["g"]: r for r in fit(data, ["g"], model, fixed=fixed, array_limit=3).collect()}
    assert set(short) == set(long)
    for g in short:
        assert short[g]["converged"] and long[g]["converged"]
        for name in (*MODELS[model].raw, "rss", "ll", "mss", "aic"):
            assert long[g][name] == pytest.approx(short[g][name], rel=1e-5)
        assert long[g]["cov"] == pytest.approx(short[g]["cov"], rel=1e-3)


NOISY = {
    "logistic": lambda t: 50 / (1 + np.exp((30 - t) / 6)),
    "fpl": lambda t: 4 + 46 / (1 + np.exp((30 - t) / 6)),
    "gompertz": lambda t: 50 * np.exp(-6 * 0.9**t),
    "exponential": lambda t: 2 * np.exp(0.05 * t),
    "monomolecular": lambda t: 50 - 45 * np.exp(-0.06 * t),
    "power2": lambda t: (0.1**0.4 + 0.05 * t * 0.4) ** 2.5,
}


def noisy(model, times, spread=0.3):
    t = np.linspace(0, 60, times)
    draw = np.random.default_rng(times)
    y = NOISY[model](t)
    y = y + draw.normal(0, spread, times)
    return [(model, float(a), float(b)) for a, b in zip(t, y)]


def same_fit(spark, model, rows, limit):
    data = spark.createDataFrame(rows, "g string, x double, y double")
    fixed = {"M0": 0.1} if model == "power2" else {}
    short = one(fit(data, ["g"], model, fixed=fixed, array_limit=10**6))
    long = one(fit(data, ["g"], model, fixed=fixed, array_limit=limit))
    assert short["converged"] == long["converged"]
    for name in MODELS[model].raw:
        assert long[name] == pytest.approx(short[name], rel=1e-5)
    assert long["rss"] == pytest.approx(short["rss"], rel=1e-9)
    for name in ("n", "ll", "mss", "delta", "aic"):
        assert long[name] == pytest.approx(short[name], rel=1e-5, abs=1e-9)
    return short


@pytest.mark.parametrize("model", ["exponential", "fpl", "monomolecular", "power2"])
def test_noisy_long_groups_give_the_same_fit(spark, model):
    assert same_fit(spark, model, noisy(model, 600), 250)["converged"]


def test_one_time_above_the_default_limit(spark):
    assert same_fit(spark, "gompertz", noisy("gompertz", 4097), 4096)["converged"]


def test_copies_of_observations_only_change_the_count(spark):
    data = series(spark, "CER")
    once, thrice = one(fit(data, ["g"], "logistic")), one(fit(data.union(data).union(data), ["g"], "logistic"))
    assert thrice["n"] == 3 * once["n"] and thrice["rss"] == pytest.approx(3 * once["rss"], rel=1e-9)
    assert thrice["Asym"] == pytest.approx(once["Asym"], rel=1e-6)


def test_a_bad_group_does_not_harm_the_others(spark):
    bad = [("flat", float(x), 1.0) for x in range(6)] + [("short", 1.0, 2.0), ("short", 2.0, 3.0)]
    bad += [("null", None, 1.0), ("null", 1.0, None)]
    data = series(spark, "CER").union(spark.createDataFrame(bad, "g string, x double, y double"))
    rows = {r["g"]: r for r in fit(data, ["g"], "logistic").collect()}
    assert rows["CER"]["converged"] and not rows["flat"]["converged"] and not rows["short"]["converged"]
    assert not rows["null"]["converged"] and rows["null"]["n"] == 0 and rows["null"]["Asym"] is None
    few = {r["g"]: r for r in fit(data, ["g"], "power2", fixed={"M0": 0.01}).collect()}
    assert not few["short"]["converged"]
    shares = one(compare_models({"logistic": fit(data, ["g"], "logistic")}, ["g"]))
    assert (shares["groups"], shares["converged"]) == (4, 1)


def test_fit_of_known_curves(spark):
    x = np.arange(0, 60, 2.0)
    truth = {"a": (5.0, 30.0, 6.0), "b": (0.6, 20.0, 3.0), "c": (40.0, 35.0, 8.0)}
    rows = [(g, float(t), float(k / (1 + np.exp((m - t) / s)))) for g, (k, m, s) in truth.items() for t in x]
    data = spark.createDataFrame(rows, "g string, x double, y double")
    for row in fit(data, ["g"], "logistic").collect():
        assert row["converged"]
        assert (row["Asym"], row["xmid"], row["scal"]) == pytest.approx(truth[row["g"]], rel=1e-5)
        assert row["r"] == pytest.approx(1 / truth[row["g"]][2], rel=1e-5)


def test_starting_values(spark):
    points = compress(series(spark, "holcus"), ["g"], "x", "y")
    start = one(initial_values(points, ["g"], "exponential"))
    assert start["r"] == pytest.approx(0.13865540, abs=1e-8) and start["M0"] == pytest.approx(0.000484, abs=1e-9)
    few = one(initial_values(points.where("x < 25"), ["g"], "power"))
    assert few["r"] is None and few["beta"] is None


# Curves --------------------------------------------------------------------------------

NATURAL = {
    "linear": {"M0": 0.5, "a": 0.2},
    "exponential": {"M0": 0.5, "r": 0.1},
    "power": {"M0": 0.01, "r": 0.2, "beta": 0.7},
    "monomolecular": {"K": 5.0, "r": 0.08, "M0": 0.3},
    "logistic": {"K": 5.0, "r": 0.2, "M0": 0.1},
    "fpl": {"K": 5.0, "r": 4.0, "M0": 0.1, "xmid": 20.0},
    "gompertz": {"K": 5.0, "r": 0.15, "M0": 0.05},
}


@pytest.mark.parametrize("name", NATURAL)
def test_rates_are_the_derivative_of_mass(name):
    spec, p, m = MODELS[name], NATURAL[name], NumpyMath
    t, h = np.linspace(1, 40, 25), 1e-5
    mass = spec.mass(m, p, t)
    slope = (spec.mass(m, p, t + h) - spec.mass(m, p, t - h)) / (2 * h)
    assert spec.agr(m, p, t, mass) == pytest.approx(slope, rel=1e-6, abs=1e-8)
    assert spec.rgrm(m, p, mass) == pytest.approx(slope / mass, rel=1e-5, abs=1e-7)


def test_published_gompertz_parameters_and_edge_rows(spark):
    rows = [
        ("IW_P04899", 0.44537009608967965, 0.05275588545927644, 1.3574758806053019e-7),
        ("no mass", 0.4, 0.1, 0.0),
        ("tiny", 0.5, 0.2, 1e-75),
    ]
    params = spark.createDataFrame(rows, "id string, K double, r double, M0 double")
    rates = add_curves(C.rate_grid(params, 0.0, 130.0, 100), "gompertz")
    assert rates.count() == 300
    by = {r["id"]: r for r in rates.groupBy("id").agg(F.count("RGRm").alias("n"), F.max("M").alias("top"), F.count("AGR").alias("a")).collect()}
    assert by["IW_P04899"]["n"] == 100 and 0.4 < by["IW_P04899"]["top"] < 0.4454
    assert by["no mass"]["a"] == 0
    assert by["tiny"]["a"] == 100


def test_log_curves(spark):
    params = spark.createDataFrame([(5.0, 0.2, 0.1)], "K double, r double, M0 double")
    row = one(add_curves(C.rate_grid(params, 10.0, 11.0, 2), "logistic", log_scale=True).where("t = 10"))
    plain = one(add_curves(C.rate_grid(params, 10.0, 11.0, 2), "logistic").where("t = 10"))
    assert row["RGRt"] == pytest.approx(plain["AGR"]) and row["AGR"] == pytest.approx(plain["AGR"] * np.exp(plain["M"]))


def test_residuals_and_statistics(spark):
    data = series(spark, "CER")
    row = one(fit(data, ["g"], "logistic"))
    raw = data.withColumns({n: F.lit(row[n]) for n in ("Asym", "xmid", "scal")})
    stats = one(fit_stats(add_residuals(raw, "logistic"), ["g"], 3))
    for name in ("rss", "ll", "aic", "mss", "r2", "root_rss"):
        assert stats[name] == pytest.approx(row[name], rel=1e-9)


# Grids, intervals, contrasts -------------------------------------------------------------


def test_chunked_grid_equals_whole_grid(spark):
    axes = {"M0": (0.0, 0.01, 4), "r": (0.05, 0.15, 5), "beta": (0.2, 0.8, 4)}
    data = series(spark, "holcus", "CER")
    whole = {tuple(r[c] for c in "gijk"): r["LL"] for r in grid_values(data, ["g"], axes).collect()}
    parts = {tuple(r[c] for c in "gijk"): r["LL"] for r in grid_values(data, ["g"], axes, array_limit=2).collect()}
    assert len(whole) == 160 and whole.keys() == parts.keys()
    for key, value in whole.items():
        assert parts[key] == pytest.approx(value, rel=1e-9) if value is not None else parts[key] is None
    best = two_step_search(data, ["g"], axes, axes)
    assert {r["g"]: r["step"] for r in best.collect()}.keys() == {"holcus", "CER"}


def test_intervals_match_numpy(spark):
    cov = np.array([[0.04, 0.02, 0.01], [0.02, 0.5, 0.1], [0.01, 0.1, 0.3]])
    mean = np.array([5.0, 30.0, 6.0])
    params = spark.createDataFrame([("g", *mean.tolist(), cov.ravel().tolist())], "g string, Asym double, xmid double, scal double, cov array<double>")
    drawn = np.random.default_rng(3).multivariate_normal(mean, cov, size=40000)
    found = {r["t"]: r for r in C.simulate(params, ["g"], "logistic", 10.0, 50.0, 3, 4000).collect()}
    for t, row in found.items():
        mass = drawn[:, 0] / (1 + np.exp((drawn[:, 1] - t) / drawn[:, 2]))
        low, high = np.quantile(mass, [0.025, 0.975])
        assert row["M_lo"] == pytest.approx(low, abs=0.05 * (high - low) + 1e-3)
        assert row["M_hi"] == pytest.approx(high, abs=0.05 * (high - low) + 1e-3)


def test_contrasts_cover_all_pairs(spark):
    rows = [(g, 5.0 + i, 0.2, 0.1 + i / 10) for i, g in enumerate("cab")]
    params = spark.createDataFrame(rows, "g string, K double, r double, M0 double")
    found = C.contrasts(params, "g", "logistic", 1.0, 40.0, 10)
    assert {(r["a"], r["b"]) for r in found.select("a", "b").distinct().collect()} == {("a", "b"), ("a", "c"), ("b", "c")}
    assert found.count() == 30
    chosen = spark.createDataFrame([("b", "c")], "a string, b string")
    assert C.contrasts(params, "g", "logistic", 1.0, 40.0, 10, pairs=chosen).count() == 10
    two = C.contrasts(params.where("g <> 'c'"), "g", "logistic", 1.0, 40.0, 10)
    assert two.count() == 10


def test_contrast_intervals_hold_the_point_difference(spark):
    fits = fit(series(spark, "CER", "GER"), ["g"], "logistic")
    point = {r["step"]: r for r in C.contrasts(fits, "g", "logistic", 14.0, 189.0, 6).collect()}
    rows = C.contrast_intervals(fits, "g", "logistic", 14.0, 189.0, 6, 500).collect()
    assert len(rows) == 6
    for row in rows:
        assert row["diffM_lo"] < point[row["step"]]["diffM"] < row["diffM_hi"]


# Patterns --------------------------------------------------------------------------------


def test_local_smooth_reproduces_a_parabola(spark):
    rows = [("g", d, 2.0 + 0.5 * d - 0.01 * d * d) for d in range(40) for _ in range(3)]
    data = spark.createDataFrame(rows, "g string, d int, y double")
    for row in local_smooth(data, ["g"], "d", "y", count=9).collect():
        assert row["smooth"] == pytest.approx(2.0 + 0.5 * row["t"] - 0.01 * row["t"] ** 2, abs=1e-6)


def test_trajectory_groups_are_repeatable(spark):
    rows = [(i, *(float((i % 4) * 10 + t + (i % 3) * 0.1) for t in range(5))) for i in range(80)]
    matrix = spark.createDataFrame(rows, "id int, a double, b double, c double, d double, e double")
    sizes = lambda: sorted(r["count"] for r in trajectory_groups(matrix, "id", list("abcde")).groupBy("pattern").count().collect())
    assert sizes() == [20, 20, 20, 20] == sizes()
