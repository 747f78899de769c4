"""Growth models, written once for Spark columns and for numpy arrays.

Each model has a fitting form (``raw`` parameters) and a biological form
(``natural`` parameters: K upper limit, M0 initial mass, r rate, beta exponent).
Curves give mass M, absolute growth rate AGR = dM/dt and the relative growth rate as a
function of time (RGRt = AGR/M) and of mass (RGRm).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotloom.functions.scalar import finite


class SparkMath:
    """The few functions a formula needs, null where undefined."""

    exp = staticmethod(F.exp)
    log = staticmethod(F.ln)
    power = staticmethod(F.pow)
    div = staticmethod(F.try_divide)

    @staticmethod
    def const(value):
        return F.lit(value)


class NumpyMath:
    exp = staticmethod(np.exp)
    log = staticmethod(np.log)
    power = staticmethod(np.power)
    div = staticmethod(np.divide)

    @staticmethod
    def const(value):
        return value


@dataclass(frozen=True)
class Model:
    name: str
    raw: tuple[str, ...]
    natural: tuple[str, ...]
    predict: Callable  # (math, raw parameters, x) -> y
    transform: Callable  # (math, raw parameters) -> natural parameters
    mass: Callable  # (math, natural parameters, t) -> M
    agr: Callable  # (math, natural parameters, t, M) -> AGR
    rgrm: Callable  # (math, natural parameters, M) -> relative rate at mass M
    rgrm_log: Callable | None = None  # the same on a log-mass curve: without the 1/M
    fixed: tuple[str, ...] = field(default=())  # parameters given, not fitted


def _same(m, p):
    return p


def _power_base(m, p, t):
    return m.power(p["M0"], 1 - p["beta"]) + p["r"] * t * (1 - p["beta"])


def _power_mass(m, p, t):
    return m.power(_power_base(m, p, t), m.div(m.const(1.0), 1 - p["beta"]))


def _power_agr(m, p, t, mass):
    return p["r"] * m.power(_power_base(m, p, t), m.div(p["beta"], 1 - p["beta"]))


def _gompertz_mass(m, p, t):
    return p["K"] * m.power(m.div(p["M0"], p["K"]), m.exp(-p["r"] * t))


def _gompertz_agr(m, p, t, mass):
    # ln K - ln M0 stays finite where K / M0 would overflow, and is undefined at M0 = 0.
    return p["r"] * mass * m.exp(-p["r"] * t) * (m.log(p["K"]) - m.log(p["M0"]))


def _logistic_mass(m, p, t):
    return m.div(p["M0"] * p["K"], p["M0"] + (p["K"] - p["M0"]) * m.exp(-p["r"] * t))


def _logistic_agr(m, p, t, mass):
    decay = m.exp(-p["r"] * t)
    below = p["M0"] + (p["K"] - p["M0"]) * decay
    return m.div(p["r"] * p["M0"] * p["K"] * (p["K"] - p["M0"]) * decay, below * below)


def _fpl_wave(m, p, t):
    return m.exp(m.div(p["xmid"] - t, p["r"]))


def _fpl_mass(m, p, t):
    return p["M0"] + m.div(p["K"] - p["M0"], 1 + _fpl_wave(m, p, t))


def _fpl_agr(m, p, t, mass):
    wave = _fpl_wave(m, p, t)
    return m.div((p["K"] - p["M0"]) * wave, p["r"] * (1 + wave) * (1 + wave))


def _raw_mass(mass, transform):
    return lambda m, p, x: mass(m, transform(m, p), x)


def _mono_natural(m, p):
    return {"K": p["Asym"], "r": m.exp(p["lrc"]), "M0": p["R0"]}


def _logistic_natural(m, p):
    return {
        "K": p["Asym"],
        "r": m.div(m.const(1.0), p["scal"]),
        "M0": m.div(p["Asym"], 1 + m.exp(m.div(p["xmid"], p["scal"]))),
    }


def _gompertz_natural(m, p):
    return {"K": p["Asym"], "r": -m.log(p["b3"]), "M0": m.div(p["Asym"], m.exp(p["b2"]))}


def _fpl_natural(m, p):
    return {"M0": p["A"], "K": p["B"], "xmid": p["xmid"], "r": p["scal"]}


MODELS: dict[str, Model] = {
    model.name: model
    for model in [
        Model(
            "linear", ("a", "M0"), ("M0", "a"),
            lambda m, p, x: p["M0"] + p["a"] * x, _same,
            lambda m, p, t: p["M0"] + p["a"] * t,
            lambda m, p, t, mass: p["a"] + 0 * t,
            lambda m, p, mass: m.div(p["a"], mass),
        ),
        Model(
            "origin", ("a",), ("a",),
            lambda m, p, x: p["a"] * x, _same,
            lambda m, p, t: p["a"] * t,
            lambda m, p, t, mass: p["a"] + 0 * t,
            lambda m, p, mass: m.div(p["a"], mass),
        ),
        Model(
            "exponential", ("M0", "r"), ("M0", "r"),
            lambda m, p, x: p["M0"] * m.exp(p["r"] * x), _same,
            lambda m, p, t: p["M0"] * m.exp(p["r"] * t),
            lambda m, p, t, mass: p["r"] * mass,
            lambda m, p, mass: p["r"] + 0 * mass,
        ),
        Model(
            "power", ("M0", "r", "beta"), ("M0", "r", "beta"),
            _power_mass, _same, _power_mass, _power_agr,
            lambda m, p, mass: p["r"] * m.power(mass, p["beta"] - 1),
        ),
        Model(
            "power2", ("r", "beta"), ("M0", "r", "beta"),
            _power_mass, _same, _power_mass, _power_agr,
            lambda m, p, mass: p["r"] * m.power(mass, p["beta"] - 1),
            fixed=("M0",),
        ),
        Model(
            "monomolecular", ("Asym", "R0", "lrc"), ("K", "r", "M0"),
            lambda m, p, x: p["Asym"] - m.exp(-m.exp(p["lrc"]) * x) * (p["Asym"] - p["R0"]),
            _mono_natural,
            lambda m, p, t: p["K"] - m.exp(-p["r"] * t) * (p["K"] - p["M0"]),
            lambda m, p, t, mass: p["r"] * m.exp(-p["r"] * t) * (p["K"] - p["M0"]),
            lambda m, p, mass: m.div(p["r"] * (p["K"] - mass), mass),
            lambda m, p, mass: p["r"] * (p["K"] - mass),
        ),
        Model(
            "logistic", ("Asym", "xmid", "scal"), ("K", "r", "M0"),
            lambda m, p, x: m.div(p["Asym"], 1 + m.exp(m.div(p["xmid"] - x, p["scal"]))),
            _logistic_natural, _logistic_mass, _logistic_agr,
            lambda m, p, mass: p["r"] * (1 - m.div(mass, p["K"])),
            lambda m, p, mass: p["r"] * mass * (1 - m.div(mass, p["K"])),
        ),
        Model(
            "fpl", ("A", "B", "xmid", "scal"), ("M0", "K", "xmid", "r"),
            _raw_mass(_fpl_mass, _fpl_natural), _fpl_natural, _fpl_mass, _fpl_agr,
            lambda m, p, mass: m.div((p["M0"] - mass) * (p["K"] - mass), p["r"] * mass * (p["M0"] - p["K"])),
            lambda m, p, mass: m.div((p["M0"] - mass) * (p["K"] - mass), p["r"] * (p["M0"] - p["K"])),
        ),
        Model(
            "gompertz", ("Asym", "b2", "b3"), ("K", "r", "M0"),
            lambda m, p, x: p["Asym"] * m.exp(-p["b2"] * m.power(p["b3"], x)),
            _gompertz_natural, _gompertz_mass, _gompertz_agr,
            lambda m, p, mass: p["r"] * (m.log(p["K"]) - m.log(mass)),
            lambda m, p, mass: p["r"] * mass * (m.log(p["K"]) - m.log(mass)),
        ),
    ]
}


def parameter_columns(model: Model, prefix: str = "") -> dict[str, Column]:
    return {name: F.col(f"{prefix}{name}") for name in model.natural}


def curve_columns(model: Model, p: Mapping[str, Column], t: Column, log_scale: bool = False) -> dict[str, Column]:
    """M, AGR, RGRt and RGRm as columns; a value that is not finite is null.

    With ``log_scale`` the curve was fitted to log mass, so its slope is already a
    relative rate and the absolute rate is that slope times the mass.
    """
    m = SparkMath
    mass = model.mass(m, p, t)
    slope = model.agr(m, p, t, mass)
    if log_scale:
        rates = {"AGR": slope * F.exp(mass), "RGRt": slope, "RGRm": mass_rate(model, p, mass, True)}
    else:
        rates = {"AGR": slope, "RGRt": F.try_divide(slope, mass), "RGRm": mass_rate(model, p, mass, False)}
    return {"M": finite(mass), **{name: finite(rate) for name, rate in rates.items()}}


def curve_arrays(model: Model, p: Mapping[str, np.ndarray], t: np.ndarray, log_scale: bool = False) -> dict[str, np.ndarray]:
    """The same curves as arrays, NaN where a value is not finite."""
    m = NumpyMath
    with np.errstate(all="ignore"):
        mass = model.mass(m, p, t)
        slope = model.agr(m, p, t, mass)
        by_mass = (model.rgrm_log if log_scale else model.rgrm)(m, p, mass)
        if log_scale:
            rates = {"AGR": slope * np.exp(mass), "RGRt": slope, "RGRm": by_mass}
        else:
            rates = {"AGR": slope, "RGRt": slope / mass, "RGRm": by_mass}
        return {name: np.where(np.isfinite(v), v, np.nan) for name, v in {"M": mass, **rates}.items()}


def mass_rate(model: Model, p: Mapping[str, Column], mass: Column, log_scale: bool) -> Column:
    if not log_scale:
        return model.rgrm(SparkMath, p, mass)
    if model.rgrm_log is None:
        raise ValueError(f"{model.name} has no log-scale form")
    return model.rgrm_log(SparkMath, p, mass)


def add_curves(df: DataFrame, model: str, t: str = "t", log_scale: bool = False) -> DataFrame:
    """Add the four curves to a frame with the natural parameters and a time column."""
    spec = MODELS[model]
    return df.withColumns(curve_columns(spec, parameter_columns(spec), F.col(t), log_scale))


def add_natural(df: DataFrame, model: str) -> DataFrame:
    """Add natural parameters computed from the raw ones."""
    spec = MODELS[model]
    raw = {name: F.col(name) for name in spec.raw + spec.fixed}
    return df.withColumns({name: finite(value) for name, value in spec.transform(SparkMath, raw).items()})


def add_residuals(observations: DataFrame, model: str, x: str = "x", y: str = "y") -> DataFrame:
    """Fitted value and residual of every observation that carries its raw parameters."""
    spec = MODELS[model]
    raw = {name: F.col(name) for name in spec.raw + spec.fixed}
    fitted = finite(spec.predict(SparkMath, raw, F.col(x)))
    return observations.withColumn("fitted", fitted).withColumn("resid", F.col(y) - F.col("fitted"))


def rescale(df: DataFrame, column: str, factor: float) -> DataFrame:
    """Change the unit of a measurement (grams to milligrams before a log fit, and back)."""
    return df.withColumn(column, F.col(column) * F.lit(factor))
