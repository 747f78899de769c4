"""Growth models on the running event totals (ten units at the end of the month)."""

from __future__ import annotations

from pyspark.sql import functions as F

from plotloom.growth import curves as C
from plotloom.growth import fit as G
from plotloom.growth import grid as S
from plotloom.growth import patterns as P
from plotloom.growth.smoothing import local_smooth as local_smoother
from plotloom.growth.models import MODELS, add_curves, add_natural, add_residuals, rescale
from plotloom.growth.points import compress, initial_values
from plotloom.operators.keys import join_same
from plotloom.operators.sizing import attach
from plotloom.operators.stats import fit_stats, histogram, interval, peak, rel_diff
from plotloom.queries.base import GROWTH_SQL, daily_growth, query, rounded, table
from plotloom.queries.fits import (
    CURVES as FIT_CURVES,
)
from plotloom.queries.fits import (
    compare_sql,
    covariance_sql,
    fit_sql,
    least_squares_sql,
    logistic_params_sql,
)

CURVES = ["M", "AGR", "RGRt", "RGRm"]


def _round_all(df, names, places=6):
    return df.withColumns({name: rounded(name, places) for name in names})


# Closed-form fits ----------------------------------------------------------------------


@query(
    "fit_linear",
    f"with {GROWTH_SQL} select g, round(regr_slope(y, x), 6) as a, round(regr_intercept(y, x), 6) as \"M0\","
    " cast(count(*) as bigint) as n from growth group by 1",
)
def fit_linear(spark, folder):
    return _round_all(G.fit_linear(daily_growth(spark, folder), ["g"]), ["a", "M0"])


@query(
    "fit_linear_by_user",
    """
select user_id as g, round(regr_slope(value, epoch(ts) / 86400 - 19723), 6) as a,
  round(regr_intercept(value, epoch(ts) / 86400 - 19723), 6) as "M0", cast(count(*) as bigint) as n
from events group by 1""",
)
def fit_linear_by_user(spark, folder):
    """One regression per user over all raw events."""
    begin = F.lit("2024-01-01").cast("timestamp_ntz")
    day = F.timestamp_diff("MICROSECOND", begin, F.col("ts")) / 86_400_000_000
    events = table(spark, folder, "events").select(F.col("user_id").alias("g"), day.alias("x"), F.col("value").alias("y"))
    return _round_all(G.fit_linear(events, ["g"]), ["a", "M0"])


@query(
    "fit_origin",
    f"with {GROWTH_SQL} select g, round(sum(x * y) / sum(x * x), 6) as a, cast(count(*) as bigint) as n from growth group by 1",
)
def fit_origin(spark, folder):
    return _round_all(G.fit_origin(daily_growth(spark, folder), ["g"]), ["a"])


# Starting values -----------------------------------------------------------------------

RANGE_SQL = f"{GROWTH_SQL}, r as (select g, min(y) as lo, max(y) as hi, max(y) - min(y) as w from growth group by 1)"


def _start_sql(response: str, columns: str) -> str:
    return f"""
with {RANGE_SQL}, z as (select growth.g, x, lo, hi, w, y, {response} as z from growth join r on r.g = growth.g),
l as (select g, lo, hi, w, regr_slope(z, x) as s, regr_intercept(z, x) as i from z group by all)
select g, {columns}, cast((select count(distinct x) from growth q where q.g = l.g) as bigint) as distinct_x from l"""


STARTS = {
    "linear": _start_sql("y", 'round(s, 6) as a, round(lo, 6) as "M0"'),
    "exponential": _start_sql("ln(y)", 'round(lo, 6) as "M0", round(s, 6) as r'),
    "power": _start_sql("ln(y)", 'round(lo, 6) as "M0", round(s, 6) as r, cast(0.9 as double) as beta'),
    "logistic": _start_sql(
        "case when y / (hi + w * 0.05) < 1 then ln((y / (hi + w * 0.05)) / (1 - y / (hi + w * 0.05))) end",
        'round(hi + w * 0.05, 6) as "Asym", round(-i / s, 6) as xmid, round(1 / s, 6) as scal',
    ),
    "gompertz": _start_sql(
        "ln(-ln(y / (hi + w * 0.05)))",
        'round(hi + w * 0.05, 6) as "Asym", round(exp(i), 6) as b2, round(exp(s), 6) as b3',
    ),
    "fpl": _start_sql(
        "ln(((y - (lo - w * 0.05)) / (w * 1.1)) / (1 - (y - (lo - w * 0.05)) / (w * 1.1)))",
        'round(lo - w * 0.05, 6) as "A", round(hi + w * 0.05, 6) as "B", round(-i / s, 6) as xmid, round(1 / s, 6) as scal',
    ),
    "monomolecular": _start_sql(
        "ln(hi + w * 0.25 - y)",
        'round(hi + w * 0.25, 6) as "Asym", round(hi + w * 0.25 - exp(i), 6) as "R0", round(ln(-s), 6) as lrc',
    ),
}


def _register_start(model: str, sql: str) -> None:
    @query(f"initial_values_{model}", sql)
    def run(spark, folder):
        points = compress(daily_growth(spark, folder), ["g"], "x", "y")
        return _round_all(initial_values(points, ["g"], model), MODELS[model].raw)


for _model, _sql in STARTS.items():
    _register_start(_model, _sql)


# Rate curves ---------------------------------------------------------------------------

PARAMS_SQL = f"""{GROWTH_SQL}, params as (
  select g, max(y) * 1.1 as "K", min(y) as "M0", 1.5 * regr_slope(ln(y), x) as r, 0.4 + min(y) / 10 as beta,
    regr_slope(y, x) as a, 14.0 + min(y) as xmid from growth group by 1)"""
TIMES_SQL = "times as (select 1 + i * 29 / 19.0::double as t, cast(i as integer) as step from range(20) r(i))"


def growth_params(spark, folder):
    series = daily_growth(spark, folder)
    return series.groupBy("g").agg(
        (F.max("y") * 1.1).alias("K"), F.min("y").alias("M0"), (F.regr_slope(F.ln("y"), F.col("x")) * 1.5).alias("r"),
        (F.min("y") / 10 + 0.4).alias("beta"), F.regr_slope("y", "x").alias("a"), (F.min("y") + 14.0).alias("xmid"),
    )


def _curve_sql(mass: str, agr: str, rgrm: str, where: str = "") -> str:
    return f"""
with {PARAMS_SQL}, {TIMES_SQL}, c as (select *, {mass} as m from params, times)
, d as (select *, {agr} as v from c)
select g, round(t, 6) as t, round(m, 6) as "M", round(v, 6) as "AGR", round(v / m, 6) as "RGRt", round({rgrm}, 6) as "RGRm" from d {where}"""


def _log_curve_sql(mass: str, agr: str, rgrm: str) -> str:
    return f"""
with {PARAMS_SQL}, {TIMES_SQL}, c as (select *, {mass} as m from params, times)
, d as (select *, {agr} as v from c)
select g, round(t, 6) as t, round(m, 6) as "M", round(v * exp(m), 4) as "AGR", round(v, 6) as "RGRt", round({rgrm}, 6) as "RGRm" from d"""


FPL_SCALE = "(1 / r)"
MASS = {
    "linear": '"M0" + a * t',
    "origin": "a * t",
    "exponential": '"M0" * exp(r * t)',
    "power": 'pow(pow("M0", 1 - beta) + r * t * (1 - beta), 1 / (1 - beta))',
    "monomolecular": '"K" - exp(-r * t) * ("K" - "M0")',
    "logistic": '"M0" * "K" / ("M0" + ("K" - "M0") * exp(-r * t))',
    "fpl": f'"M0" + ("K" - "M0") / (1 + exp((xmid - t) / {FPL_SCALE}))',
    "gompertz": '"K" * pow("M0" / "K", exp(-r * t))',
}
AGR = {
    "linear": "a",
    "origin": "a",
    "exponential": '"M0" * r * exp(r * t)',
    "power": 'r * pow(pow("M0", 1 - beta) + r * t * (1 - beta), beta / (1 - beta))',
    "monomolecular": 'r * exp(-r * t) * ("K" - "M0")',
    "logistic": '(r * "M0" * "K" * ("K" - "M0") * exp(-r * t)) / pow("M0" + ("K" - "M0") * exp(-r * t), 2)',
    "fpl": f'(("K" - "M0") * exp((xmid - t) / {FPL_SCALE})) / ({FPL_SCALE} * pow(1 + exp((xmid - t) / {FPL_SCALE}), 2))',
    "gompertz": 'r * "K" * exp(-r * t) * ln("K" / "M0") * pow("M0" / "K", exp(-r * t))',
}
RGRM = {
    "linear": "a / m",
    "origin": "a / m",
    "exponential": "r",
    "power": "r * pow(m, beta - 1)",
    "monomolecular": 'r * ("K" - m) / m',
    "logistic": 'r * (1 - m / "K")',
    "fpl": f'("M0" - m) * ("K" - m) / ({FPL_SCALE} * m * ("M0" - "K"))',
    "gompertz": 'r * ln("K" / m)',
}
RGRM_LOG = {
    "monomolecular": 'r * ("K" - m)',
    "logistic": 'r * m * (1 - m / "K")',
    "fpl": f'("M0" - m) * ("K" - m) / ({FPL_SCALE} * ("M0" - "K"))',
    "gompertz": 'r * m * ln("K" / m)',
}


def _model_params(spark, folder, model):
    params = growth_params(spark, folder)
    return params.withColumn("r", 1 / F.col("r")) if model == "fpl" else params


def _register_curves(model: str) -> None:
    @query(f"rates_{model}", _curve_sql(MASS[model], AGR[model], RGRM[model]))
    def run(spark, folder):
        grid = C.rate_grid(_model_params(spark, folder, model), 1.0, 30.0, 20)
        return _round_all(add_curves(grid, model), ["t", *CURVES]).select("g", "t", *CURVES)

    if model in RGRM_LOG:

        @query(f"rates_{model}_log", _log_curve_sql(MASS[model], AGR[model], RGRM_LOG[model]))
        def run_log(spark, folder):
            grid = C.rate_grid(_model_params(spark, folder, model), 1.0, 30.0, 20)
            curves = add_curves(grid, model, log_scale=True)
            return _round_all(curves, ["t", "M", "RGRt", "RGRm"]).select(
                "g", "t", "M", rounded("AGR", 4).alias("AGR"), "RGRt", "RGRm"
            )


for _model in MASS:
    _register_curves(_model)


# Times long before the first observation, where a line is below zero.
EARLY_SQL = "times as (select -100 + i * 130 / 19.0::double as t, cast(i as integer) as step from range(20) r(i))"


@query(
    "rates_positive_mass",
    _curve_sql(MASS["linear"], AGR["linear"], RGRM["linear"], "where m > 0").replace(TIMES_SQL, EARLY_SQL),
)
def rates_positive_mass(spark, folder):
    grid = C.rate_grid(_model_params(spark, folder, "linear"), -100.0, 30.0, 20)
    curves = C.positive_mass(add_curves(grid, "linear"))
    return _round_all(curves, ["t", *CURVES]).select("g", "t", *CURVES)


@query(
    "transform_parameters",
    f"""
with {PARAMS_SQL}
select g, round("K", 6) as "K", round(1 / (2 + "M0"), 6) as r, round("K" / (1 + exp(xmid / (2 + "M0"))), 6) as "M0" from params""",
)
def transform_parameters(spark, folder):
    """Fitting form to biological form of the logistic."""
    raw = growth_params(spark, folder).select("g", F.col("K").alias("Asym"), "xmid", (F.col("M0") + 2).alias("scal"))
    return _round_all(add_natural(raw, "logistic"), ["K", "r", "M0"]).select("g", "K", "r", "M0")


@query(
    "fitted_residuals",
    f"""
with {PARAMS_SQL}, f as (
  select growth.g, x, y, "K" / (1 + exp((xmid - x) / (2 + "M0"))) as fitted from growth join params on params.g = growth.g)
select g, x, round(fitted, 6) as fitted, round(y - fitted, 6) as resid from f""",
)
def fitted_residuals(spark, folder):
    series = daily_growth(spark, folder)
    raw = growth_params(spark, folder).select("g", F.col("K").alias("Asym"), "xmid", (F.col("M0") + 2).alias("scal"))
    return _round_all(add_residuals(attach(series, raw, ["g"]), "logistic"), ["fitted", "resid"]).select(
        "g", "x", "fitted", "resid"
    )


@query(
    "rate_table",
    f"""
with {PARAMS_SQL}, e as (select min(x) as lo, max(x) as hi from growth),
c as (select g, r, "K", "M0", lo + i * (hi - lo) / 99.0::double as t from params, e, range(100) s(i)),
d as (select *, "K" * pow("M0" / "K", exp(-r * t)) as m from c)
select g, round(t, 6) as t, round(m, 6) as "M", round(r * "K" * exp(-r * t) * ln("K" / "M0") * pow("M0" / "K", exp(-r * t)), 6) as "AGR",
  round(r * ln("K" / m), 6) as "RGRm" from d""",
)
def rate_table(spark, folder):
    """Gompertz curves of all groups over the time span of the observations."""
    rates = C.rate_table(growth_params(spark, folder), "gompertz", daily_growth(spark, folder))
    return _round_all(rates, ["t", "M", "AGR", "RGRm"]).select("g", "t", "M", "AGR", "RGRm")


@query(
    "peak_growth",
    f"""
with {PARAMS_SQL}, {TIMES_SQL}, c as (select g, t, round({AGR['logistic']}, 6) as v from params, times)
select g, max(v) as peak, round(arg_min(t, {{'s': -v, 't': t}}), 6) as peak_time from c group by 1""",
)
def peak_growth(spark, folder):
    """Size and time of the largest absolute growth rate."""
    rates = add_curves(C.rate_grid(growth_params(spark, folder), 1.0, 30.0, 20), "logistic")
    found = peak(rates.withColumn("AGR", rounded("AGR")), ["g"])
    return found.withColumn("peak_time", rounded("peak_time"))


# Grid search ---------------------------------------------------------------------------

AXES = {"M0": (0.0, 1.0, 11), "r": (0.02, 0.5, 13), "beta": (0.0, 0.9, 10)}
GRID_SQL = f"""{GROWTH_SQL}, axis as (
  select cast(i as integer) as i, cast(j as integer) as j, cast(k as integer) as k, i * 0.1::double as "M0",
    0.02 + j * 0.04::double as r, k * 0.1::double as beta
  from range(11) a(i), range(13) b(j), range(10) c(k)),
sse as (select g, i, j, k, any_value("M0") as "M0", any_value(r) as r, any_value(beta) as beta, count(*)::double as n,
    sum(pow(y - pow(pow("M0", 1 - beta) + r * x * (1 - beta), 1 / (1 - beta)), 2)) as rss
  from growth, axis group by g, i, j, k),
ll as (select *, -n * (ln(2 * pi()) + 1 - ln(n) + ln(rss)) / 2 as ll from sse)"""


@query(
    "grid_values",
    f'with {GRID_SQL} select g, i, j, k, round("M0", 6) as "M0", round(r, 6) as r, round(beta, 6) as beta, round(ll, 6) as "LL" from ll',
)
def grid_values(spark, folder):
    """Log-likelihood of the power law at every grid point and group."""
    return _round_all(S.grid_values(daily_growth(spark, folder), ["g"], AXES), ["M0", "r", "beta", "LL"])


@query(
    "grid_search_power",
    f"""
with {GRID_SQL}, b as (
  select g, arg_min({{'M0': "M0", 'r': r, 'beta': beta, 'LL': ll}}, {{'s': -ll, 'i': i, 'j': j, 'k': k}}) as b from ll group by 1)
select g, round(b.M0, 6) as "M0", round(b.r, 6) as r, round(b.beta, 6) as beta, round(b.LL, 6) as "LL" from b""",
)
def grid_search_power(spark, folder):
    best = S.grid_search(daily_growth(spark, folder), ["g"], AXES)
    return _round_all(best, ["M0", "r", "beta", "LL"]).select("g", "M0", "r", "beta", "LL")


FINE = {"M0": (0.0, 0.5, 26), "r": (0.02, 0.5, 25), "beta": (0.2, 0.8, 25)}


@query(
    "grid_two_grids",
    f"""
with {GRID_SQL}, fine as (
  select cast(i as integer) as i, cast(j as integer) as j, cast(k as integer) as k, i * 0.02::double as "M0",
    0.02 + j * 0.02::double as r, 0.2 + k * 0.025::double as beta
  from range(26) a(i), range(25) b(j), range(25) c(k)),
fsse as (select g, i, j, k, any_value("M0") as "M0", any_value(r) as r, any_value(beta) as beta, count(*)::double as n,
    sum(pow(y - pow(pow("M0", 1 - beta) + r * x * (1 - beta), 1 / (1 - beta)), 2)) as rss
  from growth, fine group by g, i, j, k),
joined as (select 0 as step, * from ll where "M0" <> 0
  union all select 1, *, -n * (ln(2 * pi()) + 1 - ln(n) + ln(rss)) / 2 from fsse),
b as (
  select g, arg_min({{'step': step, 'M0': "M0", 'r': r, 'beta': beta, 'LL': ll}}, {{'s': -ll, 't': step, 'i': i, 'j': j, 'k': k}}) as b
  from joined group by 1)
select g, b.step as step, round(b.M0, 6) as "M0", round(b.r, 6) as r, round(b.beta, 6) as beta, round(b.LL, 6) as "LL" from b""",
)
def grid_two_grids(spark, folder):
    """The best point of a coarse grid without zero masses and a fine one."""
    best = S.two_step_search(daily_growth(spark, folder), ["g"], AXES, FINE)
    return _round_all(best, ["M0", "r", "beta", "LL"]).select("g", "step", "M0", "r", "beta", "LL")


@query("grid_search_two_step")
def grid_search_two_step(spark, folder):
    """Coarse and fine grids pooled, with the difference of the best point to the fixed-mass fit."""
    series = daily_growth(spark, folder)
    best = S.two_step_search(series, ["g"], AXES, FINE)
    fixed = G.fit(series, ["g"], "power2", fixed={"M0": 0.3}).select(
        "g", F.col("r").alias("fixed_r"), F.col("beta").alias("fixed_beta"), "converged"
    )
    return join_same(best, fixed, ["g"]).withColumns(
        {"diff_r": rel_diff("r", "fixed_r"), "diff_beta": rel_diff("beta", "fixed_beta")}
    )


@query(
    "param_grid",
    """
select g, round(i * 0.25::double, 6) as "M0", round(0.1 + j * 0.1::double, 6) as r
from (select distinct event_type as g from events), range(5) a(i), range(4) b(j)""",
)
def param_grid(spark, folder):
    groups = table(spark, folder, "events").select(F.col("event_type").alias("g")).distinct()
    grid = S.param_grid(groups, {"M0": (0.0, 1.0, 5), "r": (0.1, 0.4, 4)})
    return _round_all(grid, ["M0", "r"])


# Contrasts and intervals ---------------------------------------------------------------

CONTRAST_SQL = f"""{PARAMS_SQL}, {TIMES_SQL},
c as (select g, t, step, "K", r, "M0", {MASS['logistic']} as m, {AGR['logistic']} as v from params, times),
e as (select g, min(m) as lo, max(m) as hi from c group by 1),
p as (select a.g as a, b.g as b, a.step, a.t, greatest(ea.lo, eb.lo) as mlo, least(ea.hi, eb.hi) as mhi,
    a.m - b.m as dm, a.v - b.v as dv, a.v / a.m - b.v / b.m as dr, a."K" as ak, a.r as ar, b."K" as bk, b.r as br
  from c a join c b on a.step = b.step and a.g < b.g join e ea on ea.g = a.g join e eb on eb.g = b.g),
q as (select *, mlo + step * (mhi - mlo) / 19.0::double as mass from p)"""


@query(
    "group_contrasts",
    f"""
with {CONTRAST_SQL}
select a, b, step, round(t, 6) as t, round(mass, 6) as mass, round(dm, 6) as "diffM", round(dv, 6) as "diffAGR",
  round(dr, 6) as "diffRGRt", round(ar * (1 - mass / ak) - br * (1 - mass / bk), 6) as "diffRGRm" from q""",
)
def group_contrasts(spark, folder):
    """All pairs of event types, compared at equal time and at equal mass."""
    found = C.contrasts(growth_params(spark, folder), "g", "logistic", 1.0, 30.0, 20)
    return _round_all(found, ["t", "mass", *C.DIFFERENCES])


def _normal_sql(*parts: str) -> str:
    def uniform(tail: str) -> str:
        text = ", ".join([*parts, f"'{tail}'"])
        return f"((('0x' || substr(md5(concat_ws('|', {text})), 1, 12))::bigint + 0.5::double) / 281474976710656.0::double)"

    return f"sqrt(-2 * ln({uniform('u')})) * cos(2 * pi() * {uniform('v')})"


FIT_SQL = f"""{PARAMS_SQL}, fit as (
  select g, "K" as a, xmid as m, 2 + "M0" as s, 0.01 * "K" as c00, 0.002 * "K" as c01, 0.001 * "K" as c02,
    0.25 as c11, 0.02 as c12, 0.04 as c22 from params),
chol1 as (select *, sqrt(c00) as l00, c01 / sqrt(c00) as l10, c02 / sqrt(c00) as l20 from fit),
chol2 as (select *, sqrt(c11 - l10 * l10) as l11 from chol1),
chol3 as (select *, (c12 - l20 * l10) / l11 as l21 from chol2),
chol as (select *, sqrt(c22 - l20 * l20 - l21 * l21) as l22 from chol3)"""


def fitted_params(spark, folder):
    """Logistic parameters with a covariance, as a fit returns them."""
    k, zero = F.col("K"), F.lit(0.0)
    c = lambda value: F.lit(value) + zero
    return growth_params(spark, folder).select(
        "g", k.alias("Asym"), "xmid", (F.col("M0") + 2).alias("scal"),
        F.array(0.01 * k, 0.002 * k, 0.001 * k, 0.002 * k, c(0.25), c(0.02), 0.001 * k, c(0.02), c(0.04)).alias("cov"),
        k.alias("K"), F.try_divide(F.lit(1.0), F.col("M0") + 2).alias("r"),
        F.try_divide(k, 1 + F.exp(F.try_divide(F.col("xmid"), F.col("M0") + 2))).alias("M0"),
    )


def _draw_sql(source: str, prefix: str, *key: str) -> str:
    z = [_normal_sql("'1'", *key, "cast(draw as varchar)", f"'{i}'") for i in range(3)]
    return f"""select *, {prefix}a + {prefix}l00 * z0 as k, {prefix}m + {prefix}l10 * z0 + {prefix}l11 * z1 as x,
    {prefix}s + {prefix}l20 * z0 + {prefix}l21 * z1 + {prefix}l22 * z2 as s2 from (
  select *, {z[0]} as z0, {z[1]} as z1, {z[2]} as z2 from {source})"""


@query(
    "param_interval",
    f"""
with {FIT_SQL}, draws as (select chol.*, d.draw from chol, (select unnest(range(1, 201)) as draw) d),
drawn as ({_draw_sql('draws', '', 'g')}),
nat as (select g, draw, k as "K", 1 / s2 as r, k / (1 + exp(x / s2)) as "M0" from drawn),
c as (select g, t, {MASS['logistic']} as m, {AGR['logistic']} as v, "K", r from nat, (select 1 + i * 29 / 9.0::double as t from range(10) r(i)))
select g, round(t, 6) as t, round(quantile_cont(m, 0.025), 5) as "M_lo", round(quantile_cont(m, 0.975), 5) as "M_hi",
  round(quantile_cont(v, 0.025), 5) as "AGR_lo", round(quantile_cont(v, 0.975), 5) as "AGR_hi",
  round(quantile_cont(v / m, 0.025), 5) as "RGRt_lo", round(quantile_cont(v / m, 0.975), 5) as "RGRt_hi",
  round(quantile_cont(r * (1 - m / "K"), 0.025), 5) as "RGRm_lo", round(quantile_cont(r * (1 - m / "K"), 0.975), 5) as "RGRm_hi"
from c group by g, t""",
)
def param_interval(spark, folder):
    """Intervals of the curves from 200 hashed normal draws per group."""
    found = C.simulate(fitted_params(spark, folder), ["g"], "logistic", 1.0, 30.0, 10, 200)
    return _round_all(found.withColumn("t", rounded("t")), [f"{m}_{e}" for m in CURVES for e in ("lo", "hi")], 5)


@query(
    "draw_interval",
    f"""
with {FIT_SQL}, draws as (select chol.*, d.draw from chol, (select unnest(range(1, 501)) as draw) d),
drawn as ({_draw_sql('draws', '', 'g')}),
nat as (select g, k as "K", 1 / s2 as r, k / (1 + exp(x / s2)) as "M0" from drawn)
select g, """
    + ", ".join(
        f'round(quantile_cont("{n}", {q}), 5) as "{n}_{e}"' for n in ("K", "r", "M0") for q, e in ((0.025, "lo"), (0.975, "hi"))
    )
    + " from nat group by g",
)
def draw_interval(spark, folder):
    """Two-sided quantiles of 500 parameter draws per group."""
    drawn = C.parameter_draws(fitted_params(spark, folder), ["g"], "logistic", 500, "1")
    found = interval(drawn, ["g"], ["K", "r", "M0"])
    return _round_all(found, [c for c in found.columns if c != "g"], 5)


SIDE_COLUMNS = ["a", "m", "s", "l00", "l10", "l20", "l11", "l21", "l22"]


def _pair_draws_sql() -> str:
    pairs = ", ".join(f"{side}.{c} as {side}_{c}" for side in "pq" for c in SIDE_COLUMNS)
    one = _draw_sql("pairs", "p_", "a", "b", "'a'")
    two = _draw_sql("pairs", "q_", "a", "b", "'b'")
    nat = 'k as "K", 1 / s2 as r, k / (1 + exp(x / s2)) as "M0"'
    grid = "(select cast(i as integer) as step, 1 + i * 29 / 9.0::double as t from range(10) r(i))"
    base = 'select g, a as "K", 1 / s as r, a / (1 + exp(m / s)) as "M0" from fit'
    return f"""
with {FIT_SQL}, grid as {grid},
pairs as (select p.g as a, q.g as b, {pairs}, d.draw from chol p join chol q on p.g < q.g, (select unnest(range(1, 101)) as draw) d),
base as (select n.g, {MASS['logistic']} as m from ({base}) n, grid),
ends as (select g, min(m) as lo, max(m) as hi from base group by 1),
one as (select a, b, draw, {nat} from ({one})), two as (select a, b, draw, {nat} from ({two})),
c1 as (select a, b, draw, step, "K", r, {MASS['logistic']} as m, {AGR['logistic']} as v from one, grid),
c2 as (select a, b, draw, step, "K", r, {MASS['logistic']} as m, {AGR['logistic']} as v from two, grid),
d as (select c1.a, c1.b, c1.step, c1.m - c2.m as dm, c1.v - c2.v as dv, c1.v / c1.m - c2.v / c2.m as dr,
    c1.r as r1, c1."K" as k1, c2.r as r2, c2."K" as k2,
    greatest(ea.lo, eb.lo) + c1.step * (least(ea.hi, eb.hi) - greatest(ea.lo, eb.lo)) / 9.0::double as mass
  from c1 join c2 using (a, b, draw, step) join ends ea on ea.g = c1.a join ends eb on eb.g = c1.b),
f as (select a, b, step, dm, dv, dr, r1 * (1 - mass / k1) - r2 * (1 - mass / k2) as dq from d)
select a, b, step, round(quantile_cont(dm, 0.025), 5) as "diffM_lo", round(quantile_cont(dm, 0.975), 5) as "diffM_hi",
  round(quantile_cont(dv, 0.025), 5) as "diffAGR_lo", round(quantile_cont(dv, 0.975), 5) as "diffAGR_hi",
  round(quantile_cont(dr, 0.025), 5) as "diffRGRt_lo", round(quantile_cont(dr, 0.975), 5) as "diffRGRt_hi",
  round(quantile_cont(dq, 0.025), 5) as "diffRGRm_lo", round(quantile_cont(dq, 0.975), 5) as "diffRGRm_hi"
from f group by a, b, step"""


@query("contrast_interval", _pair_draws_sql())
def contrast_interval(spark, folder):
    """Intervals of the contrasts from 100 independent draws of both groups."""
    found = C.contrast_intervals(fitted_params(spark, folder), "g", "logistic", 1.0, 30.0, 10, 100)
    return _round_all(found, [f"{m}_{e}" for m in C.DIFFERENCES for e in ("lo", "hi")], 5)


# Iterative fits: checked by value in the tests -------------------------------------------


def user_growth(spark, folder):
    """(g, x, y): running total of event values per user and day."""
    from pyspark.sql import Window

    day = F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")) + 1
    daily = table(spark, folder, "events").groupBy(F.col("user_id").alias("g"), day.cast("double").alias("x")).agg(
        F.sum("value").alias("v")
    )
    so_far = Window.partitionBy("g").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    return daily.select("g", "x", F.sum("v").over(so_far).alias("y"))


def _register_fit(model: str) -> None:
    @query(f"fit_{model}")
    def run(spark, folder):
        return G.fit(user_growth(spark, folder), ["g"], model)


for _model in ("exponential", "monomolecular", "logistic", "fpl", "gompertz"):
    _register_fit(_model)


@query("fit_power_fixed_mass")
def fit_power_fixed_mass(spark, folder):
    return G.fit(user_growth(spark, folder), ["g"], "power2", fixed={"M0": 1.0})


@query("fit_gompertz_variance")
def fit_gompertz_variance(spark, folder):
    """Variance grows with the fitted value; the measure is rescaled before the log."""
    logged = rescale(user_growth(spark, folder), "y", 1000.0).withColumn("y", F.ln("y"))
    return G.fit(logged, ["g"], "gompertz", variance="exp")


def _register_daily_fit(model: str) -> None:
    @query(f"fit_daily_{model}", fit_sql(model))
    def run(spark, folder):
        fits = G.fit(daily_growth(spark, folder), ["g"], model)
        raw = list(FIT_CURVES[model][0])
        chosen = fits.select("g", *raw, "converged", "n", "rss", "ll", "aic")
        return _round_all(_round_all(chosen, raw, 4), ["rss", "ll", "aic"])


for _model in FIT_CURVES:
    _register_daily_fit(_model)


@query("compare_daily_models", compare_sql(["logistic", "gompertz", "exponential"]))
def compare_daily_models(spark, folder):
    series = daily_growth(spark, folder)
    models = ("logistic", "gompertz", "exponential")
    return _round_all(G.compare_models({m: G.fit(series, ["g"], m) for m in models}, ["g"]), ["mean_ll", "min_ll", "max_ll"])


@query(
    "daily_residual_stats",
    f"""
with recursive {GROWTH_SQL}, {least_squares_sql('logistic')},
curve as (select g, {FIT_CURVES['logistic'][2]} as f, y - {FIT_CURVES['logistic'][2]} as e from fitted join growth using (g)),
s as (select g, count(*)::double as n, var_pop(f) * count(*) as mss, sum(e * e) as rss from curve group by g),
l as (select *, -n * (ln(2 * pi()) + 1 - ln(n) + ln(rss)) / 2 as ll from s)
select g, n, round(mss, 4) as mss, round(rss, 6) as rss, round(mss / (mss + rss), 6) as r2, round(sqrt(rss), 6) as root_rss,
  round(sqrt(rss / n), 6) as rmse, round(ll, 5) as ll, round(-2 * ll + 2 * 4, 5) as aic from l""",
)
def daily_residual_stats(spark, folder):
    """Residual statistics of the fitted curves, from the residuals themselves."""
    series = daily_growth(spark, folder)
    fits = G.fit(series, ["g"], "logistic").select("g", "Asym", "xmid", "scal")
    stats = fit_stats(add_residuals(attach(series, fits, ["g"]), "logistic"), ["g"], 3)
    places = {"mss": 4, "rss": 6, "r2": 6, "root_rss": 6, "rmse": 6, "ll": 5, "aic": 5}
    return stats.select("g", "n", *[rounded(name, digits).alias(name) for name, digits in places.items()])


INTERVAL_SQL = f"""{logistic_params_sql()}, {covariance_sql('logistic')},
fit as (select g, "Asym" as a, "xmid" as m, "scal" as s, c00, c01, c02, c11, c12, c22 from fitted join fitted_cov using (g)),
chol1 as{FIT_SQL.split('chol1 as', 1)[1]}"""


@query(
    "fit_then_rates",
    f"""
with recursive {INTERVAL_SQL}, {TIMES_SQL}, draws as (select chol.*, d.draw from chol, (select unnest(range(1, 201)) as draw) d),
drawn as ({_draw_sql('draws', '', 'g')}),
nat as (select g, draw, k as "K", 1 / s2 as r, k / (1 + exp(x / s2)) as "M0" from drawn),
c as (select g, step, {MASS['logistic']} as m, {AGR['logistic']} as v, "K", r from nat, times),
q as (select g, step, """
    + ", ".join(
        f'quantile_cont({value}, {q}) as "{name}_{end}"'
        for name, value in (("M", "m"), ("AGR", "v"), ("RGRt", "v / m"), ("RGRm", 'r * (1 - m / "K")'))
        for q, end in ((0.025, "lo"), (0.975, "hi"))
    )
    + f""" from c group by all),
p as (select g, step, t, {MASS['logistic']} as "M", {AGR['logistic']} as "AGR", r, "K" from params, times)
select g, round(t, 6) as t, round("M", 4) as "M", round("AGR", 4) as "AGR", round("AGR" / "M", 4) as "RGRt",
  round(r * (1 - "M" / "K"), 4) as "RGRm", """
    + ", ".join(f'round("{name}_{end}", 4) as "{name}_{end}"' for name in CURVES for end in ("lo", "hi"))
    + " from p join q using (g, step)",
)
def fit_then_rates(spark, folder):
    """Fit, transform, curves with intervals, joined on group and step."""
    fits = G.fit(daily_growth(spark, folder), ["g"], "logistic").where("converged")
    found = C.rates_with_intervals(fits, ["g"], "logistic", 1.0, 30.0, 20, 200).withColumn("t", rounded("t"))
    return _round_all(found, [*CURVES, *[f"{name}_{end}" for name in CURVES for end in ("lo", "hi")]], 4)


@query(
    "fit_by_group_contrasts",
    f"""
with recursive {CONTRAST_SQL.replace(PARAMS_SQL, logistic_params_sql())}
select a, b, step, round(t, 6) as t, round(mass, 4) as mass, round(dm, 4) as "diffM", round(dv, 4) as "diffAGR",
  round(dr, 4) as "diffRGRt", round(ar * (1 - mass / ak) - br * (1 - mass / bk), 4) as "diffRGRm" from q""",
)
def fit_by_group_contrasts(spark, folder):
    fits = G.fit(daily_growth(spark, folder), ["g"], "logistic").where("converged")
    found = C.contrasts(fits, "g", "logistic", 1.0, 30.0, 20).withColumn("t", rounded("t"))
    return _round_all(found, ["mass", *C.DIFFERENCES], 4)


@query("fit_residual_stats")
def fit_residual_stats(spark, folder):
    series = user_growth(spark, folder)
    fits = G.fit(series, ["g"], "logistic").where("converged").select("g", "Asym", "xmid", "scal")
    return fit_stats(add_residuals(attach(series, fits, ["g"]), "logistic"), ["g"], 3)


@query("compare_models")
def compare_models(spark, folder):
    series = user_growth(spark, folder)
    return G.compare_models({m: G.fit(series, ["g"], m) for m in ("logistic", "fpl", "gompertz")}, ["g"])


@query("likelihood_histogram")
def likelihood_histogram(spark, folder):
    fits = G.fit(user_growth(spark, folder), ["g"], "gompertz").where("converged")
    return histogram(fits, [], "ll", 10)


# Patterns ------------------------------------------------------------------------------

MONTHS = list(range(1, 13))


@query(
    "series_matrix",
    "select o_custkey, "
    + ", ".join(f'round(avg(case when month(o_orderdate) = {m} then o_totalprice end), 4) as "{m}"' for m in MONTHS)
    + " from orders group by 1",
)
def series_matrix(spark, folder):
    orders = table(spark, folder, "orders").withColumn("m", F.month("o_orderdate"))
    return _round_all(P.series_matrix(orders, "o_custkey", "m", MONTHS, "o_totalprice"), [str(m) for m in MONTHS], 4)


def _trajectories(spark, folder):
    orders = table(spark, folder, "orders").withColumn("m", F.month("o_orderdate"))
    matrix = P.series_matrix(orders, "o_custkey", "m", MONTHS, "o_totalprice")
    return matrix, P.trajectory_groups(matrix, "o_custkey", [str(m) for m in MONTHS], 4)


@query("trajectory_groups")
def trajectory_groups(spark, folder):
    return _trajectories(spark, folder)[1]


@query(
    "trajectory_summary",
    """
with m as (select o_custkey, month(o_orderdate) as month, avg(o_totalprice) as v from orders group by all)
select month, (select count(distinct o_custkey) from orders) as plants, 4::bigint as patterns, count(*) as measured,
  round(sum(v), 2) as total from m group by month""",
)
def trajectory_summary(spark, folder):
    """Every plant is in one of four patterns, whose sums per month are those of all plants."""
    matrix, groups = _trajectories(spark, folder)
    whole = groups.agg(F.count("*").alias("plants"), F.countDistinct("pattern").alias("patterns"))
    months = F.array(*[F.struct(F.lit(m).cast("long").alias("month"), F.col(f"`{m}`").alias("v")) for m in MONTHS])
    cells = matrix.join(groups.select("o_custkey", "pattern"), "o_custkey").select("pattern", F.explode(months).alias("c"))
    per_pattern = cells.groupBy("pattern", "c.month").agg(F.count("c.v").alias("n"), F.sum("c.v").alias("v"))
    per_month = per_pattern.groupBy("month").agg(F.sum("n").alias("measured"), F.round(F.sum("v"), 2).alias("total"))
    return per_month.join(F.broadcast(whole)).where("measured > 0").select("month", "plants", "patterns", "measured", "total")


@query(
    "local_smooth",
    """
with p as (select event_type as g, cast(date_diff('day', date '2024-01-01', cast(ts as date)) + 1 as double) as x,
    count(*)::double as n, avg(value) as y from events group by 1, 2),
e as (select g, min(x) as lo, max(x) as hi, sum(n) as total from p group by 1),
s as (select g, cast(i as integer) as step, floor(total * 0.75) as q, lo + i / 19.0::double * (hi - lo) as t from e, range(20) r(i)),
d as (select s.g, step, t, q, p.x, n, y, abs(p.x - t) as dist from s join p on p.g = s.g),
c as (select *, sum(n) over (partition by g, step order by dist, n rows unbounded preceding) as seen from d),
h as (select g, step, min(case when seen >= q then dist end) as h from c group by 1, 2),
w as (select d.g, d.step, t, x - t as z, y, case when dist < h then n * pow(1 - pow(dist / h, 3), 3) else 0 end as w
  from d join h on h.g = d.g and h.step = d.step),
m as (select g, step, t, sum(w) as s0, sum(w * z) as s1, sum(w * z * z) as s2, sum(w * pow(z, 3)) as s3, sum(w * pow(z, 4)) as s4,
  sum(w * y) as b0, sum(w * y * z) as b1, sum(w * y * z * z) as b2 from w group by 1, 2, 3)
select g, step, round(t, 6) as t, round((b0 * (s2 * s4 - s3 * s3) - s1 * (b1 * s4 - b2 * s3) + s2 * (b1 * s3 - b2 * s2))
  / (s0 * (s2 * s4 - s3 * s3) - s1 * (s1 * s4 - s2 * s3) + s2 * (s1 * s3 - s2 * s2)), 4) as smooth from m""",
)
def local_smooth(spark, folder):
    """Local quadratic of event values per type and day."""
    day = F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")) + 1
    events = table(spark, folder, "events").select(F.col("event_type").alias("g"), day.alias("day"), "value")
    smooth = local_smoother(events, ["g"], "day", "value", count=20)
    return smooth.withColumns({"t": rounded("t"), "smooth": rounded("smooth", 4)})
