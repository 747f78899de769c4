"""Least squares in SQL: what the iterative fits are held against.

A recursive query makes one damped Gauss-Newton step per group and round; the damping falls each
round, so the last rounds are plain Newton steps at the minimum.  Nothing of the library's solver
is used: derivatives are written out, and the normal equations are solved by determinants.
"""

from __future__ import annotations

from collections.abc import Sequence

from plotloom.queries.base import GROWTH_SQL

ROUNDS = 70

_GROW = 'exp(("xmid" - x) / "scal")'
_RATIO = f"pow(1 + {_GROW}, 2)"
_DOUBLE = 'exp(0 - "b2" * pow("b3", x))'
# Parameters, a start near the daily series (which end at ten), the curve, and its derivatives.
CURVES = {
    "logistic": (
        ("Asym", "xmid", "scal"),
        (11, 15, 6),
        f'"Asym" / (1 + {_GROW})',
        (f"1 / (1 + {_GROW})", f'0 - "Asym" * {_GROW} / ("scal" * {_RATIO})', f'"Asym" * {_GROW} * ("xmid" - x) / ("scal" * "scal" * {_RATIO})'),
    ),
    "gompertz": (
        ("Asym", "b2", "b3"),
        (13.5, 3, 0.925),
        f'"Asym" * {_DOUBLE}',
        (_DOUBLE, f'0 - "Asym" * pow("b3", x) * {_DOUBLE}', f'0 - "Asym" * "b2" * x * pow("b3", x - 1) * {_DOUBLE}'),
    ),
    "exponential": (("M0", "r"), (1.8, 0.06), '"M0" * exp("r" * x)', ('exp("r" * x)', '"M0" * x * exp("r" * x)')),
}


def _determinant(rows: Sequence[Sequence[str]]) -> str:
    if len(rows) == 1:
        return rows[0][0]
    parts = []
    for c, head in enumerate(rows[0]):
        minor = _determinant([[v for k, v in enumerate(row) if k != c] for row in rows[1:]])
        parts.append(f"{head if c % 2 == 0 else f'(0 - {head})'} * {minor}")
    return f"({' + '.join(parts)})"


def least_squares_sql(model: str, name: str = "fitted") -> str:
    """Tables ``<name>_rounds`` and ``<name>`` (g, raw parameters, n, rss) from the table growth (g, x, y).

    To be used in a query that begins ``with recursive``.
    """
    raw, start, curve, slopes = CURVES[model]
    p = range(len(raw))
    columns = ", ".join(f'"{c}"' for c in raw)
    first = ", ".join(f'{v}::double as "{c}"' for c, v in zip(raw, start))
    sums = [f"sum(d{i} * d{j}) as n{i}{j}" for i in p for j in p if i <= j] + [f"sum(d{i} * e) as slope{i}" for i in p]
    normal = [[f"n{min(i, j)}{max(i, j)}" + (" * (1 + damping)" if i == j else "") for j in p] for i in p]
    whole = _determinant(normal)
    steps = []
    for c, parameter in enumerate(raw):
        replaced = [[f"slope{i}" if j == c else normal[i][j] for j in p] for i in p]
        steps.append(f'"{parameter}" + {_determinant(replaced)} / {whole} as "{parameter}"')
    derivatives = ", ".join(f"{slope} as d{i}" for i, slope in enumerate(slopes))
    return f"""{name}_rounds as (
  select g, 0 as i, {first} from (select distinct g from growth)
  union all
  select g, i + 1, {', '.join(steps)} from (
    select g, i, {columns}, 0.1 * pow(0.6, i) as damping, {', '.join(sums)} from (
      select g, i, {columns}, y - ({curve}) as e, {derivatives}
      from {name}_rounds join growth using (g) where i < {ROUNDS})
    group by g, i, {columns})),
{name} as (
  select g, {columns}, count(*)::double as n, sum(pow(y - ({curve}), 2)) as rss
  from {name}_rounds join growth using (g) where i = {ROUNDS} group by g, {columns})"""


def covariance_sql(model: str, name: str = "fitted") -> str:
    """Table ``<name>_cov`` (g, c00, c01, ...): rss / (n - p) times the inverse normal matrix."""
    raw, _, _, slopes = CURVES[model]
    p = range(len(raw))
    derivatives = ", ".join(f"{slope} as d{i}" for i, slope in enumerate(slopes))
    sums = ", ".join(f"sum(d{i} * d{j}) as n{i}{j}" for i in p for j in p if i <= j)
    normal = [[f"n{min(i, j)}{max(i, j)}" for j in p] for i in p]
    whole = _determinant(normal)
    cofactors = []
    for i in p:
        for j in p:
            if i <= j:
                minor = _determinant([[normal[a][b] for b in p if b != j] for a in p if a != i])
                sign = "" if (i + j) % 2 == 0 else "0 - "
                cofactors.append(f"rss / (n - {len(raw)}) * ({sign}{minor}) / {whole} as c{i}{j}")
    return f"""{name}_cov as (
  select g, {', '.join(cofactors)} from (
    select g, n, rss, {sums} from (select g, n, rss, {derivatives} from {name} join growth using (g)) group by g, n, rss))"""


def likelihood_sql(n: str = "n", rss: str = "rss") -> str:
    return f"(-{n} * (ln(2 * pi()) + 1 - ln({n}) + ln({rss})) / 2)"


def fit_sql(model: str) -> str:
    """The fitted parameters of the daily series with their statistics."""
    raw = CURVES[model][0]
    rounded = ", ".join(f'round("{c}", 4) as "{c}"' for c in raw)
    return f"""with recursive {GROWTH_SQL}, {least_squares_sql(model)}
select g, {rounded}, true as converged, n, round(rss, 6) as rss, round({likelihood_sql()}, 6) as ll,
  round(-2 * {likelihood_sql()} + {2 * (len(raw) + 1)}, 6) as aic from fitted"""


def compare_sql(models: Sequence[str]) -> str:
    """Spread of the log-likelihood per model."""
    tables = ", ".join(least_squares_sql(model, f"fit_{model}") for model in models)
    parts = [
        f"""select '{model}' as model, count(*) as groups, count(*) as converged, round(avg({likelihood_sql()}), 6) as mean_ll,
  round(min({likelihood_sql()}), 6) as min_ll, round(max({likelihood_sql()}), 6) as max_ll from fit_{model}"""
        for model in models
    ]
    return f"with recursive {GROWTH_SQL}, {tables}\n" + "\nunion all ".join(parts)


def logistic_params_sql() -> str:
    """Tables up to params (g, "K", r, "M0", xmid): the biological parameters of the fitted logistic curves."""
    return f"""{GROWTH_SQL}, {least_squares_sql('logistic')}, params as (
  select g, "Asym" as "K", 1 / "scal" as r, "Asym" / (1 + exp("xmid" / "scal")) as "M0", "xmid" as xmid from fitted)"""
