"""The growth analysis from loaded tables to parameters and rates."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotloom.growth.curves import rate_table
from plotloom.growth.fit import compare_models, fit
from plotloom.operators.sizing import cut_lineage
from plotloom.operators.stats import histogram
from plotloom.plans.views import growth_input, parameter_table, trait_series

TRIAL_MODELS = ("logistic", "fpl", "gompertz")


def growth_analysis(
    tables: Mapping[str, DataFrame],
    sowing: DataFrame,
    trait: str = "NDVI",
    model: str = "gompertz",
    excluded_date: str | None = None,
    count: int = 100,
) -> dict[str, DataFrame]:
    """Frames ``input``, ``comparison``, ``parameters``, ``rates`` and ``likelihoods``.

    The dated series is materialised once; every model then reads that.
    """
    prepared = cut_lineage(growth_input(trait_series(tables, trait), sowing, excluded_date))
    fits = {name: cut_lineage(fit(prepared, ["ID"], name, "X", "Y")) for name in {*TRIAL_MODELS, model}}
    parameters = parameter_table(fits[model], prepared)
    return {
        "input": prepared,
        "comparison": compare_models({name: fits[name] for name in TRIAL_MODELS}, ["ID"]),
        "parameters": parameters,
        "rates": rate_table(parameters, model, prepared, "X", count),
        "likelihoods": histogram(fits[model].where(F.col("converged")), [], "ll", 10),
    }
