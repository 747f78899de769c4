"""Analysis views over the loaded tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotloom.functions.domain import days_since, measure_date
from plotloom.functions.scalar import to_number, token
from plotloom.operators.keys import denormalise, lookup, one_to_many
from plotloom.operators.stats import vocabulary

Tables = Mapping[str, DataFrame]

# Passport columns nobody analyses.
PASSPORT_COLUMNS = [
    "breeders_code", "breeders_name", "subtaxa_id", "puid", "colldate", "collcode", "collname", "collmissid",
    "othernumb", "duplsite", "duplinstname",
]


def compound_view(tables: Tables) -> DataFrame:
    """Compound values with compound, entity and dataset; rows of either side are kept."""
    fact = tables["compounddata"].select("compound_id", "germinatebase_id", "dataset_id", "compound_value")
    joined = denormalise(
        fact,
        [
            ("compound_id", "_compound", tables["compounds"]),
            ("germinatebase_id", "_entity", tables["germinatebase"]),
            ("dataset_id", "_dataset", tables["datasets"]),
        ],
    )
    return joined.drop(*PASSPORT_COLUMNS)


def phenotype_view(tables: Tables) -> DataFrame:
    fact = tables["phenotypedata"].select("phenotype_id", "germinatebase_id", "dataset_id", "phenotype_value")
    joined = denormalise(
        fact,
        [
            ("phenotype_id", "_phenotype", tables["phenotypes"]),
            ("germinatebase_id", "_entity", tables["germinatebase"]),
            ("dataset_id", "_dataset", tables["datasets"]),
        ],
    )
    return joined.drop(*PASSPORT_COLUMNS)


def trait_series(tables: Tables, trait: str = "NDVI") -> DataFrame:
    """Dated values of one trait whose name is ``trait;day-month``.

    The filter needs a phenotype, so the planner turns the full joins that cannot add
    such rows into one-sided ones.
    """
    short = token("short_name", ";", 1)
    chosen = phenotype_view(tables).where(short == trait).select(
        "source_file", "general_identifier", "phenotype_id", "germinatebase_id", "experiment_id", "dataset_id",
        "short_name", F.col("phenotype_value").alias("value"), short.alias("trait"),
    )
    dated = measure_date(chosen).withColumn("value", to_number("value"))
    return lookup(dated, tables["datasets"], "dataset_id", "id", {"dataset": "description"}, ["id"])


def growth_input(series: DataFrame, sowing: DataFrame, excluded_date: str | None = None) -> DataFrame:
    """(Y, X = days since sowing, ID, dataset, logY) for the growth fits.

    A dataset without a sowing date has no days.  A row without a date is left out when a
    date is excluded, as comparison with it is unknown.
    """
    kept = series if excluded_date is None else series.where(F.col("date") != F.lit(excluded_date).cast("date"))
    keyed = kept.withColumn("dataset", token("dataset", " ", 1))
    sown = lookup(keyed, sowing, "dataset", "dataset", {"sowing": "date"}, ["date"])
    return days_since(sown, "date", F.to_date("sowing")).select(
        F.col("value").alias("Y"), F.col("days").cast("double").alias("X"),
        F.col("general_identifier").alias("ID"), "dataset", F.log10("value").alias("logY"),
    )


def parameter_table(fits: DataFrame, observations: DataFrame, key: str = "ID") -> DataFrame:
    """(id, K, r, M0, trial) of the groups that converged."""
    labelled = lookup(fits.where("converged"), observations, key, key, {"trial": "dataset"}, ["dataset"])
    return labelled.select(F.col(key).alias("id"), "K", "r", "M0", "trial")


def panel_members(tables: Tables) -> DataFrame:
    """Accession groups with their members; a group without members is kept."""
    panels = tables["groups"].where(F.col("grouptype_id") == 3)
    members = tables["groupmembers"].select("group_id", "foreign_id")
    joined = one_to_many(panels, members, "id", "group_id")
    return lookup(
        joined, tables["germinatebase"], "foreign_id", "id", {"general_id": "general_identifier"}, ["id"]
    )


def sample_vocabularies(sheet: DataFrame, position: str = "row") -> dict[str, DataFrame]:
    """Word lists of tissue, stage and sample type in order of first sighting."""
    return {name: vocabulary(sheet, name, position) for name in ("Tissue", "Stage", "Sample_Type")}
