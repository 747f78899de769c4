"""Loads of the entity tree: accessions, plots, samples, grain packets, attributes.

All kinds share one table; parents are resolved after every row has an id.  Sheets carry
an order column ``row``; of several rows with one identifier the first is taken.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotloom.functions.domain import (
    ATTRIBUTE_IDS,
    ENTITY_TYPES,
    LOCATION_RULES,
    LOCATION_RULES_FIRST,
    accession_notes,
    location_rule,
    not_surplus,
    sample_class,
    sample_name,
)
from plotloom.literals import literal
from plotloom.operators.keys import (
    first_per_key,
    lookup,
    lookup_or_default,
    parent_key,
)
from plotloom.operators.numbering import assign_ids
from plotloom.operators.sizing import broadcast_if_small, cut_lineage
from plotloom.operators.reshape import attributes_to_long, columns_with_prefix, to_long, with_constants
from plotloom.plans.common import LoadResult, finish_load
from plotloom.sources.tables import update_column

Tables = Mapping[str, DataFrame]

ACCESSION_ATTRIBUTES = [
    "Cross", "Pedigree", "Source", "Cid", "Sid", "GID", "Other_ID",
    "Alternative_Name_1", "Alternative_Name_2", "Alternative_Name_3", "Alternative_ID", "Notes",
]
SAMPLE_ATTRIBUTES = ["Notes", "Sample_Type", "Stage", "Tissue"]

# Passport codes given to new accessions and samples.
BIOLOGICAL_STATUS, COLLECTION_SOURCE, TAXONOMY = 400, 40, 1


def _entities(rows: DataFrame, key: str, tables: Tables, as_of: str | None, constants: Mapping[str, object]) -> LoadResult:
    columns = [c for c in rows.columns if c not in (key, "row")]
    first = first_per_key(rows, [key], columns, ["row"])
    shaped = with_constants(
        first.withColumns({"general_identifier": F.col(key), "number": F.col(key)}).drop(key),
        {**constants, **({} if as_of is None else {"created_on": as_of})},
    )
    return finish_load("germinatebase", shaped, tables["germinatebase"], ["general_identifier"])


def load_accessions(sheet: DataFrame, tables: Tables, as_of: str) -> LoadResult:
    rows = sheet.select("Accession_ID", F.col("Accession_name").alias("name"), "row")
    return _entities(
        rows, "Accession_ID", tables, as_of,
        {"entitytype_id": ENTITY_TYPES["accession"], "biologicalstatus_id": BIOLOGICAL_STATUS, "taxonomy_id": TAXONOMY},
    )


def load_attributes(
    sheet: DataFrame, identifier: str, names: Sequence[str], tables: Tables, as_of: str
) -> LoadResult:
    """New (attribute, entity, value) triples; the entity is found once per sheet row."""
    linked = lookup(
        sheet, tables["germinatebase"], identifier, "general_identifier", {"foreign_id": "id"}, ["id"]
    )
    long = attributes_to_long(linked, ["foreign_id"], {name: ATTRIBUTE_IDS[name] for name in names})
    rows = long.select("attribute_id", "foreign_id", "value").distinct().withColumn("created_on", F.lit(as_of))
    return finish_load("attributedata", rows, tables["attributedata"], ["attribute_id", "foreign_id", "value"])


def accession_parents(sheet: DataFrame, entities: DataFrame) -> DataFrame:
    """Entities with the parent named by their accession row."""
    named = sheet.where(F.col("Parent_ID").isNotNull()).select("Accession_ID", "Parent_ID", "row")
    return _set_parents(named, "Accession_ID", "Parent_ID", entities)


def _set_parents(rows: DataFrame, key: str, parent: str, entities: DataFrame) -> DataFrame:
    # the last row of a sheet that names an entity decides, as repeated updates would
    last = first_per_key(rows, [key], [parent], ["row"], latest=True)
    resolved = lookup(last, entities, parent, "general_identifier", {"entityparent_id": "id"}, ["id"])
    updates = resolved.select(F.col(key).alias("general_identifier"), "entityparent_id")
    return update_column(entities, updates, "general_identifier", "entityparent_id")


def accession_attributes(sheet: DataFrame, tables: Tables, as_of: str) -> LoadResult:
    return load_attributes(sheet, "Accession_ID", ACCESSION_ATTRIBUTES, tables, as_of)


def load_experiments(sheet: DataFrame, tables: Tables, as_of: str) -> LoadResult:
    named = sheet.where(F.col("Experiment_Name").isNotNull())
    first = first_per_key(named, ["Experiment_ID"], ["Experiment_Name"], ["row"])
    rows = first.select(
        F.col("Experiment_ID").alias("experiment_name"), F.col("Experiment_Name").alias("description"),
        F.lit(3).alias("experiment_type_id"), F.lit(as_of).alias("created_on"),
    )
    return finish_load("experiments", rows, tables["experiments"], ["experiment_name"])


def load_plots(sheet: DataFrame, tables: Tables) -> LoadResult:
    """Plots with their accession as parent and the location their site text stands for."""
    named = sheet.where(F.col("Accession_ID").isNotNull())
    linked = lookup(
        named, tables["germinatebase"], "Accession_ID", "general_identifier", {"entityparent_id": "id"}, ["id"]
    )
    rows = linked.select(
        "PlantPlot_ID", F.coalesce("PlantPlot_Name", F.lit("")).alias("name"), "entityparent_id",
        location_rule("Experiment_Location", LOCATION_RULES).alias("location_id"), "row",
    )
    return _entities(rows, "PlantPlot_ID", tables, None, {"entitytype_id": ENTITY_TYPES["plot"]})


def load_samples(sheet: DataFrame, tables: Tables, as_of: str) -> LoadResult:
    rows = sample_name(sheet.where(not_surplus())).select("Sample_ID", "name", "row")
    return _entities(
        rows, "Sample_ID", tables, as_of,
        {
            "entitytype_id": ENTITY_TYPES["sample"], "biologicalstatus_id": BIOLOGICAL_STATUS,
            "collsrc_id": COLLECTION_SOURCE, "taxonomy_id": TAXONOMY,
        },
    )


def sample_attributes(sheet: DataFrame, tables: Tables, as_of: str) -> LoadResult:
    """Class, notes, tissue and stage of every sample that is not surplus."""
    classed = sheet.where(not_surplus()).withColumn("Sample_Type", sample_class("Sample_Type", "Purpose"))
    return load_attributes(classed, "Sample_ID", SAMPLE_ATTRIBUTES, tables, as_of)


def sample_parents(sheet: DataFrame, entities: DataFrame) -> DataFrame:
    """A parent sample goes before the plot."""
    named = parent_key(sheet.where(not_surplus()), ["Parent_ID", "PlantPlot_ID"])
    return _set_parents(named, "Sample_ID", "parent_key", entities)


def load_grain(sheet: DataFrame, tables: Tables) -> LoadResult:
    """Packets under their plot, else their accession; without either they are left out."""
    named = parent_key(sheet, ["PlantPlot_ID", "Accession_ID"], required=True)
    linked = lookup(
        named, tables["germinatebase"], "parent_key", "general_identifier", {"entityparent_id": "id"}, ["id"]
    )
    rows = linked.select("GrainPacket_ID", F.col("Accession_Name").alias("name"), "entityparent_id", "row")
    return _entities(rows, "GrainPacket_ID", tables, None, {"entitytype_id": ENTITY_TYPES["grain packet"]})


# Compounds named in workbooks ----------------------------------------------------

# Kind -> (description, class).
COMPOUND_KINDS = {
    "peptide": ("LCMS polypeptide", "polypeptide"),
    "functional bin": (
        "LCMS proteomic functional bin (based off one or more polypeptides)",
        "proteomic functional bin",
    ),
    "metabolite": ("GCMS metabolites", "metabolite"),
}


def load_compound_names(names: DataFrame, kind: str, tables: Tables, as_of: str) -> LoadResult:
    """Compounds of one kind from a frame with a ``name`` column."""
    description, compound_class = COMPOUND_KINDS[kind]
    rows = with_constants(
        names.select("name").distinct(),
        {"description": description, "compound_class": compound_class, "created_on": as_of},
    )
    return finish_load("compounds", rows, tables["compounds"], ["name"])


def load_bin_values(
    sheet: DataFrame, tables: Tables, as_of: str, prefix: str = "IW_S", dataset: int = 1, keep_missing: bool = False
) -> LoadResult:
    """Values of a matrix with one compound per row and one sample per column.

    Compounds are found once per row and samples once per column, before the cells.
    """
    samples = columns_with_prefix(sheet, prefix)
    compound = next(c for c in sheet.columns if c not in samples)
    named = lookup(
        sheet.select(compound, *samples), tables["compounds"], compound, "name", {"compound_id": "id"}, ["id"]
    )
    long = to_long(named, ["compound_id"], samples, "sample_id", "value")
    number = F.col("value").try_cast("double")
    valued = long.withColumn("compound_value", F.when(~F.isnan(number), number))
    if not keep_missing:
        valued = valued.where(F.col("compound_value").isNotNull())
    columns = literal(sheet.sparkSession, [(name,) for name in samples], "sample_id string")
    known = lookup(
        columns, tables["germinatebase"], "sample_id", "general_identifier", {"germinatebase_id": "id"}, ["id"]
    )
    rows = valued.join(broadcast_if_small(known), "sample_id").select(
        "compound_id", "germinatebase_id", F.lit(dataset).alias("dataset_id"), "compound_value",
        F.lit(as_of).alias("created_on"),
    )
    return finish_load("compounddata", rows, tables["compounddata"], ["compound_id", "germinatebase_id", "dataset_id"])


# The older table layout ------------------------------------------------------------


def old_accessions(sheet: DataFrame, tables: Tables, as_of: str) -> DataFrame:
    """Accessions with one notes text; every sheet row becomes a row."""
    rows = accession_notes(sheet).select(
        F.col("Accession_ID").alias("general_identifier"), F.col("Accession_ID").alias("number"),
        F.col("Accession_name").alias("name"), F.lit(BIOLOGICAL_STATUS).alias("biologicalstatus_id"),
        F.lit(TAXONOMY).alias("taxonomy_id"), F.lit(as_of).alias("created_on"), "notes",
    )
    return assign_ids(rows, tables["germinatebase"])


def old_experiments(sheet: DataFrame, tables: Tables, as_of: str) -> tuple[DataFrame, DataFrame]:
    """Experiments and one design row for each, which points at the first of that name."""
    named = sheet.where(F.col("Experiment_Name").isNotNull())
    rows = named.select(
        F.col("Experiment_ID").alias("experiment_number"), F.col("Experiment_Name").alias("experiment_name"),
        F.col("Experiment_Name").alias("description"), F.lit(3).alias("experiment_type_id"),
        F.lit(as_of).alias("created_on"),
    )
    added = assign_ids(rows, tables["experiments"])
    known = tables["experiments"].select("id", "experiment_name").unionByName(added.select("id", "experiment_name"))
    designs = lookup(
        rows, known, "experiment_name", "experiment_name", {"experiments_id": "id"}, ["id"]
    ).select(
        F.concat("experiment_name", F.lit("_Design")).alias("name"), "experiments_id", F.lit(as_of).alias("created_on")
    )
    return added, assign_ids(designs, tables["experimentdesign"])


def design_of_experiment(tables: Tables) -> DataFrame:
    """(experiment_number, design id) by an inner join of designs and experiments."""
    designs = tables["experimentdesign"].select(F.col("id").alias("design_id"), "experiments_id")
    experiments = tables["experiments"].select("id", "experiment_number")
    return designs.join(experiments, F.col("experiments_id") == F.col("id"), "inner").select(
        "experiment_number", "design_id"
    )


def old_plots(sheet: DataFrame, tables: Tables, as_of: str) -> DataFrame:
    named = sheet.where(F.col("Accession_ID").isNotNull())
    linked = lookup(
        named, tables["germinatebase"], "Accession_ID", "general_identifier", {"germinatebase_id": "id"}, ["id"]
    )
    linked = lookup(
        linked, design_of_experiment(tables), "Experiment_ID", "experiment_number",
        {"experimentdesign_id": "design_id"}, ["design_id"],
    )
    linked = lookup(linked, tables["trialseries"], "Panel", "seriesname", {"trialseries_id": "id"}, ["id"])
    rows = linked.select(
        F.col("PlantPlot_ID").alias("number"), F.coalesce("PlantPlot_Name", F.lit("")).alias("name"),
        "germinatebase_id", "experimentdesign_id", "trialseries_id",
        location_rule("Experiment_Location", LOCATION_RULES_FIRST).alias("locations_id"),
        F.lit(as_of).alias("created_on"),
    )
    return assign_ids(rows, tables["plantplot"])


def old_samples(sheet: DataFrame, tables: Tables) -> DataFrame:
    """Samples with plot, tissue and stage; a missing one is the row named Unknown."""
    linked = lookup_or_default(
        sheet, tables["plantplot"], "PlantPlot_ID", "Unknown", "number", {"plantplot_id": "id"}, ["id"]
    )
    linked = lookup_or_default(linked, tables["tissue"], "Tissue", "Unknown", "name", {"tissue_id": "id"}, ["id"])
    linked = lookup_or_default(
        linked, tables["samplestage"], "Stage", "Unknown", "name", {"samplestage_id": "id"}, ["id"]
    )
    rows = linked.select(
        F.col("Sample_ID").alias("name"), "plantplot_id",
        F.coalesce("Sample_Name", F.lit("")).alias("altname"), "tissue_id", "samplestage_id",
    )
    return assign_ids(rows, tables["plantsample"])


def old_sample_parents(sheet: DataFrame, samples: DataFrame) -> DataFrame:
    """Samples with the parent named by their sheet row, else the one named No Parent."""
    last = first_per_key(sheet, ["Sample_ID"], ["Parent_ID"], ["row"], latest=True)
    resolved = lookup_or_default(last, samples, "Parent_ID", "No Parent", "name", {"parentsample_id": "id"}, ["id"])
    updates = resolved.select(F.col("Sample_ID").alias("name"), "parentsample_id")
    return update_column(samples, updates, "name", "parentsample_id")


# All kinds, in the order their parents need ----------------------------------------


def load_tree(sheets: Mapping[str, DataFrame], tables: Tables, as_of: str, kinds: set[str]) -> dict[str, LoadResult]:
    """Run the chosen kinds; each sees the entities added before it.

    The rows of a kind are materialised once, as the later kinds read them again.
    """
    current = dict(tables)
    results: dict[str, LoadResult] = {}

    def add(kind: str, result: LoadResult) -> None:
        result = results[kind] = replace(result, new_rows=cut_lineage(result.new_rows))
        table = current[result.target]
        current[result.target] = table.unionByName(result.new_rows, allowMissingColumns=True).select(table.columns)

    if "accessions" in kinds:
        add("accessions", load_accessions(sheets["Accession"], current, as_of))
        add("accession_attributes", accession_attributes(sheets["Accession"], current, as_of))
    if "experiments" in kinds:
        add("experiments", load_experiments(sheets["Experiment"], current, as_of))
    if "plots" in kinds:
        add("plots", load_plots(sheets["Plant_Plot"], current))
    if "samples" in kinds:
        add("samples", load_samples(sheets["Sample"], current, as_of))
        add("sample_attributes", sample_attributes(sheets["Sample"], current, as_of))
    if "grain" in kinds:
        add("grain", load_grain(sheets["GrainPacket"], current))
    return results
