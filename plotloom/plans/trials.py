"""Loads fed by the trial, compound and genotype sheets.

Inputs are frames as read by ``sources.sheets``:

* ``files``      (file, year, site, trial, datatype)
* ``plots``      (file, place, ID, Panel): one row per sheet row
* ``cells``      (file, place, ID or compound..., name, value): one row per filled cell
* ``genotypes``  (file, AlleleID, chromosome and position columns)
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotloom.functions.domain import (
    COMPOUND_TYPES,
    clean_compound,
    compound_class,
    dataset_key,
    experiment_code,
    experiment_description,
    file_name_parts,
    genotype_group,
    institution,
    marker_interval,
    normalise_site,
    phenotype_datatype,
    phenotype_name,
    trait_header,
)
from plotloom.functions.scalar import glue
from plotloom.operators.keys import lookup, lookup_any_of, lookup_fallback, lookup_rekey, only_known
from plotloom.operators.numbering import number_rows
from plotloom.operators.reshape import with_constants
from plotloom.operators.sizing import broadcast_if_small
from plotloom.plans.common import LoadResult, finish_load

Tables = Mapping[str, DataFrame]

CHROMOSOME = "Chrom_Wheat_ChineseSpring04"
POSITION = "ChromPos_Wheat_ChineseSpring04"
OFFSET = "SnpPosition"

# Type ids given to new rows.
PANEL_GROUP, SITE_GROUP, MARKER_GROUP = 3, 4, 2
COMPOUND_EXPERIMENT = 6
FIRST_COMPOUND_EXPERIMENT = 22


# Markers ---------------------------------------------------------------------


def load_markers(genotypes: DataFrame, tables: Tables) -> LoadResult:
    rows = genotypes.select(F.col("AlleleID").alias("marker_name"), F.lit(1).alias("markertype_id"))
    return finish_load("markers", rows, tables["markers"], ["marker_name"])


def load_map_definitions(genotypes: DataFrame, tables: Tables) -> LoadResult:
    """Positions of markers; needs the markers loaded before."""
    placed = marker_interval(genotypes, CHROMOSOME, POSITION, OFFSET)
    named = lookup(placed, tables["markers"], "AlleleID", "marker_name", {"marker_id": "id"}, ["id"])
    rows = with_constants(named, {"mapfeaturetype_id": 1, "map_id": 1}).select(
        "mapfeaturetype_id", "marker_id", "map_id", "definition_start", "definition_end", "chromosome"
    )
    return finish_load("mapdefinitions", rows, tables["mapdefinitions"], ["marker_id"])


# Groups ----------------------------------------------------------------------


def _groups(names: DataFrame, description: str, grouptype: int, tables: Tables) -> LoadResult:
    rows = with_constants(
        names.distinct(), {"description": description, "visibility": 1, "grouptype_id": grouptype}
    ).select("name", "description", "visibility", "grouptype_id")
    return finish_load("groups", rows, tables["groups"], ["name"])


def _members(rows: DataFrame, tables: Tables, keys: Sequence[str]) -> LoadResult:
    """Members by their full key; ids of different tables share ``foreign_id``, so the
    narrow key ``("foreign_id",)`` mixes them up and is only there on request."""
    pairs = rows.select("foreign_id", "group_id").distinct()
    return finish_load("groupmembers", pairs, tables["groupmembers"], list(keys))


MEMBER_KEY = ("foreign_id", "group_id")


def load_panel_groups(plots: DataFrame, tables: Tables) -> LoadResult:
    return _groups(plots.select(F.col("Panel").alias("name")), "Accession panel", PANEL_GROUP, tables)


def _site_names(plots: DataFrame) -> DataFrame:
    """Distinct files first: the name rules then run once per file, not once per row."""
    return normalise_site(file_name_parts(plots.select("file").distinct()))


def load_site_groups(plots: DataFrame, tables: Tables) -> LoadResult:
    return _groups(
        _site_names(plots).select(F.col("site_name_short").alias("name")), "Trial location", SITE_GROUP, tables
    )


def load_panel_members(plots: DataFrame, tables: Tables, keys: Sequence[str] = MEMBER_KEY) -> LoadResult:
    pairs = plots.select("ID", "Panel").distinct()
    found = lookup_fallback(
        pairs, tables["germinatebase"], "ID", ["general_identifier", "name"], "id", "foreign_id", ["id"]
    )
    grouped = lookup(found, tables["groups"], "Panel", "name", {"group_id": "id"}, ["id"])
    return _members(grouped, tables, keys)


def load_site_members(plots: DataFrame, tables: Tables, keys: Sequence[str] = MEMBER_KEY) -> LoadResult:
    sites = _site_names(plots).select("site_name_short").distinct()
    placed = lookup(sites, tables["locations"], "site_name_short", "site_name_short", {"foreign_id": "id"}, ["id"])
    grouped = lookup(placed, tables["groups"], "site_name_short", "name", {"group_id": "id"}, ["id"])
    return _members(grouped, tables, keys)


def _genotype_names(genotypes: DataFrame) -> DataFrame:
    parts = file_name_parts(genotypes.select("file", "AlleleID"))
    return parts.select("AlleleID", genotype_group("trial").alias("name"))


def load_genotype_groups(genotypes: DataFrame, tables: Tables) -> LoadResult:
    return _groups(_genotype_names(genotypes).select("name"), "Genotyping dataset", MARKER_GROUP, tables)


def load_marker_members(genotypes: DataFrame, tables: Tables, keys: Sequence[str] = MEMBER_KEY) -> LoadResult:
    pairs = _genotype_names(genotypes).distinct()
    found = lookup(pairs, tables["markers"], "AlleleID", "marker_name", {"foreign_id": "id"}, ["id"])
    grouped = lookup(found, tables["groups"], "name", "name", {"group_id": "id"}, ["id"])
    return _members(grouped, tables, keys)


# Experiments and entities ------------------------------------------------------


def load_compound_experiments(cells: DataFrame, tables: Tables) -> LoadResult:
    """One experiment per name and data type of the compound sheets.

    ``cells`` holds empty cells too: a sheet row with a gap does not count.  Numbers
    follow the order in which the stacked files show the experiments, last file first.
    """
    rows = cells.groupBy("file", "place", "experiment_name").agg(F.every(F.col("value").isNotNull()).alias("whole"))
    kept = file_name_parts(rows.where(F.col("whole") & F.col("experiment_name").isNotNull()))
    seen = kept.groupBy("experiment_name", F.col("datatype").alias("type")).agg(F.max("place").alias("place"))
    described = experiment_description(seen, "experiment_name", "type")
    numbered = number_rows(
        described, [F.col("place").desc(), F.col("type")], "number", FIRST_COMPOUND_EXPERIMENT
    )
    coded = numbered.select(
        experiment_code("number").alias("experiment_name"),
        "description",
        F.lit(COMPOUND_EXPERIMENT).alias("experiment_type_id"),
    )
    return finish_load("experiments", coded, tables["experiments"], ["description"])


def refresh_entities(plots: DataFrame, tables: Tables) -> DataFrame:
    """Entities with location and institution of the trial they were grown in.

    The whole table with two columns recomputed; write it with ``sources.tables.replace``.
    Both depend on the file alone, so the last file that shows an identifier decides.
    """
    sited = normalise_site(file_name_parts(plots.select("ID", "file").distinct()))
    placed = lookup(
        sited, tables["locations"], "site_name_short", "site_name_short", {"location_id": "id"}, ["id"]
    ).withColumn("institution_id", institution("site_name_short"))
    return lookup_any_of(
        tables["germinatebase"].drop("location_id", "institution_id"),
        placed,
        ["general_identifier", "number", "name"],
        "ID",
        {"location_id": "location_id", "institution_id": "institution_id"},
        ["file"],
        latest=True,
    )


# Datasets ----------------------------------------------------------------------


def load_datasets(files: DataFrame, tables: Tables, contact: str) -> LoadResult:
    compound = F.col("datatype").isin(COMPOUND_TYPES)
    with_type = glue("description", "datatype", separator=" ")
    described = dataset_key(normalise_site(files)).withColumn(
        "description", F.when(compound, with_type).otherwise(F.col("description"))
    )
    linked = lookup(described, tables["experiments"], "description", "description", {"experiment_id": "id"}, ["id"])
    placed = lookup(linked, tables["locations"], "site_name_short", "site_name_short", {"location_id": "id"}, ["id"])
    rows = with_constants(
        placed.withColumn("description", F.when(compound, F.col("description")).otherwise(with_type)),
        {"version": 0.1, "created_by": 1, "dataset_state_id": 2, "contact": contact},
    ).select(
        "experiment_id", "location_id", "description", F.col("file").alias("source_file"), "datatype",
        "version", "created_by", "dataset_state_id", "contact",
    )
    return finish_load("datasets", rows, tables["datasets"], ["description"])


def load_dataset_members(tables: Tables) -> LoadResult:
    rows = tables["datasets"].select(F.col("id").alias("dataset_id"), F.lit(2).alias("datasetmembertype_id"))
    return finish_load("datasetmembers", rows, tables["datasetmembers"], ["dataset_id"])


def load_dataset_permissions(tables: Tables) -> LoadResult:
    rows = tables["datasets"].select(
        F.col("id").alias("dataset_id"), F.lit(1).alias("user_id"), F.lit(1).alias("group_id")
    )
    return finish_load("datasetpermissions", rows, tables["datasetpermissions"], ["dataset_id"])


# Compounds ---------------------------------------------------------------------


def load_compounds(sheet_rows: DataFrame, tables: Tables) -> LoadResult:
    """Names from (file, compound), one row per sheet row."""
    named = file_name_parts(sheet_rows).withColumnRenamed("compound", "name")
    rows = clean_compound(compound_class(named)).select(
        "description", "name", "compound_class", F.lit(1).alias("unit_id")
    )
    return finish_load("compounds", rows, tables["compounds"], ["name"])


COMPOUND_KEY = ("compound_id", "germinatebase_id", "dataset_id")


def load_compound_data(
    cells: DataFrame, tables: Tables, keys: Sequence[str] = COMPOUND_KEY, files: DataFrame | None = None
) -> LoadResult:
    """Values from (file, compound, name = sample id, value) without empty cells.

    The data set is found once per file (``files``: file; taken from the cells when not given).
    """
    names = (cells if files is None else files).select("file").distinct()
    parts = dataset_key(file_name_parts(names)).withColumn("description", glue("description", "datatype", separator=" "))
    known = lookup(parts, tables["datasets"], "description", "description", {"dataset_id": "id"}, ["id"])
    described = cells.select(
        "file", "compound", F.col("name").alias("sample_id"), F.col("value").try_cast("double").alias("compound_value")
    ).join(broadcast_if_small(known.select("file", "dataset_id")), "file")
    named = clean_compound(described, "compound")
    linked = lookup(named, tables["compounds"], "compound", "name", {"compound_id": "id"}, ["id"])
    linked = lookup(
        linked, tables["germinatebase"], "sample_id", "general_identifier", {"germinatebase_id": "id"}, ["id"]
    )
    rows = linked.select("compound_id", "germinatebase_id", "dataset_id", "compound_value")
    return finish_load("compounddata", rows, tables["compounddata"], list(keys))


# Phenotypes --------------------------------------------------------------------


def known_traits(cells: DataFrame, key_file: DataFrame) -> DataFrame:
    """Distinct headers of filled cells whose short name is in the key file."""
    headers = cells.select(F.col("name").alias("trait")).distinct()
    return only_known(trait_header(headers), key_file, ["short_name"])


def load_units(cells: DataFrame, key_file: DataFrame, unit_file: DataFrame, tables: Tables) -> LoadResult:
    units = known_traits(cells, key_file).select("unit_abbreviation").where(F.col("unit_abbreviation").isNotNull())
    rows = lookup(
        units.distinct(), unit_file, "unit_abbreviation", "unit_abbreviation",
        {"unit_name": "unit_name", "unit_description": "unit_description"}, ["unit_name", "unit_description"],
    )
    return finish_load("units", rows, tables["units"], ["unit_abbreviation"])


def load_phenotypes(cells: DataFrame, key_file: DataFrame, tables: Tables, count_unit: int = 13) -> LoadResult:
    """Traits with their unit; needs the units loaded before."""
    linked = lookup(
        known_traits(cells, key_file), tables["units"], "unit_abbreviation", "unit_abbreviation",
        {"unit_id": "id"}, ["id"],
    )
    named = lookup(
        linked, key_file, "short_name", "short_name",
        {"name": "name", "description": "Description"}, ["name", "Description"],
    )
    typed = phenotype_datatype(phenotype_name(named), "unit_id", count_unit)
    rows = typed.select(
        "name", "short_name", "description", "datatype",
        F.coalesce(F.col("unit_id").cast("string"), F.lit("")).alias("unit_id"),
    ).distinct()
    return finish_load("phenotypes", rows, tables["phenotypes"], ["name", "short_name"])


PHENOTYPE_KEY = ("phenotype_id", "germinatebase_id", "dataset_id")


def resolve_headers(headers: DataFrame, key_file: DataFrame, tables: Tables) -> DataFrame:
    """(file, name) of known traits with their phenotype, data set and location ids."""
    traits = only_known(trait_header(headers.withColumnRenamed("name", "trait")), key_file, ["short_name"])
    parts = normalise_site(dataset_key(file_name_parts(traits))).withColumn(
        "description", glue("description", "datatype", separator=" ")
    )
    with_measure = glue("short_name", "measure_id", separator=";")
    linked = lookup_rekey(
        parts, tables["phenotypes"], "short_name", with_measure, "short_name", "id", "phenotype_id", ["id"]
    )
    linked = lookup(linked, tables["datasets"], "description", "description", {"dataset_id": "id"}, ["id"])
    linked = lookup(linked, tables["locations"], "site_name_short", "site_name_short", {"location_id": "id"}, ["id"])
    return linked.select("file", F.col("trait").alias("name"), "phenotype_id", "dataset_id", "location_id")


def load_phenotype_data(
    cells: DataFrame,
    key_file: DataFrame,
    tables: Tables,
    keys: Sequence[str] = PHENOTYPE_KEY,
    headers: DataFrame | None = None,
) -> LoadResult:
    """Values from (file, ID, name = trait header, value) without empty cells.

    Names are split and looked up once per file and header, so a cell costs one join for all of
    that and one for its entity.  With ``headers`` (file, name), such as ``sheets.headers``
    gives, the cells are read once; else also for their headers.
    """
    pairs = (cells if headers is None else headers).select("file", "name").distinct()
    resolved = broadcast_if_small(resolve_headers(pairs, key_file, tables))
    linked = cells.select("file", "name", "ID", "value").join(resolved, ["file", "name"])
    linked = lookup_fallback(
        linked, tables["germinatebase"], "ID", ["general_identifier", "name"], "id", "germinatebase_id", ["id"]
    )
    rows = linked.select(
        "phenotype_id", "germinatebase_id", F.col("value").alias("phenotype_value"), "dataset_id", "location_id"
    )
    return finish_load("phenotypedata", rows, tables["phenotypedata"], list(keys))
