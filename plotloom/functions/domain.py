"""Transforms that know the naming rules of the trial data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plotloom.literals import literal
from plotloom.functions.scalar import (
    days_between,
    glue,
    if_else,
    labelled_part,
    replace_first,
    strip_csv,
    to_date_dmy,
    token,
)

# Data types carried by the file names.
TRIAL_TYPES = ["Harvest", "Lidar", "Biomass", "ASD", "Q2", "Physiology-Raw", "Physiology-BLUE"]
COMPOUND_TYPES = ["Metabolomics-metabolite", "Proteomics-functionalbin", "Proteomics-peptide"]
GENOTYPE_TYPES = ["GBS"]

# Substring of a site text -> location id, first hit wins.
LOCATION_RULES_FIRST = [
    ("Obregon", 2),
    ("ACPFG", 3),
    ("Birdcage", 5),
    ("GES17", 1),
    ("GES_CR4", 1),
]
LOCATION_RULES = [
    ("Acacia", 4),
    ("Obregon", 2),
    ("ACPFG", 3),
    ("Birdcage", 5),
    ("GES17", 1),
    ("GES_CR4", 1),
    ("Naracoorte, SA", 7),
    ("GES 2018", 6),
]

# Attribute name -> attribute id.
ATTRIBUTE_IDS = {
    "Cross": 1,
    "Pedigree": 2,
    "Source": 3,
    "Cid": 4,
    "Sid": 5,
    "GID": 6,
    "Other_ID": 7,
    "Alternative_Name_1": 8,
    "Alternative_Name_2": 9,
    "Alternative_Name_3": 10,
    "Alternative_ID": 11,
    "Notes": 12,
    "Sample_Type": 13,
    "Stage": 14,
    "Tissue": 15,
}

# Entity kind -> entity type id.
ENTITY_TYPES = {"accession": 1, "plot": 2, "sample": 3, "grain packet": 10}

# Label in the notes text -> column, in output order.
NOTE_PARTS = [
    ("Cross", "Cross"),
    ("Pedigree", "Pedigree"),
    ("Source", "Source"),
    ("Cid", "Cid"),
    ("Sid", "Sid"),
    ("Gid", "GID"),
    ("Other ID", "Other_ID"),
    ("Alternative Name 1", "Alternative_Name_1"),
    ("Alternative Name 2", "Alternative_Name_2"),
    ("Alternative Name 3", "Alternative_Name_3"),
    ("Alternative ID", "Alternative_ID"),
    ("Other Notes", "Notes"),
]

SURPLUS_NOTE = "Surplus Sample Number"


def file_name_parts(df: DataFrame, file: str = "file") -> DataFrame:
    """Add year, site, trial and datatype from ``YYYY_site_trial_datatype.csv``."""
    return df.withColumns(
        {
            "year": token(file, "_", 1),
            "site": token(file, "_", 2),
            "trial": token(file, "_", 3),
            "datatype": strip_csv(token(file, "_", 4)),
        }
    )


def site_name(site, year) -> Column:
    site = F.col(site) if isinstance(site, str) else site
    year = F.col(year) if isinstance(year, str) else year
    return if_else(
        year == "2017",
        replace_first(site, "GES", "GES CR04"),
        replace_first(site, "GES", "GES VR11"),
    )


def normalise_site(df: DataFrame, site: str = "site", year: str = "year", out: str = "site_name_short") -> DataFrame:
    """Field name of the GES site depends on the season."""
    return df.withColumn(out, site_name(site, year))


def _experiment_text(text: Column) -> Column:
    return replace_first(replace_first(text, "Obregon2016_trial", "CIMMYT2016"), "GES20", "GES")


def dataset_key(df: DataFrame, out: str = "description") -> DataFrame:
    """``site + year _ trial``, with the two programme spellings applied."""
    return df.withColumn(out, _experiment_text(glue("site", "year", F.lit("_"), "trial")))


def experiment_description(df: DataFrame, name: str, kind: str, out: str = "description") -> DataFrame:
    return df.withColumn(out, glue(_experiment_text(F.col(name)), kind, separator=" "))


def trait_header(df: DataFrame, header: str = "trait") -> DataFrame:
    """Split ``short_unit_measure`` into three columns."""
    return df.withColumns(
        {
            "short_name": token(header, "_", 1),
            "unit_abbreviation": token(header, "_", 2),
            "measure_id": token(header, "_", 3),
        }
    )


def with_measure(name, measure) -> Column:
    """``name;measure`` if there is a measure, else the bare name."""
    name = F.col(name) if isinstance(name, str) else name
    measure = F.col(measure) if isinstance(measure, str) else measure
    return F.when(measure.isNotNull(), glue(name, measure, separator=";")).otherwise(name)


def phenotype_name(df: DataFrame, measure: str = "measure_id") -> DataFrame:
    return df.withColumns(
        {"name": with_measure("name", measure), "short_name": with_measure("short_name", measure)}
    )


def phenotype_datatype(df: DataFrame, unit: str = "unit_id", count_unit: int = 13, out: str = "datatype") -> DataFrame:
    """Counts are int, other units float, no unit gives an empty text."""
    chosen = F.when(F.col(unit) == count_unit, "int").when(F.col(unit).isNotNull(), "float").otherwise("")
    return df.withColumn(out, chosen)


def clean_compound(df: DataFrame, name: str = "name") -> DataFrame:
    return df.withColumn(name, replace_first(replace_first(name, " Elke", ""), " new", ""))


def compound_class(df: DataFrame, kind: str = "datatype") -> DataFrame:
    """``Class-kind`` gives description (class) and compound_class (kind)."""
    return df.withColumns({"compound_class": token(kind, "-", 2), "description": token(kind, "-", 1)})


def marker_interval(df: DataFrame, chromosome: str, start: str, offset: str) -> DataFrame:
    return df.withColumns(
        {
            "chromosome": F.coalesce(F.col(chromosome), F.lit("Unmapped")),
            "definition_start": F.col(start),
            "definition_end": F.col(start) + F.col(offset),
        }
    )


def location_rule(text, rules: Sequence[tuple[str, int]] = LOCATION_RULES) -> Column:
    """First rule whose text occurs in the site; null when none does."""
    text = F.col(text) if isinstance(text, str) else text
    found = None
    for wanted, location in rules:
        hit = text.contains(wanted)
        found = F.when(hit, location) if found is None else found.when(hit, location)
    return found


def sample_class(sample_type, purpose) -> Column:
    """Storage class of a sample from its type and purpose; null when no rule fits."""
    kind = F.lower(F.coalesce(F.col(sample_type), F.lit("")))
    aim = F.lower(F.coalesce(F.col(purpose), F.lit("")))
    return (
        F.when(aim == "backup", "Backup")
        .when(aim.contains("q2"), "Q2")
        .when(kind.contains("frozen leaf") & aim.isin("", "prot/met", "tissue sample"), "Frozen Leaf")
        .when(aim.isin("genotyping", "dna") | (kind == "dna"), "DNA Extraction")
        .when(aim == "metabolomics", "Metabolomics")
        .when(aim == "proteomics", "Proteomics")
        .when(aim.contains("original leaf"), "Original Leaf")
    )


def attribute_map(spark: SparkSession) -> DataFrame:
    return literal(spark, list(ATTRIBUTE_IDS.items()), "attribute string, attribute_id int")


def entity_types(spark: SparkSession) -> DataFrame:
    return literal(spark, list(ENTITY_TYPES.items()), "entity_kind string, entitytype_id int")


def accession_notes(df: DataFrame, out: str = "notes") -> DataFrame:
    """Twelve labelled parts in one text, each from its own column."""
    return df.withColumn(out, F.concat(*[labelled_part(label, name) for label, name in NOTE_PARTS]))


def not_surplus(notes: str = "Notes") -> Column:
    return ~F.col(notes).eqNullSafe(F.lit(SURPLUS_NOTE))


def sample_name(df: DataFrame, out: str = "name") -> DataFrame:
    return df.withColumn(out, F.coalesce(F.col("Sample_Name"), F.col("Plant_Name")))


def institution(site) -> Column:
    site = F.col(site) if isinstance(site, str) else site
    return if_else(site == "Obregon", F.lit(4), F.lit(1))


def experiment_code(number) -> Column:
    """``IW_E00n`` above ten, ``IW_E000n`` up to ten."""
    number = F.col(number) if isinstance(number, str) else number
    return if_else(
        number > 10,
        F.concat(F.lit("IW_E00"), number.cast("string")),
        F.concat(F.lit("IW_E000"), number.cast("string")),
    )


def genotype_group(panel) -> Column:
    return glue(panel, F.lit("GBS"), separator=" ")


def measure_date(df: DataFrame, short_name: str = "short_name", file: str = "source_file", out: str = "date") -> DataFrame:
    """Day and month from the trait, year from the file name."""
    return df.withColumn(out, to_date_dmy(glue(token(short_name, ";", 2), token(file, "_", 1))))


def days_since(df: DataFrame, date: str, sowing: str, out: str = "days") -> DataFrame:
    return df.withColumn(out, days_between(sowing, date))
