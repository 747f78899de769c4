"""Loads of small fixed vocabularies: experiment types, licenses, marker kinds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from plotloom.literals import literal
from plotloom.plans.common import LoadResult, finish_load

# Fixed values.
EXPERIMENT_TYPES = [("compound",)]
MAPS = [("DArT-seq SNPs",)]
MARKER_TYPES = [("SNP",), ("AFLP",), ("KASP",), ("MicroSat",)]
GROUP_TYPES = [("trialsite", "locations")]
LICENSES = [
    ("IWYP pending", "license pending grants by IWYP"),
    ("CC-BY-NC-ND", "Anyone can share this material, provided it remains unaltered in any way, this is not done for commercial purposes, and the original authors are credited and cited."),
    ("CC-BY-ND", "Anyone can share this material, providing it remains unaltered in any way and the original authors are credited and cited."),
    ("CC-BY-NC", "Anyone can share, reuse, remix, or adapt this material, providing this is not done for commercial purposes and the original authors are credited and cited."),
    ("CC-BY", "Anyone can share, reuse, remix, or adapt this material for any purpose, providing the original authors are credited and cited."),
]

# target -> (rows, schema, natural key)
VOCABULARIES = {
    "experimenttypes": (EXPERIMENT_TYPES, "description string", "description"),
    "licenses": (LICENSES, "name string, description string", "name"),
    "maps": (MAPS, "description string", "description"),
    "markertypes": (MARKER_TYPES, "description string", "description"),
    "mapfeaturetypes": (MARKER_TYPES, "description string", "description"),
    "grouptypes": (GROUP_TYPES, "description string, target_table string", "description"),
}


def load_vocabulary(target: str, existing: DataFrame, rows: Sequence[tuple] | None = None) -> LoadResult:
    """Append the words of a vocabulary that the table does not hold yet."""
    fixed, schema, key = VOCABULARIES[target]
    words = literal(existing.sparkSession, fixed if rows is None else rows, schema)
    return finish_load(target, words, existing, [key])
