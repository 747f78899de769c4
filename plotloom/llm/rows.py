"""Whole rows beside keys to join them by, whatever other columns the rows have."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def whole_rows(docs: DataFrame, **keys: Column) -> DataFrame:
    """Every row as one struct column ``row``, beside the named keys."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return docs.select(row, *[value.alias(name) for name, value in keys.items()])
