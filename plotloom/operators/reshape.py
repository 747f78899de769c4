"""Wide to long and back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def columns_with_prefix(df: DataFrame, prefix: str) -> list[str]:
    return [name for name in df.columns if name.startswith(prefix)]


def to_long(
    df: DataFrame,
    ids: Sequence[str],
    values: Sequence[str] | None = None,
    name: str = "name",
    value: str = "value",
    drop_nulls: bool = False,
) -> DataFrame:
    """Every column that is not an id becomes a (name, value) row, values as text.

    One pass, no shuffle; the generated code grows linearly with the column count,
    which matters for sheets with one column per sample.
    """
    chosen = [c for c in df.columns if c not in ids] if values is None else list(values)
    cells = F.array(
        *[F.struct(F.lit(c).alias("n"), F.col(f"`{c}`").cast("string").alias("v")) for c in chosen]
    )
    long = df.select(*ids, F.explode(cells).alias("__cell")).select(
        *ids, F.col("__cell.n").alias(name), F.col("__cell.v").alias(value)
    )
    return long.where(F.col(value).isNotNull()) if drop_nulls else long


def to_wide(df: DataFrame, rows: Sequence[str], column: str, names: Sequence, cell: Column) -> DataFrame:
    """One column per listed name; the list is given so that the plan needs no extra pass."""
    return df.groupBy(*rows).pivot(column, list(names)).agg(cell)


def attributes_to_long(df: DataFrame, ids: Sequence[str], attributes: Mapping[str, int]) -> DataFrame:
    """Sparse attribute columns to (attribute_id, value) rows; missing cells give none."""
    cells = F.array(
        *[
            F.struct(F.lit(code).alias("attribute_id"), F.col(column).cast("string").alias("value"))
            for column, code in attributes.items()
        ]
    )
    long = df.select(*ids, F.explode(cells).alias("__cell")).select(*ids, "__cell.attribute_id", "__cell.value")
    return long.where(F.col("value").isNotNull())


def grid_slice(grid: DataFrame, fixed: Mapping[str, float], rows: str, columns: str, names: Sequence, value: str) -> DataFrame:
    """A table of ``value`` over two parameters with the others held at given values."""
    kept = grid
    for column, wanted in fixed.items():
        kept = kept.where(F.col(column) == F.lit(wanted))
    return to_wide(kept, [rows], columns, names, F.first(value))


def union_all(frames: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    """Stack by column name; absent columns become null when allowed."""
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=allow_missing)
    return stacked


def with_constants(df: DataFrame, constants: Mapping[str, object]) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in constants.items()})


def drop_incomplete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.dropna(how="any", subset=None if columns is None else list(columns))
