"""In-line tables."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def literal(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """An in-line table.  Made from Arrow it is a local relation of known size, so joins
    with it need no shuffle of the other side."""
    fields = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(fields)
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    arrays = [pa.array(list(column), type=field.type) for column, field in zip(columns, arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow), fields)
