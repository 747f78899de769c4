"""Joining a small table without guessing that it is small."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotloom.operators.keys import join_same
from plotloom.session import cut_lineage

__all__ = ["SMALL_BYTES", "SMALL_ROWS", "attach", "broadcast_if_small", "cut_lineage"]

# Rows of a few numbers each up to which a table is small.
SMALL_ROWS = 100_000
# Bytes of a table's values as text up to which it is broadcast.
SMALL_BYTES = 8 << 20


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """Materialise a reduced table, measure it, and broadcast it only when it is small.

    A larger one is joined by shuffle, where hot keys are split at run time.
    """
    kept = cut_lineage(df)
    texts = [F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("")) for name in kept.columns]
    size = kept.agg(F.sum(F.octet_length(F.concat(*texts)) + 8 * len(texts))).first()[0] or 0
    return F.broadcast(kept) if size <= SMALL_BYTES else kept


def attach(df: DataFrame, per_group: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join one row per group back to the rows of the group.

    The planner cannot know how few groups a large table has, so the group table is
    measured: with few groups the rows are not shuffled at all, however many one of them
    holds.
    """
    return join_same(df, broadcast_if_small(per_group), keys, how)
