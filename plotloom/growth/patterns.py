"""Temporal patterns of plants."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plotloom.operators.reshape import to_wide
from plotloom.operators.stats import mean_strict
from plotloom.session import cut_lineage

# Series that are clustered with one another.
MICRO = 2000


def series_matrix(df: DataFrame, row: str, column: str, names: Sequence, value: str) -> DataFrame:
    """One row per plant with its mean per date; a missing measurement makes a cell null."""
    return to_wide(df, [row], column, names, mean_strict(value))


def merges(vectors: np.ndarray) -> list[tuple[float, int, int]]:
    """Complete-linkage merges (distance, member, member) by nearest-neighbour chains.

    A chain goes from a cluster to its nearest one until two are nearest to each other; those are
    merged.  The merges are those of always merging the closest pair, in another order.
    """
    n = len(vectors)
    squares = (vectors**2).sum(axis=1)
    distance = np.sqrt(np.maximum(squares[:, None] + squares[None, :] - 2 * vectors @ vectors.T, 0))
    np.fill_diagonal(distance, np.inf)
    alive, found, chain = np.ones(n, dtype=bool), [], []
    for _ in range(n - 1):
        if not chain:
            chain = [int(np.argmax(alive))]
        while True:
            at = chain[-1]
            nearest = int(np.argmin(distance[at]))
            if len(chain) > 1 and distance[at, chain[-2]] <= distance[at, nearest]:
                break
            chain.append(nearest)
        b, a = chain.pop(), chain.pop()
        found.append((float(distance[a, b]), a, b))
        distance[a] = distance[:, a] = np.maximum(distance[a], distance[b])
        distance[a, a] = distance[b] = distance[:, b] = np.inf
        alive[b] = False
    return found


def cut(found: list[tuple[float, int, int]], n: int, k: int) -> np.ndarray:
    """Labels of the ``k`` clusters left when the closest merges are made first; by first member."""
    parent = list(range(n))

    def top(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for _, a, b in sorted(found, key=lambda m: m[0])[: max(n - k, 0)]:
        parent[top(b)] = top(a)
    roots = [top(i) for i in range(n)]
    names: dict[int, int] = {}
    return np.array([names.setdefault(root, len(names)) for root in roots])


def trajectory_groups(matrix: DataFrame, row: str, columns: Sequence[str], k: int = 4) -> DataFrame:
    """(row, pattern, radius): plants in ``k`` temporal patterns, the complete-linkage tree of their series cut.

    Empty cells take the mean of their date.  Up to ``MICRO`` different series are clustered themselves,
    and ``radius`` is 0.  Of more, ``MICRO`` chosen by hash are the centres of small clusters, every series goes with the
    nearest centre at distance ``radius``, and the centres are clustered: any distance between two
    clusters, so any height of the tree, is then right to within twice the largest radius.  The
    driver sees ``MICRO`` series at most.
    """
    # avg over no value is null: a date without any measurement adds nothing.
    means = {c: F.coalesce(matrix.agg(F.avg(F.col(f"`{c}`"))).scalar(), F.lit(0.0)) for c in columns}
    filled = matrix.select(row, F.array(*[F.coalesce(F.col(f"`{c}`"), means[c]).cast("double") for c in columns]).alias("__v"))
    filled = cut_lineage(filled)
    different = filled.groupBy("__v").agg(F.min(row).alias("__first"))
    chosen = different.orderBy(F.xxhash64("__v"), "__v").limit(MICRO + 1).collect()
    centres = sorted(chosen[:MICRO], key=lambda r: (r["__first"] is not None, r["__first"]))
    vectors = np.array([r["__v"] for r in centres]).reshape(len(centres), len(columns))
    labels = cut(merges(vectors), len(centres), k) if len(centres) else np.zeros(0, dtype=int)
    squares = (vectors**2).sum(axis=1)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            own = np.stack(batch["__v"].to_numpy())
            nearest = np.concatenate(
                [np.argmin(squares - 2 * own[at : at + 512] @ vectors.T, axis=1) for at in range(0, len(own), 512)]
            )
            radius = np.sqrt(((own - vectors[nearest]) ** 2).sum(axis=1))
            yield pd.DataFrame({row: batch[row], "pattern": labels[nearest], "radius": radius})

    fields = [filled.schema[row], T.StructField("pattern", T.IntegerType()), T.StructField("radius", T.DoubleType())]
    return filled.mapInPandas(assign, T.StructType(fields))
