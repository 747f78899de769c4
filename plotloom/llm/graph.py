"""Connected components of a link table, in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotloom.operators.sizing import cut_lineage

# Short rows that one task takes.
ROWS_PER_TASK = 50_000


def components(links: DataFrame) -> DataFrame:
    """(node, root): the least node of each node's component, for links (a, b) of one type.

    Alternates hooking every node's larger neighbours to its least neighbour with hooking its
    smaller ones to it, until nothing changes; the number of rounds grows with the logarithm
    of the longest chain.  Each round aggregates the least neighbour before the shuffle, so
    a node with very many links is no hot group.
    """
    edges = cut_lineage(links.select("a", "b").where("a != b").distinct())
    state = _state(edges)
    edges = few_partitions(edges, state[0])
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("low"))
        least = few_partitions(least.select("a", F.least("a", "low").alias("low")), state[0])
        # Larger neighbours, and the node itself, to the least neighbour.
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("x"), F.col("low").alias("y"))
        large = large.union(least.select(F.col("a").alias("x"), F.col("low").alias("y"))).where("x != y")
        large = few_partitions(few_partitions(large, state[0]).distinct(), state[0])
        # Each node's smaller neighbours to the least of them.
        low = few_partitions(large.groupBy("x").agg(F.min("y").alias("low")), state[0])
        small = large.join(low, "x").select(F.col("y").alias("x"), F.col("low").alias("y"))
        small = small.union(low.select("x", F.col("low").alias("y"))).where("x != y")
        small = few_partitions(few_partitions(small, state[0]).distinct(), state[0])
        edges = cut_lineage(small.select(F.col("x").alias("a"), F.col("y").alias("b")))
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))


def few_partitions(df: DataFrame, rows: int) -> DataFrame:
    """A table of about ``rows`` short rows in as many partitions as are worth a task each.

    Rounds over small tables would otherwise write as many small files as there are shuffle partitions.
    """
    return df.coalesce(rows // ROWS_PER_TASK + 1)


def _state(edges: DataFrame) -> tuple:
    """Number and hash sums of the distinct edges: equal when nothing has changed."""
    # Sums of 32 and 31 bits cannot overflow below four thousand million edges.
    first, second = F.xxhash64("a", "b"), F.xxhash64("b", "a")
    return tuple(
        edges.agg(
            F.count("*"), F.sum(F.shiftright(first, 32)), F.sum(F.shiftright(second, 33)), F.sum(F.hash("a", "b"))
        ).first()
    )
