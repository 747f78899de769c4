"""Line dedup: repeated three-line windows, in DataFrame functions only.

Every run of ``window`` consecutive lines is one window, so windows overlap.  A window is
known by 128 bits of hash.  Its first occurrence, by (doc_id, place in the text), stays; all
lines that a later occurrence covers are removed, where overlapping occurrences are merged
into one span first.

Defined results
* Lines are what stands between newlines, compared exactly.
* A text with fewer lines than ``window`` has no window and stays as it is; so does null.
* A window of empty lines only is no repetition.
* A text all of whose lines go becomes the empty text; its row stays.
* Rows with the same doc_id and text count as one document and get the same result.  A null
  doc_id sorts before all others.
* Further columns are passed through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plotloom.operators.sizing import cut_lineage

WINDOW = 3
# Put before the lines for the second half of a window's key.
SECOND_HASH = 7919


def line_array(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc, body, start, key_a, key_b): one row per window; body tells texts of one id apart."""
    lines = F.col("lines")

    def described(i: Column) -> Column:
        parts = [F.get(lines, i + j) for j in range(window)]
        return F.struct(
            i.alias("start"),
            F.xxhash64(*parts).alias("key_a"),
            F.xxhash64(F.lit(SECOND_HASH), *parts).alias("key_b"),
        )

    def has_content(i: Column) -> Column:
        return F.exists(F.slice(lines, i + 1, window), lambda line: line != "")

    starts = F.filter(F.sequence(F.lit(0), F.size(lines) - window), has_content)
    return (
        docs.select(
            F.col("doc_id").alias("doc"), F.xxhash64("text").alias("body"), line_array(F.col("text")).alias("lines")
        )
        .where(F.size("lines") >= window)
        .select("doc", "body", F.explode(F.transform(starts, described)).alias("w"))
        .select("doc", "body", "w.start", "w.key_a", "w.key_b")
    )


def covered_spans(found: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc, body, spans): the merged line spans of each document that later occurrences cover.

    Counting and finding the first occurrence aggregate before the shuffle, so a window that
    a third of all documents have is no hot key there; the join back is one that adaptive
    execution splits.  Only windows that occur twice take part in it.
    """
    place = F.struct("doc", "body", "start")
    repeated = (
        found.groupBy("key_a", "key_b")
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .where(~F.col("first").eqNullSafe(F.col("last")))
        .select("key_a", "key_b", "first")
    )
    later = found.join(repeated, ["key_a", "key_b"]).where(~place.eqNullSafe(F.col("first")))
    in_doc = Window.partitionBy("doc", "body").orderBy("start")
    gap = F.coalesce(F.col("start") - F.lag("start").over(in_doc) > window, F.lit(True))
    islands = (
        later.select("doc", "body", "start")
        .distinct()
        .withColumn("opens", gap.cast("int"))
        .withColumn("island", F.sum("opens").over(in_doc))
        .groupBy("doc", "body", "island")
        .agg(F.min("start").alias("first"), (F.max("start") + window - 1).alias("last"))
    )
    return islands.groupBy("doc", "body").agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("spans"))


def kept_text(lines: Column, spans: Column) -> Column:
    """The lines outside the spans, joined again; linear in lines and spans."""
    count = F.size(spans)

    def before(i: Column) -> Column:
        begin = F.when(i == 0, F.lit(0)).otherwise(F.get(spans, i - 1)["last"] + 1)
        end = F.when(i == count, F.size(lines)).otherwise(F.get(spans, i)["first"])
        return F.slice(lines, begin + 1, end - begin)

    return F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), count), before)), "\n")


def dedup_lines(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents with later occurrences of repeated windows removed from ``text``.

    Adds ``n_lines`` (before), ``n_removed`` and ``removed_lines``, an array of (first, last)
    line numbers from 0, replacing columns of these names.
    """
    found = cut_lineage(windows(docs, window))
    spans = covered_spans(found, window)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col("doc_id").alias("id"),
        F.xxhash64("text").alias("text_hash"),
    )
    joined = rows.join(spans, F.col("id").eqNullSafe(F.col("doc")) & (F.col("text_hash") == F.col("body")), "left")
    text = F.col("row")["text"]
    lines = line_array(text)
    hit = F.col("spans").isNotNull()
    removed = F.aggregate("spans", F.lit(0), lambda total, s: total + s["last"] - s["first"] + 1)
    added = {
        "n_lines": F.when(text.isNull(), 0).otherwise(F.size(lines)).cast("long"),
        "n_removed": F.coalesce(removed, F.lit(0)).cast("long"),
        "removed_lines": F.coalesce(F.col("spans"), F.array().cast("array<struct<first:int,last:int>>")),
    }
    # First all results, then the columns of the row, which may have any name.
    added["text"] = F.when(hit, kept_text(lines, F.col("spans"))).otherwise(text)
    done = joined.select("row", F.struct(*[value.alias(name) for name, value in added.items()]).alias("new"))
    kept = [
        (F.col("new")["text"] if c == "text" else F.col("row")[c]).alias(c)
        for c in docs.columns
        if c == "text" or c not in added
    ]
    return done.select(*kept, *[F.col("new")[name].alias(name) for name in added if name != "text"])
