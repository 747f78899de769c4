"""MinHash near-dedup of weighted sets: BagMinHash signatures, bands, verified overlap.

A text is the multiset of its five-word shingles.  Every shingle with its count draws points
of Poisson processes over (weight, time): one process for each of the weight intervals (0, 1],
(1, 2], (2, 4], (4, 8] ... that the count reaches into.  A process on an interval of width w has
rate w per signature place; its points come in order of time, each with a uniform place and a
uniform weight, and a point counts if its weight, rounded up, is within the count.  A place of
the signature is the earliest point that falls on it, so two texts agree there with a
probability of exactly their weighted Jaccard similarity.  A process stops as soon as it is
later than every place, so a text of n shingles and a signature of m places need about
n + m log m points rather than n * m.

Documents with one multiset form a class first (128-bit sums of hashes), and only one of
each class goes on.  Its signature is cut into bands; classes that share a band are candidates, each
against the least class of the band, and a pair is linked if the exact multiset overlap
reaches the threshold.  Bands whose classes are not all connected by then are gone through
again: small ones by all pairs of unconnected classes; in larger ones every class outside the
largest component is compared with every unconnected one that is likely enough by signature, block
by block within tasks that hold both blocks' texts.  Only links come out of them, fewer than
classes, so no table has a row per pair of a large group.

Defined results: null and empty texts are equal, and so one class.  Texts of one to four words
have one shingle.  Words are compared as they stand, apart from blanks.  Rows with the same
doc_id are one member of the class.  A null doc_id is the least.  The class id is the least
doc_id in the class.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotloom.llm.arrow_text import SLICE_BYTES, text_slices
from plotloom.llm.graph import components, few_partitions
from plotloom.llm.rows import whole_rows
from plotloom.llm.words import batch_shingles, mix, multisets, sum_by_text
from plotloom.operators.sizing import cut_lineage

THRESHOLD = 0.8
# 26 bands of 5 places: a pair at 0.8 shares a band with probability 0.99997.
BANDS, ROWS = 26, 5
PLACES = BANDS * ROWS
# Bands with at most so many classes are resolved by all pairs of unconnected ones.
ALL_PAIRS = 16
# In larger ones: classes and bytes of text per block, and the share of equal sketch places that a partner
# must have (at 0.8, less with probability 1e-8).
BLOCK, BLOCK_BYTES, LIKELY = 1024, 4 << 20, 0.6

_U53 = 1.0 / (1 << 53)


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * _U53


def bag_signatures(owner: np.ndarray, shingle: np.ndarray, count: np.ndarray, texts: int) -> np.ndarray:
    """The signature of each text, one row of ``PLACES`` 64-bit point names."""
    times = np.full((texts, PLACES), np.inf)
    names = np.zeros((texts, PLACES), dtype=np.uint64)
    # One process per shingle and weight interval: level 0 is (0, 1], level j is (2^(j-1), 2^j].
    levels = 1 + np.ceil(np.log2(count.astype(np.float64))).astype(np.int64)
    rows = np.repeat(np.arange(len(shingle)), levels)
    level = np.arange(len(rows)) - np.repeat(np.cumsum(levels) - levels, levels)
    text, limit = owner[rows], count[rows]
    state = mix(shingle[rows] ^ mix(level.astype(np.uint64) + np.uint64(1)))
    low = np.where(level == 0, 0, 1 << np.maximum(level - 1, 0))
    width = np.where(level == 0, 1, low)
    rate = width.astype(np.float64) * PLACES
    now = np.zeros(len(rows))
    latest = np.full(texts, np.inf)
    step = np.uint64(0x9E3779B97F4A7C15)
    while len(text):
        state = state + step
        draw = mix(state)
        now = now - np.log(_uniform(draw)) / rate
        alive = now < latest[text]
        if not alive.all():
            text, limit, state, low, width = text[alive], limit[alive], state[alive], low[alive], width[alive]
            rate, now, draw = rate[alive], now[alive], draw[alive]
            if not len(text):
                break
        second = mix(draw ^ step)
        place = (second % np.uint64(PLACES)).astype(np.int64)
        weight = low + np.floor(_uniform(mix(second)) * width) + 1
        counts = weight <= limit
        t, p, when, name = text[counts], place[counts], now[counts], draw[counts]
        np.minimum.at(times, (t, p), when)
        won = times[t, p] == when
        names[t[won], p[won]] = name[won]
        touched = np.unique(t)
        latest[touched] = times[touched].max(axis=1)
    return names


def content_keys(shingles: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that are equal for equal multisets."""
    return (
        sum_by_text(shingles, bounds),
        sum_by_text(mix(shingles ^ np.uint64(0xA0761D6478BD642F)), bounds),
    )


def band_keys(names: np.ndarray) -> np.ndarray:
    """One 64-bit key per text and band, different between bands."""
    grouped = names.reshape(len(names), BANDS, ROWS)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), grouped.shape[:2])
    for j in range(ROWS):
        keys = mix(keys ^ grouped[:, :, j]) + np.uint64(j)
    return keys


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def _signature_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in text_slices(batches):
        shingles, bounds = batch_shingles(texts)
        key_a, key_b = content_keys(shingles, bounds)
        owner, values, count = multisets(shingles, bounds)
        names = bag_signatures(owner, values, count, len(texts))
        bands = band_keys(names)
        sketch = pa.array([row.tobytes() for row in names.astype(np.uint8)], pa.binary())
        bands = pa.ListArray.from_arrays(
            pa.array(np.arange(len(texts) + 1, dtype=np.int32) * BANDS), pa.array(_signed(bands.reshape(-1)))
        )
        empty = pa.array(np.diff(bounds) == 0)
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), part.column("text_key"), pa.array(_signed(key_a)), pa.array(_signed(key_b)), empty, bands, sketch],
            ["doc_id", "text_key", "key_a", "key_b", "empty", "bands", "sketch"],
        )


def _content_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in text_slices(batches):
        shingles, bounds = batch_shingles(texts)
        key_a, key_b = content_keys(shingles, bounds)
        packed = pa.array([zlib.compress(t, 1) for t in texts], pa.binary())
        sizes = pa.array([len(t) for t in texts], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(_signed(key_a)), pa.array(_signed(key_b)), pa.array(np.diff(bounds) == 0), packed, sizes],
            ["key_a", "key_b", "empty", "text", "size"],
        )


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, key_a, key_b, empty, bands) for documents with a long ``doc_id`` and ``text``."""
    schema = "doc_id long, text_key long, key_a long, key_b long, empty boolean, bands array<long>, sketch binary"
    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_key")).mapInArrow(_signature_batches, schema)


def overlap(left: list[bytes], right: list[bytes]) -> np.ndarray:
    """Exact weighted Jaccard similarity of the shingle multisets, pair by pair."""
    shingles, bounds = batch_shingles(left + right)
    owner, values, count = multisets(shingles, bounds)
    n = len(left)
    pair, side = owner % n, owner // n
    order = np.lexsort((side, values, pair))
    pair, values, count = pair[order], values[order], count[order]
    same = np.flatnonzero((pair[1:] == pair[:-1]) & (values[1:] == values[:-1]))
    common = np.bincount(pair[same], np.minimum(count[same], count[same + 1]), minlength=n)
    sizes = np.diff(bounds)
    union = sizes[:n] + sizes[n:] - common
    return np.where(union > 0, common / np.maximum(union, 1), 1.0)


def bag_items(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of each text with the second, third ... occurrence as items of their own, and how many each text has."""
    owner, values, count = multisets(*batch_shingles(texts))
    rows = np.repeat(np.arange(len(values)), count)
    nth = (np.arange(len(rows)) - np.repeat(np.cumsum(count) - count, count)).astype(np.uint64)
    return mix(values[rows] + nth * np.uint64(0x9E3779B97F4A7C15)), np.bincount(owner[rows], minlength=len(texts))


def pair_slices(left: pa.Array, right: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, list[bytes], list[bytes]]]:
    """(first row, left texts, right texts) of slices of pairs, inflated; both sides together bounded, one pair at least."""
    begin, size, lefts, rights = 0, 0, [], []
    for at in range(len(left)):
        pair = [zlib.decompress(column[at].as_buffer()) for column in (left, right)]
        more = sum(map(len, pair))
        if lefts and size + more > limit:
            yield begin, lefts, rights
            begin, size, lefts, rights = at, 0, [], []
        size += more
        lefts.append(pair[0])
        rights.append(pair[1])
    if lefts:
        yield begin, lefts, rights


def verified(pairs: DataFrame, texts: DataFrame, threshold: float, alike: Callable = overlap) -> DataFrame:
    """The pairs (a, b) whose texts overlap enough; texts has (cls, text), the text deflated.

    Both joins are by class; a class that is the centre of very many pairs is a hot key
    which adaptive execution splits.
    """
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    used = texts.join(wanted, "cls")
    left = used.select(F.col("cls").alias("a"), F.col("text").alias("left"))
    right = used.select(F.col("cls").alias("b"), F.col("text").alias("right"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")

    def check(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, lefts, rights in pair_slices(batch.column(2), batch.column(3)):
                part = batch.slice(begin, len(lefts)).select([0, 1])
                yield part.filter(pa.array(alike(lefts, rights) >= threshold))

    return both.mapInArrow(check, "a long, b long")


def star_pairs(bands: DataFrame) -> DataFrame:
    """Every class of a band with the least class of it; distinct over the bands."""
    centre = bands.groupBy("band").agg(F.min("cls").alias("a"), F.max("cls").alias("z")).where("a < z")
    return bands.join(centre.select("band", "a"), "band").where("cls > a").select("a", F.col("cls").alias("b")).distinct()


def unsettled(bands: DataFrame, roots: DataFrame) -> DataFrame:
    """(band, cls, root, n): the bands of n classes that are not all connected yet."""
    placed = bands.select("band", "cls").join(roots, F.col("cls") == F.col("node")).select("band", "cls", "root")
    mixed = (
        placed.groupBy("band")
        .agg(F.count("*").alias("n"), F.min("root").alias("r"), F.max("root").alias("s"))
        .where("r < s")
        .select("band", "n")
    )
    return placed.join(mixed, "band")


def small_band_pairs(left: DataFrame) -> DataFrame:
    """All pairs (a, b) of unconnected classes in unsettled bands of up to ``ALL_PAIRS`` classes."""
    small = left.where(F.col("n") <= ALL_PAIRS)
    return (
        small.alias("x")
        .join(small.alias("y"), "band")
        .where("x.cls < y.cls and x.root <> y.root")
        .select(F.col("x.cls").alias("a"), F.col("y.cls").alias("b"))
        .distinct()
    )


def band_groups(left: DataFrame, rows: int) -> DataFrame:
    """(node, grp) of the classes in larger unsettled bands: bands that share classes are one group."""
    large = left.where(F.col("n") > ALL_PAIRS)
    least = large.groupBy("band").agg(F.min("cls").alias("b"))
    found = components(few_partitions(large.join(least, "band").select(F.col("cls").alias("a"), "b"), rows))
    return cut_lineage(few_partitions(found.toDF("node", "grp"), rows))


def block_links(
    left: DataFrame, groups: DataFrame, sketches: DataFrame, texts: DataFrame, threshold: float, items: Callable, rows: int
) -> DataFrame:
    """(a, b): links that connect all classes of larger unsettled bands that are alike enough and unconnected yet.

    A group's classes outside its largest component and those in it are dealt into blocks.  Each block of
    the former meets every block in one task, with sketches (one byte per signature place) and texts.  Pairs at
    least ``LIKELY`` alike by sketch are compared exactly, unless earlier links of the task connect them, and
    links between components come out.  So a class is sent once per block that it meets.
    """
    large = left.where(F.col("n") > ALL_PAIRS)
    members = few_partitions(large.select("cls", "root").distinct(), rows)
    members = members.join(groups, F.col("cls") == F.col("node"), "left").select("cls", "root", F.coalesce("grp", "cls").alias("grp"))
    members = cut_lineage(few_partitions(members.join(texts.select("cls", "size"), "cls"), rows))
    sizes = members.groupBy("grp", "root").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
    tops = sizes.groupBy("grp").agg(F.max(F.struct("n", "root"))["root"].alias("top"))
    sizes = sizes.join(few_partitions(tops, rows), "grp")

    def blocks(inside: Column) -> Column:
        counted = [F.sum(F.when(inside, F.col(c) / size)) for c, size in (("n", BLOCK), ("bytes", BLOCK_BYTES))]
        return F.coalesce(F.ceil(F.greatest(*counted)), F.lit(0)).cast("int")

    inside = F.col("root") == F.col("top")
    counts = sizes.groupBy("grp", "top").agg(blocks(~inside).alias("apart"), blocks(inside).alias("settled"))
    homes = members.join(few_partitions(counts, rows), "grp").withColumn("draw", F.xxhash64("cls"))
    own = F.when(inside, F.col("apart") + F.pmod("draw", "settled")).otherwise(F.pmod("draw", "apart")).cast("int")
    last = F.when(inside, F.col("apart")).otherwise(F.col("apart") + F.col("settled")) - 1
    homes = homes.select("grp", "cls", "root", own.alias("own"), F.explode(F.sequence(F.lit(0), last)).alias("other"))
    placed = (
        cut_lineage(few_partitions(homes, rows))
        .join(sketches, "cls")
        .join(texts, "cls")
        .select("grp", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "cls", "root", "own", "sketch", "text")
    )

    def compare(batch: pa.Table) -> pa.Table:
        batch = batch.sort_by("cls")
        cls, root, own = (np.asarray(batch.column(c).combine_chunks()) for c in ("cls", "root", "own"))
        sketch = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), dtype=np.uint8).reshape(len(cls), -1)
        values, amounts = items([zlib.decompress(t) for t in batch.column("text").to_pylist()])
        _, values = np.unique(values, return_inverse=True)
        heads = np.cumsum(amounts) - amounts
        marked = np.zeros(len(values) + 1, dtype=np.int32)
        least, across = batch.column("i")[0].as_py(), batch.column("i")[0] != batch.column("j")[0]
        part = np.unique(root, return_inverse=True)[1]
        found: list[tuple[int, int]] = []
        looking = np.flatnonzero(own == least)
        for begin in range(0, len(looking), 32):
            mine = looking[begin : begin + 32]
            apart = (sketch[mine][:, None, :] != sketch[None, :, :]).sum(axis=2)
            likely = apart <= (1 - LIKELY) * sketch.shape[1]
            if across:
                likely &= own[None, :] != least
            for row, x in enumerate(mine.tolist()):
                others = np.flatnonzero(likely[row] & (part != part[x]) & (amounts > 0))
                if not len(others):
                    continue
                own_items = values[heads[x] : heads[x] + amounts[x]]
                marked[own_items] = 1
                places = np.repeat(heads[others] - np.cumsum(amounts[others]) + amounts[others], amounts[others])
                places += np.arange(len(places))
                common = np.add.reduceat(marked[values[places]], np.cumsum(amounts[others]) - amounts[others])
                marked[own_items] = 0
                linked = others[common / (amounts[x] + amounts[others] - common) >= threshold]
                joined, first = np.unique(part[linked], return_index=True)
                found += [(x, y) for y in linked[first].tolist()]
                part[np.isin(part, joined)] = part[x]
        pairs = cls[np.array(found, dtype=np.int64).reshape(-1, 2)]
        return pa.table({"a": pa.array(pairs.min(axis=1)), "b": pa.array(pairs.max(axis=1))})

    return placed.groupBy("grp", "i", "j").applyInArrow(compare, "a long, b long")


def merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """The components (node, root) after adding links: only their roots are connected anew."""
    left = roots.select(F.col("node").alias("a"), F.col("root").alias("ra"))
    right = roots.select(F.col("node").alias("b"), F.col("root").alias("rb"))
    # Materialised first: few partitions are for the links that are left, not for the work that finds them.
    between = cut_lineage(links).join(left, "a").join(right, "b").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
    between = few_partitions(between, roots.count())
    joined = components(between).select(F.col("node").alias("root"), F.col("root").alias("new"))
    return cut_lineage(roots.join(joined, "root", "left").select("node", F.coalesce("new", "root").alias("root")))


def shared_bands(bands: DataFrame) -> DataFrame:
    """The bands (cls, band) that several classes have."""
    shared = bands.groupBy("band").agg(F.min("cls").alias("a"), F.max("cls").alias("z")).where("a < z").select("band")
    return cut_lineage(bands.join(shared, "band"))


def linked(
    bands: DataFrame,
    sketches: DataFrame,
    texts: DataFrame,
    threshold: float,
    alike: Callable = overlap,
    items: Callable = bag_items,
) -> DataFrame:
    """(node, root): the components of classes that share bands (cls, band) and are alike enough.

    ``sketches`` has (cls, sketch) and ``texts`` (cls, text, size), the text deflated.  ``alike`` is the
    likeness of pairs of texts, and ``items`` gives sets whose Jaccard similarity it is.
    """
    seen = cut_lineage(star_pairs(bands))
    roots = bands.select(F.col("cls").alias("node"), F.col("cls").alias("root")).distinct()
    roots = merged(roots, verified(seen, texts, threshold, alike))
    # Bands whose classes are all connected have nothing more to add, and need not be looked at again.
    bands = cut_lineage(unsettled(bands, roots))
    left = bands.count()
    bands = few_partitions(bands, left)
    pairs = cut_lineage(small_band_pairs(bands).join(seen, ["a", "b"], "left_anti"))
    roots = merged(roots, verified(pairs, texts, threshold, alike))
    bands = cut_lineage(few_partitions(unsettled(bands.select("cls", "band"), roots).where(F.col("n") > ALL_PAIRS), left))
    if bands.isEmpty():
        return roots
    return merged(roots, block_links(bands, band_groups(bands, left), sketches, texts, threshold, items, left))


def rooted(docs: DataFrame, threshold: float) -> DataFrame:
    """(doc_id, text_key, first_doc, root): every row's class, and the least document of the same multiset."""
    signed = cut_lineage(signatures(docs))
    content = ["key_a", "key_b", "empty"]
    # Nulls are the least: they take the place before all numbers.
    exact = signed.groupBy(*content).agg(
        F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id")).alias("least"),
        F.first("bands").alias("bands"),
        F.first("sketch").alias("sketch"),
    )
    exact = cut_lineage(
        exact.select(
            *content,
            F.col("least.doc_id").alias("first_doc"),
            F.xxhash64(*content).alias("cls"),
            "bands",
            "sketch",
        )
    )
    bands = exact.where(~F.col("empty")).select("cls", F.explode("bands").alias("band"))
    bands = shared_bands(bands)
    source = exact.join(bands.select("cls").distinct(), "cls").select("cls", "first_doc")
    # By id first, then by content, as an id may have several texts.
    texts = docs.select("doc_id", "text").join(
        source.select(F.col("first_doc").alias("id")).distinct(), F.col("doc_id").eqNullSafe(F.col("id")), "left_semi"
    )
    texts = texts.mapInArrow(_content_batches, "key_a long, key_b long, empty boolean, text binary, size long")
    texts = texts.select(F.xxhash64(*content).alias("cls"), F.struct("text", "size").alias("text")).join(source.select("cls"), "cls")
    sketches = cut_lineage(exact.join(bands.select("cls").distinct(), "cls").select("cls", "sketch"))
    texts = cut_lineage(texts.groupBy("cls").agg(F.min("text").alias("text")).select("cls", "text.*"))
    roots = linked(bands, sketches, texts, threshold)
    members = exact.join(roots, F.col("cls") == F.col("node"), "left").select(
        *content, "first_doc", F.coalesce("root", "cls").alias("root")
    )
    return signed.select("doc_id", "text_key", *content).join(members, content).drop(*content)


def _least(*columns: str) -> Column:
    """The least of several columns by the first, nulls before all numbers."""
    return F.min(F.struct(F.col(columns[0]).isNotNull().alias("known"), *columns))


def near_classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, class_id, copy_id): each document's class, and the least document with its text.

    One row per distinct doc_id and multiset.
    """
    found = rooted(docs, threshold)
    least = found.groupBy("root").agg(_least("first_doc").alias("least"))
    named = found.join(least, "root").select(
        "doc_id", F.col("least.first_doc").alias("class_id"), F.col("first_doc").alias("copy_id"), "root"
    )
    return named.distinct().drop("root")


def drop_near_copies(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row of each class with all its columns: the least by doc_id, then by hash of the text.

    Of rows with that doc_id and text any one stays.
    """
    found = rooted(docs, threshold)
    chosen = found.groupBy("root").agg(_least("doc_id", "text_key").alias("least"), F.count("*").alias("rows"))
    chosen = cut_lineage(chosen.select(F.col("least.doc_id").alias("id"), F.col("least.text_key").alias("key"), "rows"))
    rows = whole_rows(docs, row_id=F.col("doc_id"), row_key=F.xxhash64("text"))
    same = F.col("row_id").eqNullSafe(F.col("id")) & (F.col("row_key") == F.col("key"))
    # Only in classes of several rows can the chosen row be there twice.
    alone = rows.join(chosen.where("rows = 1").drop("rows"), same, "left_semi")
    several = rows.join(chosen.where("rows > 1").drop("rows"), same, "left_semi").dropDuplicates(["row_id", "row_key"])
    return alone.unionByName(several).select("row.*")
