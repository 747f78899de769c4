"""Document fingerprints: MinHash signatures, their likeness, and verified similar pairs.

A signature has ``PERMUTATIONS`` places.  Place p is the least value of the universal hash
(a_p * x + b_p) mod 2^64 / 2^32 over the text's five-word shingles x (32 bits of the shingle's
hash); all of them are computed in numpy, batch by batch.  Two signatures agree in a place with
the Jaccard similarity of the shingle sets as probability, so the share of equal places is their likeness.

``fingerprints`` gives signatures, ``similar_pairs`` joins signature bands in Spark and keeps the
pairs whose exact Jaccard similarity reaches the threshold, ``near_groups`` connects all rows by such
pairs, ``with_edits`` compares every text with an edited version of itself and with its neighbour by
descending doc_id, and ``with_groups`` adds each row's group to that.

Defined results: null counts as the empty text.  A text without words has the signature of
no shingle (all places at their greatest value); two such texts are equal (likeness 1), and
one of them against a text with words has likeness 0.  Texts of one to four words have one
shingle.  Neighbours of equal doc_id are ordered by text; a null doc_id is the least.  With
one document, that document is its own neighbour.  Further columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotloom.llm.arrow_text import SLICE_BYTES, text_slices
from plotloom.llm.near_dedup import linked
from plotloom.llm.words import batch_shingles, mix, multisets
from plotloom.operators.sizing import cut_lineage
from plotloom.session import shuffle_partitions

PERMUTATIONS = 128
# 32 bands of 4 places: a pair at 0.8 shares a band with probability 1 - 5e-8.
BAND_ROWS = 4
THRESHOLD = 0.8
# Shingles hashed by all permutations at once, so that they stay in the cache.
CHUNK = 1 << 14
NOTHING = np.uint32(0xFFFFFFFF)
# Band keys that a task gathers before it packs them.
GATHERED = 1 << 20
# Bits that say which texts may be needed.
FILTER_BITS = 1 << 25
# Bytes of text that are sorted by range, and deflated, at once.
PACKED_BYTES = 8 << 20
# Stands for a null doc_id.
LEAST_ID = -(1 << 63)

_random = np.random.Generator(np.random.PCG64(20240607))
_A = _random.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _random.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64)


def signatures(shingles: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One row of 32-bit minima per text."""
    out = np.full((len(bounds) - 1, PERMUTATIONS), NOTHING, dtype=np.uint32)
    values = shingles >> np.uint64(32)
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    work = np.empty(min(CHUNK, len(values)), dtype=np.uint64)
    for begin in range(0, len(values), CHUNK):
        x = values[begin : begin + CHUNK]
        own = owner[begin : begin + CHUNK]
        heads = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
        texts = own[heads]
        buffer = work[: len(x)]
        for p in range(PERMUTATIONS):
            np.multiply(x, _A[p], out=buffer)
            buffer += _B[p]
            least = (np.minimum.reduceat(buffer, heads) >> np.uint64(32)).astype(np.uint32)
            out[texts, p] = np.minimum(out[texts, p], least)
    return out


def likeness(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return (left == right).mean(axis=1)


def as_text(signature: np.ndarray) -> list[str]:
    """Eight hex digits per place."""
    data = signature.astype(">u4").tobytes()
    width = PERMUTATIONS * 4
    return [data[i : i + width].hex() for i in range(0, len(data), width)]


def _signature_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in text_slices(batches):
        found = signatures(*batch_shingles(texts))
        flat = pa.array(found.reshape(-1).view(np.int32))
        offsets = pa.array(np.arange(len(texts) + 1, dtype=np.int32) * PERMUTATIONS)
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.ListArray.from_arrays(offsets, flat)], ["doc_id", "signature"]
        )


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, signature) of every row."""
    return docs.select("doc_id", "text").mapInArrow(_signature_batches, "doc_id long, signature array<int>")


def _jaccard(left: list[bytes], right: list[bytes]) -> np.ndarray:
    shingles, bounds = batch_shingles(left + right)
    n = len(left)
    out = np.empty(n)
    for i in range(n):
        a = np.unique(shingles[bounds[i] : bounds[i + 1]])
        b = np.unique(shingles[bounds[n + i] : bounds[n + i + 1]])
        common = len(np.intersect1d(a, b, assume_unique=True))
        union = len(a) + len(b) - common
        out[i] = common / union if union else 1.0
    return out


def _set_items(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text, and how many each has."""
    owner, values, _ = multisets(*batch_shingles(texts))
    return values, np.bincount(owner, minlength=len(texts))


def _band_keys(found: np.ndarray) -> np.ndarray:
    """One 64-bit key per text and band, different between bands."""
    grouped = found.astype(np.uint64).reshape(len(found), -1, BAND_ROWS)
    keys = np.broadcast_to(np.arange(1, grouped.shape[1] + 1, dtype=np.uint64), grouped.shape[:2])
    for j in range(BAND_ROWS):
        keys = mix(keys ^ grouped[:, :, j]) + np.uint64(j)
    return keys


def signature_class(keys: np.ndarray) -> np.ndarray:
    """A 64-bit name per text from its band keys, equal for equal signatures."""
    own = np.zeros(len(keys), dtype=np.uint64)
    for j in range(keys.shape[1]):
        own = mix(own ^ keys[:, j]) + np.uint64(j)
    return own.view(np.int64)


_ENTRIES = "part int, bands binary, classes binary, ids array<long>, text_keys array<long>, own array<long>"


def _entries(partitions: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Band keys with their classes, packed by hash of the key, and the rows (doc_id, text_key, class) beside them."""

    def rows(gathered: list[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        own = np.concatenate([g[1] for g in gathered])
        keys = np.concatenate([g[2] for g in gathered])
        # The copies gathered here need their bands only once.
        classes, first = np.unique(own, return_index=True)
        flat = keys[first].reshape(-1)
        classes = np.repeat(classes, keys.shape[1])
        part = (flat % np.uint64(partitions)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        flat, classes, part = flat[order], classes[order], part[order]
        bounds = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1], [True])))
        spans = list(zip(bounds[:-1].tolist(), bounds[1:].tolist()))
        longs = pa.list_(pa.int64())
        members = [[v for g in gathered for v in g[0].column(c).to_pylist()] for c in ("doc_id", "text_key")]
        rest = [[]] * (len(spans) - 1)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(part[bounds[:-1]], pa.int32()),
                pa.array([flat[a:b].tobytes() for a, b in spans], pa.binary()),
                pa.array([classes[a:b].tobytes() for a, b in spans], pa.binary()),
                *[pa.array([values, *rest], longs) for values in (*members, own.tolist())],
            ],
            ["part", "bands", "classes", "ids", "text_keys", "own"],
        )

    def entries(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered, size = [], 0
        for part, texts in text_slices(batches):
            keys = _band_keys(signatures(*batch_shingles(texts)))
            gathered.append((part.select(["doc_id", "text_key"]), signature_class(keys), keys))
            size += keys.size
            if size >= GATHERED:
                yield from rows(gathered)
                gathered, size = [], 0
        if gathered:
            yield from rows(gathered)

    return entries


_BANDED = "band long, cls long, doc_id long, text_key long"


def _banded(band, cls, doc_id, text_key) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(v, pa.int64()) for v in (band, cls, doc_id, text_key)], ["band", "cls", "doc_id", "text_key"]
    )


def _unpacked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per band and class, and, without a band, per row of the table."""
    for batch in batches:
        for _, bands, classes, ids, text_keys, own in zip(*[column.to_pylist() for column in batch.columns]):
            band = np.frombuffer(bands, dtype=np.int64)
            yield _banded(band, np.frombuffer(classes, dtype=np.int64), [None] * len(band), [None] * len(band))
            if own:
                yield _banded([None] * len(own), own, ids, text_keys)


def _shared(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows by band and class, each once: those whose band has several classes, and all without a band.

    Streams: only the last row of a batch is held, with whether it has been given out.
    """
    held, given = np.empty((2, 0), dtype=np.int64), False
    for batch in batches:
        without = batch.filter(pc.is_null(batch.column("band")))
        if without.num_rows:
            yield without
        batch = batch.filter(pc.is_valid(batch.column("band")))
        rows = np.hstack((held, np.array([np.asarray(batch.column(c)) for c in ("band", "cls")], dtype=np.int64)))
        if not rows.shape[1]:
            continue
        same = rows[0, 1:] == rows[0, :-1]
        once = np.concatenate(([True], ~(same & (rows[1, 1:] == rows[1, :-1]))))
        rows = rows[:, once]
        same = rows[0, 1:] == rows[0, :-1]
        shared = np.concatenate(([False], same)) | np.concatenate((same, [False]))
        last = bool(shared[-1]) or (given and rows.shape[1] == 1)
        if given:
            shared[0] = False
        held, given = rows[:, -1:], last
        none = [None] * int(shared.sum())
        yield _banded(rows[0, shared], rows[1, shared], none, none)


def _deflated(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in text_slices(batches):
        found = signatures(*batch_shingles(texts))
        values = [
            pa.array(signature_class(_band_keys(found))),
            pa.array([zlib.compress(t, 1) for t in texts], pa.binary()),
            pa.array([len(t) for t in texts], pa.int64()),
            pa.array([row.tobytes() for row in found.astype(np.uint8)], pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), part.column("text_key"), *values], ["doc_id", "text_key", "own", "text", "size", "sketch"]
        )


def _likely_rows(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id is in ``ids`` (id), and a few others.

    By a bitmap of hashes, of one size whatever the table: more ids let more other rows through, and a
    join sorts them out.  So texts that are not needed are not shuffled.
    """
    # Spark's bitmaps count from one.
    place = F.pmod(F.xxhash64("id"), F.lit(FILTER_BITS)) + 1
    bits = ids.select(F.bitmap_bucket_number(place).alias("bucket"), F.bitmap_bit_position(place).alias("bit"))
    maps = bits.repartition("bucket").groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).collect()
    known = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    for row in maps:
        own = np.frombuffer(row["bits"], dtype=np.uint8)
        begin = (row["bucket"] - 1) * len(own)
        known[begin : begin + len(own)] = own
    table = docs.sparkSession.sparkContext.broadcast(known)

    @F.pandas_udf("boolean")
    def likely(places: pd.Series) -> pd.Series:
        at = places.to_numpy()
        return pd.Series((table.value[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool))

    return docs.where(likely(F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))))


def _classes(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (doc_id, text_key, cls), and of the classes shared bands, and texts (cls, text, size, sketch), deflated.

    Rows of one signature are a class, so copies are never expanded.  Bands are shuffled once, packed, and
    only those of several classes are kept; texts are those of classes in such bands.
    """
    partitions = shuffle_partitions(docs.sparkSession)
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    packed = keyed.mapInArrow(_entries(partitions), _ENTRIES).repartition(partitions, "part")
    banded = packed.mapInArrow(_unpacked, _BANDED).sortWithinPartitions("band", "cls")
    kept = cut_lineage(banded.mapInArrow(_shared, _BANDED))
    signed = kept.where("band is null").select("doc_id", "text_key", "cls")
    bands = kept.where("band is not null").select("cls", "band")
    # One row of each class: by id, nulls being the least, then by text.
    least = F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "text_key")).alias("least")
    used = signed.join(bands.select("cls").distinct(), "cls").groupBy("cls").agg(least)
    used = cut_lineage(used.select("cls", F.col("least.doc_id").alias("id"), F.col("least.text_key").alias("key")))
    schema = "doc_id long, text_key long, own long, text binary, size long, sketch binary"
    texts = _likely_rows(keyed, used.select("id")).mapInArrow(_deflated, schema)
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_key") == F.col("key"))
    texts = used.join(texts, (F.col("cls") == F.col("own"))).where(same)
    texts = texts.groupBy("cls").agg(F.first(F.struct("text", "size", "sketch")).alias("text")).select("cls", "text.*")
    return signed, bands, cut_lineage(texts)


def similar_pairs(docs: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(members, pairs): membership of signature classes, and verified pairs of classes.

    ``members`` has (doc_id, text_key, class_id).  All pairs of classes that share a band are verified;
    ``pairs`` has (a, b, similarity), the lesser class first.
    """
    signed, bands, texts = _classes(docs)
    # Nulls are the least: they take the place before all numbers.
    least = F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id")).alias("least")
    names = cut_lineage(signed.groupBy("cls").agg(least).select("cls", F.col("least.doc_id").alias("class_id")))
    pairs = (
        bands.alias("x")
        .join(bands.alias("y"), "band")
        .where("x.cls < y.cls")
        .select(F.col("x.cls").alias("a"), F.col("y.cls").alias("b"))
        .distinct()
    )
    left = texts.join(names, "cls").select(F.col("cls").alias("a"), F.col("text").alias("left"), F.col("class_id").alias("p"))
    right = texts.join(names, "cls").select(F.col("cls").alias("b"), F.col("text").alias("right"), F.col("class_id").alias("q"))

    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, lefts in text_slices(batches, "left", SLICE_BYTES // 4):
            rights = part.column("right").to_pylist()
            found = _jaccard([zlib.decompress(t) for t in lefts], [zlib.decompress(t) for t in rights])
            kept = part.select(["p", "q"]).append_column("similarity", pa.array(found))
            yield kept.filter(pa.array(found >= threshold))

    both = pairs.join(left, "a").join(right, "b").select("p", "q", "left", "right")
    found = both.mapInArrow(verify, "p long, q long, similarity double")
    lesser = F.col("p").isNull() | (F.col("q").isNotNull() & (F.col("p") <= F.col("q")))
    pairs = found.select(
        F.when(lesser, F.col("p")).otherwise(F.col("q")).alias("a"),
        F.when(lesser, F.col("q")).otherwise(F.col("p")).alias("b"),
        "similarity",
    )
    return signed.join(names, "cls").select("doc_id", "text_key", "class_id"), pairs


def near_groups(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, cls, group_id) of the rows whose group, the rows that verified pairs connect, has a lesser doc_id.

    ``cls`` is the signature class, ``group_id`` the least doc_id of the group.
    """
    signed, bands, texts = _classes(docs)
    roots = linked(bands, texts.select("cls", "sketch"), texts.select("cls", "text", "size"), threshold, _jaccard, _set_items)
    placed = signed.join(roots, F.col("cls") == F.col("node"), "left").select("doc_id", "cls", F.coalesce("root", "cls").alias("root"))
    least = F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id")).alias("least")
    groups = placed.groupBy("root").agg(least, F.count("*").alias("n")).where("n > 1")
    found = placed.join(groups.select("root", F.col("least.doc_id").alias("group_id")), "root")
    return found.where(~F.col("doc_id").eqNullSafe(F.col("group_id"))).select("doc_id", "cls", "group_id").distinct()


def with_groups(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``with_edits``, and as ``group_id`` the least doc_id of the rows that each is connected with."""
    return _neighbours(docs, cut_lineage(near_groups(docs, threshold)))


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def id_blocks(docs: DataFrame, blocks: int) -> list[int]:
    """Ascending first ids of at most ``blocks`` ranges with about equally many rows each."""
    ids = docs.select("doc_id").where("doc_id is not null").repartitionByRange(blocks, "doc_id")
    lows = ids.groupBy(F.spark_partition_id().alias("p")).agg(F.min("doc_id").alias("low")).collect()
    return sorted(row["low"] for row in lows)


def with_edits(docs: DataFrame) -> DataFrame:
    """Every document beside its edited text and its neighbour by descending doc_id.

    (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).
    """
    return _neighbours(docs, None).drop("group_id")


def _neighbours(docs: DataFrame, groups: DataFrame | None) -> DataFrame:
    """``with_edits`` and the ``group_id`` that ``groups`` (doc_id, cls, group_id) gives, else the row's own doc_id.

    Ids are cut into ranges, one per shuffle partition.  Each range also gets the row
    that follows its last one, the greatest of the next range that has rows, so every text
    is shuffled once, deflated with others of its range, and only one row per range twice; no row of a
    range is needed elsewhere.  Rows of ``groups`` go the same way, ahead of their documents; a task
    holds those of one doc_id.
    """
    blocks = shuffle_partitions(docs.sparkSession)
    lows = np.array(id_blocks(docs, blocks), dtype=np.int64)

    # Null ids come after all others in descending order: they are with the least ids.
    number = F.coalesce("doc_id", F.lit(LEAST_ID))

    @F.pandas_udf("int")
    def block_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.maximum(np.searchsorted(lows, ids.to_numpy(), side="right") - 1, 0).astype("int32"))

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    heads = sorted(
        (row["block"], row["head"])
        for row in rows.select(block_of(number).alias("block"), number.alias("id"))
        .groupBy("block")
        .agg(F.max("id").alias("head"))
        .collect()
    )
    # The head of each range also goes to the next higher range that has rows; the top one's to the lowest.
    targets = {head: heads[(i + 1) % len(heads)][0] for i, (_, head) in enumerate(heads)}
    known = np.array(sorted(targets), dtype=np.int64)
    goals = np.array([targets[h] for h in known.tolist()], dtype=np.int32)

    @F.pandas_udf("int")
    def goal_of(ids: pd.Series) -> pd.Series:
        """The range that an id follows, -1 for all but heads."""
        place = np.minimum(np.searchsorted(known, ids.to_numpy()), len(known) - 1)
        return pd.Series(np.where(known[place] == ids.to_numpy(), goals[place], -1).astype("int32"))

    placed = rows.withColumns({"block": block_of(number), "goal": goal_of(number)})
    packed = placed.select("doc_id", "text", "block", "goal").mapInArrow(_packed_texts, _PACKED)
    if groups is not None:
        moved = groups.select("doc_id", "cls", "group_id", block_of(number).alias("block"))
        packed = packed.unionByName(moved.mapInArrow(_packed_groups, _PACKED))
    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
        " near_edited double, near_next double, group_id long"
    )
    rows = packed.repartition(blocks, "block").mapInArrow(_unpacked_rows, _ROWS)
    # A null text, of a row of groups, comes first.
    ordered = rows.sortWithinPartitions("block", "extra", F.col("doc_id").desc_nulls_last(), F.col("text"))
    return ordered.mapInArrow(_edit_batches, schema)


_PACKED = "block int, extra boolean, doc_ids array<long>, sizes array<int>, texts binary, classes array<long>, groups array<long>"
_PACKED_NAMES = ["block", "extra", "doc_ids", "sizes", "texts", "classes", "groups"]
_ROWS = "block int, extra boolean, doc_id long, text string, cls long, group_id long"


def _by_block(blocks: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each block and its places."""
    order = np.argsort(blocks, kind="stable")
    for places in np.split(order, np.flatnonzero(np.diff(blocks[order])) + 1):
        if len(places):
            yield int(blocks[places[0]]), places


def _packed_row(block: int, extra: bool, ids: list, sizes: list, texts: bytes | None, classes: list, groups: list):
    values = ([block], [extra], [ids], [sizes], [texts], [classes], [groups])
    longs = pa.list_(pa.int64())
    types = (pa.int32(), pa.bool_(), longs, pa.list_(pa.int32()), pa.binary(), longs, longs)
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types)], _PACKED_NAMES)


def _packed_texts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of one block deflated together; those with a goal also for that block, as extra ones."""
    codec = pa.Codec("zstd", 3)
    for part, texts in text_slices(batches, "text", PACKED_BYTES):
        ids, block, goal = (part.column(c) for c in ("doc_id", "block", "goal"))
        goal = np.asarray(goal)
        heads = np.flatnonzero(goal >= 0)
        for extra, places, targets in ((False, np.arange(len(texts)), np.asarray(block)), (True, heads, goal[heads])):
            for target, at in _by_block(targets):
                rows = places[at].tolist()
                own = [texts[i] for i in rows]
                joined = codec.compress(b"".join(own), asbytes=True)
                yield _packed_row(target, extra, [ids[i].as_py() for i in rows], [len(t) for t in own], joined, [], [])


def _packed_groups(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, classes, groups = (batch.column(c) for c in ("doc_id", "cls", "group_id"))
        for block, places in _by_block(np.asarray(batch.column("block"))):
            yield _packed_row(block, False, ids.take(places).to_pylist(), [], None, classes.take(places).to_pylist(), groups.take(places).to_pylist())


def _unpacked_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    codec = pa.Codec("zstd")
    for batch in batches:
        for row in range(batch.num_rows):
            block, extra, ids, sizes, texts, classes, groups = (column[row].as_py() for column in batch.columns)
            n = len(ids)
            if texts is None:
                text = pa.nulls(n, pa.string())
            else:
                ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
                text = pa.StringArray.from_buffers(n, pa.py_buffer(ends), codec.decompress(texts, int(ends[-1])))
                classes = groups = [None] * n
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([block] * n, pa.int32()),
                    pa.array([extra] * n, pa.bool_()),
                    pa.array(ids, pa.int64()),
                    text,
                    pa.array(classes, pa.int64()),
                    pa.array(groups, pa.int64()),
                ],
                ["block", "extra", "doc_id", "text", "cls", "group_id"],
            )


def _pairs_in_order(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int | None, str, str, dict[int, int | None]]]:
    """(doc_id, text, next text, groups by class) from rows sorted by block, extra last, then by order.

    Streams: only one row is held back, and the groups of its doc_id, which come first.  Of several rows that follow
    a block (equal ids) the first counts; a block's own rows all precede them.
    """
    held: tuple[int, int | None, str, dict] | None = None
    owner, places = None, {}
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(6)]
        for block, extra, doc_id, text, cls, group in zip(*columns):
            if text is None:
                if owner != doc_id:
                    owner, places = doc_id, {}
                places[cls] = group
                continue
            if held is not None and held[0] == block:
                yield held[1], held[2], text, held[3]
                held = None
            if not extra:
                held = (block, doc_id, text, places if owner == doc_id else {})


def _edit_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    group: list[tuple[int | None, str, str, dict]] = []
    size = 0

    def finish() -> pa.RecordBatch:
        changed = [edited(text, following) for _, text, following, _ in group]
        texts = [text.encode() for _, text, *_ in group]
        n = len(group)
        # The next row's text is that row's own text, so it is hashed once if it is in the group.
        last = group[-1][2].encode()
        found = signatures(*batch_shingles([*texts, last, *[c.encode() for c in changed]]))
        own, after, edits = found[:n], found[1 : n + 1].copy(), found[n + 1 :]
        for i in range(n - 1):
            if group[i][2] is not group[i + 1][1]:
                after[i] = signatures(*batch_shingles([group[i][2].encode()]))[0]
        classes = signature_class(_band_keys(own)).tolist()
        return pa.RecordBatch.from_arrays(
            [
                pa.array([g[0] for g in group], pa.int64()),
                pa.array([len(g[1]) for g in group], pa.int64()),
                pa.array([hashlib.sha256(c.encode()).hexdigest() for c in changed]),
                pa.array(as_text(own)),
                pa.array(as_text(edits)),
                pa.array(likeness(own, edits)),
                pa.array(likeness(own, after)),
                pa.array([g[3].get(cls, g[0]) for g, cls in zip(group, classes)], pa.int64()),
            ],
            ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "group_id"],
        )

    for item in _pairs_in_order(batches):
        group.append(item)
        size += len(item[1])
        if size >= 1 << 20:
            yield finish()
            group, size = [], 0
    if group:
        yield finish()
