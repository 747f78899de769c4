"""Benchmark decontamination: passages of documents within a small edit distance of an item.

A passage counts if its edit distance to the item, over UTF-8 bytes, is at most ``EDITS`` of the
item's length.

1. Windows.  A passage within k edits of an item of n bytes shares at least n - 7 - 8k of the
   item's 8-byte grams with it, on diagonals at most 2k apart.  Every gram of the text is looked
   up; where an item has that many on neighbouring diagonals, item-sized windows are laid on the
   diagonal that has most of them and on that of the first.  By the bound no passage is lost here.
2. Embedding.  Windows and items go through the CGK random walk: at every step the current
   byte is put out, and a random bit for (step, byte) says whether to move on.  Texts at a small
   edit distance fall into step again after each edit, so their walks are at a small Hamming distance.
3. Bit-sampling LSH.  ``TABLES`` times, ``SAMPLED`` places of one of ``WALKS`` independent walks are compared; a
   window is a candidate if all places of one table agree.  The number of tables follows from the
   recall aimed at for walks that agree in half of their places (``tables_for``).
4. The exact edit distance of each candidate is computed, with free ends within the window's
   surroundings.

Items are broadcast in slices of at most ``ITEM_BYTES`` of text; a larger benchmark takes
one pass over the documents per slice.

Defined results: null and empty texts contain nothing, null and empty items are contained in
nothing.  Items under 8 bytes allow no edit and are searched for as they are.  Equal items are reported each, and
repeated rows of a document each.  Positions are code points, ends exclusive; of
overlapping passages for one item the closest one is reported, the first of equals.  Further columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotloom.llm.arrow_text import text_slices
from plotloom.llm.rows import whole_rows

EDITS = 0.1
GRAM = 8
WALKS, SAMPLED, RECALL = 4, 4, 0.99
ITEM_BYTES = 16 << 20
SLICE = 2 << 20
_BITS = 22
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def tables_for(recall: float, agreement: float = 0.5) -> int:
    """Tables needed so that a pair whose walks agree with this rate meets in one of them."""
    return math.ceil(math.log(1 - recall) / math.log(1 - agreement**SAMPLED))


TABLES = tables_for(RECALL)


def allowed_edits(length: int) -> int:
    return int(EDITS * length) if length >= GRAM else 0


def _grams(data: bytes) -> np.ndarray:
    """The 8-byte gram at every place, as a number."""
    if len(data) < GRAM:
        return np.empty(0, dtype=np.uint64)
    return np.ndarray((len(data) - GRAM + 1,), dtype="<u8", buffer=data, strides=(1,)).astype(np.uint64)


def _slot(grams: np.ndarray) -> np.ndarray:
    return (grams * _SPREAD) >> np.uint64(64 - _BITS)


def walk_embed(windows: np.ndarray, lengths: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """CGK embedding of byte rows; ``bits`` is (steps, 256).  Past its end a row puts out 0."""
    n, steps = len(windows), len(bits)
    out = np.zeros((steps, n), dtype=np.uint8)
    at = np.zeros(n, dtype=np.int64)
    rows = np.arange(n)
    last = windows.shape[1] - 1
    for t in range(steps):
        here = np.where(at < lengths, windows[rows, np.minimum(at, last)], 0)
        out[t] = here
        at += bits[t, here]
    return out


def _edit_ends(pattern: bytes, text: bytes) -> list[int]:
    """For every end in ``text``, the least edit distance of ``pattern`` to a substring that ends there.

    Bit-parallel dynamic programming; one number holds a whole column.
    """
    m = len(pattern)
    full = (1 << m) - 1
    where: dict[int, int] = {}
    for i, c in enumerate(pattern):
        where[c] = where.get(c, 0) | (1 << i)
    high = 1 << (m - 1)
    up, down, score = full, 0, m
    out = []
    for c in text:
        eq = where.get(c, 0)
        vertical = eq | down
        diagonal = (((eq & up) + up) ^ up) | eq
        rise = down | ~(diagonal | up) & full
        fall = up & diagonal
        if rise & high:
            score += 1
        elif fall & high:
            score -= 1
        rise = (rise << 1) & full
        fall = (fall << 1) & full
        up = (fall | ~(vertical | rise)) & full
        down = rise & vertical
        out.append(score)
    return out


def closest(item: bytes, text: bytes, low: int, high: int) -> tuple[int, int, int] | None:
    """(distance, start, end) of the closest passage in text[low:high], if it is close enough."""
    part = text[low:high]
    if not part:
        return None
    scores = _edit_ends(item, part)
    best = min(scores)
    if best > allowed_edits(len(item)):
        return None
    end = scores.index(best) + 1
    # The longest passage with that end and distance: its start is found backwards.
    back = _edit_ends(item[::-1], part[:end][::-1])
    size = max(i + 1 for i, s in enumerate(back) if s == best)
    return best, low + end - size, low + end


@dataclass
class Items:
    """A slice of the benchmark with its gram table and walks."""

    ids: list[int]
    texts: list[bytes]

    def __post_init__(self):
        lengths = np.array([len(t) for t in self.texts], dtype=np.int64)
        self.lengths = lengths
        self.short = np.flatnonzero((lengths > 0) & (lengths < GRAM)).tolist()
        self.edits = np.array([allowed_edits(n) for n in lengths], dtype=np.int64)
        self.need = np.maximum(lengths - GRAM + 1 - GRAM * self.edits, 1)
        counts = np.maximum(lengths - GRAM + 1, 0)
        grams = np.concatenate([_grams(t) for t in self.texts] or [np.empty(0, np.uint64)])
        owner = np.repeat(np.arange(len(self.texts)), counts)
        offset = np.arange(len(grams)) - np.repeat(np.cumsum(counts) - counts, counts)
        order = np.argsort(grams, kind="stable")
        self.owner, self.offset = owner[order], offset[order]
        self.grams, first = np.unique(grams[order], return_index=True)
        self.bounds = np.concatenate((first, [len(grams)]))
        self.slots = np.zeros(1 << _BITS, dtype=bool)
        self.slots[_slot(self.grams)] = True
        draw = np.random.Generator(np.random.PCG64(99))
        # Most rows are used up after about twice their length; places beyond tell nothing.
        self.steps = int(1.8 * lengths.max()) + 1 if len(lengths) else 0
        self.bits = draw.integers(0, 2, (WALKS, self.steps, 256), dtype=np.uint8)
        self.shares = draw.random((WALKS, math.ceil(TABLES / WALKS), SAMPLED))
        rows = self._rows(self.texts)
        self.walks = [walk_embed(rows, lengths, self.bits[w]) for w in range(WALKS)] if len(lengths) else []

    def _rows(self, windows: list[bytes]) -> np.ndarray:
        width = max(int(self.lengths.max()), 1)
        return np.frombuffer(b"".join(w.ljust(width, b"\0") for w in windows), dtype=np.uint8).reshape(-1, width)

    def candidates(self, texts: list[bytes]) -> list[list[tuple[int, int]]]:
        """Per text, (item, start) of windows that share enough grams with the item; see the module."""
        out: list[list[tuple[int, int]]] = [[] for _ in texts]
        gap = b"\0" * GRAM
        grams = _grams(gap.join(texts) + gap)
        places = np.flatnonzero(self.slots[_slot(grams)])
        if not len(places) or not len(self.grams):
            return out
        found = np.minimum(np.searchsorted(self.grams, grams[places]), len(self.grams) - 1)
        hit = self.grams[found] == grams[places]
        places, found = places[hit], found[hit]
        counts = self.bounds[found + 1] - self.bounds[found]
        sizes = np.fromiter((len(t) + GRAM for t in texts), dtype=np.int64, count=len(texts))
        begins = np.cumsum(sizes) - sizes
        text = np.searchsorted(begins, places, side="right") - 1
        entry = np.repeat(self.bounds[found] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        item = self.owner[entry]
        pair = np.repeat(text, counts) * len(self.texts) + item
        # Only where a whole text shares enough grams with an item can a window do so.
        if len(texts) * len(self.texts) <= 8 * max(len(pair), 1 << 16):
            enough = np.bincount(pair, minlength=len(texts) * len(self.texts))[pair] >= self.need[item]
        else:
            _, inverse, number = np.unique(pair, return_inverse=True, return_counts=True)
            enough = number[inverse] >= self.need[item]
        entry, item, pair = entry[enough], item[enough], pair[enough]
        if not len(pair):
            return out
        offset = self.offset[entry]
        start = np.repeat(places - begins[text], counts)[enough] - offset
        # Cells of 2k + 1 diagonals: a passage lies in two neighbouring ones at most.
        reach = int(self.lengths.max())
        cell = (start + reach) // (2 * self.edits[item] + 1)
        _, number = np.unique(pair, return_inverse=True)
        key = (number.astype(np.int64) << 32) + cell
        order = np.argsort(key, kind="stable")
        key = key[order]
        heads = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        size = np.diff(np.concatenate((heads, [len(key)])))
        cells = key[heads]
        follows = np.concatenate((cells[1:] == cells[:-1] + 1, [False]))
        joint = size + np.where(follows, np.concatenate((size[1:], [0])), 0)
        for i in np.flatnonzero(joint >= self.need[item[order[heads]]]):
            own = order[heads[i] : heads[i] + joint[i]]
            starts = start[own]
            values, n = np.unique(starts, return_counts=True)
            to = out[int(pair[own[0]]) // len(self.texts)]
            for pick in {int(values[n.argmax()]), int(starts[offset[own].argmin()])}:
                to.append((int(item[own[0]]), pick))
        return out

    def collide(self, pairs: list[tuple[int, int, int]], texts: list[bytes]) -> np.ndarray:
        """Which (text, item, start) windows agree with their item in all places of some table."""
        item = np.array([p[1] for p in pairs])
        lengths = self.lengths[item]
        windows = [texts[t][max(s, 0) : max(s, 0) + int(n)] for (t, _, s), n in zip(pairs, lengths)]
        rows, sizes = self._rows(windows), np.array([len(w) for w in windows])
        longest = int(1.8 * lengths.max()) + 1
        hit = np.zeros(len(pairs), dtype=bool)
        column = np.arange(len(pairs))
        for w in range(WALKS):
            walk = walk_embed(rows, sizes, self.bits[w][:longest])
            for shares in self.shares[w]:
                agree = np.ones(len(pairs), dtype=bool)
                for share in shares:
                    place = (share * 1.8 * lengths).astype(np.int64)
                    agree &= walk[place, column] == self.walks[w][place, item]
                hit |= agree
        return hit

    def search(self, texts: list[bytes]) -> list[list[tuple[int, int, int, int]]]:
        """The passages of each text."""
        windows = [(t, i, s) for t, own in enumerate(self.candidates(texts)) for i, s in sorted(set(own))]
        near: dict[int, list[tuple[int, int]]] = {}
        for begin in range(0, len(windows), 4096):  # a fixed amount of memory
            part = windows[begin : begin + 4096]
            for (t, item, start), hit in zip(part, self.collide(part, texts)):
                if hit:
                    near.setdefault(t, []).append((item, start))
        if self.short:
            return [self.passages(text, near.get(t, [])) for t, text in enumerate(texts)]
        return [self.passages(texts[t], near[t]) if t in near else [] for t in range(len(texts))]

    def passages(self, text: bytes, windows: list[tuple[int, int]]) -> list[tuple[int, int, int, int]]:
        """(item, start, end, distance) in bytes; of overlapping ones per item the closest."""
        found: set[tuple[int, int, int, int]] = set()
        for item, start in windows:
            slack = 3 * int(self.edits[item])
            low, high = max(start - slack, 0), start + int(self.lengths[item]) + slack
            close = closest(self.texts[item], text, low, high)
            if close:
                found.add((item, close[1], close[2], close[0]))
        for item in self.short:
            at = text.find(self.texts[item])
            while at >= 0:
                found.add((item, at, at + int(self.lengths[item]), 0))
                at = text.find(self.texts[item], at + int(self.lengths[item]))
        kept: list[tuple[int, int, int, int]] = []
        taken: dict[int, list[tuple[int, int]]] = {}
        for passage in sorted(found, key=lambda p: (p[0], p[3], p[1])):
            spans = taken.setdefault(passage[0], [])
            if all(passage[2] <= a or passage[1] >= b for a, b in spans):
                spans.append((passage[1], passage[2]))
                kept.append(passage)
        return sorted(kept)


def item_slices(benchmark: DataFrame) -> Iterator[Items]:
    """The benchmark in slices of bounded size; slices are formed by hash of the item's text."""
    rows = benchmark.where("text is not null and text <> ''").select("item_id", "text")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # Half full on average, so that none is likely to go beyond the bound.
    number = max(1, math.ceil(2 * total / ITEM_BYTES)) if total > ITEM_BYTES else 1
    for i in range(number):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(number)) == i).collect()
        if part:
            part.sort(key=lambda r: (r["item_id"] is not None, r["item_id"] or 0, r["text"]))
            yield Items([r["item_id"] for r in part], [r["text"].encode() for r in part])


def find_passages(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, start, end, distance): every passage of a document that is close to an item."""
    return keyed_passages(docs, benchmark).drop("text_key")


def keyed_passages(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The passages with ``text_key``, the hash of the text that each was found in."""
    schema = "doc_id long, text_key long, item_id long, start long, end long, distance int"
    spark = docs.sparkSession
    # No rows, made without Python: a list would take workers of its own on every executor.
    fields = [field.split() for field in schema.split(", ")]
    result = spark.range(0).select(*[F.lit(None).cast(kind).alias(name) for name, kind in fields])
    for items in item_slices(benchmark):
        shared = spark.sparkContext.broadcast(items)

        def search(batches: Iterable[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = shared.value
            for part, texts in text_slices(batches, limit=SLICE):
                rows = []
                ids, keys = part.column("doc_id").to_pylist(), part.column("text_key").to_pylist()
                for doc_id, key, text, passages in zip(ids, keys, texts, items.search(texts)):
                    for item, start, end, distance in passages:
                        first = len(text[:start].decode(errors="ignore"))
                        size = len(text[start:end].decode(errors="ignore"))
                        rows.append((doc_id, key, items.ids[item], first, first + size, distance))
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]
                names = ["doc_id", "text_key", "item_id", "start", "end", "distance"]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        result = result.union(docs.select("doc_id", "text", F.xxhash64("text").alias("text_key")).mapInArrow(search, schema))
    return result


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any such passage; all columns.  Decisions are by doc_id, null too, and text."""
    hits = keyed_passages(docs, benchmark).select(F.col("doc_id").alias("hit_id"), F.col("text_key").alias("hit_key")).distinct()
    rows = whole_rows(docs, row_id=F.col("doc_id"), row_key=F.xxhash64("text"))
    same = F.col("row_id").eqNullSafe(F.col("hit_id")) & (F.col("row_key") == F.col("hit_key"))
    return rows.join(hits, same, "left_anti").select("row.*")
