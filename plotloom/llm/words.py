"""Words, word hashes and five-word shingles of whole batches of texts, vectorised in numpy.

A word is a longest run of characters other than the six ASCII blanks.  A shingle is five
consecutive words; a text of one to four words has one shingle of all its words, and an empty
one has none.  All hashes are fixed functions of the bytes, the same on every machine.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

SHINGLE_WORDS = 5
# Bytes hashed at once; texts are cut there between words, never within one.
PIECE = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
# Five odd factors, one for each word of a shingle.
_FACTORS = np.array(
    [0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5, 0xFF51AFD7ED558CCD],
    dtype=np.uint64,
)
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit changes every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = PIECE + 1 if n <= PIECE + 1 else n
    if size not in _POWERS:
        tables = []
        for base in (_BASE, _INVERSE):
            powers = np.full(size, base, dtype=np.uint64)
            powers[0] = 1
            tables.append(np.cumprod(powers, dtype=np.uint64))
        if size != PIECE + 1:  # one very long word; not kept
            return tables[0], tables[1]
        _POWERS[size] = (tables[0], tables[1])
    return _POWERS[size]


def _piece_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of each word of a byte array."""
    blank = _BLANK[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], blank, [True])).view(np.int8)))
    starts, ends = edge[0::2], edge[1::2]
    up, down = _powers(len(data) + 1)
    sums = np.empty(len(data) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts]), starts


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of each word."""
    array = np.frombuffer(data, dtype=np.uint8)
    found, at = [], 0
    while at < len(array):
        end = min(at + PIECE, len(array))
        if end < len(array):
            blanks = np.flatnonzero(_BLANK[array[at:end]])
            while not len(blanks) and end < len(array):  # a word longer than a piece
                end = min(end + PIECE, len(array))
                blanks = np.flatnonzero(_BLANK[array[at:end]])
            if end < len(array):
                end = at + int(blanks[-1]) + 1
        hashes, starts = _piece_hashes(array[at:end])
        found.append((hashes, starts + at))
        at = end
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def batch_shingles(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all texts in order, and where each text's begin (one more entry)."""
    sizes = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    hashes, starts = word_hashes(b" ".join(texts) + b" ")
    bounds = np.searchsorted(starts, np.concatenate(([0], np.cumsum(sizes))))
    counts = np.diff(bounds)
    n = len(hashes)
    padded = np.concatenate((hashes, np.zeros(SHINGLE_WORDS, np.uint64)))
    full = np.zeros(n, np.uint64)
    for j in range(SHINGLE_WORDS):
        full += padded[j : j + n] * _FACTORS[j]
    # A place begins a shingle if five words of its text follow, or if it begins a short text.
    keep = np.zeros(n + 1, dtype=np.int64)
    np.add.at(keep, bounds[:-1][counts >= SHINGLE_WORDS], 1)
    np.add.at(keep, (bounds[1:] - SHINGLE_WORDS + 1)[counts >= SHINGLE_WORDS], -1)
    flags = np.cumsum(keep[:n]) > 0
    for d in np.flatnonzero((counts > 0) & (counts < SHINGLE_WORDS)):
        words = hashes[bounds[d] : bounds[d + 1]]
        full[bounds[d]] = (words * _FACTORS[: len(words)]).sum(dtype=np.uint64) + np.uint64(len(words))
        flags[bounds[d]] = True
    per_text = np.where(counts >= SHINGLE_WORDS, counts - SHINGLE_WORDS + 1, np.minimum(counts, 1))
    return mix(full[flags]), np.concatenate(([0], np.cumsum(per_text)))


def multisets(shingles: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, count) of the distinct shingles of each text, by text and shingle."""
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((shingles, owner))
    owner, values = owner[order], shingles[order]
    first = np.ones(len(values), dtype=bool)
    first[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    places = np.flatnonzero(first)
    return owner[places], values[places], np.diff(np.concatenate((places, [len(values)])))


def sum_by_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum modulo 2^64 of each text's values."""
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)))
    return sums[bounds[1:]] - sums[bounds[:-1]]


def slices(sizes: Iterable[int], limit: int) -> Iterator[tuple[int, int]]:
    """Cut a run of items into ranges of at most ``limit`` in total, one item at least."""
    begin = total = at = 0
    for at, size in enumerate(sizes):
        if total and total + size > limit:
            yield begin, at
            begin, total = at, 0
        total += size
    if total or begin <= at:
        yield begin, at + 1
