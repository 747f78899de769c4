"""Parameter draws by counter, and exact quantiles over any number of them in bounded memory.

Draw number d of a group is a function of the seed, the group and d, so any block of draws can be
made again wherever it is needed: none is stored in a row or sent anywhere.

A quantile is found by narrowing: a histogram between two bounds tells between which narrower ones
the wanted ranks lie, and the draws are gone through again, until few enough values are left to
be sorted.  The result is that of sorting all of them.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator, Mapping
from hashlib import md5

import numpy as np

from plotloom.growth.models import Model, NumpyMath

# Draws made at once, and draws that are kept to be gone through again.
BLOCK, KEPT = 1 << 16, 1 << 20
BINS = 1024
# Values per point that are sorted.
SORTED = 4096


def uniforms(prefix: str, begin: int, end: int, index: int, tail: str) -> np.ndarray:
    """Numbers in (0, 1) of draws ``begin`` to ``end`` - 1, from the md5 of prefix, draw, index and tail."""
    found = [md5(f"{prefix}|{draw}|{index}|{tail}".encode()).digest()[:6] for draw in range(begin, end)]
    return np.array([(int.from_bytes(d, "big") + 0.5) / 16**12 for d in found])


def normals(prefix: str, begin: int, end: int, index: int) -> np.ndarray:
    first, second = (uniforms(prefix, begin, end, index, tail) for tail in "uv")
    return np.sqrt(-2.0 * np.log(first)) * np.cos(2 * math.pi * second)


def lower_factor(covariance: np.ndarray) -> np.ndarray:
    """The Cholesky factor; a direction without spread (or with a tiny negative rest) has none."""
    p = len(covariance)
    factor = np.zeros((p, p))
    for j in range(p):
        rest = covariance[j, j] - factor[j, :j] @ factor[j, :j]
        factor[j, j] = math.sqrt(rest) if rest > 0 else (rest if math.isnan(rest) else 0.0)
        for i in range(j + 1, p):
            mixed = covariance[i, j] - factor[i, :j] @ factor[j, :j]
            factor[i, j] = mixed / factor[j, j] if factor[j, j] else 0.0
    return factor


class Draws:
    """Natural parameters of normal draws around the raw ones of one group."""

    def __init__(self, model: Model, prefix: str, values: Mapping[str, float], covariance, count: int):
        self.model, self.prefix, self.count = model, prefix, count
        missing = lambda v: math.nan if v is None else float(v)
        self.raw = [missing(values[name]) for name in model.raw]
        self.fixed = {name: missing(values[name]) for name in model.fixed}
        p = len(model.raw)
        known = np.full((p, p), math.nan) if covariance is None else np.array(covariance, dtype=float).reshape(p, p)
        self.factor = lower_factor(known)
        self._kept: dict[int, dict[str, np.ndarray]] = {}

    def block(self, begin: int, end: int) -> dict[str, np.ndarray]:
        """Columns of natural parameters, NaN where one is not finite."""
        if begin in self._kept:
            return self._kept[begin]
        z = [normals(self.prefix, begin + 1, end + 1, i) for i in range(len(self.raw))]
        p: dict[str, np.ndarray | float] = dict(self.fixed)
        for i, name in enumerate(self.model.raw):
            p[name] = self.raw[i] + sum(self.factor[i, k] * z[k] for k in range(i + 1))
        with np.errstate(all="ignore"):
            natural = self.model.transform(NumpyMath, p)
        found = {}
        for name, value in natural.items():
            column = np.broadcast_to(np.asarray(value, dtype=float), (end - begin,))[:, None]
            found[name] = np.where(np.isfinite(column), column, np.nan)
        if self.count <= KEPT:
            self._kept[begin] = found
        return found

    def spans(self) -> Iterator[tuple[int, int]]:
        return ((begin, min(begin + BLOCK, self.count)) for begin in range(0, self.count, BLOCK))


def _ordered(values: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of the values: their bits, those of negative ones turned round."""
    bits = (values + 0.0).view(np.int64)
    return np.where(bits < 0, bits ^ np.int64(0x7FFFFFFFFFFFFFFF), bits)


def quantiles(blocks: Callable[[], Iterable[np.ndarray]], alpha: float, points: int) -> np.ndarray:
    """(2, points): the lower and upper quantile of each column of all blocks, missing values left out.

    ``blocks`` gives the same blocks of rows each time.  A column without any value stays missing.
    Bounds are narrowed on the numbers' bits, a thousandfold each time, so seven times at most.
    """
    ends = (alpha / 2, 1 - alpha / 2)
    n = sum((~np.isnan(block)).sum(axis=0) for block in blocks())
    out = np.full((2, points), np.nan)
    wanted = [(e, c) for e in range(2) for c in range(points) if n[c]]
    place = {(e, c): (int(n[c]) - 1) * ends[e] for e, c in wanted}
    ranks = {key: (int(place[key]), min(int(place[key]) + 1, int(n[key[1]]) - 1)) for key in wanted}
    bounds = dict.fromkeys(wanted, (-(1 << 63), (1 << 63) - 1))
    left = {key: int(n[key[1]]) for key in wanted}
    while todo := [key for key in wanted if left[key] > SORTED and bounds[key][0] < bounds[key][1]]:
        before, tables = _histograms(blocks, todo, bounds)
        for key in todo:
            a, b = bounds[key]
            width = (b - a) // BINS + 1
            sums = before[key] + np.cumsum(tables[key])
            first, last = (int(np.searchsorted(sums, rank, side="right")) for rank in ranks[key])
            left[key] = int(tables[key][first : last + 1].sum())
            bounds[key] = (a + first * width, min(b, a + (last + 1) * width - 1))
    for key, (values, below) in _values(blocks, wanted, bounds).items():
        low, high = (values[rank - below] for rank in ranks[key])
        out[key] = _between(low, high, place[key] - ranks[key][0])
    return out


def _between(a: float, b: float, share: float) -> float:
    """Between two ranks as numpy does it."""
    return a + (b - a) * share if share < 0.5 else b - (b - a) * (1 - share)


def _columns(blocks, keys, bounds) -> Iterator[tuple[tuple, np.ndarray, np.ndarray, int]]:
    """Per block and key: the key, the column's values, their order and the lower bound."""
    for block in blocks():
        seen: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for key in keys:
            if key[1] not in seen:
                column = block[:, key[1]]
                column = column[~np.isnan(column)]
                seen[key[1]] = column, _ordered(column)
            yield key, *seen[key[1]], bounds[key]


def _histograms(blocks, keys, bounds) -> tuple[dict, dict]:
    """Per key the number of values below its bounds, and a histogram of those between them."""
    before = dict.fromkeys(keys, 0)
    tables = {key: np.zeros(BINS, dtype=np.int64) for key in keys}
    for key, _, order, (a, b) in _columns(blocks, keys, bounds):
        before[key] += int((order < a).sum())
        between = order[(order >= a) & (order <= b)]
        above = between.view(np.uint64) - np.uint64(a & 0xFFFFFFFFFFFFFFFF)
        bins = above // np.uint64((b - a) // BINS + 1)
        tables[key] += np.bincount(bins.astype(np.int64), minlength=BINS)
    return before, tables


class _Runs:
    """Sorted values as runs of equal ones, so that ties take no room."""

    def __init__(self, values: np.ndarray, sizes: np.ndarray):
        self.values, self.ends = values, np.cumsum(sizes)

    def __len__(self) -> int:
        return int(self.ends[-1])

    def __getitem__(self, rank: int) -> float:
        return float(self.values[np.searchsorted(self.ends, rank, side="right")])


def _values(blocks, keys, bounds) -> dict:
    """Per key the sorted values between its bounds, and how many are below."""
    below = dict.fromkeys(keys, 0)
    runs = {key: (np.empty(0), np.empty(0, dtype=np.int64)) for key in keys}
    for key, column, order, (a, b) in _columns(blocks, keys, bounds):
        below[key] += int((order < a).sum())
        values, sizes = runs[key]
        new, counts = np.unique(column[(order >= a) & (order <= b)], return_counts=True)
        both, place = np.unique(np.concatenate((values, new)), return_inverse=True)
        runs[key] = both, np.bincount(place, np.concatenate((sizes, counts)), len(both)).astype(np.int64)
    return {key: (_Runs(*runs[key]), below[key]) for key in keys}
