"""Branch and bound over boxes of a grid of power-law parameters.

Mass follows dM/dt = r M^beta from M0.  A larger M0 or r never gives a smaller mass, and a larger
beta gives faster growth above a mass of one and slower growth below.  So over a box of
parameters the curve lies between two curves: the upper one starts at the largest M0, with the
largest r, the smallest beta below one and the largest above, the lower one the other way round.
Observations outside that band give a lower bound on the squared error in the box, and a box
whose bound is above the error of a point already found cannot hold the best one.

The bounds hold for times and rates from zero, masses from zero and beta below one; a grid or
series beyond that is searched whole.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

# Points up to which a box is searched whole, boxes bounded at once, points per axis of the first look.
LEAF, BATCH, FIRST_LOOK = 4, 8192, 6
# Rounding may put a bound above an error that it equals.
SLACK = 1e-7

Values = Sequence[np.ndarray]


def bounded(points: np.ndarray, values: Values) -> bool:
    """Whether the bounds hold for these observations and axis values."""
    m0, r, beta = values
    return bool((points[:, 0] >= 0).all() and (m0 >= 0).all() and (r >= 0).all() and (beta < 1).all())


def errors(m0: np.ndarray, r: np.ndarray, beta: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Squared error at each of many parameter points; NaN where the curve is undefined."""
    left = 1 - beta
    total = np.zeros(len(m0))
    with np.errstate(all="ignore"):
        base, power, slope = np.power(m0, left), 1 / left, r * left
        for x, n, y, within in points:
            gap = y - np.power(base + slope * x, power)
            total += n * gap * gap + within
    return total


def _edge(m0, r, below, above, x):
    """The curve from m0 whose exponent is ``below`` up to a mass of one and ``above`` beyond."""
    c, d = 1 - below, 1 - above
    small = m0 < 1
    start = np.power(m0, np.where(small, c, d))
    reach = np.where(small, (1 - start) / (r * c), 0.0)  # the time at which it passes one
    before = np.power(np.where(small, start + r * c * x, 1.0), 1 / c)
    after = np.power(np.where(small, 1 + r * d * np.maximum(x - reach, 0), start + r * d * x), 1 / d)
    return np.where(small & ~(x > reach), before, after)


def lower_bounds(boxes: np.ndarray, values: Values, points: np.ndarray) -> np.ndarray:
    """Least possible squared error of each box of index ranges (first and last per axis)."""
    m0, r, beta = (axis[boxes[:, [2 * i, 2 * i + 1]]] for i, axis in enumerate(values))
    x, n, y, within = (points[:, i][None, :] for i in range(4))
    column = lambda a, i: a[:, i][:, None]
    with np.errstate(all="ignore"):
        low = _edge(column(m0, 0), column(r, 0), column(beta, 1), column(beta, 0), x)
        high = _edge(column(m0, 1), column(r, 1), column(beta, 0), column(beta, 1), x)
        gap = np.fmax(np.fmax(low - y, y - high), 0.0)
        return (n * gap * gap).sum(axis=1) + within.sum()


def halves(boxes: np.ndarray) -> np.ndarray:
    """Every box cut in two along its longest side."""
    sides = boxes[:, 1::2] - boxes[:, ::2]
    axis = sides.argmax(axis=1)
    rows = np.arange(len(boxes))
    middle = (boxes[rows, 2 * axis] + boxes[rows, 2 * axis + 1]) // 2
    left, right = boxes.copy(), boxes.copy()
    left[rows, 2 * axis + 1] = middle
    right[rows, 2 * axis] = middle + 1
    return np.concatenate((left, right))


def members(boxes: np.ndarray) -> np.ndarray:
    """The index triples in boxes of any shape."""
    sides = boxes[:, 1::2] - boxes[:, ::2] + 1
    sizes = sides.prod(axis=1)
    owner = np.repeat(np.arange(len(boxes)), sizes)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    i, rest = np.divmod(place, (sides[:, 1] * sides[:, 2])[owner])
    j, k = np.divmod(rest, sides[owner, 2])
    return np.stack((i, j, k), axis=1) + boxes[owner, ::2]


class Search:
    """The best point of one group, ties going to the first in axis order."""

    def __init__(self, values: Values, points: np.ndarray, positive_mass: bool = False):
        self.values, self.points, self.positive = values, points, positive_mass
        self.best: tuple = (np.inf, 0, 0, 0)
        self.limit, self.evaluated = np.inf, 0

    def look(self, triples: np.ndarray) -> None:
        """Evaluate points and keep the best."""
        if not len(triples):
            return
        m0, r, beta = (axis[triples[:, i]] for i, axis in enumerate(self.values))
        total = errors(m0, r, beta, self.points)
        self.evaluated += len(triples)
        total = np.where(np.isnan(total) | (self.positive & (m0 == 0)), np.inf, total)
        at = np.lexsort((triples[:, 2], triples[:, 1], triples[:, 0], total))[0]
        if np.isfinite(total[at]):
            self.best = min(self.best, (float(total[at]), *(int(v) for v in triples[at])))
            self.limit = self.best[0] * (1 + SLACK) + SLACK**2 * float((self.points[:, 1] * self.points[:, 2] ** 2).sum())

    def run(self, begin: int, end: int) -> tuple | None:
        """(error, i, j, k) of the best point with ``begin`` <= i < ``end``; None if another range has a better one."""
        first = np.meshgrid(*[np.unique(np.linspace(0, len(v) - 1, FIRST_LOOK).astype(int)) for v in self.values], indexing="ij")
        self.look(np.stack([axis.ravel() for axis in first], axis=1))
        whole = np.array([[begin, end - 1, 0, len(self.values[1]) - 1, 0, len(self.values[2]) - 1]])
        if not bounded(self.points, self.values):
            for i in range(begin, end):
                self.look(members(np.array([[i, i, *whole[0, 2:]]])))
        else:
            waiting = [whole]
            while waiting:
                self._step(waiting.pop(), waiting)
        return self.best if begin <= self.best[1] < end and np.isfinite(self.best[0]) else None

    def _step(self, boxes: np.ndarray, waiting: list[np.ndarray]) -> None:
        bounds = lower_bounds(boxes, self.values, self.points)
        keep = bounds <= self.limit
        boxes, bounds = boxes[keep], bounds[keep]
        if not len(boxes):
            return
        # The corner of the likeliest boxes may lower the limit.
        self.look(boxes[np.argsort(bounds, kind="stable")[:4]][:, ::2])
        keep = bounds <= self.limit
        boxes, bounds = boxes[keep], bounds[keep]
        small = (boxes[:, 1::2] - boxes[:, ::2] + 1).prod(axis=1) <= LEAF
        self.look(members(boxes[small]))
        rest = boxes[~small]
        rest = rest[np.argsort(-bounds[~small], kind="stable")]  # the likeliest are taken up first
        for at in range(0, len(rest), BATCH // 2):
            waiting.append(halves(rest[at : at + BATCH // 2]))


def quarters(boxes: np.ndarray) -> np.ndarray:
    """Every box cut in up to four along each side."""
    for _ in range(6):
        wide = (boxes[:, 1::2] > boxes[:, ::2]).any(axis=1)
        boxes = np.concatenate((boxes[~wide], halves(boxes[wide])))
    return boxes
