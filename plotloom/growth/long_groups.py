"""Fits of groups with more distinct times than one array should hold.

The steps and rules are those of ``solver.solve``, and so are the results up to rounding; only
the sums over a group's points are taken by Spark.  Points lie in chunks of bounded size; a
step evaluates every chunk at its group's trial parameters in numpy, adds up the sums, and one row
per group moves on.  No task ever holds a group.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plotloom.growth import solver
from plotloom.growth.models import MODELS
from plotloom.growth.points import PARTS, point_arrays, point_matrix
from plotloom.operators.keys import join_same
from plotloom.operators.sizing import SMALL_ROWS, cut_lineage

# Passes over the points in which curve and variance are fitted together.
JOINT_STEPS = 40
PLAIN_STEPS = 4
FIRST, STEP, DONE = 0, 1, 2


def _sums(spec, theta, fixed, x, y, w, within) -> np.ndarray:
    """Normal matrix, gradient, and the sums a step needs, of one chunk."""
    normal, gradient, rss = solver._summary(spec, theta[None], fixed, x, y, w, np.zeros(1))
    return np.concatenate((normal.ravel(), gradient.ravel(), rss, [within]))


def _numbers(frame: pd.DataFrame, column: str, size: int) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=float) for v in frame[column]]).reshape(len(frame), size)


def _weight(spec, slots, x, fixed, s) -> np.ndarray:
    """Weights of the variance model: from the curve at ``base``, held while the curve moves."""
    delta = s[slots["delta"]][0]
    if delta == 0:
        return np.ones_like(x)
    fitted = solver._predict(spec, s[slots["base"]][None], fixed, x)
    return np.exp(-2 * delta * (fitted - s[slots["centre"]][0]))


class LongFit:
    """One model on chunked groups; state is one row per group: (keys, s) with s an array of numbers.

    ``_slots`` has the layout of s.
    """

    def __init__(self, chunks: DataFrame, keys: Sequence[str], model: str):
        groups = chunks.select(*keys).distinct().count()
        # One row of some forty numbers per group: broadcast only up to a fixed number of them.
        self.hint = F.broadcast if groups <= SMALL_ROWS else (lambda frame: frame)
        self.chunks, self.keys, self.spec = chunks, list(keys), MODELS[model]
        self.passes = 0
        self.p = len(self.spec.raw)
        self.size = 2 * self.p + self.p**2 + self.p + 8 + self.p
        fields = [chunks.schema[key] for key in keys]
        self.schema = T.StructType([*fields, T.StructField("s", T.ArrayType(T.DoubleType()))])

    def _slots(self) -> dict[str, slice]:
        p, at, out = self.p, 0, {}
        for name, size in [
            ("theta", p), ("trial", p), ("normal", p * p), ("gradient", p), ("rss", 1), ("within", 1), ("damping", 1),
            ("n", 1), ("phase", 1), ("delta", 1), ("centre", 1), ("spare", 1), ("base", p),
        ]:
            out[name] = slice(at, at + size)
            at += size
        return out

    def start(self, starts: DataFrame) -> DataFrame:
        """State at the starting values: every group's trial, not evaluated yet."""
        slots, size, names, keys = self._slots(), self.size, list(self.spec.raw), self.keys

        def begin(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                s = np.zeros((len(batch), size))
                theta = batch[names].to_numpy(dtype=float)
                for part in ("theta", "trial", "base"):
                    s[:, slots[part]] = theta
                s[:, slots["damping"]] = 1e-3
                yield batch[keys].assign(s=list(s))

        known = join_same(starts, self.chunks.select(*self.keys).distinct(), self.keys, "left_semi")
        return known.select(*keys, *names).mapInPandas(begin, self.schema)

    def evaluate(self, state: DataFrame, measure: Callable, width: int) -> DataFrame:
        """(keys, s, sums): ``measure(chunk, fixed, s)`` added up over the chunks of every group."""
        self.passes += 1
        keys, fixed_names = self.keys, list(self.spec.fixed)
        fields = [*[self.schema[key] for key in keys], *[T.StructField(f"v{i}", T.DoubleType()) for i in range(width)]]

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                values = np.zeros((len(batch), width))
                with np.errstate(all="ignore"):
                    for i, (_, row) in enumerate(batch.iterrows()):
                        fixed = {name: np.array([float(row[name])]) for name in fixed_names}
                        values[i] = measure(point_matrix(row), fixed, np.asarray(row["s"], dtype=float))
                yield batch[keys].assign(**{f"v{i}": values[:, i] for i in range(width)})

        joined = join_same(self.chunks, self.hint(state), keys)
        parts = joined.select(*keys, *fixed_names, *[f"point_{part}" for part in PARTS], "s").mapInPandas(run, T.StructType(fields))
        added = parts.groupBy(*keys).agg(F.array(*[F.sum(f"v{i}") for i in range(width)]).alias("sums"))
        return join_same(added, self.hint(state), keys)

    def _move(self, move: Callable, width: int) -> Callable:
        keys, size = self.keys, self.size

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if len(batch):
                    with np.errstate(all="ignore"):
                        s = move(_numbers(batch, "s", size).copy(), _numbers(batch, "sums", width))
                    yield batch[keys].assign(s=list(s))

        return run

    def minimise(self, state: DataFrame, steps: int) -> DataFrame:
        """``solver.minimise`` on all groups of the state."""
        spec, slots, p = self.spec, self._slots(), self.p
        width = p * p + p + 2

        def measure(block, fixed, s):
            x, w, y, within = (part[None] for part in block)
            weight = _weight(spec, slots, x, fixed, s)
            return _sums(spec, s[slots["trial"]], fixed, x, y, w * weight, float((within * weight).sum()))

        def move(s, sums):
            normal, gradient = sums[:, : p * p].reshape(-1, p, p), sums[:, p * p : p * p + p]
            new = np.where(np.isfinite(sums[:, -2]), sums[:, -2], np.inf)
            first = s[:, slots["phase"]][:, 0] == FIRST
            rss, damping = s[:, slots["rss"]][:, 0], s[:, slots["damping"]][:, 0]
            kept_normal, kept_gradient = s[:, slots["normal"]].reshape(-1, p, p), s[:, slots["gradient"]]
            better = first | (new <= rss)
            settled = ~first & (np.abs(new - rss) <= 1e-15 * rss)
            offset = solver.relative_offset(
                kept_normal, kept_gradient, np.where(better, new, rss) + sums[:, -1], s[:, slots["n"]][:, 0]
            )
            moved = np.where(better, np.maximum(damping * 0.2, 1e-12), damping * 5)
            damping = np.where(first, damping, moved)
            done = ~first & ((better & (offset < solver.OFFSET_TOLERANCE * 1e-5)) | settled | (damping > 1e12))
            trial = s[:, slots["trial"]]
            done |= first & ~(np.isfinite(new) & np.isfinite(trial).all(axis=1))
            theta = np.where(better[:, None], trial, s[:, slots["theta"]])
            normal = np.where(better[:, None, None], normal, kept_normal)
            gradient = np.where(better[:, None], gradient, kept_gradient)
            s[:, slots["theta"]] = theta
            s[:, slots["normal"]], s[:, slots["gradient"]] = normal.reshape(-1, p * p), gradient
            s[:, slots["rss"]] = np.where(better, new, rss)[:, None]
            s[:, slots["within"]] = sums[:, -1:]
            s[:, slots["damping"]] = damping[:, None]
            s[:, slots["phase"]] = np.where(done, DONE, STEP)[:, None]
            s[:, slots["trial"]] = theta + solver.damped_step(normal, gradient, damping)
            return s

        phase = F.get("s", F.lit(slots["phase"].start))
        for _ in range(steps + 1):
            open_groups = state.where(phase != DONE)
            moved = self.evaluate(open_groups, measure, width).mapInPandas(self._move(move, width), self.schema)
            state = cut_lineage(state.where(phase == DONE).unionByName(moved))
            if state.where(phase != DONE).isEmpty():
                break
        return state

    def _with_counts(self, state: DataFrame) -> DataFrame:
        slots = self._slots()

        def measure(block, fixed, s):
            return [block[1].sum()]

        def move(s, sums):
            s[:, slots["n"]] = sums
            return s

        return cut_lineage(self.evaluate(state, measure, 1).mapInPandas(self._move(move, 1), self.schema))

    def _score(self, state: DataFrame) -> DataFrame:
        """Curve and variance exponent together, one pass over the points per step.

        A pass gives the weighted normal equations of the curve and, for the exponent, the first two moments of
        the distance from the mean fitted value under the residual shares: the slope of the profile
        likelihood and its curvature.  Both take a step of their own at once; at the end neither moves,
        which is where alternating them ends too.
        """
        spec, slots, p, hold = self.spec, self._slots(), self.p, self._slots()["spare"]
        width = p * p + p + 2 + 4

        def measure(block, fixed, s):
            x, w, y, within = (part[None] for part in block)
            theta, delta, centre = s[slots["theta"]], s[slots["delta"]][0], s[slots["centre"]][0]
            fitted = solver._predict(spec, theta[None], fixed, x)
            away = fitted - centre
            weight = np.exp(-2 * delta * away)
            share = (w * (y - fitted) ** 2 + within) * weight
            moments = [share.sum(), (share * away).sum(), (share * away**2).sum(), (w * fitted).sum()]
            return np.concatenate((_sums(spec, theta, fixed, x, y, w * weight, float((within * weight).sum())), moments))

        def move(s, sums):
            n, delta = s[:, slots["n"]][:, 0], s[:, slots["delta"]][:, 0]
            first = s[:, slots["phase"]][:, 0] == FIRST
            whole, slope, square, total = sums[:, -4:].T
            slope, square = slope / whole, square / whole
            spread = np.maximum(square - slope**2, 1e-300)
            # The first pass finds the mean fitted value only.
            shift = np.where(first, 0.0, np.clip(slope / (2 * spread), -1 / np.sqrt(spread), 1 / np.sqrt(spread)))
            normal, gradient = sums[:, : p * p].reshape(-1, p, p), sums[:, p * p : p * p + p]
            offset = solver.relative_offset(normal, gradient, sums[:, p * p + p] + sums[:, p * p + p + 1], n)
            # Where the curve comes no nearer its step is damped.
            worse = ~first & (offset > 2 * s[:, hold][:, 0])
            damping = np.where(worse, np.maximum(s[:, slots["damping"]][:, 0] * 10, 1e-2), s[:, slots["damping"]][:, 0] * 0.1)
            step = np.where(first[:, None], 0.0, solver.damped_step(normal, gradient, damping))
            steady = np.abs(shift) <= 1e-8 * (np.abs(delta) + 1e-3)
            done = ~first & ((steady & (offset < solver.OFFSET_TOLERANCE * 1e-3)) | ~np.isfinite(offset + shift))
            s[:, slots["base"]] = s[:, slots["theta"]]
            s[:, slots["theta"]] += np.where(done[:, None], 0.0, step)
            s[:, slots["delta"]] += np.where(done, 0.0, shift)[:, None]
            s[:, slots["centre"]] = (total / n)[:, None]
            s[:, slots["damping"]], s[:, hold] = damping[:, None], offset[:, None]
            s[:, slots["phase"]] = np.where(done, DONE, STEP)[:, None]
            return s

        phase = F.get("s", F.lit(slots["phase"].start))
        for _ in range(JOINT_STEPS):
            open_groups = state.where(phase != DONE)
            moved = self.evaluate(open_groups, measure, width).mapInPandas(self._move(move, width), self.schema)
            state = cut_lineage(state.where(phase == DONE).unionByName(moved))
            if state.where(phase != DONE).isEmpty():
                break
        return state

    def fit(self, starts: DataFrame, variance: str | None) -> DataFrame:
        """State of every group at the end; see ``solver.solve``."""
        slots, size, keys = self._slots(), self.size, self.keys
        state = self._with_counts(cut_lineage(self.start(starts)))
        # With a variance to fit, a few steps of plain least squares give the start of the joint ones.
        state = self.minimise(state, PLAIN_STEPS if variance == "exp" else solver.MAX_STEPS)
        if variance != "exp":
            return state
        finite = F.forall(F.slice("s", 1, self.p), lambda v: ~F.isnan(v) & (F.abs(v) < float("inf")))

        def restart(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                s = _numbers(batch, "s", size).copy()
                s[:, slots["damping"]], s[:, slots["phase"]] = 1e-6, FIRST
                s[:, slots["spare"]] = np.inf
                yield batch[keys].assign(s=list(s))

        scored = self._score(cut_lineage(state.where(finite).mapInPandas(restart, self.schema)))
        return state.where(~finite).unionByName(scored)

    def results(self, state: DataFrame, variance: str | None, schema: T.StructType) -> DataFrame:
        """The rows of ``fit`` from the final states, with one more pass over the points."""
        spec, slots, p, keys, size = self.spec, self._slots(), self.p, self.keys, self.size
        width = p * p + p + 2 + 5

        def measure(block, fixed, s):
            x, w, y, within = (part[None] for part in block)
            theta = s[slots["theta"]]
            weight = _weight(spec, slots, x, fixed, s)
            fitted = solver._predict(spec, theta[None], fixed, x)
            plain = float((w * (y - fitted) ** 2 + within).sum())
            more = [plain, (w * fitted).sum(), (w * fitted**2).sum(), (w * y * y).sum(), 0.0]
            return np.concatenate((_sums(spec, theta, fixed, x, y, w * weight, float((within * weight).sum())), more))

        evaluated = self.evaluate(state, measure, width)
        given = self.chunks.select(*keys, *spec.fixed).distinct() if spec.fixed else None
        if given is not None:
            evaluated = join_same(evaluated, given, keys)

        def summarise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                s, sums = _numbers(batch, "s", size), _numbers(batch, "sums", width)
                theta, n = s[:, slots["theta"]], s[:, slots["n"]][:, 0]
                normal, gradient = sums[:, : p * p].reshape(-1, p, p), sums[:, p * p : p * p + p]
                weighted = sums[:, p * p + p] + sums[:, p * p + p + 1]
                plain, total, squares, own = sums[:, -5], sums[:, -4], sums[:, -3], sums[:, -2]
                with np.errstate(all="ignore"):
                    ll = -0.5 * n * (np.log(2 * np.pi) + 1 - np.log(n) + np.log(weighted))
                    offset = solver.relative_offset(normal, gradient, weighted, n)
                    cov = solver.covariance(normal, weighted, n).reshape(-1, p * p)
                    mss = squares - total**2 / n
                out = {key: batch[key].to_numpy() for key in keys}
                out |= {name: theta[:, i] for i, name in enumerate(spec.raw)}
                out |= {name: batch[name].to_numpy(dtype=float) for name in spec.fixed}
                out["converged"] = solver.accepted(theta, weighted, n, offset, cov, own)
                out |= {"n": n, "rss": plain, "mss": mss, "ll": ll, "delta": s[:, slots["delta"]][:, 0]}
                frame = pd.DataFrame(out)
                numbers = [*spec.raw, "n", "rss", "mss", "ll", "delta"]
                frame[numbers] = frame[numbers].astype(object).where(np.isfinite(frame[numbers].astype(float)), None)
                frame["cov"] = [list(row) if np.isfinite(row).all() else None for row in cov]
                yield frame[schema.fieldNames()]

        return evaluated.mapInPandas(summarise, schema)


def fit_chunked(
    packed: DataFrame, keys: Sequence[str], model: str, starts: DataFrame, variance: str | None, schema: T.StructType
) -> DataFrame:
    """Fit of the groups in ``packed`` (several chunks each)."""
    spec = MODELS[model]
    chunks = join_same(packed, starts.select(*keys, *spec.fixed), keys) if spec.fixed else packed
    chunks = cut_lineage(chunks.select(*keys, *spec.fixed, *point_arrays()))
    work = LongFit(chunks, keys, model)
    return work.results(work.fit(starts, variance), variance, schema)
