"""Damped Gauss-Newton for many small groups at once (numpy, inside tasks).

One call handles a batch of groups padded to the same number of points; weights of
padding are zero.  Errors of one group never touch another: a group that cannot be
solved keeps ``converged = False``.
"""

from __future__ import annotations

import numpy as np

from plotloom.growth.models import MODELS, NumpyMath

OFFSET_TOLERANCE = 1e-4
MAX_STEPS = 300
# Alternations of curve and variance, and curve steps in each.
VARIANCE_ROUNDS, VARIANCE_STEPS = 50, 10


def _predict(spec, theta, fixed, x):
    p = {name: theta[:, i : i + 1] for i, name in enumerate(spec.raw)}
    p.update({name: value[:, None] for name, value in fixed.items()})
    return spec.predict(NumpyMath, p, x)


def _jacobian(spec, theta, fixed, x):
    columns = []
    for i in range(theta.shape[1]):
        step = 1e-6 * np.maximum(np.abs(theta[:, i]), 1e-6)
        up, down = theta.copy(), theta.copy()
        up[:, i] += step
        down[:, i] -= step
        columns.append((_predict(spec, up, fixed, x) - _predict(spec, down, fixed, x)) / (2 * step)[:, None])
    return np.stack(columns, axis=2)


def _sum_squares(spec, theta, fixed, x, y, w):
    resid = np.where(w > 0, y - _predict(spec, theta, fixed, x), 0.0)
    total = (w * resid * resid).sum(axis=1)
    return resid, np.where(np.isfinite(total), total, np.inf)


def damped_step(normal, gradient, damping):
    """Solve the damped normal equations per group; zero step where that fails."""
    diagonal = np.einsum("bii->bi", normal)
    damped = normal.copy()
    index = np.arange(normal.shape[1])
    damped[:, index, index] += damping[:, None] * np.where(diagonal > 0, diagonal, 1.0)
    step = np.zeros_like(gradient)
    good = np.isfinite(damped).all(axis=(1, 2)) & np.isfinite(gradient).all(axis=1)
    if good.any():
        try:
            step[good] = np.linalg.solve(damped[good], gradient[good][:, :, None])[:, :, 0]
        except np.linalg.LinAlgError:
            step[good] = np.einsum("bij,bj->bi", np.linalg.pinv(damped[good], hermitian=True), gradient[good])
    return np.where(np.isfinite(step), step, 0.0)


def relative_offset(normal, gradient, rss, n):
    """Size of the remaining explained part against the residual spread."""
    p = normal.shape[1]
    explained = np.einsum("bi,bi->b", gradient, damped_step(normal, gradient, np.zeros(len(rss))))
    spread = np.maximum(rss, 0) / np.maximum(n - p, 1)
    with np.errstate(all="ignore"):
        return np.sqrt(np.maximum(explained, 0) / p) / np.sqrt(np.maximum(spread, 1e-300))


def minimise(spec, theta, fixed, x, y, w, within, steps=MAX_STEPS):
    """Least squares per group: parameters and the weighted residual sum without ``within``."""
    theta = theta.copy()
    damping = np.full(len(theta), 1e-3)
    _, rss = _sum_squares(spec, theta, fixed, x, y, w)
    active = np.isfinite(rss) & np.isfinite(theta).all(axis=1)
    n = w.sum(axis=1)
    for _ in range(steps):
        rows = np.flatnonzero(active)
        if not len(rows):
            break
        part = {name: value[rows] for name, value in fixed.items()}
        xs, ys, ws = x[rows], y[rows], w[rows]
        resid, _ = _sum_squares(spec, theta[rows], part, xs, ys, ws)
        jac = np.where((ws > 0)[:, :, None], _jacobian(spec, theta[rows], part, xs), 0.0)
        normal = np.einsum("bk,bki,bkj->bij", ws, jac, jac)
        gradient = np.einsum("bk,bki,bk->bi", ws, jac, resid)
        trial = theta[rows] + damped_step(normal, gradient, damping[rows])
        _, new = _sum_squares(spec, trial, part, xs, ys, ws)
        better = new <= rss[rows]
        settled = np.abs(new - rss[rows]) <= 1e-15 * rss[rows]
        theta[rows[better]] = trial[better]
        rss[rows[better]] = new[better]
        damping[rows] = np.where(better, np.maximum(damping[rows] * 0.2, 1e-12), damping[rows] * 5)
        offset = relative_offset(normal, gradient, rss[rows] + within[rows], n[rows])
        done = (better & (offset < OFFSET_TOLERANCE * 1e-5)) | settled | (damping[rows] > 1e12)
        active[rows[done]] = False
    return theta, rss


def _summary(spec, theta, fixed, x, y, w, within):
    resid, rss = _sum_squares(spec, theta, fixed, x, y, w)
    jac = np.where((w > 0)[:, :, None], _jacobian(spec, theta, fixed, x), 0.0)
    normal = np.einsum("bk,bki,bkj->bij", w, jac, jac)
    gradient = np.einsum("bk,bki,bk->bi", w, jac, resid)
    return normal, gradient, rss + within


def covariance(normal, rss, n):
    """RSS / (n - p) times the inverse normal matrix, NaN where it is singular."""
    p = normal.shape[1]
    result = np.full_like(normal, np.nan)
    scale = np.sqrt(np.einsum("bii->bi", normal))
    with np.errstate(all="ignore"):
        scaled = normal / (scale[:, :, None] * scale[:, None, :])
    usable = np.isfinite(scaled).all(axis=(1, 2)) & np.isfinite(rss) & (n > p)
    for row in np.flatnonzero(usable):
        if np.linalg.cond(scaled[row]) < 1e14:
            inverse = np.linalg.inv(scaled[row]) / np.outer(scale[row], scale[row])
            result[row] = inverse * rss[row] / (n[row] - p)
    return result


def _variance_slope(fitted, squares, w):
    """Best exponent d of a variance proportional to exp(2 d fitted): the profile
    likelihood is concave in d, so its slope is bisected."""
    n = w.sum(axis=1, keepdims=True)
    centre = (w * fitted).sum(axis=1, keepdims=True) / n
    span = np.maximum(np.abs(np.where(w > 0, fitted - centre, 0)).max(axis=1), 1e-12)
    low, high = -20 / span, 20 / span
    for _ in range(80):
        middle = (low + high) / 2
        share = squares * np.exp(-2 * middle[:, None] * (fitted - centre))
        with np.errstate(all="ignore"):
            slope = (share * (fitted - centre)).sum(axis=1) / share.sum(axis=1)
        up = slope > 0
        low, high = np.where(up, middle, low), np.where(up, high, middle)
    return (low + high) / 2


def accepted(theta, weighted, n, offset, cov, size):
    """Whether a group counts as fitted; ``size`` is the sum of squares of its values."""
    exact = weighted <= 1e-20 * size
    sound = np.isfinite(theta).all(axis=1) & np.isfinite(weighted) & (n > theta.shape[1])
    return sound & ((offset < OFFSET_TOLERANCE) | exact) & (np.isfinite(cov).all(axis=1) | exact)


def solve(model, start, fixed, x, y, w, within_x, variance=None):
    """Fit every group of a batch.

    ``within_x`` is the residual sum inside each time; returns a dict of arrays.
    """
    spec = MODELS[model]
    with np.errstate(all="ignore"):
        n = w.sum(axis=1)
        p = len(spec.raw)
        theta, _ = minimise(spec, start, fixed, x, y, w, within_x.sum(axis=1))
        delta = np.zeros(len(n))
        weight = np.ones_like(w)
        if variance == "exp":
            rows = np.flatnonzero(np.isfinite(theta).all(axis=1))
            for _ in range(VARIANCE_ROUNDS):
                if not len(rows):
                    break
                part = {name: value[rows] for name, value in fixed.items()}
                xs, ys, ws, inner = x[rows], y[rows], w[rows], within_x[rows]
                fitted = np.where(ws > 0, _predict(spec, theta[rows], part, xs), 0.0)
                squares = ws * (ys - fitted) ** 2 + inner
                new = _variance_slope(fitted, np.where(ws > 0, squares, 0.0), ws)
                centre = (ws * fitted).sum(axis=1, keepdims=True) / n[rows][:, None]
                weight[rows] = np.where(ws > 0, np.exp(-2 * new[:, None] * (fitted - centre)), 0.0)
                theta[rows], _ = minimise(
                    spec, theta[rows], part, xs, ys, ws * weight[rows], (inner * weight[rows]).sum(axis=1), VARIANCE_STEPS
                )
                settled = np.abs(new - delta[rows]) <= 1e-7 * (np.abs(new) + 1e-3)
                delta[rows] = new
                rows = rows[~settled]
        fitted = np.where(w > 0, _predict(spec, theta, fixed, x), 0.0)
        normal, gradient, weighted = _summary(spec, theta, fixed, x, y, w * weight, (within_x * weight).sum(axis=1))
        plain = (w * (y - fitted) ** 2 + within_x).sum(axis=1)
        mean = (w * fitted).sum(axis=1) / n
        mss = (w * (fitted - mean[:, None]) ** 2).sum(axis=1)
        ll = -0.5 * n * (np.log(2 * np.pi) + 1 - np.log(n) + np.log(weighted))
        if variance == "exp":
            # the weights were centred on the mean fitted value, which shifts nothing else
            ll = ll - delta * (w * (fitted - mean[:, None])).sum(axis=1)
        offset = relative_offset(normal, gradient, weighted, n)
        cov = covariance(normal, weighted, n).reshape(len(n), p * p)
        converged = accepted(theta, weighted, n, offset, cov, (w * y * y).sum(axis=1))
    return {
        "theta": theta, "converged": converged, "n": n, "rss": plain, "mss": mss, "ll": ll,
        "delta": delta, "cov": cov,
    }
