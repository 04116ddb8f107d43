"""Numeric kernels on NumPy arrays: smoothers of one or many series, and peaks."""

from __future__ import annotations

import numpy as np


def whittaker(y: np.ndarray, w: np.ndarray, lam: float) -> np.ndarray:
    """Minimiser of sum w (y - z)^2 + lam sum (second difference of z)^2, for (series, days) arrays.

    The system is symmetric with five diagonals; one LDL' sweep runs over the days for all series at once.
    """
    y, w = np.atleast_2d(y).astype(float), np.atleast_2d(w).astype(float)
    n = y.shape[1]
    if n < 3:
        return y.copy()
    main, off1, off2 = np.zeros(n), np.zeros(n), np.zeros(n)
    for k in range(n - 2):
        main[k : k + 3] += (1, 4, 1)
        off1[k : k + 2] += (-2, -2)
        off2[k] += 1
    d = np.empty((n, len(y)))
    e, f, z = np.zeros_like(d), np.zeros_like(d), np.empty_like(d)
    right = (w * np.where(w > 0, y, 0)).T
    for i in range(n):
        d[i] = w[:, i] + lam * main[i]
        z[i] = right[i]
        if i >= 1:
            d[i] -= e[i - 1] ** 2 * d[i - 1]
            z[i] -= e[i - 1] * z[i - 1]
        if i >= 2:
            d[i] -= f[i - 2] ** 2 * d[i - 2]
            z[i] -= f[i - 2] * z[i - 2]
        with np.errstate(divide="ignore", invalid="ignore"):
            e[i] = (lam * off1[i] - (f[i - 1] * e[i - 1] * d[i - 1] if i else 0)) / d[i]
            f[i] = lam * off2[i] / d[i]
    with np.errstate(divide="ignore", invalid="ignore"):
        z /= d
    for i in range(n - 2, -1, -1):
        z[i] -= e[i] * z[i + 1]
        if i + 2 < n:
            z[i] -= f[i] * z[i + 2]
    return z.T


def savgol(y: np.ndarray, window: int, order: int) -> np.ndarray:
    """Savitzky-Golay values; the ends come from the polynomials of the first and last window."""
    half = window // 2
    basis = np.vander(np.arange(-half, half + 1, dtype=float), order + 1, increasing=True)
    fit = basis @ np.linalg.pinv(basis)
    out = np.empty(len(y))
    out[half : len(y) - half] = np.lib.stride_tricks.sliding_window_view(y, window) @ fit[half]
    out[:half] = (fit @ y[:window])[:half]
    out[len(y) - half :] = (fit @ y[-window:])[half + 1 :]
    return out


def savgol_daily(day: np.ndarray, y: np.ndarray, window_days: int, order: int) -> np.ndarray:
    """Values for every day from first to last: binned at the median spacing, filtered, read off by day."""
    days = np.arange(day[0], day[-1] + 1, dtype=float)
    straight = np.interp(days, day, y)
    if len(day) <= order:
        return straight
    step = max(int(np.rint(np.median(np.diff(day)))), 1)
    bins = np.arange(day[0], day[-1] + 1, step, dtype=float)
    n = len(bins)
    odd_up = lambda v: v + (v % 2 == 0)
    width = min(odd_up(max(window_days // step, order + 2)), n - (n % 2 == 0))
    width = max(width, odd_up(order + 1))
    if width > n:
        return straight
    # Days past the last bin keep its value.
    return np.interp(days, bins, savgol(np.interp(bins, day, y), width, order))


def lowess(x: np.ndarray, y: np.ndarray, fraction: float, rounds: int = 3) -> np.ndarray:
    """Robust local linear fits (tricube weights, bisquare re-weighting).

    A neighbourhood has fraction * n points, 3 at least; a flat or single-point one gives its weighted mean.
    """
    n = len(x)
    k = min(n, max(3, int(fraction * n + 1e-10)))
    # The nearest k points of sorted x are a window.
    left = np.zeros(n, np.int64)
    a = 0
    for i in range(n):
        while a + k < n and x[i] - x[a] > x[a + k] - x[i]:
            a += 1
        left[i] = a
    at = left[:, None] + np.arange(k)
    gap = np.abs(x[at] - x[:, None])
    reach = gap.max(axis=1, keepdims=True)
    with np.errstate(divide="ignore", invalid="ignore"):
        near = np.where(reach > 0, np.clip(1 - (gap / reach) ** 3, 0, None) ** 3, 1.0)
    near = np.where(gap <= 1e-3 * reach, 1.0, np.where(gap >= 0.999 * reach, 0.0, near))
    robust, fit = np.ones(n), y.astype(float)
    for r in range(rounds + 1):
        w = near * robust[at]
        total = w.sum(axis=1)
        ok = total > 0
        w = np.where(ok[:, None], w / np.where(ok, total, 1)[:, None], 0)
        mean_x = (w * x[at]).sum(axis=1)
        spread = (w * (x[at] - mean_x[:, None]) ** 2).sum(axis=1)
        slope = np.where(spread > 1e-12 * max(np.ptp(x), 1e-300) ** 2, (w * (x[at] - mean_x[:, None]) * y[at]).sum(axis=1) / np.where(spread > 0, spread, 1), 0)
        fit = np.where(ok, (w * y[at]).sum(axis=1) + slope * (x - mean_x), y)
        if r == rounds:
            break
        residual = np.abs(y - fit)
        scale = 6 * np.median(residual)
        if scale <= 0:
            break
        u = residual / scale
        robust = np.where(u < 0.001, 1.0, np.where(u > 0.999, 0.0, (1 - np.minimum(u, 1) ** 2) ** 2))
    return fit


def lowess_daily(day: np.ndarray, y: np.ndarray, window_days: int) -> np.ndarray:
    days = np.arange(day[0], day[-1] + 1, dtype=float)
    if len(day) < 3:
        return np.interp(days, day, y)
    span = float(day[-1] - day[0]) or 1.0
    return np.interp(days, day, lowess(day.astype(float), y, min(window_days / span, 1.0)))


def harmonic_daily(day: np.ndarray, y: np.ndarray, terms: int = 3) -> np.ndarray:
    """Least squares on a constant and ``terms`` annual sines and cosines."""
    days = np.arange(day[0], day[-1] + 1, dtype=float)
    if len(day) < 2 * terms + 1:
        return np.interp(days, day, y)

    def basis(t: np.ndarray) -> np.ndarray:
        angle = 2 * np.pi * np.outer(t - day[0], np.arange(1, terms + 1)) / 365.25
        return np.hstack([np.ones((len(t), 1)), np.cos(angle), np.sin(angle)])

    return basis(days) @ np.linalg.lstsq(basis(day.astype(float)), y, rcond=None)[0]


def whittaker_daily(day: np.ndarray, y: np.ndarray, lam: float) -> np.ndarray:
    n = int(day[-1] - day[0]) + 1
    if n < 3:
        return np.interp(np.arange(day[0], day[-1] + 1, dtype=float), day, y)
    full, w = np.zeros(n), np.zeros(n)
    full[day - day[0]], w[day - day[0]] = y, 1.0
    z = whittaker(full, w, lam)[0]
    return z if np.isfinite(z).all() else np.interp(np.arange(n) + day[0], day, y)


def linear_daily(day: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.interp(np.arange(day[0], day[-1] + 1, dtype=float), day, y)


def peaks(y: np.ndarray, prominence: float, distance: int) -> np.ndarray:
    """Strict local maxima (the middle of a plateau, never an end), thinned by distance, then by prominence."""
    if len(y) < 3:
        return np.zeros(0, np.int64)
    # Runs of equal values; a peak run is higher than both neighbouring runs.
    cut = np.flatnonzero(np.diff(y) != 0)
    first, last = np.concatenate([[0], cut + 1]), np.concatenate([cut, [len(y) - 1]])
    level = y[first]
    top = np.flatnonzero((level[1:-1] > level[:-2]) & (level[1:-1] > level[2:])) + 1
    at = (first[top] + last[top]) // 2
    alive = np.ones(len(at), bool)
    for i in np.argsort(y[at], kind="stable")[::-1]:
        if alive[i]:
            close = np.abs(at - at[i]) < distance
            close[i] = False
            alive &= ~close
    out = []
    for p in at[alive]:
        base = []
        for side in (y[p::-1], y[p:]):
            higher = np.flatnonzero(side > y[p])
            base.append(side[: higher[0] if len(higher) else None].min())
        if y[p] - max(base) >= prominence:
            out.append(p)
    return np.array(out, np.int64)


def bimodality(y: np.ndarray, day: np.ndarray, prominence: float, distance: int) -> tuple[int, float | None, float | None, float | None]:
    """Number of peaks; of the two highest (a later one wins a tie) their distance in ``day``, height ratio and valley depth."""
    at = peaks(y, prominence, distance)
    if len(at) < 2:
        return len(at), None, None, None
    a, b = at[np.argsort(y[at])[::-1][:2]]
    high, low = max(y[a], y[b]), min(y[a], y[b])
    mean, valley = (high + low) / 2, y[min(a, b) : max(a, b) + 1].min()
    return len(at), float(abs(day[a] - day[b])), float(low / high) if high > 0 else None, float((mean - valley) / mean) if mean > 0 else None
