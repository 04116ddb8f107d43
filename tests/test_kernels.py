import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from chronogrid.functions import kernels as k


@pytest.mark.parametrize("n", [3, 4, 5, 40])
def test_whittaker_equals_dense_solution(n):
    rng = np.random.default_rng(n)
    y, w = rng.random((3, n)), (rng.random((3, n)) > 0.3).astype(float)
    w[:, :2] = 1
    d = np.diff(np.eye(n), 2, axis=0)
    for i, z in enumerate(k.whittaker(y, w, 7.0)):
        assert np.allclose(z, np.linalg.solve(np.diag(w[i]) + 7.0 * d.T @ d, w[i] * y[i]))


def test_whittaker_keeps_straight_lines():
    y = np.linspace(0.1, 0.9, 50)
    w = np.zeros(50)
    w[[0, 7, 30, 49]] = 1
    assert np.allclose(k.whittaker(y, w, 1000.0)[0], y, atol=1e-6)


def test_savgol_reproduces_polynomials():
    x = np.arange(30.0)
    y = 1 + 0.2 * x - 0.01 * x**2 + 0.0003 * x**3
    assert np.allclose(k.savgol(y, 7, 3), y)


def test_savgol_interior_is_local_least_squares():
    rng = np.random.default_rng(1)
    y = rng.random(21)
    at = np.arange(-3, 4.0)
    assert np.isclose(k.savgol(y, 7, 2)[10], np.polyval(np.polyfit(at, y[7:14], 2), 0))


def test_lowess_keeps_lines_and_resists_outliers():
    x = np.arange(40.0)
    y = 2 + 0.5 * x
    assert np.allclose(k.lowess(x, y, 0.3), y)
    bad = y.copy()
    bad[20] += 30
    assert abs(k.lowess(x, bad, 0.4)[25] - y[25]) < 0.05


def test_harmonic_reproduces_its_basis():
    day = np.arange(0, 800, 9)
    f = lambda t: 0.4 + 0.2 * np.cos(2 * np.pi * t / 365.25) - 0.1 * np.sin(4 * np.pi * t / 365.25)
    assert np.allclose(k.harmonic_daily(day, f(day)), f(np.arange(0, day[-1] + 1)))


@pytest.mark.parametrize("f", [lambda d, y: k.savgol_daily(d, y, 15, 3), lambda d, y: k.lowess_daily(d, y, 15), lambda d, y: k.harmonic_daily(d, y), lambda d, y: k.whittaker_daily(d, y, 100.0)])
@pytest.mark.parametrize("days", [[3], [3, 4], [0, 5, 9], [0, 1, 2, 3, 4, 5], [0, 10, 20, 30, 40, 50, 60]])
def test_short_series(f, days):
    day = np.array(days)
    out = f(day, np.linspace(0.2, 0.6, len(day)))
    assert len(out) == day[-1] - day[0] + 1 and np.isfinite(out).all()


def test_peaks_plateau_ends_and_distance():
    assert k.peaks(np.array([0, 1, 1, 1, 0, 0]), 0.1, 1).tolist() == [2]
    assert k.peaks(np.array([2, 1, 0, 1, 2]), 0.1, 1).tolist() == []
    assert k.peaks(np.array([0, 3, 0, 4, 0, 3.5, 0]), 0.1, 3).tolist() == [3]
    assert k.peaks(np.array([0, 3, 2.99, 4, 0]), 0.05, 1).tolist() == [3]


def test_two_humps():
    x = np.arange(365)
    y = 0.8 * np.exp(-(((x - 100) / 20) ** 2)) + 0.6 * np.exp(-(((x - 250) / 20) ** 2))
    n, apart, ratio, valley = k.bimodality(y, x, 0.05, 45)
    assert (n, apart) == (2, 150.0) and abs(ratio - 0.75) < 1e-6 and 0.99 < valley <= 1


@settings(max_examples=50, deadline=None)
@given(st.lists(st.floats(0, 1), min_size=3, max_size=60), st.integers(1, 10))
def test_peaks_are_apart_and_high(values, distance):
    y = np.array(values)
    at = k.peaks(y, 0.1, distance)
    assert (np.diff(at) >= distance).all() and ((at > 0) & (at < len(y) - 1)).all()
