"""Local regression and decomposition beside plain loops."""

import numpy as np
import pytest

from tabkit.operators import local_regression as lr


def line(y, q, at, w):
    """One local line by weighted least squares."""
    n = len(y)
    half = (q - 1) // 2
    pos = min(max(at, 0), n - 1)
    left = max(0, min(pos - half, n - q))
    right = min(n - 1, left + q - 1)
    h = max(at - left, right - at) + ((q - n) // 2 if q > n else 0)
    p = np.arange(left, right + 1)
    r = abs(p - at)
    k = np.where(r <= 0.001 * h, 1.0, np.where(r <= 0.999 * h, (1 - (r / max(h, 1)) ** 3) ** 3, 0.0)) * w[left : right + 1]
    v = y[left : right + 1]
    k = np.where(np.isnan(v), 0.0, k)
    if k.sum() == 0:
        return y[at] if at == pos else line(y, q, pos, w)
    v = np.nan_to_num(v)
    mean = (k * p).sum() / k.sum()
    spread = (k * (p - mean) ** 2).sum() / k.sum()
    if spread <= (0.001 * (n - 1)) ** 2:
        return (k * v).sum() / k.sum()
    a = np.stack([np.ones(len(p)), p - at], 1) * np.sqrt(k)[:, None]
    return np.linalg.lstsq(a, v * np.sqrt(k), rcond=None)[0][0]


def fit(y, q, w=None):
    w = np.ones(len(y)) if w is None else w
    return np.array([line(y, q, i, w) for i in range(len(y))])


def split(y, period, ns, nt, nl, inner, outer):
    n = len(y)
    trend, r = np.zeros(n), np.ones(n)
    for o in range(outer + 1):
        for _ in range(inner):
            c = np.zeros(n + 2 * period)
            for ph in range(period):
                z, w = (y - trend)[ph::period], r[ph::period]
                for s in range(-1, len(z) + 1):
                    if ns is None:
                        ok = ~np.isnan(z)
                        c[(s + 1) * period + ph] = (z[ok] * w[ok]).sum() / w[ok].sum()
                    else:
                        c[(s + 1) * period + ph] = line(z, ns, s, w)
            low = c
            for m in (period, period, 3):
                low = np.convolve(low, np.ones(m) / m, "valid")
            season = c[period : period + n] - fit(low, nl)
            trend = fit(y - season, nt, r)
        if o < outer:
            res = abs(y - season - trend)
            h = 6 * np.nanmedian(res)
            r = np.where(res <= 0.001 * h, 1.0, np.where(res <= 0.999 * h, (1 - (res / h) ** 2) ** 2, 0.0))
    return trend, season


def series(spark, n, period, gaps=(), spike=None, key="a"):
    rng = np.random.default_rng(n)
    y = 0.05 * np.arange(n) + 3 * np.sin(np.arange(n) * 2 * np.pi / period) + rng.normal(size=n)
    if spike is not None:
        y[spike] += 40
    y[list(gaps)] = np.nan
    return y, [(key, i, None if np.isnan(v) else float(v)) for i, v in enumerate(y)]


@pytest.mark.parametrize("n,window,gaps", [(40, 7, ()), (40, 7, (0, 1, 2, 3, 20)), (5, 9, ()), (1, 3, ())])
def test_local_line(spark, n, window, gaps):
    y, rows = series(spark, n, 6, gaps)
    df = spark.createDataFrame(rows, "k string, t int, x double")
    want = fit(y, window)
    for limits in ({}, {"block": 8}):
        got = [r["fit"] for r in lr.local_line(df, "k", "t", "x", window, **limits).orderBy("t").collect()]
        assert np.allclose(np.array(got, dtype=float), want, equal_nan=True)


@pytest.mark.parametrize("ns,inner,outer,gaps,limits", [(None, 2, 0, (7,), {}), (5, 1, 1, (), {}), (5, 1, 0, (10, 11), {"block": 16})])
def test_decompose_locally(spark, ns, inner, outer, gaps, limits):
    y, rows = series(spark, 41, 4, gaps, 17)
    other, more = series(spark, 29, 4, key=None)
    df = spark.createDataFrame(rows + more + [("short", i, 1.0) for i in range(7)], "k string, t int, x double")
    out = lr.decompose_locally(df, "k", "t", "x", 4, ns, 9, inner=inner, outer=outer, **limits).orderBy("t").collect()
    for key, v in (("a", y), (None, other)):
        trend, season = split(v, 4, ns, 9, 5, inner, outer)
        got = [r for r in out if r["k"] == key]
        assert np.allclose([r["trend"] for r in got], trend) and np.allclose([r["season"] for r in got], season)
        assert np.allclose(np.array([r["remainder"] for r in got], dtype=float), v - trend - season, equal_nan=True)
    assert [(r["trend"], r["season"], r["remainder"]) for r in out if r["k"] == "short"] == [(None,) * 3] * 7


def test_windows_have_to_be_odd(spark):
    df = spark.createDataFrame([], "k string, t int, x double")
    with pytest.raises(ValueError):
        lr.local_line(df, "k", "t", "x", 4)
    with pytest.raises(ValueError):
        lr.decompose_locally(df, "k", "t", "x", 4, season_window=2)
    assert lr.decompose_locally(df, "k", "t", "x", 4).count() == 0
