"""Student's t: distribution function, quantiles and maximum-likelihood fit, from grouped or plain residuals."""

from __future__ import annotations

import math

import numpy as np


def log_density(x: np.ndarray, df: float) -> np.ndarray:
    return math.lgamma((df + 1) / 2) - math.lgamma(df / 2) - 0.5 * math.log(df * math.pi) - (df + 1) / 2 * np.log1p(x * x / df)


def cdf(x: float, df: float) -> float:
    """By Simpson's rule after x = sqrt(df) tan(a), which turns the density into a power of the cosine."""
    a = np.linspace(0.0, math.atan(abs(x) / math.sqrt(df)), 2001)
    y = np.cos(a) ** (df - 1)
    area = (a[1] - a[0]) / 3 * (y[0] + y[-1] + 4 * y[1:-1:2].sum() + 2 * y[2:-1:2].sum())
    half = area * math.exp(math.lgamma((df + 1) / 2) - math.lgamma(df / 2)) / math.sqrt(math.pi)
    return 0.5 + math.copysign(half, x) if x else 0.5


def ppf(p: float, df: float) -> float:
    """Quantile by bisection."""
    if p == 0.5:
        return 0.0
    low, high = -1.0, 1.0
    while cdf(low, df) > p:
        low *= 2
    while cdf(high, df) < p:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if cdf(mid, df) < p else (low, mid)
    return (low + high) / 2


def fit(residuals: np.ndarray, counts: np.ndarray | None = None, rounds: int = 200) -> tuple[float, float, float]:
    """(df, location, scale) by EM for location and scale, with a golden-section search on df; non-finite values are left out.

    ``counts`` weighs repeated residuals, so large data can come as a histogram.
    """
    w = np.ones(len(residuals)) if counts is None else np.asarray(counts, float)
    x = np.asarray(residuals, float)
    w, x = w[np.isfinite(x)], x[np.isfinite(x)]
    if not len(x):
        return math.nan, math.nan, 0.0
    loc = float(np.average(x, weights=w))
    scale = math.sqrt(float(np.average((x - loc) ** 2, weights=w)))
    if scale == 0:
        return math.inf, loc, 0.0
    df = 5.0
    for _ in range(rounds):
        before = df, loc, scale
        u = (df + 1) / (df + ((x - loc) / scale) ** 2)
        loc = float((w * u * x).sum() / (w * u).sum())
        scale = math.sqrt(float((w * u * (x - loc) ** 2).sum() / w.sum()))
        z = (x - loc) / scale
        a, b = math.log(0.3), math.log(300.0)
        for _ in range(40):
            c, d = b - (b - a) * 0.618, a + (b - a) * 0.618
            a, b = (a, d) if (w * log_density(z, math.exp(c))).sum() > (w * log_density(z, math.exp(d))).sum() else (c, b)
        df = math.exp((a + b) / 2)
        if max(abs(p - q) for p, q in zip(before, (df, loc, scale), strict=True)) < 1e-8:
            break
    return df, loc, scale


def cdf_table(df: float, points: int = 20_001) -> tuple[np.ndarray, np.ndarray]:
    """Angles a = atan(|x| / sqrt(df)) and the probability between 0 and x at them, by Simpson's rule from point to point."""
    grid = np.linspace(0.0, math.pi / 2, points)
    fine = np.linspace(0.0, math.pi / 2, 2 * points - 1)
    y = np.clip(np.cos(fine), 0, 1) ** (df - 1)
    step = (fine[1] - fine[0]) / 3 * (y[:-2:2] + 4 * y[1:-1:2] + y[2::2])
    area = np.concatenate([[0.0], np.cumsum(step)])
    return grid, area * math.exp(math.lgamma((df + 1) / 2) - math.lgamma(df / 2)) / math.sqrt(math.pi)
