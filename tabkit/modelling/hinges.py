"""Regression on hinge functions chosen stepwise: forward by pairs, pruned by generalised cross-validation.

One pass over the rows sums the products of all candidate hinges with each
other and with the outcome. Selection, pruning and the coefficients come from
that matrix alone, whose size hangs on knots and features, not on rows; terms
of two features take one more pass over the products of the hinges chosen.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabkit.modelling.boosting import bin_edges

Hinge = tuple[int, float, bool]  # feature, knot, whether it rises above the knot
Term = tuple[Hinge, ...]
PRUNING = ("backward", "forward", "none", "exhaustive")
KNOTS, MOST_SUBSETS, LEAST = 50, 14, 1e-9


def _value(term: Term, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x))
    for f, knot, up in term:
        out = out * np.maximum(x[:, f] - knot if up else knot - x[:, f], 0.0)
    return out


def products(df: DataFrame, terms: list[Term]) -> np.ndarray:
    """Sums of w * u * v over the rows (x, y, w) for all pairs of terms and y, the last row and column."""

    def sums(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc = np.zeros((len(terms) + 1, len(terms) + 1))
        for b in it:
            for lo in range(0, b.num_rows, 4096):
                part = b.slice(lo, 4096)
                x = np.asarray(part.column(0).flatten().to_numpy(zero_copy_only=False), dtype=float).reshape(part.num_rows, -1)
                z = np.stack([*[_value(t, x) for t in terms], part.column(1).to_numpy()], axis=1)
                acc += z.T @ (z * part.column(2).to_numpy()[:, None])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(acc.size)), pa.array(acc.ravel())], ["i", "v"])

    out = np.zeros((len(terms) + 1) ** 2)
    for r in df.mapInArrow(sums, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():
        out[r["i"]] = r["v"]
    return out.reshape(len(terms) + 1, -1)


def _sweep(a: np.ndarray, k: int) -> np.ndarray:
    """What is left of the matrix once column k is explained away."""
    return a - np.outer(a[:, k], a[k]) / a[k, k]


def forward(g: np.ndarray, groups: list[list[int]], chosen: list[int], most: int) -> list[int]:
    """Columns added group by group, each time the group that explains most of y (the last column); first of equals."""
    size, chosen, left = np.maximum(np.diag(g), 1e-300), list(chosen), g.copy()
    for k in chosen:
        left = _sweep(left, k)
    whole = left[-1, -1]
    while len(chosen) < most:
        best = (LEAST * whole, None)
        for group in groups:
            a, gain, own = left, 0.0, []
            for k in group:
                if k in chosen or a[k, k] <= 1e-9 * size[k] or len(chosen) + len(own) >= most:
                    continue
                gain += a[k, -1] ** 2 / a[k, k]
                own.append(k)
                if k != group[-1]:
                    keep = [*group, -1]
                    small = _sweep(a[np.ix_(keep, keep)], group.index(k))
                    a = a.copy()
                    a[np.ix_(keep, keep)] = small
            if own and gain > best[0] * (1 + 1e-9):
                best = (gain, own)
        if best[1] is None:
            break
        for k in best[1]:
            left = _sweep(left, k)
        chosen += best[1]
    return chosen


def _rest(g: np.ndarray, cols: Sequence[int]) -> float:
    """Squared error of y on the columns."""
    b = np.linalg.lstsq(g[np.ix_(cols, cols)], g[cols, -1], rcond=1e-12)[0]
    return max(float(g[-1, -1] - 2 * b @ g[cols, -1] + b @ g[np.ix_(cols, cols)] @ b), 0.0)


def prune(g: np.ndarray, chosen: list[int], n: float, penalty: float, method: str) -> list[int]:
    """The columns with the least generalised cross-validation error; column 0, the constant, always stays.

    backward drops the term that costs least, one after the other; forward
    tries the prefixes of the order of choice; exhaustive tries all subsets (of
    at most MOST_SUBSETS terms); none keeps all.
    """
    floor = LEAST * max(_rest(g, [0]), 1e-300)

    def error(cols):
        used = len(cols) + penalty * (len(cols) - 1) / 2
        return float("inf") if used >= n else max(_rest(g, cols), floor) / n / (1 - used / n) ** 2

    if method == "none" or len(chosen) == 1:
        return chosen
    if method == "forward":
        tried = [chosen[:i] for i in range(1, len(chosen) + 1)]
    elif method == "exhaustive":
        if len(chosen) - 1 > MOST_SUBSETS:
            raise ValueError(f"exhaustive pruning takes at most {MOST_SUBSETS} terms")
        tried = [[0, *s] for m in range(len(chosen)) for s in combinations(chosen[1:], m)]
    else:
        tried, now = [chosen], list(chosen)
        while len(now) > 1:
            now = min(([c for c in now if c != k] for k in now[1:]), key=lambda cols: _rest(g, cols))
            tried.append(now)
    return min(tried, key=lambda cols: (round(error(cols) / floor, 6), len(cols)))


@dataclass
class Hinges:
    """Terms over scaled features and their coefficients; the first term is the constant."""

    features: list[str]
    mean: list[float]
    scale: list[float]
    terms: list[Term]
    coefficients: list[float]

    def sql(self) -> str:
        num = lambda v: f"double('{float(v)!r}')"
        parts = []
        for t, c in zip(self.terms, self.coefficients):
            hinges = []
            for f, knot, up in t:
                x = f"(coalesce(nanvl(double(`{self.features[f]}`), NULL), {num(self.mean[f])}) - {num(self.mean[f])}) / {num(self.scale[f])}"
                hinges.append(f"greatest({x} - {num(knot)}, {num(0)})" if up else f"greatest({num(knot)} - {x}, {num(0)})")
            parts.append(" * ".join([num(c), *hinges]))
        return " + ".join(parts)

    def transform(self, df: DataFrame) -> DataFrame:
        """df with _p, the prediction in an array."""
        return df.withColumn("_p", F.array(F.expr(self.sql())))

    def table(self) -> list[tuple[str, float]]:
        """(term, coefficient) with knots on the features' own scale."""
        name = lambda h: (lambda k: f"h({self.features[h[0]]}-{k:g})" if h[2] else f"h({k:g}-{self.features[h[0]]})")(h[1] * self.scale[h[0]] + self.mean[h[0]])
        return [("*".join(map(name, t)) or "(Intercept)", float(c)) for t, c in zip(self.terms, self.coefficients)]


def fit_hinges(df: DataFrame, label: str, features: Sequence[str], num_terms: int = 21, prod_degree: int = 1, prune_method: str = "backward", penalty: float | None = None, knots: int = KNOTS, weight: str | None = None) -> Hinges:
    """At most num_terms terms (constant included), then pruned.

    Knots are the values of a feature, or its quantiles where it has more than
    ``knots``. prod_degree 2 adds products of chosen hinges of different
    features. ``penalty`` is the price of a knot in the cross-validation error
    (2, or 3 with products). Missing features count as the mean; rows without
    label are left out; without rows the prediction is 0.
    """
    if prune_method not in PRUNING:
        raise ValueError(f"prune_method is one of {', '.join(PRUNING)}")
    features, p = list(features), len(features)
    rows = df.where(F.col(label).isNotNull())
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    x = [F.nanvl(F.col(f"`{f}`").cast("double"), F.lit(None).cast("double")) for f in features]
    stats = [v for i in range(p) for v in (F.avg(x[i]).alias(f"m{i}"), F.stddev_pop(x[i]).alias(f"s{i}"))]
    s = rows.agg(F.count(F.lit(1)).alias("n"), *stats).first()
    mean, scale = [s[f"m{i}"] or 0.0 for i in range(p)], [s[f"s{i}"] or 1.0 for i in range(p)]
    if not s["n"]:
        return Hinges(features, mean, scale, [()], [0.0])
    z = F.array(*[(F.coalesce(x[i], F.lit(mean[i])) - F.lit(mean[i])) / F.lit(scale[i]) for i in range(p)])
    data = rows.select(z.alias("x"), F.col(label).cast("double").alias("y"), w.alias("w"))
    edges = bin_edges(rows, features, knots)
    low = rows.agg(*[F.min(v).alias(f"v{i}") for i, v in enumerate(x)]).first()
    terms: list[Term] = [()]
    groups = []
    for i, f in enumerate(features):
        at = ([low[f"v{i}"]] if low[f"v{i}"] is not None else []) + edges[f]
        for v in at[:-1]:
            knot = (v - mean[i]) / scale[i]
            terms += [((i, knot, True),), ((i, knot, False),)]
            groups.append([len(terms) - 2, len(terms) - 1])
    g = products(data, terms)
    n = float(s["n"])
    price = (2.0 if prod_degree < 2 else 3.0) if penalty is None else penalty
    # products need room beside the hinges they are made of
    chosen = forward(g, groups, [0], num_terms if prod_degree < 2 else max(3, (num_terms + 1) // 2))
    if prod_degree > 1 and len(chosen) < num_terms:
        own = [terms[k] for k in chosen]
        pairs = [a + b for a, b in combinations(own[1:], 2) if a[0][0] != b[0][0]]
        terms = own + pairs
        g = products(data, terms)
        chosen = forward(g, [[k] for k in range(len(own), len(terms))], list(range(len(own))), num_terms)
    kept = prune(g, chosen, n, price, prune_method)
    coef = np.linalg.lstsq(g[np.ix_(kept, kept)], g[kept, -1], rcond=1e-12)[0]
    return Hinges(features, mean, scale, [terms[k] for k in kept], [float(c) for c in coef])
