"""Distances between short texts, 0 for equal."""

from __future__ import annotations

from collections import Counter
from math import sqrt

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _chars(x: Column) -> Column:
    return F.filter(F.split(x, ""), lambda c: c != "")


def jaccard(a: Column, b: Column) -> Column:
    """1 - shared / all distinct characters."""
    x, y = _chars(a), _chars(b)
    return 1 - F.coalesce(F.try_divide(F.size(F.array_intersect(x, y)), F.size(F.array_union(x, y))), F.lit(0.0))


def _count(text: Column, ch: Column) -> Column:
    return (F.length(text) - F.length(F.replace(text, ch, F.lit("")))).cast("double")


def _dot(a: Column, b: Column) -> Column:
    """Sum over the characters of a of their counts in a and b."""
    return F.aggregate(F.array_distinct(_chars(a)), F.lit(0.0), lambda acc, c: acc + _count(a, c) * _count(b, c))


def cosine(a: Column, b: Column) -> Column:
    """1 - cosine of the character counts."""
    dist = 1 - F.coalesce(F.try_divide(_dot(a, b), F.sqrt(_dot(a, a) * _dot(b, b))), F.lit(0.0))
    return F.greatest(dist, F.lit(0.0))


def soundex(a: Column, b: Column) -> Column:
    return F.when(F.soundex(a) == F.soundex(b), 0.0).otherwise(1.0)


def jaro_text(s: str, t: str) -> float:
    if s == t:
        return 0.0
    if not s or not t:
        return 1.0
    reach = max(max(len(s), len(t)) // 2 - 1, 0)
    taken = [False] * len(t)
    left = []
    for i, ch in enumerate(s):
        for j in range(max(0, i - reach), min(len(t), i + reach + 1)):
            if not taken[j] and t[j] == ch:
                taken[j] = True
                left.append(ch)
                break
    m = len(left)
    if not m:
        return 1.0
    right = [t[j] for j, used in enumerate(taken) if used]
    swaps = sum(p != q for p, q in zip(left, right)) // 2
    return 1 - (m / len(s) + m / len(t) + (m - swaps) / m) / 3


def _counts(s: str, seen: dict) -> tuple[dict, float]:
    if s not in seen:
        n = Counter(s)
        seen[s] = n, sqrt(sum(v * v for v in n.values()))
    return seen[s]


def cosine_text(s: str, t: str, seen: dict) -> float:
    (a, na), (b, nb) = _counts(s, seen), _counts(t, seen)
    if not na or not nb:
        return 1.0
    return max(1 - sum(v * b[c] for c, v in a.items() if c in b) / (na * nb), 0.0)


def cosine_and_jaro(a: Column, b: Column) -> Column:
    """Both distances as a struct (cosine, jw), for many pairs of few names.

    The counts of a name are kept for the batch, which beats counting anew per
    pair inside a column expression by far.
    """

    @F.pandas_udf("cosine double, jw double")
    def run(x: pd.Series, y: pd.Series) -> pd.DataFrame:
        seen: dict = {}
        pairs = list(zip(x, y))
        return pd.DataFrame({"cosine": [cosine_text(s, t, seen) for s, t in pairs], "jw": [jaro_text(s, t) for s, t in pairs]})

    return run(a, b)


def jaro(a: Column, b: Column) -> Column:
    """Jaro distance; matching is sequential, so it runs in Arrow batches."""
    @F.pandas_udf("double")
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([None if s is None or t is None else jaro_text(s, t) for s, t in zip(x, y)], dtype="float64")

    return run(a, b)
