"""Feed-forward networks with one hidden layer: weight decay, case weights, numbers and classes.

A step sums loss and gradient over blocks of rows, one partial sum per task,
added up by Spark; the driver holds the weights and a limited-memory
quasi-Newton search, nothing that grows with the rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabkit.modelling.boosting import features_array, outcome
from tabkit.session import discard, stage

BLOCK = 4096
PAIRS = 10


def _shapes(p: int, hidden: int, out: int) -> list[tuple[int, ...]]:
    return [(p, hidden), (hidden,), (hidden, out), (out,)] if hidden else [(p, out), (out,)]


def _parts(theta: np.ndarray, shapes: list[tuple[int, ...]]) -> list[np.ndarray]:
    out, at = [], 0
    for s in shapes:
        n = int(np.prod(s))
        out.append(theta[at : at + n].reshape(s))
        at += n
    return out


def _loss_and_gradient(theta: np.ndarray, shapes, x: np.ndarray, y: np.ndarray, w: np.ndarray, classes: int) -> tuple[float, np.ndarray]:
    """Weighted sums over rows, without the penalty."""
    *inner, v, c = _parts(theta, shapes)
    a = 1 / (1 + np.exp(-np.clip(x @ inner[0] + inner[1], -500, 500))) if inner else x
    z = a @ v + c
    if classes:
        z -= z.max(axis=1, keepdims=True)
        e = np.exp(z)
        p = e / e.sum(axis=1, keepdims=True)
        at = y.astype(int)
        loss = float(-(w * (z[np.arange(len(y)), at] - np.log(e.sum(axis=1)))).sum())
        d = p * w[:, None]
        d[np.arange(len(y)), at] -= w
    else:
        off = z[:, 0] - y
        loss = float((w * off * off).sum() / 2)
        d = (w * off)[:, None]
    grad = [a.T @ d, d.sum(axis=0)]
    if inner:
        back = (d @ v.T) * a * (1 - a)
        grad = [x.T @ back, back.sum(axis=0), *grad]
    return loss, np.concatenate([g.ravel() for g in grad])


@dataclass
class Network:
    """Weights for features scaled by (x - mean) / scale; missing features count as the mean."""

    features: list[str]
    mean: list[float]
    scale: list[float]
    shapes: list[tuple[int, ...]]
    theta: np.ndarray
    classes: int
    y_mean: float
    y_scale: float
    losses: list[float]

    def transform(self, df: DataFrame) -> DataFrame:
        """df with _p: the prediction, or the class probabilities, as an array."""
        row = lambda v: "array(" + ", ".join(f"double('{float(t)!r}')" for t in v) + ")"
        table = lambda m: F.expr("array(" + ", ".join(row(v) for v in m.T) + ")")
        dot = lambda wts, x: F.aggregate(F.zip_with(wts, x, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)

        def layer(x: Column, w: np.ndarray, b: np.ndarray) -> Column:
            return F.zip_with(F.transform(table(w), lambda u: dot(u, x)), F.expr(row(b)), lambda a, c: a + c)

        x = F.zip_with(features_array(self.features), F.expr(row(self.mean)), lambda a, m: F.coalesce(a, m) - m)
        df = df.withColumn("_x", F.zip_with(x, F.expr(row(self.scale)), lambda a, s: a / s))
        *inner, v, c = _parts(self.theta, self.shapes)
        if inner:
            df = df.withColumn("_x", F.transform(layer(F.col("_x"), *inner), lambda u: 1 / (1 + F.exp(-u))))
        z = layer(F.col("_x"), v, c)
        p = outcome(z, "softmax") if self.classes else F.transform(z, lambda u: u * F.lit(self.y_scale) + F.lit(self.y_mean))
        return df.withColumn("_p", p).drop("_x")


def fit_network(df: DataFrame, label: str, features: Sequence[str], classes: int = 0, hidden_units: int = 5, penalty: float = 0.0, epochs: int = 100, weight: str | None = None, seed: int = 1, tolerance: float = 1e-9) -> Network:
    """Least mean loss + penalty / 2 * (sum of squared weights, offsets apart).

    ``classes`` 0 is for numbers (squared error, on the scaled label), else the
    label is 0..classes - 1 (softmax). hidden_units 0 is a linear model.
    Features are scaled to mean 0 and deviation 1 by the weighted training rows
    (a constant one is only centred). Rows without label are left out; without
    rows the weights stay as drawn.
    """
    features, p, out = list(features), len(features), max(classes, 1)
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    rows = df.where(F.col(label).isNotNull()).select(features_array(features).alias("x"), F.col(label).cast("double").alias("y"), w.alias("w"))
    sums = []
    for i in range(p):
        v, own = F.get("x", F.lit(i)), F.when(F.get("x", F.lit(i)).isNotNull(), F.col("w"))
        sums += [(F.sum(v * F.col("w")) / F.sum(own)).alias(f"m{i}"), (F.sum(v * v * F.col("w")) / F.sum(own)).alias(f"q{i}")]
    s = rows.agg(F.sum("w").alias("w"), (F.sum(F.col("y") * F.col("w")) / F.sum("w")).alias("y"), (F.sum(F.col("y") ** 2 * F.col("w")) / F.sum("w")).alias("yy"), *sums).first()
    spread = lambda m, q: float(np.sqrt(max(q - m * m, 0.0))) or 1.0
    mean = [s[f"m{i}"] or 0.0 for i in range(p)]
    scale = [spread(m, s[f"q{i}"] or 0.0) if (s[f"q{i}"] or 0.0) - m * m > 1e-12 * max(1.0, m * m) else 1.0 for i, m in enumerate(mean)]
    y_mean, y_scale = (0.0, 1.0) if classes else (s["y"] or 0.0, spread(s["y"] or 0.0, s["yy"] or 0.0))
    total = s["w"] or 0.0
    shapes = _shapes(p, hidden_units, out)
    rng = np.random.default_rng(seed)
    theta = np.concatenate([(rng.normal(size=t) / np.sqrt(t[0]) if len(t) == 2 and hidden_units else np.zeros(t)).ravel() for t in shapes])
    ridge = np.concatenate([np.full(int(np.prod(t)), penalty if len(t) == 2 else 0.0) for t in shapes])
    if not total:
        return Network(features, mean, scale, shapes, theta, classes, y_mean, y_scale, [])
    m_, s_ = np.array(mean), np.array(scale)

    def pack(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for lo in range(0, b.num_rows, BLOCK):
                part = b.slice(lo, BLOCK)
                x = np.asarray(part.column(0).flatten().to_numpy(zero_copy_only=False), dtype=float).reshape(-1, p)
                x = np.nan_to_num((x - m_) / s_, nan=0.0)
                y, wt = part.column(1).to_numpy(), part.column(2).to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in (x, (y - y_mean) / y_scale, wt)], ["x", "y", "w"])

    blocks = stage(rows.mapInArrow(pack, "x binary, y binary, w binary"))

    def both(at: np.ndarray) -> tuple[float, np.ndarray]:
        def sums(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            acc = np.zeros(len(at) + 1)
            for b in it:
                for i in range(b.num_rows):
                    x, y, wt = (np.frombuffer(b.column(k)[i].as_py(), dtype=float) for k in range(3))
                    loss, grad = _loss_and_gradient(at, shapes, x.reshape(-1, p), y, wt, classes)
                    acc[0] += loss
                    acc[1:] += grad
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(acc))), pa.array(acc)], ["i", "v"])

        got = blocks.mapInArrow(sums, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()  # one row per weight
        v = np.zeros(len(at) + 1)
        for r in got:
            v[r["i"]] = r["v"]
        return v[0] / total + float((ridge * at * at).sum()) / 2, v[1:] / total + ridge * at

    theta, losses = minimise(both, theta, epochs, tolerance)
    discard(blocks)
    return Network(features, mean, scale, shapes, theta, classes, y_mean, y_scale, losses)


def minimise(both, x: np.ndarray, steps: int, tolerance: float = 1e-9) -> tuple[np.ndarray, list[float]]:
    """Limited-memory BFGS with halving steps; ``both`` gives loss and gradient. The weights reached and the loss of every step."""
    f, g = both(x)
    losses, moves, turns = [f], [], []
    for _ in range(steps):
        q, kept = g.copy(), []
        for s, y in zip(reversed(moves), reversed(turns)):
            a = (s @ q) / (s @ y)
            q -= a * y
            kept.append(a)
        if moves:
            q *= (moves[-1] @ turns[-1]) / (turns[-1] @ turns[-1])
        for s, y, a in zip(moves, turns, reversed(kept)):
            q += s * (a - (y @ q) / (s @ y))
        size, slope = 1.0 if moves else min(1.0, 1.0 / (np.abs(g).sum() or 1.0)), -(q @ g)
        if slope >= 0 or np.abs(g).max() < tolerance:
            break
        while True:
            new = x - size * q
            f2, g2 = both(new)
            if f2 <= f + 1e-4 * size * slope or size < 1e-10:
                break
            size /= 2
        if f2 > f:
            break
        s, y = new - x, g2 - g
        if s @ y > 1e-12:
            moves, turns = [*moves[-PAIRS + 1 :], s], [*turns[-PAIRS + 1 :], y]
        done = f - f2 <= tolerance * max(1.0, abs(f))
        x, f, g = new, f2, g2
        losses.append(f)
        if done:
            break
    return x, losses
