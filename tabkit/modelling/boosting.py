"""Gradient-boosted trees from histograms: binned features, one aggregation per tree level, second-order gain.

Rows are stored once with their bins. A level of all trees of a round is one
grouped sum of gradients and Hessians by (class, node, feature, bin), partial
sums first; the best cut of every node is found in the grouped table and only
the cuts, at most 2**depth per class, reach the driver. A round ends by writing
the rows with their new margins, which cuts the lineage.
"""

from __future__ import annotations

import random
from collections.abc import Sequence
from dataclasses import dataclass
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabkit.scale import value_counts_running
from tabkit.session import discard, stage

FLAT = 1e-16


@dataclass
class Tree:
    """Nodes in heap order (children of i are 2i + 1, 2i + 2); feature -1 marks a leaf. value is set at leaves, shrunk already."""

    feature: list[int]
    cut: list[float]
    bin: list[int]
    missing_left: list[bool]
    value: list[float]
    cover: list[float]
    gain: list[float]

    @staticmethod
    def empty(depth: int) -> Tree:
        n = 2 ** (depth + 1) - 1
        return Tree([-1] * n, [0.0] * n, [0] * n, [True] * n, [0.0] * n, [0.0] * n, [0.0] * n)


def walk(tree: Column, x: Column, cut: str, depth: int) -> Column:
    """The node a row ends in: ``depth`` steps down a tree struct, x an array of values (null missing)."""

    def step(node: Column, _: Column) -> Column:
        f = F.get(tree["feature"], node)
        v = F.get(x, f)
        left = F.when(v.isNull(), F.get(tree["missing_left"], node)).otherwise(v < F.get(tree[cut], node))
        return F.when(f < 0, node).otherwise(2 * node + F.when(left, 1).otherwise(2))

    return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(0), step) if depth else F.lit(0)


def _sql(v) -> str:
    return str(v).lower() if isinstance(v, bool) else str(v) if isinstance(v, int) else f"double('{v!r}')"


def _structs(trees: Sequence[Tree], binned: bool) -> Column:
    """The trees as a constant array of structs."""
    names = ("feature", "bin", "missing_left", "value") if binned else ("feature", "cut", "missing_left", "value")
    one = lambda t: ", ".join(f"'{k}', array({', '.join(map(_sql, getattr(t, k)))})" for k in names)
    return F.expr(f"array({', '.join(f'named_struct({one(t)})' for t in trees)})")


def features_array(features: Sequence[str]) -> Column:
    """The features as doubles, NaN and null both null."""
    x = [F.col(f"`{f}`").cast("double") for f in features]
    return F.array(*[F.when(~F.isnan(v), v) for v in x])


@dataclass
class Boosted:
    """Rounds of trees, one per class and round (a single one for numbers and two classes)."""

    features: list[str]
    base: list[float]
    rounds: list[list[Tree]]
    depth: int
    objective: str
    history: list[dict]

    def margins(self) -> Column:
        """array<double>: the margin of every output, from the features in _x."""
        out = []
        for k, b in enumerate(self.base):
            trees = _structs([r[k] for r in self.rounds], binned=False)
            out.append(F.aggregate(trees, F.lit(float(b)), lambda m, t: m + F.get(t["value"], walk(t, F.col("_x"), "cut", self.depth))))
        return F.array(*out)

    def transform(self, df: DataFrame) -> DataFrame:
        """df with _margins and _p, the prediction or the class probabilities, as arrays."""
        df = df.withColumn("_x", features_array(self.features)).withColumn("_margins", self.margins()).drop("_x")
        return df.withColumn("_p", outcome(F.col("_margins"), self.objective))

    def importances(self) -> dict[str, float]:
        """Total gain per feature."""
        out = dict.fromkeys(self.features, 0.0)
        for r in self.rounds:
            for t in r:
                for f, g in zip(t.feature, t.gain):
                    if f >= 0:
                        out[self.features[f]] += g
        return out


def outcome(margins: Column, objective: str) -> Column:
    """array: the prediction itself, or the class probabilities."""
    if objective == "squared":
        return margins
    if objective == "logistic":
        p = 1 / (1 + F.exp(-F.get(margins, F.lit(0))))
        return F.array(1 - p, p)
    top = F.array_max(margins)
    e = F.transform(margins, lambda m: F.exp(m - top))
    return F.transform(e, lambda v: v / F.aggregate(e, F.lit(0.0), lambda a, b: a + b))


def _gradients(objective: str, n_out: int) -> Column:
    """array<struct<g, h>> per output, from y and the margins m."""
    y, m, pairs = F.col("y"), F.col("m"), []
    for k in range(n_out):
        if objective == "squared":
            g, h = F.get(m, F.lit(k)) - y, F.lit(1.0)
        elif objective == "logistic":
            p = 1 / (1 + F.exp(-F.get(m, F.lit(0))))
            g, h = p - y, F.greatest(p * (1 - p), F.lit(FLAT))
        else:
            p = F.get(F.col("_soft"), F.lit(k))
            g, h = p - (y == k).cast("double"), F.greatest(2 * p * (1 - p), F.lit(FLAT))
        pairs.append(F.struct((g * F.col("w")).alias("g"), (h * F.col("w")).alias("h")))
    return F.array(*pairs)


def loss(objective: str) -> Column:
    """Mean loss over rows with y, w and margins m: rmse for numbers, log loss for classes."""
    w = F.col("w")
    if objective == "squared":
        return F.sqrt(F.sum(w * (F.get(F.col("m"), F.lit(0)) - F.col("y")) ** 2) / F.sum(w))
    p = F.get(outcome(F.col("m"), objective), F.col("y").cast("int"))
    return F.sum(-w * F.log(F.greatest(p, F.lit(1e-15)))) / F.sum(w)


def bin_edges(df: DataFrame, features: Sequence[str], bins: int) -> dict[str, list[float]]:
    """Ascending lower edges of bins 1, 2, ... per feature: every value but the first, or those at equal shares of the rows where there are more than ``bins``."""
    long = df.select(*[F.col(f"`{f}`").cast("double").alias(f) for f in features]).unpivot([], list(features), "column", "v")
    long = long.where(F.col("v").isNotNull() & ~F.isnan("v"))
    ran = stage(value_counts_running(long, ["column"], "v", {"n": F.lit(1).cast("long")}))
    size = ran.groupBy("column").agg(F.count(F.lit(1)).alias("k"), F.min("v").alias("least"))
    share = lambda c: F.floor(c * bins / F.col("n_cum_total"))
    edge = (F.col("k") <= bins) | (share(F.col("n_cum") - F.col("n")) < share(F.col("n_cum")))
    rows = ran.join(F.broadcast(size), "column").where(edge & (F.col("v") > F.col("least"))).select("column", "v").collect()  # at most bins a feature
    return {f: sorted(r["v"] for r in rows if r["column"] == f) for f in features}


def _bin(f: str, edges: list[float]) -> Column:
    """Number of edges at or under the value; null if missing."""
    x = F.col(f"`{f}`").cast("double")
    if not edges:
        return F.when(x.isNotNull() & ~F.isnan(x), F.lit(0))
    e = F.array(*[F.lit(float(v)) for v in edges])
    return F.when(x.isNotNull() & ~F.isnan(x), F.size(F.filter(e, lambda v: v <= x)))


CUT = "k int, node int, feature int, bin int, missing_left boolean, gain double, lg double, lh double, tg double, th double"
CELLS_HERE = 200_000


def _best_cut(t: pa.Table, lam: float, min_n: float) -> dict:
    """The best cut of one (k, node) from its cells (feature, bin, g, h, n); bin null holds the missing rows.

    A cut sends bins under ``bin`` left and missing rows to the side with more
    gain. Ties go to the smaller feature, the smaller bin, missing to the left.
    """
    feature, b = t["feature"].to_numpy(), t["bin"].fill_null(-1).to_numpy()
    order = np.lexsort((b, feature))
    feature, b = feature[order], b[order]
    v = np.stack([t[c].to_numpy()[order].astype(float) for c in ("g", "h", "n")])
    first = np.flatnonzero(np.append(True, feature[1:] != feature[:-1]))
    size = np.diff(np.append(first, len(feature)))
    total = np.repeat(np.add.reduceat(v, first, axis=1), size, axis=1)
    missing = np.repeat(np.where(b[first] < 0, v[:, first], 0.0), size, axis=1)
    upto = np.cumsum(v, axis=1)
    under = upto - v - np.repeat((upto - v)[:, first], size, axis=1)
    score = lambda x: x[0] ** 2 / (x[1] + lam)
    best = None
    with np.errstate(divide="ignore", invalid="ignore"):
        for left in (True, False):
            a = under if left else under - missing
            z = total - a
            gain = 0.5 * (score(a) + score(z) - score(total))
            ok = (b >= 0) & (a[2] > 0.5) & (z[2] > 0.5) & (a[1] >= min_n) & (z[1] >= min_n)
            for i in np.flatnonzero(ok & (gain >= np.max(gain, where=ok, initial=-np.inf) * (1 - 1e-12)))[:1]:
                found = (float(f"{gain[i]:.12g}"), -feature[i], -b[i], left, i, a[:2, i])
                best = found if best is None or found[:4] > best[:4] else best
    t0 = total[:, 0]
    own = {"k": t["k"][0].as_py(), "node": t["node"][0].as_py(), "tg": float(t0[0]), "th": float(t0[1])}
    if best is None:
        return own | {"feature": None, "bin": None, "missing_left": None, "gain": None, "lg": None, "lh": None}
    gain, _, _, left, i, a = best
    return own | {"feature": int(feature[i]), "bin": int(b[i]), "missing_left": left, "gain": gain, "lg": float(a[0]), "lh": float(a[1])}


def _best_cuts(sums: DataFrame, cells: int, lam: float, min_n: float) -> list[dict]:
    """The best cut of every (k, node). The number of cells hangs on the model's parameters alone; many are searched in tasks, node by node."""
    if cells > CELLS_HERE:
        kind = pa.schema([(f.split()[0], {"int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_()}[f.split()[1]]) for f in CUT.split(", ")])
        return [r.asDict() for r in sums.groupBy("k", "node").applyInArrow(lambda t: pa.Table.from_pylist([_best_cut(t, lam, min_n)], schema=kind), CUT).collect()]
    t = sums.toArrow().combine_chunks()
    key = t["k"].to_numpy().astype(np.int64) << 32 | t["node"].to_numpy()
    return [_best_cut(t.filter(pa.array(key == k)), lam, min_n) for k in np.unique(key)]


class Booster:
    """Second-order boosting of ``objective`` squared, logistic (label 0/1) or softmax (label 0..n_classes - 1), a round at a time.

    min_n is the least Hessian sum of a child, penalty the ridge on leaf
    values, loss_reduction the least gain of a cut, mtry the number of features
    a tree may use, sample_size the share of rows of a round (both by hash;
    rows are told apart by ``row_id``, or by their features and label). Rows
    with ``valid`` true are not learned from, but their loss follows every
    round. Rows without a label are left out; missing features go to the better
    side of each cut. Without rows to learn from, the prediction is the base.
    """

    def __init__(
        self,
        df: DataFrame,
        label: str,
        features: Sequence[str],
        objective: str = "squared",
        n_classes: int = 0,
        learn_rate: float = 0.3,
        tree_depth: int = 6,
        min_n: float = 1.0,
        loss_reduction: float = 0.0,
        sample_size: float = 1.0,
        mtry: int | None = None,
        penalty: float = 1.0,
        bins: int = 64,
        weight: str | None = None,
        valid: str | None = None,
        row_id: str | None = None,
        seed: int = 0,
    ):
        self.features, self.objective, self.depth, self.seed = list(features), objective, tree_depth, seed
        self.rate, self.min_n, self.least_gain, self.share, self.mtry, self.lam = learn_rate, min_n, loss_reduction, sample_size, mtry, penalty
        self.n_out = n_classes if objective == "softmax" else 1
        w = F.col(weight).cast("double") if weight else F.lit(1.0)
        held = F.coalesce(F.col(valid).cast("boolean"), F.lit(False)) if valid else F.lit(False)
        rows = df.where(F.col(label).isNotNull()).withColumns({"_w": w, "_held": held})
        learn, y = rows.where("not _held"), F.col(label).cast("double")
        self.edges = bin_edges(learn, self.features, bins)
        if objective == "softmax":
            shares = learn.agg(*[F.sum(F.when(y == k, F.col("_w")).otherwise(0.0)).alias(f"s{k}") for k in range(n_classes)], F.sum("_w").alias("t")).first()
            self.base = [_log((shares[f"s{k}"] or 0.0) / (shares["t"] or 1.0)) for k in range(n_classes)]
        else:
            mean = learn.agg((F.sum(y * F.col("_w")) / F.sum("_w")).alias("m")).first()["m"] or 0.0
            self.base = [mean if objective == "squared" else _log(mean) - _log(1 - mean)]
        who = F.col(row_id) if row_id else F.xxhash64(*[F.col(f"`{f}`").cast("double") for f in self.features], y)
        state = rows.select(
            F.xxhash64(who).alias("id"), y.alias("y"), F.col("_w").alias("w"), F.col("_held").alias("held"),
            F.array(*[_bin(f, self.edges[f]) for f in self.features]).alias("b"), F.array(*[F.lit(float(b)) for b in self.base]).alias("m"),
        )
        self.state = stage(state)
        self.rounds: list[list[Tree]] = []
        self.history: list[dict] = []

    def step(self) -> dict:
        """Add a round; its number and the loss on learned and held rows after it."""
        grown = self._grow(len(self.rounds))
        step = _structs(grown, binned=True)
        moved = F.transform(F.arrays_zip(F.col("m").alias("m"), step.alias("t")), lambda p: p["m"] + F.get(p["t"]["value"], walk(p["t"], F.col("b"), "bin", self.depth)))
        after = stage(self.state.withColumn("m", moved))
        discard(self.state)
        self.state = after
        self.rounds.append(grown)
        now = {r["held"]: r["loss"] for r in self.state.groupBy("held").agg(loss(self.objective).alias("loss")).collect()}
        self.history.append({"round": len(self.rounds), "loss_trn": now.get(False), "loss_tst": now.get(True)})
        return self.history[-1]

    def finish(self, rounds: int | None = None) -> Boosted:
        """The model of the first ``rounds`` rounds; the stored rows go."""
        discard(self.state)
        return Boosted(self.features, self.base, self.rounds[:rounds], self.depth, self.objective, self.history)

    def _grow(self, i: int) -> list[Tree]:
        """The trees of round i, one per output, level by level."""
        d = self.state.where("not held")
        if self.share < 1:
            d = d.where(F.pmod(F.xxhash64("id", F.lit(self.seed), F.lit(i)), F.lit(1_000_000)) < int(self.share * 1_000_000))
        if self.objective == "softmax":
            d = d.withColumn("_soft", outcome(F.col("m"), "softmax"))
        d = d.select("b", F.posexplode(_gradients(self.objective, self.n_out)).alias("k", "gh"))
        used, heap = list(range(len(self.features))), 2 ** (self.depth + 1)
        if self.mtry and self.mtry < len(used):
            used = sorted(random.Random(f"{self.seed}-{i}").sample(used, self.mtry))
        grown = [Tree.empty(self.depth) for _ in range(self.n_out)]
        live = [(k, 0) for k in range(self.n_out)]
        for level in range(self.depth):
            if not live:
                break
            at = walk(F.get(_structs(grown, binned=True), F.col("k")), F.col("b"), "bin", level)
            met = d.withColumn("node", at).where((F.col("k") * heap + F.col("node")).isin([k * heap + n for k, n in live])) if level else d.withColumn("node", F.lit(0))
            cells = F.array(*[F.struct(F.lit(f).alias("feature"), F.get(F.col("b"), F.lit(f)).alias("bin")) for f in used])
            sums = met.select("k", "node", "gh", F.explode(cells).alias("c")).groupBy("k", "node", F.col("c.feature").alias("feature"), F.col("c.bin").alias("bin"))
            sums = sums.agg(F.sum("gh.g").alias("g"), F.sum("gh.h").alias("h"), F.count(F.lit(1)).alias("n"))
            n_cells, following = len(live) * len(used) * (max(map(len, self.edges.values())) + 2), []
            for c in _best_cuts(sums, n_cells, self.lam, self.min_n):
                t, n = grown[c["k"]], c["node"]
                if not level:
                    t.value[0], t.cover[0] = -self.rate * c["tg"] / (c["th"] + self.lam), c["th"]
                if c["gain"] is None or c["gain"] <= max(self.least_gain, 1e-12):
                    continue
                t.feature[n], t.bin[n], t.missing_left[n], t.gain[n] = c["feature"], c["bin"], c["missing_left"], c["gain"]
                t.cut[n] = self.edges[self.features[c["feature"]]][c["bin"] - 1]
                for child, g, h in ((2 * n + 1, c["lg"], c["lh"]), (2 * n + 2, c["tg"] - c["lg"], c["th"] - c["lh"])):
                    t.value[child], t.cover[child] = -self.rate * g / (h + self.lam), h
                    following.append((c["k"], child))
            live = following
        return grown


def fit_boosted(df: DataFrame, label: str, features: Sequence[str], trees: int = 15, stop_iter: int | None = None, **options) -> Boosted:
    """``trees`` rounds of a Booster. With stop_iter the fit ends once the loss of the held rows (of the learned ones, if none are held) has not fallen for so many rounds, and keeps the rounds up to the best."""
    b = Booster(df, label, features, **options)
    best, at = None, 0
    for i in range(1, trees + 1):
        now = b.step()
        watch = now["loss_trn"] if now["loss_tst"] is None else now["loss_tst"]
        if best is None or watch < best:
            best, at = watch, i
        if stop_iter and i - at >= stop_iter:
            break
    return b.finish(at if stop_iter else None)


def _log(p: float) -> float:
    return log(min(max(p, 1e-15), 1 - 1e-15)) if p < 1 else 0.0
