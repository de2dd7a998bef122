import math
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabkit.modelling import boosting, explain, models, tune
from tabkit.modelling.boosting import fit_boosted
from tabkit.modelling.tree_shap import boosted_leaves, contributions, mllib_leaves, tree_contributions


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    x = rng.integers(0, 9, (400, 3)).astype(float)
    y = x[:, 0] * 2 + (x[:, 1] > 4) * x[:, 2] + rng.normal(0, 0.1, 400)
    out = [(i, *map(float, x[i]), float(y[i]), "abc"[int(x[i, 0]) // 3]) for i in range(400)]
    out += [(400 + i, None, float("nan"), 3.0, 50.0, "c") for i in range(20)]
    return spark.createDataFrame(out, "id int, a double, b double, c double, y double, k string").cache()


def plain_round(x, g, h, lam, depth, rate):
    """One greedy second-order tree on complete rows, all cuts tried."""
    out = np.zeros(len(x))

    def grow(own, left):
        G, H = g[own].sum(), h[own].sum()
        best = (1e-12, None)
        if left:
            for f in range(x.shape[1]):
                for c in sorted(set(x[own, f]))[1:]:
                    a = own[x[own, f] < c]
                    A, B = g[a].sum(), h[a].sum()
                    gain = 0.5 * (A * A / (B + lam) + (G - A) ** 2 / (H - B + lam) - G * G / (H + lam))
                    if B >= 1 and H - B >= 1 and gain > best[0] * (1 + 1e-12):
                        best = (gain, (f, c))
        if best[1] is None:
            out[own] = -rate * G / (H + lam)
            return
        f, c = best[1]
        grow(own[x[own, f] < c], left - 1)
        grow(own[x[own, f] >= c], left - 1)

    grow(np.arange(len(x)), depth)
    return out


@pytest.mark.parametrize("in_tasks", [False, True])
def test_rounds_equal_plain_greedy_trees(spark, rows, monkeypatch, in_tasks):
    if in_tasks:
        monkeypatch.setattr(boosting, "CELLS_HERE", 0)
    full = rows.where("id < 400")
    got = fit_boosted(full, "y", ["a", "b", "c"], trees=3, tree_depth=3, learn_rate=0.5).transform(full)
    p = {r["id"]: r["_p"][0] for r in got.collect()}
    data = full.orderBy("id").collect()
    x, y = np.array([[r["a"], r["b"], r["c"]] for r in data]), np.array([r["y"] for r in data])
    m = np.full(len(y), y.mean())
    for _ in range(3):
        m += plain_round(x, m - y, np.ones(len(y)), 1.0, 3, 0.5)
    assert np.allclose([p[r["id"]] for r in data], m, atol=1e-8)


def test_missing_values_take_the_better_side(spark, rows):
    fit = models.boost_tree("regression", trees=20, tree_depth=2, learn_rate=0.5).fit(rows, "y", ["a", "b"])
    far = fit.predict(rows).groupBy((F.col("id") >= 400).alias("gone")).agg(F.avg("pred").alias("p")).collect()
    assert {r["gone"]: round(r["p"]) for r in far}[True] > 40


def test_softmax_learns_and_adds_up(spark, rows):
    fit = models.boost_tree(trees=6, tree_depth=2).fit(rows, "k", ["a", "c"])
    p = fit.predict(rows.where("id < 400"))
    assert p.where("pred = k").count() / 400 > 0.97
    assert p.agg(F.max(F.abs(F.col("prob_a") + F.col("prob_b") + F.col("prob_c") - 1))).first()[0] < 1e-12
    assert explain.importance(fit, spark).first()["feature"] == "a"


def test_case_weights_count_like_repeated_rows(spark, rows):
    w = rows.withColumn("w", (F.col("id") % 3 + 1).cast("double"))
    many = w.withColumn("r", F.explode(F.sequence(F.lit(1), F.col("w").cast("int"))))
    spec = models.boost_tree("regression", trees=3, tree_depth=2)
    a = spec.fit(w, "y", ["a", "c"], weight="w").predict(rows)
    b = spec.fit(many, "y", ["a", "c"]).predict(rows)
    assert a.select("id", F.col("pred").alias("p")).join(b.select("id", "pred"), "id").agg(F.max(F.abs(F.col("p") - F.col("pred")))).first()[0] < 1e-8


def test_mtry_and_samples_are_repeatable(spark, rows):
    fit = lambda seed: fit_boosted(rows, "y", ["a", "b", "c"], trees=2, tree_depth=2, mtry=1, sample_size=0.5, row_id="id", seed=seed)
    a, b = fit(1), fit(1)
    for t, u in zip([t for r in a.rounds for t in r], [t for r in b.rounds for t in r], strict=True):
        assert t.feature == u.feature and t.cut == u.cut and np.allclose(t.value, u.value)
        assert len({f for f in t.feature if f >= 0}) <= 1


def test_unlearnable(spark, rows):
    flat = rows.withColumn("y", F.lit(4.0))
    assert {r["pred"] for r in models.boost_tree("regression", trees=2).fit(flat, "y", ["a"]).predict(flat).collect()} == {4.0}
    none = models.boost_tree("regression", trees=1).fit(rows.limit(0), "y", ["a"])
    assert {r["pred"] for r in none.predict(rows).collect()} == {0.0}


def test_folds_stop_together(spark, rows):
    noise = rows.withColumn("y", F.rand(3)).withColumn("fold", F.col("id") % 3)
    r = tune.tune_boost_rounds(models.boost_tree("regression", trees=30, learn_rate=0.9, tree_depth=4), noise, [{}], "y", ["a", "b", "c"], early_stop=2).first()
    assert r["ran"] == r["iter"] + 2 < 30


def by_subsets(leaves, base, x):
    """Shapley values from the weighted leaf sums of every subset of features."""
    p = len(x)

    def known(s):
        out = base
        for leaf in leaves:
            w = leaf.value
            for j, f in enumerate(leaf.features):
                meets = leaf.missing[j] if math.isnan(x[f]) else leaf.lo[j] < x[f] <= leaf.hi[j]
                w *= (1.0 if meets else 0.0) if f in s else leaf.share[j]
            out += w
        return out

    phi = []
    for f in range(p):
        rest = [i for i in range(p) if i != f]
        phi.append(sum(math.factorial(k) * math.factorial(p - k - 1) / math.factorial(p) * (known({*s, f}) - known(set(s))) for k in range(p) for s in combinations(rest, k)))
    return phi


@pytest.mark.parametrize("kind", ["boosted", "softmax", "forest", "forest_class", "logistic"])
def test_contributions_equal_all_subsets(spark, rows, kind):
    cols, level = ["a", "b", "c"], None
    d = rows if kind in ("boosted", "softmax") else rows.where("id < 400")
    d = d.withColumn("two", F.when(F.col("a") > 4, "yes").otherwise("no"))
    if kind == "boosted":
        fit = models.boost_tree("regression", trees=4, tree_depth=4).fit(d, "y", cols)
    elif kind == "softmax":
        fit, level = models.boost_tree(trees=3, tree_depth=3).fit(d, "k", cols), "b"
    elif kind == "logistic":
        fit, level = models.boost_tree(trees=3, tree_depth=3).fit(d, "two", cols), "no"
    elif kind == "forest":
        fit = models.rand_forest("regression", trees=4, tree_depth=4).fit(d, "y", cols)
    else:
        fit, level = models.rand_forest(trees=4, tree_depth=4).fit(d, "k", cols), "b"
    at = fit.levels.index(level) if level else None
    leaves, base = boosted_leaves(fit.model, at if kind == "softmax" else 0) if hasattr(fit.model, "rounds") else mllib_leaves(fit.model, at)
    sign = -1 if kind == "logistic" else 1
    few = d.orderBy("id").limit(25).unionByName(d.where("id >= 400").limit(2))
    got = {r["id"]: r for r in tree_contributions(fit, few, "id", level).collect()}
    for r in few.collect():
        x = [float("nan") if r[c] is None else r[c] for c in cols]
        assert np.allclose([got[r["id"]][c] for c in cols], [sign * v for v in by_subsets(leaves, base, x)], atol=1e-9)
    want = {r["id"]: r for r in (fit.model.transform(few).select("id", (F.get("_margins", F.lit(at if kind == "softmax" else 0)) * sign).alias("v")) if hasattr(fit.model, "rounds") else fit.predict(few).select("id", F.col("pred" if kind == "forest" else "prob_b").alias("v"))).collect()}
    assert all(math.isclose(sum(r[c] for c in cols) + r["baseline"], want[i]["v"], abs_tol=1e-9) for i, r in got.items())


def test_contributions_of_no_rows_and_no_splits(spark, rows):
    fit = models.boost_tree("regression", trees=1).fit(rows.withColumn("y", F.lit(1.0)), "y", ["a"])
    assert {(r["a"], r["baseline"]) for r in tree_contributions(fit, rows, "id").collect()} == {(0.0, 1.0)}
    assert tree_contributions(fit, rows.limit(0), "id").count() == 0
    assert contributions([], np.zeros((2, 1)))[1] == 0.0
