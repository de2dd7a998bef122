"""Properties of splits, models, tuning, explanation and matching."""

import math
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabkit.functions import scalars, text_distance as td, udf
from tabkit.modelling import ensemble, explain, metrics as m, models, neighbours, resample as rs, tune
from tabkit.operators import geo, matching, series
from tabkit.plans import adversarial, places
from tabkit.sources import tables as io
from tabkit.session import scratch_dir, stage


@pytest.fixture(scope="module")
def signal(spark):
    """y follows x; 'hot' takes a third of the groups."""
    d = spark.range(600).select("id", F.sin(F.col("id") * 12.9898).alias("x"), F.cos(F.col("id") * 78.233).alias("z"))
    d = d.withColumn("y", 3 * F.col("x") + 0.1 * F.col("z")).withColumn("c", F.when(F.col("x") > 0.2, "yes").otherwise("no"))
    return d.withColumn("g", F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id"))).cache()


def test_splits_are_exact_and_repeat(spark, signal):
    a = rs.initial_split(signal, "id", 0.75, "c", seed=3)
    by = {(r["c"], r["is_train"]): r["n"] for r in a.groupBy("c", "is_train").agg(F.count("*").alias("n")).collect()}
    for c in ("yes", "no"):
        n = by[(c, True)] + by[(c, False)]
        assert by[(c, True)] == math.floor(0.75 * n)
    b = rs.initial_split(signal.repartition(13), "id", 0.75, "c", seed=3)
    assert a.exceptAll(b.select(a.columns)).isEmpty()


def test_folds_balance(spark, signal):
    f = rs.vfold(signal, "id", 7, "c").groupBy("c", "fold").agg(F.count("*").alias("n")).collect()
    for c in ("yes", "no"):
        n = [r["n"] for r in f if r["c"] == c]
        assert len(n) == 7 and max(n) - min(n) <= 1
    assert rs.vfold(signal.limit(3), "id", 5).count() == 3
    for folds in (rs.group_vfold(signal, "g", 4), rs.group_vfold_balanced(signal, "g", 4)):
        assert folds.groupBy("g").agg(F.count_distinct("fold").alias("k")).where("k > 1").isEmpty()
        assert folds.count() == 600


def test_class_balance(spark, signal):
    few = signal.where("c = 'yes' OR id % 5 = 0")
    up = rs.upsample(few, "c", "id").groupBy("c").count().collect()
    down = rs.downsample(few, "c", "id").groupBy("c").count().collect()
    n = sorted(r["count"] for r in few.groupBy("c").count().collect())
    assert {r["count"] for r in up} == {n[1]} and {r["count"] for r in down} == {n[0]}


def test_bootstrap_mean_weight(spark, signal):
    w = rs.bootstraps(signal, "id", 20).agg(F.avg("weight").alias("m"), F.avg((F.col("weight") == 0).cast("int")).alias("o")).first()
    assert abs(w["m"] - 1) < 0.05 and abs(w["o"] - math.exp(-1)) < 0.03


@pytest.mark.parametrize("spec", [models.linear_reg(), models.rand_forest("regression", trees=10), models.boost_tree("regression", trees=10), models.bag_tree(trees=5), models.mars(num_terms=8)])
def test_regressions_learn(spark, signal, spec):
    p = spec.fit(signal, "y", ["x", "z"]).predict(signal)
    r = p.agg(m.rmse("y", "pred").alias("e"), F.stddev("y").alias("s")).first()
    assert r["e"] < 0.5 * r["s"]


@pytest.mark.parametrize("spec", [models.linear_reg("classification"), models.rand_forest(trees=10), models.boost_tree(trees=5), models.mlp(hidden_units=3, epochs=60)])
def test_classifiers_learn_and_repeat(spark, signal, spec):
    p = spec.fit(signal, "c", ["x", "z"]).predict(signal)
    assert p.agg(m.accuracy("c", "pred").alias("a")).first()["a"] > 0.9
    assert math.isclose(p.agg(F.avg(F.col("prob_yes") + F.col("prob_no")).alias("t")).first()["t"], 1.0, abs_tol=1e-9)
    q = spec.fit(signal, "c", ["x", "z"]).predict(signal)
    assert p.select("id", "pred").exceptAll(q.select("id", "pred")).isEmpty()


def test_knn_equals_brute_force_with_a_crowded_cell(spark):
    rng = np.random.default_rng(1)
    pts = np.vstack([rng.normal(0, 0.01, (60, 4)), rng.normal(0, 3, (90, 4))]).round(4)
    df = spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(pts)], "id int, v array<double>")
    for metric in ("l2", "l1"):
        got = {}
        for r in neighbours.knn(df, df, 4, "id", "id", "v", "v", metric=metric, pivots=6, tile=20).collect():
            got.setdefault(r["q_id"], {})[r["rk"]] = r["r_id"]
        d = neighbours.distances(pts, pts, metric).round(9)
        for i in range(len(pts)):
            want = sorted(range(len(pts)), key=lambda j: (d[i, j], j))[:4]
            assert [got[i][k] for k in (1, 2, 3, 4)] == want


@pytest.mark.parametrize("dim,metric", [(2, "l2"), (12, "l2"), (3, "l1")])
def test_knn_part_by_part_equals_brute_force(spark, monkeypatch, dim, metric):
    """References in many parts, a crowded cell, ties, far-off values, missing components of queries, ids as text."""
    monkeypatch.setattr(neighbours, "PART_BYTES", 8 * (dim + 2) * 30)
    rng = np.random.default_rng(dim)
    refs = np.vstack([rng.normal(1000, 0.01, (80, dim)), rng.normal(1000, 3, (70, dim)), rng.integers(0, 3, (50, dim))]).round(3)
    qs = np.vstack([refs[::4], rng.normal(1000, 2, (30, dim))])
    qs[::11, 0] = np.nan
    name = [f"r{(i * 7) % 200:03}" for i in range(200)]
    rs = spark.createDataFrame([(n, v.tolist()) for n, v in zip(name, refs)], "name string, v array<double>")
    df = spark.createDataFrame([(i, [None if np.isnan(x) else float(x) for x in v]) for i, v in enumerate(qs)], "id int, v array<double>")
    got = {}
    for r in neighbours.knn(df, rs, 6, "id", "name", "v", "v", metric=metric, pivots=9, tile=20).collect():
        got.setdefault(r["q_id"], {})[r["rk"]] = (r["r_id"], r["d"])
    d = neighbours.distances(qs, refs, metric).round(9)
    for i in range(len(qs)):
        want = sorted(range(200), key=lambda j: (d[i, j], name[j]))[:6]
        assert [got[i][k + 1] for k in range(6)] == [(name[j], d[i, j]) for j in want]


def test_knn_of_repeated_and_missing_ids(spark):
    df = spark.createDataFrame([(1, [0.0, 1.0]), (1, [0.0, 1.0]), (2, [5.0, 5.0]), (None, [0.0, 2.0])], "id long, v array<float>")
    got = [tuple(r) for r in neighbours.knn(df, df, 3, "id", "id", "v", "v").collect()]
    assert sorted(r for r in got if r[0] == 1) == [(1, 1, 0.0, 1), (1, 1, 0.0, 2), (1, 1, 0.0, 3)]
    assert sorted((r for r in got if r[0] is None), key=lambda r: r[3]) == [(None, None, 0.0, 1), (None, 1, 1.0, 2), (None, 1, 1.0, 3)]
    assert neighbours.knn(df.limit(0), df, 3, "id", "id", "v", "v").collect() == []
    assert neighbours.knn(df, df, 9, "id", "id", "v", "v").count() == 8 + 4 + 4


def test_knn_stores_no_query_for_every_cell_it_visits(spark):
    x = np.random.default_rng(2).normal(size=(2000, 64))
    df = stage(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>"))

    def stored():
        return sum(os.path.getsize(f"{d}/{f}") for d, _, names in os.walk(scratch_dir(spark)) for f in names if f.endswith(".parquet"))

    before = stored()
    assert neighbours.knn(df, df, 3, "id", "id", "v", "v", pivots=40, tile=100).count() == 6000
    assert stored() - before < 4 * x.nbytes


def test_fuzzy_join_equals_all_pairs(spark):
    random.seed(4)
    word = lambda: "".join(random.choice("abcdeo") for _ in range(random.randint(1, 7)))
    xs, ys = sorted({word() for _ in range(40)} | {"zz"}), sorted({word() for _ in range(40)} | {"qq", "Zz"})
    left, right = [x for x in xs if x not in ys], [y for y in ys if y not in xs]
    sx = {r["n"]: r["s"] for r in spark.createDataFrame([(n,) for n in xs + ys], "n string").select("n", F.soundex("n").alias("s")).collect()}

    def score(a, b):
        A, B = set(a), set(b)
        return (td.cosine_text(a, b, {}) + 1 - len(A & B) / len(A | B) + td.jaro_text(a, b)) * (1 if sx[a] == sx[b] else 2)

    best = {b: min(((round(score(a, b), 9), a) for a in left)) for b in right}
    keep = {}
    for b, (s, a) in best.items():
        keep[a] = min(keep.get(a, (9, "")), (s, b))
    want = sorted((a, b) for a, (s, b) in keep.items())
    rule = lambda k: F.round(matching.default_score(k), 9)
    x, y = (spark.createDataFrame([(n,) for n in v], "name string") for v in (xs, ys))
    got = matching.join_fuzzily(x, y, f_score=rule).collect()
    assert sorted((r["name_x"], r["name_y"]) for r in got) == want
    assert matching.join_fuzzily(x, y, f_score=rule, exact=True).count() == len(want) + len(set(xs) & set(ys))


def test_tuning_race_and_stack(spark, signal):
    d = rs.vfold(signal, "id", 4)
    wf = tune.Workflow(models.linear_reg(), "y", ["x", "z"])
    r = tune.tune_grid(wf, d, [{"penalty": 0.0}, {"penalty": 50.0}], "id", ["rmse"])
    assert tune.select_best(r, "rmse") == {"penalty": 0.0}
    assert r.predictions.count() == 1200
    race = tune.tune_race(wf, d, [{"penalty": 0.0}, {"penalty": 50.0}], "id", "rmse")
    assert {x["config"] for x in race.metrics.select("config").distinct().collect()} == {1}
    c = ensemble.candidates(r.predictions, "id", "y", [1, 2], keep=["fold"])
    b = ensemble.blend(c, "y", ["cand_1", "cand_2"])
    assert b["weights"]["cand_1"] > 0.9 and min(b["weights"].values()) >= 0


def test_latin_hypercube_visits_every_stratum():
    g = tune.latin_hypercube(10, seed=2, a=(0.0, 1.0), n=(1, 10))
    assert sorted(int(p["a"] * 10) for p in g) == list(range(10)) and sorted(p["n"] for p in g) == list(range(1, 11))


def test_t_quantile():
    assert math.isclose(tune.t_quantile(0.95, 5), 2.015048, abs_tol=1e-5)


def test_shapley_adds_up(spark, signal):
    fit = models.rand_forest("regression", trees=5).fit(signal, "y", ["x", "z"])
    s = explain.shapley(fit.predict, signal, signal, ["x", "z"], "id", nsim=4)
    gap = s.join(fit.predict(signal), "id").agg(F.max(F.abs(s["x"] + s["z"] + F.col("baseline") - F.col("pred"))).alias("g")).first()["g"]
    assert gap < 1e-9
    lin = explain.linear_shapley(spark.createDataFrame([(1, 5.0), (2, 1.0)], "id int, x double"), {"x": 2.0}, "id")
    assert sorted(r["x"] for r in lin.collect()) == [-4.0, 4.0]


def test_shapley_in_slices_drops_its_shuffles(spark, signal, monkeypatch):
    """The same values whatever the slices hold, and no shuffle file is left behind."""

    def files():
        found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {str(found.apply(i).getName()) for i in range(found.size())}

    def run():
        rows = explain.shapley(lambda d: d.withColumn("pred", F.col("x") * F.col("z")), twice, twice, ["x", "z"], "id", nsim=3)
        return sorted((r["id"], round(r["x"], 9), round(r["z"], 9), round(r["baseline"], 9)) for r in rows.collect())

    twice = stage(signal.select(F.when(F.col("id") > 5, F.col("id")).alias("id"), "x", "z").where("id > 9").unionByName(signal.select("id", "x", "z").limit(20)).repartition(5))
    whole = run()
    assert len(whole) == twice.count()
    monkeypatch.setattr(explain, "SLICE_DRAWS", 210)
    before = files()
    assert run() == whole
    assert not {f for f in files() - before if f.startswith("shuffle_")}
    none = twice.where("id < 0")
    assert explain.shapley(lambda d: d.withColumn("pred", F.col("x")), none, twice, ["x"], "id").count() == 0


def test_permutation_keeps_the_values(spark, signal):
    p = explain.permute(signal, "x", "id")
    assert p.select("x").exceptAll(signal.select("x")).isEmpty()
    fit = models.linear_reg().fit(signal, "y", ["x", "z"])
    imp = {r["feature"]: r["importance"] for r in explain.permutation_importance(fit, signal, "id", m.rmse("y", "pred"), True).collect()}
    assert imp["x"] > imp["z"] >= -1e-6


def test_adversarial_split(spark, signal):
    d = adversarial.drift(signal.where("x < 0.3"), signal.where("x >= 0.3"), ["x", "z"], models.rand_forest(trees=5))
    assert d.auc.first()["auc"] > 0.95
    s = adversarial.split_by_likeness(d.scored, "id")
    n = s.count()
    assert s.where("is_train").count() == math.floor(0.8 * n)


def test_smoothing_over_slices(spark):
    d = spark.range(1, 101).select(F.lit("k").alias("k"), "id", (F.col("id") * 37 % 11).cast("double").alias("x"))
    got = [r["level"] for r in series.smooth(d, "k", "id", "x", 0.4, parts=6).orderBy("id").collect()]
    lv, want = None, []
    for i in range(1, 101):
        x = float(i * 37 % 11)
        lv = x if lv is None else 0.4 * x + 0.6 * lv
        want.append(lv)
    assert np.allclose(got, want)
    with pytest.raises(ValueError):
        series.declare_series(d.unionByName(d), "k", "id")


def test_geometry(spark):
    sq = spark.createDataFrame([(1, i, x, y) for i, (x, y) in enumerate([(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0)])], "poly_id int, seq int, x double, y double")
    pts = spark.createDataFrame([(1, 0.5, 0.5), (2, 1.5, 1.5), (3, 2.5, 2.5)], "point_id int, x double, y double")
    for cell in (0.3, 5.0):
        assert sorted(r["point_id"] for r in geo.points_in_polygons(pts, sq, cell).collect()) == [1, 2]
    c = geo.centroids(sq).first()
    assert (c["cx"], c["cy"]) == (1.0, 1.0)


def test_near_pairs_in_crowded_cells(spark, monkeypatch):
    """All pairs, whatever the cells hold, and the pairs of one cell come from many tasks."""
    monkeypatch.setattr(geo, "PAIRS", 500)
    rng = np.random.default_rng(7)
    pts = {n: np.vstack([rng.normal(0, 0.6, (k, 2)), rng.normal(0, 40, (60, 2)), [[1e6, 1e6]]]).round(2) for n, k in (("a", 250), ("b", 220))}
    a, b = (spark.createDataFrame([(i // 2, float(x), float(y)) for i, (x, y) in enumerate(p)] + [(9999, None, 1.0)], f"{n} long, x double, y double") for n, p in pts.items())
    for scale in (1.0, 0.5):
        out = geo.near_pairs(a, b, 1.5, "a", "b", scale=scale)
        got = sorted((r["a"], r["b"], round(r["d"], 9)) for r in out.collect())
        d = np.sqrt(((pts["a"][:, None] - pts["b"][None]) ** 2).sum(axis=2)) * scale
        assert got == sorted((int(i) // 2, int(j) // 2, round(float(d[i, j]), 9)) for i, j in np.argwhere(d < 1.5))
    one = spark.range(300).select("id", (F.col("id") / 1000).alias("x"), F.lit(0.5).alias("y"))
    out = geo.near_pairs(one, one.withColumnRenamed("id", "other"), 1.0, "id", "other")
    assert out.count() == 300 * 300
    assert out.select(F.spark_partition_id().alias("task")).distinct().count() > 2


def test_fast_rounding_equals_round(spark):
    rng = np.random.default_rng(4)
    v = [0.0, 0.1234565, 2.5e-7, 5e-7, 1.0000005, 12.3456785, 1e15 + 0.3, -1.2345675, -3e-7, float("nan"), float("inf"), None, *rng.random(2000).tolist(), *(rng.integers(0, 10**8, 2000) / 2e6 / 10).tolist()]
    df = spark.createDataFrame([(x,) for x in v], "d double")
    assert df.where(~scalars.round_fast("d", 6).eqNullSafe(F.round("d", 6))).count() == 0


def test_match_places(spark):
    g = spark.createDataFrame([(1, "Chez Anna", 0.0, 0.0), (2, "La Tour", 5.0, 5.0), (3, "Nowhere", 50.0, 50.0)], "gid int, name string, x double, y double")
    y = spark.createDataFrame([(10, "Anna", 0.001, 0.0), (11, "La Toure", 9.0, 9.0), (12, "Xyz", 20.0, 20.0)], "sid int, name string, x double, y double")
    got = {(r["gid"], r["sid"], r["how"]) for r in places.match_places(g, y, 1.0, "gid", "sid").collect()}
    assert got == {(1, 10, "distance"), (2, 11, "name")}


def test_materialize(spark, tmp_path):
    p = str(tmp_path / "t")
    assert io.materialize(spark, lambda: spark.range(3), p).count() == 3
    assert io.materialize(spark, lambda: spark.range(9), p).count() == 3
    assert io.materialize(spark, lambda: spark.range(2), p, "append").count() == 5
    assert io.materialize(spark, lambda: spark.range(1), p, "overwrite").count() == 1

    def fail():
        raise RuntimeError("no")

    with pytest.raises(RuntimeError):
        io.materialize(spark, fail, p, "overwrite")
    assert io.materialize(spark, fail, p).count() == 1


def test_csv_round_trip(spark, tmp_path):
    p = str(tmp_path / "c")
    d = spark.createDataFrame([(1, "a,b", None), (2, 'q"x', 2.5)], "id int, s string, v double")
    io.write_csv(d, p)
    assert sorted(map(tuple, io.read_csv(spark, p).collect())) == sorted(map(tuple, d.collect()))
    back = io.read_csv_as(spark, p, ["id", "s", "v"], {"id": "int"})
    assert dict(back.dtypes) == {"id": "int", "s": "string", "v": "string"}


def test_group_functions(spark):
    d = spark.createDataFrame([(1, 1.0), (1, 2.0), (2, 5.0)], "k int, x double")

    def fn(p):
        if p["k"].iloc[0] == 2:
            raise ValueError("bad")
        return p.groupby("k", as_index=False)["x"].sum()

    out = {r["k"]: (r["x"], r["error"]) for r in udf.map_groups_safely(d, ["k"], fn, "k int, x double").collect()}
    assert out == {1: (3.0, None), 2: (None, "ValueError: bad")}
    total = lambda p: p.groupby("k", as_index=False, dropna=False)["x"].sum()
    many = spark.range(0, 5000, 1, 7).selectExpr("int(id % 3) as k", "double(1) as x")
    assert {tuple(r) for r in udf.fold_groups(many, ["k"], total, total, "k int, x double").collect()} == {(0, 1667.0), (1, 1667.0), (2, 1666.0)}
