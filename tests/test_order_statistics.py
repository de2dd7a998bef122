import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabkit import scale
from tabkit.modelling import resample
from tabkit.operators import frames, series


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(6)
    out = [(i, "ab"[i % 2], float(rng.choice([rng.normal(), 2.5, -1e9, float(i)], p=[0.5, 0.3, 0.1, 0.1]))) for i in range(3000)]
    out += [(3000, "a", None), (3001, "b", float("nan")), (3002, None, 1.0), (3003, None, 4.0), (3004, "one", 7.0), (3005, "none", None)]
    return spark.createDataFrame(out, "id int, k string, v double").repartition(5).cache()


@pytest.mark.parametrize("accuracy,one_task", [(10_000, 1_000_000), (200, 0), (7, 1_000_000)])
def test_quantiles_select_the_exact_ranks(spark, rows, monkeypatch, accuracy, one_task):
    monkeypatch.setattr(scale, "ACCURACY", accuracy)
    monkeypatch.setattr(scale, "ONE_TASK_ROWS", one_task)
    probs = {"lo": 0.0, "q": 0.25, "m": 0.5, "p": 0.931, "hi": 1.0}
    got = {r["k"]: r for r in scale.exact_quantiles(rows, "k", "v", probs).collect()}
    by = {}
    for r in rows.collect():
        if r["v"] is not None and not math.isnan(r["v"]):
            by.setdefault(r["k"], []).append(r["v"])
    assert set(got) == set(by)
    for k, v in by.items():
        assert np.allclose([got[k][c] for c in probs], np.quantile(v, list(probs.values())), rtol=1e-12)


def test_selection_holds_its_ranks_and_gives_up_where_it_does_not(spark, rows, monkeypatch):
    d = rows.where("v is not null and not isnan(v)").select("k", F.col("v").alias("_x"))
    assert scale._selected_quantiles(d, ["k"], {"m": 0.5}) is not None
    monkeypatch.setattr(scale, "_selected_quantiles", lambda *a: None)
    assert scale.exact_quantiles(rows, None, "v", {"m": 0.5}).first()["m"] == np.median([r["_x"] for r in d.collect()])


def test_no_rows(spark, rows):
    assert scale.exact_quantiles(rows.limit(0), "k", "v", {"m": 0.5}).count() == 0


@pytest.mark.parametrize("fraction", [0.0, 0.001, 0.37, 0.8, 1.0])
@pytest.mark.parametrize("down", [True, False])
def test_top_fraction_by_one_cut(spark, rows, fraction, down):
    got = {r["id"] for r in frames.top_fraction(rows, ["-v" if down else "v", "id"], fraction).collect()}
    key = lambda r: (r["v"] is None or math.isnan(r["v"]), 0 if r["v"] is None or math.isnan(r["v"]) else -r["v"] if down else r["v"], r["id"])
    every = sorted(rows.collect(), key=key)
    assert got == {r["id"] for r in every[: int(len(every) * fraction)]}


def test_stratified_bootstrap_draws_every_stratum_fully(spark, rows):
    b = resample.bootstraps(rows, "id", 20, seed=3, strata="k")
    g = {(r["replicate"], r["k"]): (r["n"], r["w"]) for r in b.groupBy("replicate", "k").agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("w")).collect()}
    assert len(g) == 20 * 5 and all(n == w for n, w in g.values())
    out = b.agg(F.avg((F.col("weight") == 0).cast("int")).alias("o")).first()["o"]
    assert abs(out - math.exp(-1)) < 0.02
    again = resample.bootstraps(rows.repartition(3), "id", 20, seed=3, strata="k", keep_out_of_bag=False)
    assert again.exceptAll(b.where("weight > 0")).isEmpty() and again.agg(F.min("weight")).first()[0] == 1
    assert resample.bootstraps(rows, "id", 2, exact=True).agg(F.sum("weight")).first()[0] == 2 * rows.count()
    assert resample.bootstraps(rows.limit(0), "id", 2, strata="k").count() == 0


def plain_levels(values, w):
    level, out = None, []
    for v in values:
        if v is not None:
            level = v if level is None else w * v + (1 - w) * level
        out.append(level)
    return out


@pytest.mark.parametrize("parts", [1, 2, 4, 7, 40])
def test_levels_do_not_hang_on_the_slices(spark, parts):
    rng = np.random.default_rng(1)
    keyed = {"a": [1.0, None, 3.0, 5.0], "gone": [None] * 30, "late": [None] * 25 + [2.0, None, 4.0], "long": [None if rng.random() < 0.4 else float(v) for v in rng.normal(size=150)], None: [3.0, 1.0]}
    df = spark.createDataFrame([(k, t, v) for k, vs in keyed.items() for t, v in enumerate(vs)], "k string, t int, x double")
    got = {}
    for r in series.smooth(df, "k", "t", "x", 0.5, parts).collect():
        got.setdefault(r["k"], {})[r["t"]] = r["level"]
    for k, vs in keyed.items():
        for t, want in enumerate(plain_levels(vs, 0.5)):
            assert got[k][t] is None if want is None else math.isclose(got[k][t], want, abs_tol=1e-12), (k, t)
