"""No silent caps, no colliding names, errors for what is not known."""

import pytest
from pyspark.sql import functions as F

from tabkit.features import steps as st
from tabkit.features.recipe import Recipe
from tabkit.modelling import models, resample, tune
from tabkit.sources import tables as io


def prepared(df, step, outcome="y"):
    return Recipe(outcome).add(step).prep(df).bake(df)


def test_dummy_levels_that_differ_in_signs_or_script(spark):
    levels = ["北京", "上海", "a b", "a-b", "a_b"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(levels)], "y int, v string")
    out = prepared(df, st.StepDummy(["v"], keep_first=True)).orderBy("y")
    names = [c for c in out.columns if c.startswith("v_")]
    assert len(names) == len(levels)
    assert [sum(r[c] for c in names) for r in out.collect()] == [1.0] * len(levels)


def test_term_columns_have_no_cap(spark):
    df = spark.createDataFrame([(0, [f"t{i}" for i in range(1500)])], "y int, v array<string>")
    assert len([c for c in prepared(df, st.StepTf(["v"])).columns if c.startswith("tf_")]) == 1500


def test_class_columns_with_clashing_levels(spark):
    df = spark.createDataFrame([(i, float(i % 3), ["a b", "a-b", "c"][i % 3]) for i in range(60)], "id int, x double, y string")
    out = models.rand_forest(trees=3).fit(df, "y", ["x"]).predict(df.withColumn("prob_mine", F.lit(7)))
    assert {"prob_a_b", "prob_a_b_2", "prob_c", "prob_mine"} <= set(out.columns)


def test_features_named_like_other_predictions(spark):
    df = spark.createDataFrame([(i, i / 10.0, 2.0 * i) for i in range(20)], "id int, prob_a double, y double")
    out = models.linear_reg().fit(df, "y", ["prob_a"]).predict(df)
    assert out.where(F.abs(F.col("pred") - F.col("y")) > 1e-6).count() == 0


def test_unknown_names_raise(spark):
    df = spark.createDataFrame([(i, float(i), float(i), i % 2) for i in range(8)], "id int, x double, y double, fold int")
    with pytest.raises(ValueError):
        models.boost_tree("regression", no_such=3)
    wf = tune.Workflow(models.linear_reg(), "y", ["x"])
    with pytest.raises(ValueError):
        tune.tune_grid(wf, df, [{}], "id", ["nonsense"])
    with pytest.raises(ValueError):
        tune.tune_grid(wf, df, [{"no_such": 1}], "id", ["rmse"])


def test_multiclass_auc_in_tuning(spark):
    from tabkit.modelling import metrics as mt

    df = spark.createDataFrame([(i, float((i * 7) % 11), "abc"[i % 3], i % 2) for i in range(90)], "id int, x double, y string, fold int")
    r = tune.tune_grid(tune.Workflow(models.rand_forest(trees=3), "y", ["x"]), df, [{}], "id", ["roc_auc"])
    for fold in (0, 1):
        want = mt.roc_auc_multiclass(r.predictions.where(F.col("fold") == fold), "y", models.prob_columns(["a", "b", "c"])).first()[0]
        assert abs(r.metrics.where((F.col("fold") == fold) & (F.col("metric") == "roc_auc")).first()["value"] - want) < 1e-9


def test_line_breaks_in_csv(spark, tmp_path):
    rows = [(1, 'a\nb "q", c'), (2, "plain"), (3, "\r\nx")]
    df = spark.createDataFrame(rows, "id int, s string")
    io.write_csv(df, str(tmp_path / "t"))
    back = io.read_csv_as(spark, str(tmp_path / "t"), ["id", "s"], {"id": "int"}, multiline=True)
    assert sorted((r[0], r[1].replace("\r\n", "\n")) for r in back.collect()) == [(i, s.replace("\r\n", "\n")) for i, s in rows]


def test_balanced_groups_and_long_upsampling(spark):
    df = spark.range(1000).selectExpr("id", "int(sqrt(id)) as g")
    sizes = [r["count"] for r in resample.group_vfold_balanced(df, "g", 4).groupBy("fold").count().collect()]
    assert sum(sizes) == 1000 and max(sizes) - min(sizes) <= 64
    d = spark.range(30_001).selectExpr("id", "if(id = 0, 'few', 'many') as k")
    out = resample.upsample(d, "k", "id").groupBy("k").agg(F.count("*").alias("n"), F.count_distinct("copy").alias("c"))
    assert {r["k"]: (r["n"], r["c"]) for r in out.collect()} == {"few": (30_000, 30_000), "many": (30_000, 1)}
