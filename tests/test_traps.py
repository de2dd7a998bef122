"""Small literal frames with answers worked by hand."""

import math

import pytest
from pyspark.sql import functions as F

from tabkit.features import steps as st
from tabkit.features.recipe import Recipe, all_nominal_predictors, all_numeric_predictors
from tabkit.functions import beta, scalars as s, text_distance as td
from tabkit.modelling import metrics as m
from tabkit.operators import aggregates as ag, frames as fr, joins, windows as wn
from tabkit.scale import exact_quantiles, near_rows, row_numbers, running


def values(df, *cols):
    return [tuple(r[c] for c in cols) if len(cols) > 1 else r[cols[0]] for r in df.collect()]


def test_quantiles(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (10.0,)], "x double")
    r = exact_quantiles(df, None, "x", {"p25": 0.25, "p50": 0.5, "p100": 1.0}).first()
    assert (r["p25"], r["p50"], r["p100"]) == (1.75, 3.0, 10.0)


def test_cut_is_right_closed(spark):
    df = spark.createDataFrame([(20,), (21,), (40,), (41,), (70,), (71,)], "x int")
    got = values(df.select("x", s.cut_right("x", [20, 40, 50, 60, 70]).alias("b")).orderBy("x"), "b")
    assert got == [None, "(20,40]", "(20,40]", "(40,50]", "(60,70]", None]


def test_slice_ties(spark):
    df = spark.createDataFrame([(1, 1), (2, 1), (3, 2)], "id int, score int").withColumn("k", F.lit(0))
    assert wn.slice_top(df, "k", [F.col("score")]).count() == 2
    assert wn.slice_top(df, "k", [F.col("score"), F.col("id")], with_ties=False).count() == 1


def test_lag_stays_in_key(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3), ("b", 9)], "k string, t int")
    assert values(wn.lags(df, "k", [F.col("t")], "t", [1]).orderBy("k", "t"), "t_lag1") == [None, 1, 2, None]


def test_rolling_six(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 8)], "x double").withColumn("k", F.lit(0))
    assert values(wn.rolling_mean(df, "k", [F.col("x")], "x", 6, "r").orderBy("x"), "r") == [None] * 5 + [3.5, 4.5]


@pytest.mark.parametrize("block", [3, 7])
def test_hot_keys_give_the_same_windows(spark, block):
    df = spark.range(200).withColumn("k", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")))
    df = df.withColumn("x", F.col("id") * 1.0)

    def add(d, w):
        f = w.rowsBetween(-2, 2)
        return d.withColumns({"a": F.sum("x").over(f), "b": F.lead("x", 2).over(w), "c": F.lag("x", 2).over(w)})

    plain = near_rows(df, "k", [F.col("id")], 2, 2, add)
    hot = near_rows(df, "k", [F.col("id")], 2, 2, add, hot_rows=10, block=block)
    assert hot.count() == 200
    assert plain.exceptAll(hot.select(plain.columns)).isEmpty()


def test_running_over_slices(spark):
    df = spark.range(100).withColumn("k", F.when(F.col("id") < 70, "a").otherwise(F.lit(None).cast("string")))
    r = running(df, "k", [F.col("id")], {"s": F.col("id"), "n": F.lit(1)}, totals=True, parts=7).orderBy("id").collect()
    assert [x["n"] for x in r] == list(range(1, 71)) + list(range(1, 31))
    assert r[69]["s"] == sum(range(70)) == r[0]["s_total"]
    assert {x["n_total"] for x in r if x["k"] is None} == {30}


def test_global_row_numbers(spark):
    df = spark.range(57)
    assert [r["rn"] for r in row_numbers(df, None, [F.desc("id")], "rn").orderBy(F.desc("id")).collect()] == list(range(1, 58))


def test_half_even(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,)], "x double")
    assert [float(v) for v in values(df.select("x", s.round_half_even("x").alias("r")).orderBy("x"), "r")] == [0, 2, 2]


def test_compass_and_week(spark):
    d = spark.createDataFrame([("N", "2021-01-01"), ("E", "2021-01-08"), ("SSW", "2021-12-31"), (None, None), ("?", None)], "c string, d string")
    got = values(d.select(s.compass_degrees("c").alias("a"), s.week_of_year(F.to_date("d")).alias("w")), "a", "w")
    assert got == [(0.0, 1), (90.0, 2), (202.5, 53), (None, None), (None, None)]


def test_text_functions(spark):
    d = spark.createDataFrame([("$1,234.5 net", "12.5%", "['a', 'b']", "abcb")], "n string, p string, l string, x string")
    r = d.select(s.parse_number("n").alias("n"), s.percent_to_fraction("p").alias("p"), s.remove_first("x", "b").alias("f"), s.remove_all("x", "b").alias("a"), s.drop_last("x").alias("d")).first()
    assert r["n"] == 1234.5 and math.isclose(r["p"], 0.125) and (r["f"], r["a"], r["d"]) == ("acb", "ac", "abc")


def test_missing_rules(spark):
    d = spark.createDataFrame([(1, None), (2, float("nan")), (3, 1.0)], "id int, x double")
    assert values(fr.drop_missing(d), "id") == [3]
    assert sorted(values(fr.incomplete_rows(d), "id")) == [1, 2]
    assert fr.where_not_in(d, "x", [1.0]).count() == 2
    test = F.when(F.col("id") < 3, F.col("id") == 1)
    assert values(d.select("id", s.if_else(test, "y", "n").alias("v")).orderBy("id"), "v") == ["y", "n", None]
    assert d.agg(ag.agg_strict(F.sum, "id").alias("a"), ag.agg_strict(F.max, "x").alias("b")).first()["b"] is None


def test_column_lists(spark):
    d = spark.createDataFrame([(1, "a", 2.0)], "playerAge int, `Full Name` string, x double")
    assert fr.clean_names(d).columns == ["player_age", "full_name", "x"]
    assert fr.any_of(d, ["x", "y"]) == ["x"]
    with pytest.raises(ValueError):
        fr.all_of(d, ["y"])
    assert fr.typed(d, "numeric") == ["playerAge", "x"]


def test_natural_join_meets_missing_keys(spark):
    a = spark.createDataFrame([(1, None), (2, "u")], "id int, k string")
    b = spark.createDataFrame([(None, 10), ("v", 20)], "k string, y int")
    assert sorted(values(joins.natural_join(a, b), "id", "y"), key=str) == [(1, 10), (2, None)]
    assert joins.natural_join(a, b, "full").count() == 3
    assert joins.crossing(spark.range(2000), spark.range(2000).toDF("j")).count() == 4_000_000


def test_metrics(spark):
    d = spark.createDataFrame([("yes", 0.8), ("no", 0.4)], "y string, p double")
    assert math.isclose(d.agg(m.binary_log_loss("y", "p", "yes").alias("v")).first()["v"], 0.366985, abs_tol=1e-6)
    d = spark.createDataFrame([(0, 0.1), (0, 0.4), (1, 0.35), (1, 0.8)], "y int, p double")
    assert m.roc_auc(d, F.col("y") == 1, "p").first()["auc"] == 0.75
    c = m.roc_curve(d, F.col("y") == 1, "p").orderBy(F.desc("threshold")).collect()
    xs, ys = [0.0] + [1 - r["specificity"] for r in c], [0.0] + [r["sensitivity"] for r in c]
    assert math.isclose(sum((b - a) * (u + v) / 2 for a, b, u, v in zip(xs, xs[1:], ys, ys[1:])), 0.75)
    d = spark.createDataFrame([(1.0, 1.0), (3.0, 7.0)], "y double, p double")
    assert math.isclose(d.agg(m.rmsle("y", "p").alias("v")).first()["v"], 0.490129, abs_tol=1e-6)
    # a constant side has no correlation, and no error
    assert spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "y double, p double").agg(m.rsq("y", "p").alias("v")).first()["v"] is None


def test_correlation_of_constants_and_gaps(spark):
    rows = [(1.0, 2.0, 5.0, None), (2.0, 4.0, 5.0, 1.0), (3.0, 5.0, 5.0, 0.0), (4.0, 4.0, 5.0, None)]
    d = spark.createDataFrame(rows, "a double, b double, k double, g double")
    c = s.correlation
    r = d.agg(c("a", "b").alias("ab"), c("a", "k").alias("ak"), c("k", "a").alias("ka"), c("k", "k").alias("kk"), c("b", "g").alias("bg"), F.corr("a", "b").alias("true")).first()
    assert math.isclose(r["ab"], r["true"]) and (r["ak"], r["ka"], r["kk"]) == (None, None, None)
    assert math.isclose(r["bg"], -1.0)


def test_text_distances(spark):
    d = spark.createDataFrame([("abc", "abd")], "a string, b string")
    r = d.select(td.jaccard(F.col("a"), F.col("b")).alias("j"), td.cosine(F.col("a"), F.col("b")).alias("c"), td.cosine_and_jaro(F.col("a"), F.col("b")).alias("p")).first()
    assert r["j"] == 0.5 and math.isclose(r["c"], 1 / 3) and math.isclose(r["p"]["cosine"], r["c"])
    assert math.isclose(td.jaro_text("MARTHA", "MARHTA"), 1 - 0.944444, abs_tol=1e-5)


def test_beta_quantile():
    # uniform and symmetric cases are known exactly
    assert math.isclose(float(beta.beta_quantile(0.3, 1, 1)), 0.3, abs_tol=1e-12)
    assert math.isclose(float(beta.beta_quantile(0.5, 7.5, 7.5)), 0.5, abs_tol=1e-12)
    assert math.isclose(float(beta.beta_quantile(0.25, 0.5, 0.5)), math.sin(math.pi / 8) ** 2, abs_tol=1e-10)
    assert math.isclose(float(beta.beta_quantile(0.1, 3, 1)), 0.1 ** (1 / 3), abs_tol=1e-10)


def test_recipe_learns_on_training_rows_only(spark):
    tr = spark.createDataFrame([(1, "a", 1.0), (2, "a", 3.0), (3, "b", None)], "id int, g string, x double")
    te = spark.createDataFrame([(4, "z", None), (5, None, 100.0)], "id int, g string, x double")
    r = Recipe(ids=["id"]).add(st.StepImputeMean(["x"]), st.StepNovel(all_nominal_predictors()), st.StepUnknown(all_nominal_predictors()), st.StepDummy(["g"]), st.StepCenter(all_numeric_predictors()))
    p = r.prep(tr)
    out = {x["id"]: x for x in p.bake(te).collect()}
    assert out[4]["x"] == 0.0 and out[5]["x"] == 98.0
    assert set(p.juice().columns) == {"id", "x", "g_b"}


def test_recipe_saves(spark, tmp_path):
    from pyspark.ml import PipelineModel

    d = spark.createDataFrame([(1, "a'b", 1.0), (2, "c", 3.0)], "id int, g string, x double")
    p = Recipe(ids=["id"]).add(st.StepNormalize(["x"]), st.StepDummy(["g"], keep_first=True)).prep(d)
    path = str(tmp_path / "recipe")
    p.as_pipeline().write().overwrite().save(path)
    assert sorted(PipelineModel.load(path).transform(d).collect()) == sorted(p.bake(d).collect())


def test_dropping_steps(spark):
    d = spark.range(100).select(F.col("id").cast("double").alias("a"), (F.col("id") * 2.0 + 1).alias("b"), (F.col("id") % 7).cast("double").alias("c"), F.lit(1.0).alias("k"))
    d = d.withColumn("sum", F.col("a") + F.col("c"))
    assert "k" not in Recipe().add(st.StepZv(all_numeric_predictors())).prep(d).juice().columns
    left = Recipe().add(st.StepZv(all_numeric_predictors()), st.StepLincomb(all_numeric_predictors())).prep(d).juice().columns
    assert left == ["a", "c"]
    assert len({"a", "b"} & set(Recipe().add(st.StepCorr(["a", "b"], 0.9)).prep(d).juice().columns)) == 1


def test_spline_bases(spark):
    d = spark.range(0, 101).select((F.col("id") / 100.0).alias("x"))
    b = Recipe().add(st.StepBs(["x"], 6)).prep(d).juice().collect()
    assert len(b[0]) == 6 and all(-1e-9 <= v <= 1 + 1e-9 for r in b for v in r)
    assert all(sum(r) <= 1 + 1e-9 for r in b) and math.isclose(b[-1][-1], 1.0)
    assert len(Recipe().add(st.StepNs(["x"], 4)).prep(d).juice().columns) == 4


def test_yeo_johnson_finds_the_log(spark):
    d = spark.range(1, 2000).select(F.expm1(F.sin(F.col("id") * 1.0) + F.cos(F.col("id") * 7.0) + 3).alias("x"))
    sql = dict(st.StepYeoJohnson(["x"]).learn(d, ["x"])[0])["x"]
    lam = float(sql.split("/ double('")[1].split("'")[0]) if "/ double('" in sql.split("ELSE")[0] else 0.0
    assert abs(lam) < 0.15
