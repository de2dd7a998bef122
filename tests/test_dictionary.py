import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tabkit.features import steps as st
from tabkit.features.dictionary import block_entries, block_name, block_size, learn_levels, level_contributions, level_weights
from tabkit.features.recipe import Recipe
from tabkit.modelling import models


@pytest.fixture
def few(spark):
    return spark.createDataFrame([(1, "b", 1.0), (2, "a", 2.0), (3, None, 3.0), (4, "c", 4.0), (5, "b", 5.0)], "id int, k string, y double")


def baked(step, train, new):
    return {r["id"]: r for r in Recipe(ids=["id"]).add(step).prep(train).bake(new).collect()}


def test_steps_on_new_and_missing_levels(spark, few):
    new = spark.createDataFrame([(1, "a"), (2, "z"), (3, None), (4, "c")], "id int, k string")
    assert [baked(st.StepNovel(["k"]), few, new)[i]["k"] for i in (1, 2, 3, 4)] == ["a", "new", None, "c"]
    assert [baked(st.StepString2Factor(["k"]), few, new)[i]["k"] for i in (1, 2, 3, 4)] == [0, 3, 3, 2]
    assert [baked(st.StepRankEncode(["k"]), few, new)[i]["k"] for i in (1, 2, 3, 4)] == [2, None, None, 3]
    d = baked(st.StepBinary(["k"]), few, new)
    assert [(d[i]["k_0"], d[i]["k_1"]) for i in (1, 2, 3, 4)] == [(0, 1), (0, 0), (0, 0), (1, 1)]
    assert "k" not in d[1].asDict()


def test_sparse_block_of_levels_and_tokens(spark, few):
    step = st.StepDummy(["k"], sparse=True).fit(few)
    out = step.transform(few)
    assert block_size(out, block_name("k")) == 2 and "k" not in out.columns
    got = sorted((r["id"], r["level"], r["value"]) for r in block_entries(out, "k", ["id"], step).collect())
    assert got == [(1, "b", 1.0), (4, "c", 1.0), (5, "b", 1.0)]
    text = spark.createDataFrame([(1, ["x", "y", "x"]), (2, []), (3, None), (4, ["q", "y"])], "id int, t array<string>")
    tf = st.StepTf(["t"], max_tokens=2, sparse=True).fit(text)
    rows = tf.transform(text)
    assert rows.count() == 4 and block_size(rows, "t_block") == 2
    assert sorted(tuple(r) for r in block_entries(rows, "t", ["id"], tf).collect()) == [(1, "x", 2.0), (1, "y", 1.0), (4, "y", 1.0)]


def test_saved_with_its_dictionary(spark, few, tmp_path):
    prepared = Recipe("y", ids=["id"]).add(st.StepNovel(["k"]), st.StepDummy(["k"], sparse=True)).prep(few)
    path = f"{tmp_path}/recipe"
    prepared.as_pipeline().write().overwrite().save(path)
    back = PipelineModel.load(path).transform(few.withColumn("k", F.when(F.col("id") == 4, "other").otherwise(F.col("k"))))
    assert sorted(tuple(r) for r in back.select("id", F.col("k_block").cast("string")).collect())[1] == (2, "(2,[],[])")
    assert path in back.sparkSession.read.parquet(f"{path}/stages/{sorted(__import__('os').listdir(f'{path}/stages'))[1]}/dictionary_0").inputFiles()[0]


def test_empty_table(spark, few):
    none = few.limit(0)
    assert baked(st.StepString2Factor(["k"]), none, few)[1]["k"] == 0
    step = st.StepDummy(["k"], sparse=True).fit(none)
    assert step.transform(few).count() == 5 and block_entries(step.transform(few), "k", ["id"], step).count() == 0


def test_many_levels_fit_and_score_without_the_driver(spark, monkeypatch):
    """A fifth of a million levels; collecting them is an error here."""
    import tabkit.features.levels as lv

    monkeypatch.setattr(lv, "collect_levels", lambda *a: pytest.fail("levels collected"))
    monkeypatch.setattr(st, "collect_levels", lambda *a: pytest.fail("levels collected"))
    n = 200_000
    df = spark.range(2 * n).select("id", F.concat(F.lit("k"), (F.col("id") % n).cast("string")).alias("k"), (F.col("id") % 7).cast("double").alias("x"))
    df = df.withColumn("y", F.col("x") * 3 + F.when(F.col("k") == "k5", 100.0).otherwise(0.0))
    assert learn_levels(df, ["k"])[0][2] == n
    step = st.StepDummy(["k"], sparse=True).fit(df)
    rows = step.transform(df.withColumn("name", F.col("k")))
    fit = models.linear_reg(epochs=5).fit(rows, "y", ["x", "k_block"])
    assert fit.extra["widths"] == [1, n - 1]
    assert fit.predict(rows).count() == 2 * n
    w = level_weights(fit, step, "k", df)
    assert w.count() == n and w.orderBy(F.desc(F.abs("weight"))).first()["level"] == "k5"
    total = level_contributions(fit, step, "k", df, "id").agg(F.sum("contribution").alias("s"), F.count(F.lit(1)).alias("n")).first()
    assert abs(total["s"]) < 1e-3 and total["n"] == 2 * n
    index = st.StepString2Factor(["k"]).fit(df).transform(df)
    assert index.agg(F.max("k"), F.countDistinct("k")).first() == (n - 1, n)


def test_stop_words_are_sparks_own(spark):
    t = spark.createDataFrame([(1, ["the", "cat", "isn't", "about", "and"])], "id int, t array<string>")
    assert st.StepStopwords(["t"]).fit(t).transform(t).first()["t"] == ["cat"]
    assert st.StepStopwords(["t"], ["cat"]).fit(t).transform(t).first()["t"] == ["the", "isn't", "about", "and"]
    assert st.StepStopwords(["t"], []).fit(t).transform(t).first()["t"] == ["the", "cat", "isn't", "about", "and"]
