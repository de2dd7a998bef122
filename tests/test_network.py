import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from tabkit.modelling import metrics as m
from tabkit.modelling import models
from tabkit.modelling.network import _loss_and_gradient, _shapes


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(300, 2))
    k = np.where(x[:, 0] ** 2 + x[:, 1] ** 2 < 1, "in", np.where(x[:, 0] > 0, "right", "left"))
    out = [(i, float(a), float(b), str(c), float(np.sin(2 * a) + b * b), float(i % 3 + 1)) for i, ((a, b), c) in enumerate(zip(x, k))]
    return spark.createDataFrame(out, "id int, a double, b double, k string, y double, w double").cache()


@pytest.mark.parametrize("hidden,classes", [(0, 0), (0, 3), (4, 0), (4, 3)])
def test_gradient(hidden, classes):
    rng = np.random.default_rng(1)
    shapes = _shapes(3, hidden, max(classes, 1))
    theta = rng.normal(size=sum(int(np.prod(s)) for s in shapes))
    x, y, w = rng.normal(size=(20, 3)), rng.integers(0, 3, 20).astype(float), rng.random(20)
    _, g = _loss_and_gradient(theta, shapes, x, y, w, classes)
    for i in range(len(theta)):
        e = np.zeros(len(theta))
        e[i] = 1e-6
        up, down = (_loss_and_gradient(theta + s * e, shapes, x, y, w, classes)[0] for s in (1, -1))
        assert abs((up - down) / 2e-6 - g[i]) < 1e-4


def test_no_hidden_units_equal_ridge_logistic(spark, rows):
    s = rows.agg(*[f(c).alias(f"{c}{n}") for c in "ab" for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    scaled = rows.withColumns({c: (F.col(c) - s[f"{c}m"]) / s[f"{c}s"] for c in "ab"})
    fit = models.mlp(hidden_units=0, penalty=0.1, epochs=200).fit(rows, "k", ["a", "b"])
    mine = {r["id"]: [r[f"prob_{v}"] for v in fit.levels] for r in fit.predict(rows).collect()}
    d = models.assemble(scaled, ["a", "b"]).withColumn("_label", F.array_position(F.array(*map(F.lit, fit.levels)), F.col("k")).cast("double") - 1)
    ridge = LogisticRegression(featuresCol="_features", labelCol="_label", family="multinomial", regParam=0.1, standardization=False, tol=1e-10, maxIter=500).fit(d)
    for r in ridge.transform(d).select("id", "probability").collect():
        assert np.allclose(mine[r["id"]], r["probability"].toArray(), atol=1e-4)


def test_hidden_units_learn_and_the_penalty_holds_back(spark, rows):
    loose = models.mlp(hidden_units=6, epochs=120).fit(rows, "k", ["a", "b"])
    tight = models.mlp(hidden_units=6, epochs=120, penalty=0.5).fit(rows, "k", ["a", "b"])
    acc = lambda f: f.predict(rows).agg(m.accuracy("k", "pred").alias("a")).first()["a"]
    assert acc(loose) > 0.95 > 0.8 > acc(tight)
    assert np.square(tight.model.theta).sum() < np.square(loose.model.theta).sum()
    assert all(a >= b for a, b in zip(loose.model.losses, loose.model.losses[1:]))
    reg = models.mlp("regression", hidden_units=8, epochs=150).fit(rows, "y", ["a", "b"]).predict(rows)
    assert reg.agg(m.rsq("y", "pred").alias("v")).first()["v"] > 0.95


def test_weights_count_like_repeated_rows(spark, rows):
    many = rows.withColumn("r", F.explode(F.sequence(F.lit(1), F.col("w").cast("int"))))
    spec = models.mlp("regression", hidden_units=0, penalty=0.2)
    a, b = spec.fit(rows, "y", ["a", "b"], weight="w"), spec.fit(many, "y", ["a", "b"])
    assert np.allclose(a.model.theta, b.model.theta, atol=1e-6)


def test_odd_rows(spark, rows):
    odd = rows.withColumns({"b": F.when(F.col("id") > 4, F.col("b")), "one": F.lit(2.0), "y": F.when(F.col("id") > 9, F.col("y"))})
    p = models.mlp("regression", hidden_units=2, epochs=5).fit(odd, "y", ["a", "b", "one"]).predict(odd)
    assert p.where("pred is null or isnan(pred)").count() == 0 and p.count() == 300
    none = models.mlp("regression", hidden_units=2).fit(rows.limit(0), "y", ["a"])
    assert none.predict(rows).where("isnan(pred)").count() == 0
