import numpy as np
import pytest
from pyspark.sql import functions as F

from tabkit.modelling import models
from tabkit.modelling.hinges import fit_hinges, forward, prune


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(2)
    x = rng.integers(0, 40, (500, 3)).astype(float)
    y = 2 * np.maximum(x[:, 0] - 15, 0) - np.maximum(25 - x[:, 1], 0) + rng.normal(0, 0.3, 500)
    z = np.maximum(x[:, 0] - 20, 0) * np.maximum(x[:, 1] - 10, 0)
    return spark.createDataFrame([(i, *map(float, x[i]), float(y[i]), float(z[i]), float(i % 2 + 1)) for i in range(500)], "id int, a double, b double, c double, y double, z double, w double").cache()


def names(fit):
    return {t for t, _ in fit.model.table()}


def test_planted_knots_are_found_and_noise_is_dropped(spark, rows):
    fit = models.mars(num_terms=11).fit(rows, "y", ["a", "b", "c"])
    found = names(fit)
    assert {"h(a-15)", "h(25-b)"} <= found
    dear = names(models.mars(num_terms=11, penalty=8.0).fit(rows, "y", ["a", "b", "c"]))
    assert {"h(a-15)", "h(25-b)"} <= dear and not any("c" in t.replace("Intercept", "") for t in dear)
    more = names(models.mars(num_terms=11, prune_method="none").fit(rows, "y", ["a", "b", "c"]))
    assert len(more) > len(found)
    e = fit.predict(rows).agg(F.sqrt(F.avg((F.col("pred") - F.col("y")) ** 2))).first()[0]
    assert e < 0.35


@pytest.mark.parametrize("method", ["backward", "forward", "exhaustive"])
def test_pruning_methods(spark, rows, method):
    fit = models.mars(num_terms=9, prune_method=method).fit(rows, "y", ["a", "b", "c"])
    e = fit.predict(rows).agg(F.sqrt(F.avg((F.col("pred") - F.col("y")) ** 2))).first()[0]
    assert e < 0.4 and len(fit.model.terms) <= 9
    with pytest.raises(ValueError):
        models.mars(prune_method="no such").fit(rows, "y", ["a"])


def test_products(spark, rows):
    one = models.mars(num_terms=15).fit(rows, "z", ["a", "b"])
    two = models.mars(num_terms=15, prod_degree=2).fit(rows, "z", ["a", "b"])
    e = [f.predict(rows).agg(F.sqrt(F.avg((F.col("pred") - F.col("z")) ** 2))).first()[0] for f in (one, two)]
    assert e[1] < 0.5 * e[0] and any("*" in t for t in names(two))


def test_selection_against_plain_least_squares():
    rng = np.random.default_rng(5)
    x = np.column_stack([np.ones(80), rng.normal(size=(80, 8))])
    y = x @ np.array([1, 0, 3, 0, 0, -2, 0, 0, 0.5]) + rng.normal(0, 0.1, 80)
    z = np.column_stack([x, y])
    g = z.T @ z
    groups = [[1, 2], [3, 4], [5, 6], [7, 8]]
    rest = lambda cols: np.linalg.lstsq(x[:, cols], y, rcond=None)[1].sum()
    chosen = [0]
    for _ in range(4):
        best = min((gr for gr in groups if gr[0] not in chosen), key=lambda gr: rest(chosen + gr))
        chosen += best
    assert forward(g, groups, [0], 9) == chosen
    kept = prune(g, chosen, 80, 2.0, "exhaustive")
    assert sorted(kept) == sorted(prune(g, chosen, 80, 2.0, "backward")) and {0, 2, 5, 8} <= set(kept)


def test_weights_and_odd_rows(spark, rows):
    many = rows.withColumn("r", F.explode(F.sequence(F.lit(1), F.col("w").cast("int"))))
    a, b = fit_hinges(rows, "y", ["a"], num_terms=3, weight="w", knots=5, prune_method="none"), fit_hinges(many, "y", ["a"], num_terms=3, knots=5, prune_method="none")
    assert len(a.terms) == len(b.terms) == 3
    odd = rows.withColumns({"a": F.when(F.col("id") > 9, F.col("a")), "b": F.lit(1.0), "y": F.when(F.col("id") > 3, F.col("y"))})
    p = models.mars().fit(odd, "y", ["a", "b"]).predict(odd)
    assert p.where("pred is null or isnan(pred)").count() == 0
    assert {r["pred"] for r in models.mars().fit(rows.limit(0), "y", ["a"]).predict(rows).collect()} == {0.0}
