"""Model specifications over MLlib, with one parameter vocabulary.

A Spec is fitted on a DataFrame and gives a Fitted, which adds ``pred`` and, for
classes, ``prob_<level>`` columns. Everything between is MLlib.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

from pyspark.ml import classification as C
from pyspark.ml import clustering as K
from pyspark.ml import regression as R
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabkit.features.dictionary import block_size
from tabkit.features.levels import collect_levels
from tabkit.features.recipe import safe_name, unique_names
from tabkit.modelling.boosting import Boosted, fit_boosted
from tabkit.modelling.hinges import Hinges, fit_hinges
from tabkit.modelling.neighbours import NeighbourModel
from tabkit.modelling.network import Network, fit_network


def labelled(df: DataFrame, label: str, levels: Sequence[str] | None) -> tuple[DataFrame, str]:
    """df with the numeric _label, and the loss that goes with it."""
    if levels is None:
        return df.withColumn("_label", F.col(label).cast("double")), "squared"
    lv = F.array(*[F.lit(v) for v in levels])
    at = F.array_position(lv, F.col(label).cast("string"))
    return df.withColumn("_label", F.when(at > 0, (at - 1).cast("double"))), "logistic" if len(levels) == 2 else "softmax"


def prob(level) -> str:
    return f"prob_{safe_name(str(level))}"


def prob_columns(levels: Sequence[str]) -> dict[str, str]:
    """The probability column of each level; levels that differ in signs only get numbers."""
    return {v: f"prob_{n}" for v, n in unique_names(levels).items()}


# What each kind of model takes; a name outside is an error, not a default.
PARAMS = {
    "linear_reg": {"penalty", "mixture", "epochs"},
    "mars": {"num_terms", "prod_degree", "prune_method", "penalty", "knots"},
    "mlp": {"hidden_units", "penalty", "epochs", "seed"},
    "rand_forest": {"trees", "min_n", "tree_depth", "mtry", "seed"},
    "bag_tree": {"trees", "min_n", "tree_depth", "seed"},
    "nearest_neighbor": {"neighbors", "weight_func"},
    "boost_tree": {"trees", "learn_rate", "tree_depth", "min_n", "loss_reduction", "sample_size", "mtry", "stop_iter", "penalty", "bins", "seed"},
}


MOST_NORMAL = 4096  # columns the normal equations take; wider fits go by gradients


def assemble(df: DataFrame, features: Sequence[str], out: str = "_features", invalid: str = "keep") -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid=invalid).transform(df)


@dataclass
class Fitted:
    """A fitted model with what is needed to score raw columns."""

    spec: "Spec"
    features: list[str]
    model: object
    levels: list[str] | None = None
    extra: dict = field(default_factory=dict)

    def _vectors(self, df: DataFrame) -> DataFrame:
        for c, e in self.extra.get("columns", {}).items():
            df = df.withColumn(c, F.expr(e))
        return assemble(df, self.extra.get("inputs", self.features))

    def predict(self, df: DataFrame) -> DataFrame:
        # an older prediction is replaced; a feature keeps its name
        made = {"pred", *prob_columns(self.levels or []).values()}
        taken = made & set(self.features)
        if taken:
            raise ValueError(f"features named like the predictions to be written: {sorted(taken)}")
        cols = [c for c in df.columns if c not in made]
        df = df.select(*[F.col(f"`{c}`") for c in cols])
        if isinstance(self.model, (Boosted, Hinges, Network)):
            return self._array_outcome(self.model.transform(df), cols)
        if self.levels is None and isinstance(self.model, NeighbourModel):
            return self._neighbours(df).select(*cols, "pred")
        if self.levels is None:
            p = self.model.transform(self._vectors(df))
            return p.select(*cols, F.col("prediction").alias("pred"))
        if isinstance(self.model, NeighbourModel):
            p = self._neighbours(df)
            return p.select(*cols, "pred", *[F.get("p", i).alias(n) for i, n in enumerate(prob_columns(self.levels).values())])
        p = self.model.transform(self._vectors(df))
        arr = vector_to_array("probability")
        lv = F.array(*[F.lit(v) for v in self.levels])
        probs = [arr[i].alias(name) for i, name in enumerate(prob_columns(self.levels).values())]
        return p.select(*cols, F.get(lv, F.col("prediction").cast("int")).alias("pred"), *probs)

    def _array_outcome(self, p: DataFrame, cols: list[str]) -> DataFrame:
        """The array _p as pred, or as the likeliest level (ties to the first) and the probabilities."""
        if self.levels is None:
            return p.select(*cols, F.get("_p", F.lit(0)).alias("pred"))
        lv = F.array(*[F.lit(v) for v in self.levels])
        top = F.get(lv, (F.array_position("_p", F.array_max("_p")) - 1).cast("int"))
        return p.select(*cols, top.alias("pred"), *[F.get("_p", F.lit(i)).alias(name) for i, name in enumerate(prob_columns(self.levels).values())])

    def _neighbours(self, df: DataFrame) -> DataFrame:
        return self.model.score(df.withColumn("v", F.array(*[F.col(f"`{c}`").cast("double") for c in self.features])), self.levels)

    def score_expr(self) -> str:
        """The column that ranks rows: the prediction, or the second level's probability."""
        return "pred" if self.levels is None else prob_columns(self.levels)[self.levels[-1]]


@dataclass(frozen=True)
class Spec:
    """kind, mode ('regression' or 'classification') and named parameters."""

    kind: str
    mode: str
    params: dict = field(default_factory=dict)

    def __post_init__(self):
        unknown = set(self.params) - PARAMS.get(self.kind, set())
        if unknown:
            raise ValueError(f"{self.kind} has no parameter {sorted(unknown)}")

    def set(self, **params) -> "Spec":
        return replace(self, params={**self.params, **params})

    def fit(self, df: DataFrame, label: str, features: Sequence[str], weight: str | None = None, valid: str | None = None, levels: Sequence[str] | None = None) -> Fitted:
        """``levels`` fixes the classes where df may lack one, as a fold does."""
        features = list(features)
        if self.mode == "classification":
            levels = list(levels) if levels is not None else collect_levels(df, label)
        else:
            levels = None
        d, objective = labelled(df, label, levels)
        extra: dict = {}
        if self.kind == "nearest_neighbor":
            if weight:
                raise ValueError("nearest_neighbor takes no case weights")
            v = F.array(*[F.col(f"`{c}`").cast("double") for c in features])
            rows = d.select("_label", v.alias("v")).where("_label IS NOT NULL")
            return Fitted(self, features, NeighbourModel(rows, "_label", self.params.get("neighbors", 5), self.params.get("weight_func", "rectangular")), levels, extra)
        if self.kind == "mars":
            return Fitted(self, features, fit_hinges(d, "_label", features, weight=weight, **self.params), levels, extra)
        if self.kind == "boost_tree":
            return Fitted(self, features, fit_boosted(d, "_label", features, objective=objective, n_classes=len(levels or []), weight=weight, valid=valid, **self.params), levels, extra)
        if self.kind == "mlp":
            return Fitted(self, features, fit_network(d, "_label", features, len(levels or []), weight=weight, **self.params), levels, extra)
        extra["widths"] = [block_size(d, c) or 1 for c in extra.get("inputs", features)]
        d = assemble(d, extra.get("inputs", features))
        keep = ["_features", "_label"] + [c for c in (weight, valid) if c]
        d = d.select(*keep).where("_label IS NOT NULL")
        return Fitted(self, features, self._estimator(levels, features, weight, valid, sum(extra["widths"])).fit(d), levels, extra)

    def _estimator(self, levels, features, weight, valid, width=0):
        p, wide = self.params, width > MOST_NORMAL
        cols = {"featuresCol": "_features", "labelCol": "_label"}
        seed = p.get("seed", 1)
        w = {"weightCol": weight} if weight else {}
        n_classes = len(levels) if levels else 0
        if self.kind == "linear_reg":
            if levels is None:
                solver = {} if p.get("penalty") or wide else {"solver": "normal"}
                return R.LinearRegression(**cols, **w, **solver, regParam=p.get("penalty", 0.0), elasticNetParam=p.get("mixture", 0.0), maxIter=p.get("epochs", 100))
            family = "binomial" if n_classes == 2 else "multinomial"
            return C.LogisticRegression(**cols, **w, family=family, regParam=p.get("penalty", 0.0), elasticNetParam=p.get("mixture", 0.0), maxIter=p.get("epochs", 100))
        if self.kind in ("rand_forest", "bag_tree"):
            bag = self.kind == "bag_tree"
            mtry = "all" if bag else str(p["mtry"]) if "mtry" in p else "auto"
            args = dict(numTrees=p.get("trees", 25 if bag else 100), minInstancesPerNode=p.get("min_n", 1), maxDepth=p.get("tree_depth", 8), featureSubsetStrategy=mtry, seed=seed)
            return (C.RandomForestClassifier if levels else R.RandomForestRegressor)(**cols, **w, **args)
        raise ValueError(f"unknown model: {self.kind}")


def linear_reg(mode: str = "regression", **params) -> Spec:
    """Least squares, elastic net (penalty, mixture), logistic or multinomial by mode."""
    return Spec("linear_reg", mode, params)


def mlp(mode: str = "classification", **params) -> Spec:
    """One hidden layer (hidden_units, 0 for none) with weight decay (penalty)."""
    return Spec("mlp", mode, params)


def rand_forest(mode: str = "classification", **params) -> Spec:
    return Spec("rand_forest", mode, params)


def bag_tree(mode: str = "regression", **params) -> Spec:
    return Spec("bag_tree", mode, params)


def boost_tree(mode: str = "classification", **params) -> Spec:
    return Spec("boost_tree", mode, params)


def nearest_neighbor(mode: str = "classification", **params) -> Spec:
    """k nearest neighbours (neighbors, weight_func) on numeric predictors without missing values; scale them first."""
    return Spec("nearest_neighbor", mode, params)


def mars(**params) -> Spec:
    """Stepwise hinge regression (num_terms, prod_degree, prune_method)."""
    return Spec("mars", "regression", params)


def univariate_logistic(df: DataFrame, label: str, columns: Sequence[str], parallelism: int = 4) -> DataFrame:
    """One binomial model per column: estimate, standard error, statistic and p-value."""

    def one(c: str):
        d = assemble(df.select(F.col(label).cast("double").alias("_label"), F.col(c).cast("double").alias(c)).dropna(), [c])
        m = R.GeneralizedLinearRegression(family="binomial", featuresCol="_features", labelCol="_label").fit(d)
        s = m.summary
        return [
            (c, t, float(b), float(s.coefficientStandardErrors[i]), float(s.tValues[i]), float(s.pValues[i]))
            for i, (t, b) in enumerate([(c, m.coefficients[0]), ("(Intercept)", m.intercept)])
        ]

    with ThreadPoolExecutor(parallelism) as pool:
        rows = [r for rs in pool.map(one, columns) for r in rs]
    schema = "variable string, term string, estimate double, std_error double, statistic double, p_value double"
    return df.sparkSession.createDataFrame(rows, schema).orderBy("p_value", "variable", "term")


def kmeans_feature(train: DataFrame, columns: Sequence[str], k: int = 2, seed: int = 1):
    """Fit clusters on training rows; returns a function adding ``cluster`` to any rows."""
    model = K.KMeans(k=k, seed=seed, featuresCol="_features", predictionCol="cluster").fit(assemble(train, columns).select("_features"))
    return lambda df: model.transform(assemble(df, columns)).drop("_features")


def predict_on(spec: Spec, train: DataFrame, new: DataFrame, label: str, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Fit, score, and keep the named columns with the predictions."""
    fit = spec.fit(train, label, features)
    return fit.predict(new).select(*keep, "pred", *prob_columns(fit.levels or []).values())


def augment(fitted: Fitted, df: DataFrame, transform: dict[str, Column] | None = None) -> DataFrame:
    """The rows with their predictions, optionally transformed back."""
    return fitted.predict(df).withColumns(transform or {})
