"""Model metrics as aggregate expressions, and exact rank metrics."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabkit.functions.scalars import correlation
from tabkit.scale import names, running

# Fixed value: probabilities are kept this far from 0 and 1.
EPS = 2.220446049250313e-16


@dataclass(frozen=True)
class Metric:
    """An aggregate over (truth, estimate) and the direction that is better."""

    expr: Callable[[str, str], Column]
    minimize: bool


def accuracy(truth: str, est: str) -> Column:
    return F.avg((F.col(truth) == F.col(est)).cast("double"))


def log_loss(p_true: Column) -> Column:
    """Mean -log of the probability given to the true class."""
    return -F.avg(F.log(F.least(F.greatest(p_true, F.lit(EPS)), F.lit(1 - EPS))))


def binary_log_loss(truth: str, p: str, event) -> Column:
    return log_loss(F.when(F.col(truth) == F.lit(event), F.col(p)).otherwise(1 - F.col(p)))


def class_log_loss(truth: str, probs: dict[object, str]) -> Column:
    p = None
    for lv, c in probs.items():
        p = F.when(F.col(truth) == F.lit(lv), F.col(c)) if p is None else p.when(F.col(truth) == F.lit(lv), F.col(c))
    return log_loss(p)


def rmse(truth: str, est: str) -> Column:
    return F.sqrt(F.avg((F.col(truth) - F.col(est)) ** 2))


def mae(truth: str, est: str) -> Column:
    return F.avg(F.abs(F.col(truth) - F.col(est)))


def mape(truth: str, est: str) -> Column:
    return F.avg(F.abs(F.try_divide(F.col(truth) - F.col(est), F.col(truth)))) * 100


def rsq(truth: str, est: str) -> Column:
    """Squared correlation (not 1 - SSE/SST)."""
    return correlation(truth, est) ** 2


def rmsle(truth: str, est: str, na_rm: bool = True) -> Column:
    v = F.sqrt(F.avg((F.log1p(F.col(truth)) - F.log1p(F.col(est))) ** 2))
    return v if na_rm else F.when(F.count_if(F.col(truth).isNull() | F.col(est).isNull()) == 0, v)


METRICS: dict[str, Metric] = {
    "accuracy": Metric(accuracy, False),
    "rmse": Metric(rmse, True),
    "mae": Metric(mae, True),
    "mape": Metric(mape, True),
    "rsq": Metric(rsq, False),
    "rmsle": Metric(rmsle, True),
}

DIRECTIONS: dict[str, bool] = {"log_loss": True, "roc_auc": False}


def register(name: str, expr: Callable[[str, str], Column], minimize: bool) -> None:
    """Make a user aggregate usable wherever a metric is named."""
    METRICS[name] = Metric(expr, minimize)


def minimizes(name: str) -> bool:
    return METRICS[name].minimize if name in METRICS else DIRECTIONS[name]


def evaluate(df: DataFrame, truth: str, est: str, which: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """All named metrics in one pass, long form (metric, value)."""
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), METRICS[m].expr(truth, est).alias("value")) for m in which])
    return df.groupBy(*by).agg(pairs.alias("_m")).select(*by, F.inline("_m"))


def _score_counts(df: DataFrame, event: Column, score: str, keys: Sequence[str]) -> DataFrame:
    d = df.select(*keys, F.col(score).cast("double").alias("score"), event.cast("boolean").alias("_e")).dropna()
    return d.groupBy(*keys, "score").agg(F.count_if("_e").alias("pos"), F.count_if(~F.col("_e")).alias("neg"))


def roc_auc(df: DataFrame, event: Column, score: str, keys: str | Sequence[str] | None = None) -> DataFrame:
    """Exact area under the ROC curve per key: ties count one half.

    Rows collapse to distinct scores, then one distributed running sum.
    """
    keys = names(keys)
    g = _score_counts(df, event, score, keys)
    r = running(g, keys, [F.col("score")], {"neg_cum": F.col("neg")})
    won = F.sum(F.col("pos") * (F.col("neg_cum") - F.col("neg") / 2.0))
    return r.groupBy(*keys).agg(F.try_divide(won, F.sum("pos").cast("double") * F.sum("neg")).alias("auc"))


def roc_auc_multiclass(df: DataFrame, truth: str, probs: dict[str, str], keys: str | Sequence[str] | None = None) -> DataFrame:
    """Hand-Till per key: the mean over ordered class pairs of the pairwise areas; pairs without both classes are left out."""
    keys = names(keys)
    parts = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(probs[a]).alias("s")) for a in probs for b in probs if a != b]
    d = df.select(*keys, F.col(truth).cast("string").alias("_t"), F.inline(F.array(*parts))).where("_t = a or _t = b")
    auc = roc_auc(d, F.col("_t") == F.col("a"), "s", [*keys, "a", "b"])
    return auc.groupBy(*keys).agg(F.avg("auc").alias("auc"))


def roc_curve(df: DataFrame, event: Column, score: str) -> DataFrame:
    """Sensitivity and specificity at every distinct threshold."""
    g = _score_counts(df, event, score, [])
    r = running(g, None, [F.desc("score")], {"tp": F.col("pos"), "fp": F.col("neg")}, totals=True)
    return r.select(
        F.col("score").alias("threshold"),
        F.try_divide("tp", "tp_total").alias("sensitivity"),
        (1 - F.try_divide("fp", "fp_total")).alias("specificity"),
    )


def pr_curve(df: DataFrame, event: Column, score: str) -> DataFrame:
    g = _score_counts(df, event, score, [])
    r = running(g, None, [F.desc("score")], {"tp": F.col("pos"), "fp": F.col("neg")}, totals=True)
    return r.select(
        F.col("score").alias("threshold"),
        F.try_divide("tp", "tp_total").alias("recall"),
        F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
    )


def confusion(df: DataFrame, truth: str, est: str) -> DataFrame:
    return df.groupBy(F.col(truth).alias("truth"), F.col(est).alias("prediction")).agg(F.count(F.lit(1)).alias("n"))


def member_agreement(df: DataFrame, truth: str, members: Sequence[str]) -> DataFrame:
    """Share of rows where each member's class equals the truth, and the members' mean."""
    one = F.array(*[F.struct(F.lit(m).alias("member"), accuracy(truth, m).alias("accuracy")) for m in members])
    return df.agg(one.alias("_m")).select(F.inline("_m"))
