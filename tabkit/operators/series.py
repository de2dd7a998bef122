"""Per-key time series."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabkit.scale import broadcast_if_small, join_null_safe, names, near_rows, range_slices
from tabkit.session import stage


def duplicate_index(df: DataFrame, keys, time: str) -> DataFrame:
    """(key, time) values held by more than one row."""
    return df.groupBy(*names(keys), time).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def declare_series(df: DataFrame, keys, time: str) -> DataFrame:
    """The frame itself, once (key, time) is known to identify rows."""
    if not duplicate_index(df, keys, time).isEmpty():
        raise ValueError(f"({', '.join(names(keys))}, {time}) repeats")
    return df


def complete_series(df: DataFrame, keys, step: str, x: str, time: str, fill=None) -> DataFrame:
    """One row per step between each key's first and last time."""
    keys = names(keys)
    span = df.groupBy(*keys).agg(F.min(time).alias("_lo"), F.max(time).alias("_hi"))
    grid = span.select(*keys, F.explode(F.sequence("_lo", "_hi", F.expr(f"interval {step}"))).alias(time))
    out = join_null_safe(grid, df.select(*keys, time, x), [*keys, time], "left")
    return out.fillna({x: fill}) if fill is not None else out


def decompose(df: DataFrame, keys, time: str, x: str, period: int, phase: Column, hot_rows: int | None = None, block: int | None = None) -> DataFrame:
    """Trend (centred moving average), season (mean by phase, centred) and remainder.

    Rows must be evenly spaced per key; ``phase`` maps a row to its place in the
    period. The trend is NULL within half a period of the ends.
    """
    keys = names(keys)
    half = period // 2

    def add(d, w):
        wide, c = w.rowsBetween(-half, half), F.count(x).over(w.rowsBetween(-half, half))
        if period % 2:
            t = F.avg(x).over(wide)
        else:
            inner = F.sum(x).over(w.rowsBetween(-half + 1, half - 1))
            t = (inner + 0.5 * (F.lag(x, half).over(w) + F.lead(x, half).over(w))) / period
        return d.withColumn("trend", F.when(c == 2 * half + 1, t))

    t = near_rows(df, keys, [F.col(time)], half, half, add, hot_rows, block).withColumn("_ph", phase)
    raw = t.groupBy(*keys, "_ph").agg(F.avg(F.col(x) - F.col("trend")).alias("_s"))
    mid = raw.groupBy(*keys).agg(F.avg("_s").alias("_m"))
    season = join_null_safe(raw, mid, keys, "inner").withColumn("season", F.col("_s") - F.col("_m")).drop("_s", "_m")
    out = join_null_safe(t, season, [*keys, "_ph"], "left").drop("_ph")
    return out.withColumn("remainder", F.col(x) - F.col("trend") - F.col("season"))


def smooth(df: DataFrame, keys, time: str, x: str, alpha: float | str, parts: int | None = None) -> DataFrame:
    """Simple exponential smoothing: adds ``level`` (after the row) per key.

    The first level is the first value; a missing value leaves the level as it
    is, and before the first value there is none. The recursion is a chain of
    maps s -> a * s + b (the identity where a value is missing), so every range
    slice is smoothed alone; the maps of whole slices are composed in a prefix
    scan and give each slice the level it starts from. One long series uses all
    executors. ``alpha`` may be a column holding the weight; times are distinct
    within a key.
    """
    keys = names(keys)
    cols = df.columns
    d = df if isinstance(alpha, str) else df.withColumn("_alpha", F.lit(float(alpha)))
    acol = alpha if isinstance(alpha, str) else "_alpha"
    d = d.withColumn("_y", F.when(~F.isnan(F.col(x).cast("double")), F.col(x).cast("double")))
    cut = range_slices(d, [*[F.col(k) for k in keys], F.col(time)], parts)
    # the slice that holds a key's first value starts its chain
    first = cut.groupBy(*keys).agg(F.min(F.when(F.col("_y").isNotNull(), F.col("_slice"))).alias("_first"))
    cut = join_null_safe(cut, first, keys, "inner")
    schema = T.StructType([*cut.schema.fields, T.StructField("_a", T.DoubleType()), T.StructField("_b", T.DoubleType())])

    def local(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values(time, kind="stable")
        w, v, begins = float(p[acol].iloc[0]), p["_y"].to_numpy(float), p["_first"].iloc[0]
        if pd.isna(begins) or p["_slice"].iloc[0] < begins:
            p["_a"], p["_b"] = np.nan, np.nan
        elif p["_slice"].iloc[0] == begins:
            p["_a"], p["_b"] = 0.0, pd.Series(v).ewm(alpha=w, adjust=False, ignore_na=True).mean().to_numpy()
        else:
            p["_a"] = (1 - w) ** np.cumsum(~np.isnan(v))
            p["_b"] = pd.Series(np.r_[0.0, v]).ewm(alpha=w, adjust=False, ignore_na=True).mean().to_numpy()[1:]
        return p

    part = stage(cut.groupBy("_slice", *keys).applyInPandas(local, schema))
    ends = part.where("_slice >= _first").groupBy(*keys, "_slice", "_first").agg(F.max_by(F.struct("_a", "_b"), time).alias("e"))
    starts = _slice_levels(ends.select(*keys, "_slice", "_first", "e._a", "e._b"), keys)
    j = join_null_safe(part, broadcast_if_small(starts), ["_slice", *keys], "left")
    level = F.nanvl("_b", F.lit(None).cast("double")) + F.when(F.col("_slice") > F.col("_first"), F.col("_a") * F.col("_from")).otherwise(0.0)
    return j.withColumn("level", level).select(*cols, "level")


def _slice_levels(ends: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, _slice, _from): the level a key's later slices start from.

    A prefix scan: maps of 1, 2, 4, ... slices before a slice are composed with
    its own, so s slices of a key take log2(s) small joins. Only keys that span
    slices are in it, at most two rows per slice boundary.
    """
    by = Window.partitionBy(*keys).orderBy("_slice")
    chain = ends.withColumn("_i", F.row_number().over(by)).withColumn("_m", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    chain = stage(chain.where("_m > 1").select(*keys, "_slice", "_i", "_a", "_b"))
    longest, step = chain.agg(F.max("_i")).first()[0] or 0, 1
    while step < longest:
        before = chain.select(*keys, (F.col("_i") + step).alias("_i"), F.col("_a").alias("_pa"), F.col("_b").alias("_pb"))
        met = join_null_safe(chain, before, [*keys, "_i"], "left")
        a, b = F.col("_a") * F.coalesce("_pa", F.lit(1.0)), F.col("_a") * F.coalesce("_pb", F.lit(0.0)) + F.col("_b")
        chain, step = stage(met.select(*keys, "_slice", "_i", a.alias("_a"), b.alias("_b"))), 2 * step
    # the first slice of a key starts from nothing, so the composed offset is the level
    after = chain.select(*keys, (F.col("_i") + 1).alias("_i"), F.col("_b").alias("_from"))
    return stage(join_null_safe(chain.select(*keys, "_slice", "_i"), after, [*keys, "_i"], "inner").select(*keys, "_slice", "_from"))


def smooth_best(df: DataFrame, keys, time: str, x: str, alphas: Sequence[float]) -> DataFrame:
    """Per key the weight with the least one-step squared error, that error and the last level; missing values make no error."""
    keys = names(keys)
    grid = df.select(*keys, time, x).withColumn("alpha", F.explode(F.array(*[F.lit(float(a)) for a in alphas])))
    s = smooth(grid, [*keys, "alpha"], time, x, "alpha")
    # the error before seeing x follows from the level after it: level = prev + alpha * (x - prev)
    prev = F.try_divide(F.col("level") - F.col("alpha") * F.col(x), 1 - F.col("alpha"))
    there = F.col(x).isNotNull() & ~F.isnan(F.col(x).cast("double"))
    first = df.where(there).groupBy(*keys).agg(F.min(time).alias("_t0"))
    s = join_null_safe(s, first, keys, "inner")
    err = F.when(there & (F.col(time) > F.col("_t0")), (F.col(x) - prev) ** 2)
    by_alpha = s.groupBy(*keys, "alpha").agg(F.sum(err).alias("sse"), F.max_by("level", time).alias("level"))
    best = by_alpha.groupBy(*keys).agg(F.min(F.struct("sse", "alpha", "level")).alias("m"))
    return best.select(*keys, "m.alpha", "m.sse", "m.level")


def trend_month_fit(df: DataFrame, keys, t: Column, month: Column, x: str) -> DataFrame:
    """x ~ t + month per key: the slope and the level of each month.

    Centring t and x inside each month removes the month effects, so the slope
    comes from sums by (key, month) alone.
    """
    keys = names(keys)
    d = df.select(*keys, t.cast("double").alias("t"), month.alias("month"), F.col(x).cast("double").alias("x")).dropna(subset=["t", "x"])
    mean_t = d.agg(F.avg("t").alias("_t0"))
    d = d.crossJoin(F.broadcast(mean_t)).withColumn("t", F.col("t") - F.col("_t0"))
    m = d.groupBy(*keys, "month").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("t").alias("mt"),
        F.avg("x").alias("mx"),
        F.covar_pop("t", "x").alias("ctx"),
        F.var_pop("t").alias("vt"),
        F.first("_t0").alias("t0"),
    )
    s = m.groupBy(*keys).agg(F.try_divide(F.sum(F.col("n") * F.col("ctx")), F.sum(F.col("n") * F.col("vt"))).alias("slope"))
    j = join_null_safe(m, s, keys, "inner")
    return j.select(*keys, "month", "slope", (F.col("mx") - F.col("slope") * (F.col("mt") + F.col("t0"))).alias("intercept"))


def trend_month_predict(df: DataFrame, fit: DataFrame, keys, t: Column, month: Column, name: str = "pred") -> DataFrame:
    keys = names(keys)
    j = join_null_safe(df.withColumn("month", month), fit, [*keys, "month"], "left")
    return j.withColumn(name, F.col("intercept") + F.col("slope") * t.cast("double")).drop("intercept", "slope")


def accuracy_table(forecasts: DataFrame, model: str = "model_id", truth: str = "actual", est: str = "pred") -> DataFrame:
    """Errors of each model over its forecasts, best (lowest rmse) first."""
    from tabkit.modelling import metrics as m

    aggs = [m.METRICS[k].expr(truth, est).alias(k) for k in ("rmse", "mae", "mape", "rsq")]
    return forecasts.groupBy(model).agg(F.count(F.lit(1)).alias("n"), *aggs).orderBy("rmse", model)


def best_model(forecasts: DataFrame, model: str = "model_id") -> DataFrame:
    return accuracy_table(forecasts, model).limit(1)


def period_summary(df: DataFrame, time: str, unit: str, x: str) -> DataFrame:
    """Count, mean and exact median per calendar unit."""
    from tabkit.scale import exact_quantiles

    d = df.withColumn("period", F.date_trunc(unit, time).cast("date"))
    base = d.groupBy("period").agg(F.count(F.lit(1)).alias("n"), F.avg(x).alias("mean"))
    return base.join(exact_quantiles(d, "period", x, {"median": 0.5}), "period", "left")
