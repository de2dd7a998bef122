"""Counts, profiles, correlations and densities."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import combinations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabkit.functions.beta import beta_quantile
from tabkit.functions.scalars import correlation
from tabkit.operators.frames import is_missing, typed
from tabkit.operators.windows import average_rank
from tabkit.scale import exact_quantiles, join_null_safe, names


def count(df: DataFrame, *keys: str, name: str = "n", sort: bool = False) -> DataFrame:
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return out.orderBy(F.desc(name), *keys) if sort else out


def share(df: DataFrame, n: str, within: Sequence[str] = (), name: str = "frac") -> DataFrame:
    """Each row's part of the total, of the table or of its group.

    Totals are aggregated and joined back, so no group has to meet in one task.
    """
    tot = df.groupBy(*within).agg(F.sum(n).alias("_tot"))
    j = join_null_safe(df, tot, within, "inner") if within else df.crossJoin(F.broadcast(tot))
    return j.withColumn(name, F.try_divide(F.col(n), F.col("_tot"))).drop("_tot")


def agg_strict(fn: Callable[[Column], Column], c: str, na_rm: bool = False) -> Column:
    """An aggregate that is NULL when any input is NULL, unless na_rm."""
    return fn(F.col(c)) if na_rm else F.when(F.count(F.lit(1)) == F.count(c), fn(F.col(c)))


def summarise_across(df: DataFrame, keys, cols: Sequence[str], fns: dict[str, Callable[[Column], Column]], na_rm: bool = True) -> DataFrame:
    """n and every function of every column per group, named {col}_{fn}."""
    aggs = [F.count(F.lit(1)).alias("n")]
    aggs += [agg_strict(f, c, na_rm).alias(f"{c}_{k}") for c in cols for k, f in fns.items()]
    return df.groupBy(*names(keys)).agg(*aggs)


def count_where(cond: Column) -> Column:
    """Rows that meet the condition (NULL counts as not)."""
    return F.count_if(cond)


def rate_where(cond: Column) -> Column:
    return F.try_divide(F.count_if(cond), F.count(F.lit(1)))


def quantiles(df: DataFrame, keys, value: str, probs: dict[str, float]) -> DataFrame:
    return exact_quantiles(df, keys, value, probs)


def jeffreys_rate(df: DataFrame, keys, event: Column, level: float = 0.95) -> DataFrame:
    """n, events, rate and the Jeffreys interval per group."""
    lo, hi = (1 - level) / 2, 1 - (1 - level) / 2

    @F.pandas_udf("double")
    def bound(k: pd.Series, n: pd.Series, p: pd.Series) -> pd.Series:
        return pd.Series(beta_quantile(p.to_numpy(), k.to_numpy() + 0.5, n.to_numpy() - k.to_numpy() + 0.5))

    g = df.groupBy(*names(keys)).agg(F.count(F.lit(1)).alias("n"), F.count_if(event).alias("n_event"))
    k, n = F.col("n_event").cast("double"), F.col("n").cast("double")
    return g.withColumns({"pct": k / n, "low": bound(k, n, F.lit(lo)), "high": bound(k, n, F.lit(hi))})


def profile(df: DataFrame) -> DataFrame:
    """One row per column: type, rows, missing, complete rate and per-type statistics.

    Text and date columns carry lengths and bounds as text; numeric ones carry
    mean, sd and the five quantiles. All single-pass statistics come from one
    aggregate; quantiles go through the distributed counts.
    """
    num = typed(df, "numeric")
    txt = typed(df, "string")
    rest = [c for c in df.columns if c not in num and c not in txt]
    fields = "n_missing mean sd min_length max_length n_empty n_unique".split()
    none_d, none_l = F.lit(None).cast("double"), F.lit(None).cast("long")

    def row(c: str) -> Column:
        x = F.col(c)
        isnum, istxt = c in num, c in txt
        good = F.when(~is_missing(df, c), x)
        return F.struct(
            F.lit(c).alias("column"),
            F.lit("numeric" if isnum else "string" if istxt else "other").alias("kind"),
            F.count(F.lit(1)).alias("n"),
            F.count_if(is_missing(df, c)).alias("n_missing"),
            (F.avg(good.cast("double")) if isnum else none_d).alias("mean"),
            (F.stddev_samp(good.cast("double")) if isnum else none_d).alias("sd"),
            (F.min(F.length(x)).cast("long") if istxt else none_l).alias("min_length"),
            (F.max(F.length(x)).cast("long") if istxt else none_l).alias("max_length"),
            (F.count_if(x == "") if istxt else none_l).alias("n_empty"),
            (none_d.cast("string") if isnum else F.min(x).cast("string")).alias("min_value"),
            (none_d.cast("string") if isnum else F.max(x).cast("string")).alias("max_value"),
        )

    one = df.agg(F.array(*[row(c) for c in num + txt + rest]).alias("r")).select(F.inline("r"))
    one = one.withColumn("complete_rate", F.try_divide(F.col("n") - F.col("n_missing"), F.col("n")))
    if txt:
        long = df.select(*txt).unpivot([], txt, "column", "v").where("v is not null")
        uniq = long.distinct().groupBy("column").agg(F.count(F.lit(1)).alias("n_unique"))
        one = one.join(F.broadcast(uniq), "column", "left")
    else:
        one = one.withColumn("n_unique", none_l)
    if num:
        long = df.select(*[F.col(c).cast("double").alias(c) for c in num]).unpivot([], num, "column", "v")
        q = exact_quantiles(long, "column", "v", {"p0": 0, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p100": 1})
        one = one.join(F.broadcast(q), "column", "left")
    return one


def top_levels(df: DataFrame, cols: Sequence[str], k: int = 3) -> DataFrame:
    """The k commonest levels of each text column."""
    long = df.select(*cols).unpivot([], list(cols), "column", "level").where("level is not null")
    n = count(long, "column", "level")
    w = Window.partitionBy("column").orderBy(F.desc("n"), "level")
    return n.withColumn("rnk", F.row_number().over(w)).where(F.col("rnk") <= k)


def _pair_structs(cols: Sequence[str], both_ways: bool) -> Column:
    pairs = list(combinations(sorted(cols), 2))
    if both_ways:
        pairs += [(b, a) for a, b in pairs]
    return F.array(
        *[F.struct(F.lit(a).alias("col1"), F.lit(b).alias("col2"), correlation(a, b).alias("value")) for a, b in pairs]
    )


def correlations(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = (), both_ways: bool = False) -> DataFrame:
    """Pearson correlation of every pair in long form, pairwise complete, in one pass.

    Groups with keys combine on the map side, so a hot group is no burden.
    """
    d = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in cols])
    return d.groupBy(*keys).agg(_pair_structs(cols, both_ways).alias("_p")).select(*keys, F.inline("_p"))


def spearman(df: DataFrame, row_id: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Pearson on average ranks of the rows; rows with any value missing are left out."""
    d = df.select(*cols).dropna()
    # rank each column over its distinct values, then look the ranks up
    for c in cols:
        d = average_rank(d, None, c, f"_rk_{c}")
    d = d.select(*[F.col(f"_rk_{c}").alias(c) for c in cols])
    return correlations(d, cols)


def correlation_gap(df: DataFrame, group: str, a, b, cols: Sequence[str], k: int = 20) -> DataFrame:
    """Pairs whose correlation differs most between two groups."""
    long = correlations(df.where(F.col(group).isin(a, b)), cols, [group])
    side = lambda v: F.max(F.when(F.col(group) == F.lit(v), F.col("value")))
    wide = long.groupBy("col1", "col2").agg(side(a).alias("value_a"), side(b).alias("value_b"))
    wide = wide.withColumn("diff", F.col("value_a") - F.col("value_b"))
    return wide.orderBy(F.abs("diff").desc(), "col1", "col2").limit(k)


def collapse_text(col: str, sep: str = ",", empty: str = "none") -> Column:
    """Sorted distinct-or-not values of a bounded group joined into text."""
    vals = F.sort_array(F.collect_list(col))
    return F.when(F.size(vals) == 0, F.lit(empty)).otherwise(F.array_join(vals, sep))


def histogram(df: DataFrame, col: str, width: float, origin: float = 0.0, keys: Sequence[str] = ()) -> DataFrame:
    cell = F.floor((F.col(col) - F.lit(origin)) / F.lit(width))
    return df.where(F.col(col).isNotNull()).groupBy(*keys, cell.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def density(df: DataFrame, col: str, keys: Sequence[str], grid: tuple[float, float, int], bandwidth: float, bin_width: float) -> DataFrame:
    """Gaussian kernel density per group on a fixed grid.

    Rows are first counted into bins of ``bin_width``; the kernel then meets
    bins x grid points, a number that does not grow with the rows.
    """
    lo, hi, m = grid
    step = (hi - lo) / (m - 1)
    bins = histogram(df, col, bin_width, 0.0, keys)
    mid = (F.col("bin") + 0.5) * bin_width
    pts = F.transform(F.sequence(F.lit(0), F.lit(m - 1)), lambda i: F.lit(lo) + i * F.lit(step))
    z = (F.col("x") - mid) / F.lit(bandwidth)
    k = F.exp(-0.5 * z * z) * F.col("n")
    norm = F.sum("n") * F.lit(bandwidth * 2.5066282746310002)
    return bins.withColumn("x", F.explode(pts)).groupBy(*keys, "x").agg((F.sum(k) / norm).alias("density"))


def class_summary(df: DataFrame, label: str, cols: Sequence[str]) -> DataFrame:
    """Five numbers and the mean of each column per class, long form."""
    long = df.select(label, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot([label], list(cols), "metric", "v")
    q = exact_quantiles(long, [label, "metric"], "v", {"p0": 0, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p100": 1})
    mean = long.groupBy(label, "metric").agg(F.avg("v").alias("mean"))
    return join_null_safe(mean, q, [label, "metric"], "left")


def shape(df: DataFrame, key: str) -> DataFrame:
    """Row count, column count, distinct keys, and whether keys identify rows."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(df.columns)).cast("long").alias("n_cols"),
        F.count_distinct(key).alias("n_keys"),
    ).withColumn("key_is_unique", F.col("n_rows") == F.col("n_keys"))


def check_rows(df: DataFrame, rule: Column, what: str) -> None:
    """Raise unless a one-row aggregate rule holds."""
    if not df.agg(rule.alias("ok")).first()["ok"]:
        raise AssertionError(what)
