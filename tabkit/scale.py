"""Skew-safe building blocks the operators share.

A window partitioned by a hot key runs in one task, and a window without keys
runs in one task always. The functions here give the same rows as such windows
while every task stays bounded:

* running      running sums / row numbers of any order, with or without keys
* near_rows    lag, lead and rolling frames, hot keys cut into blocks
* hash_cuts    exact order statistics of a hash order, without moving rows
* exact_quantiles  interpolated quantiles per group
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabkit.session import stage

HOT_ROWS = 5_000_000
BROADCAST_ROWS = 100_000
ONE_TASK_ROWS = 1_000_000


def names(keys: str | Sequence[str] | None) -> list[str]:
    if keys is None:
        return []
    return [keys] if isinstance(keys, str) else list(keys)


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only after counting that df has at most max_rows rows."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi join where NULL meets NULL; one copy of the keys is kept."""
    keys = names(keys)
    if not keys:
        return left.crossJoin(right) if how == "inner" else left.join(right, F.lit(True), how)
    r = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"_r_{k}"])
        cond = c if cond is None else cond & c
    return left.join(r, cond, how).drop(*[f"_r_{k}" for k in keys])


def range_slices(df: DataFrame, by: Sequence[Column], parts: int | None = None) -> DataFrame:
    """df sorted into range slices, written, with the slice number in ``_slice``.

    Without ``parts`` adaptive execution merges small slices up to its advisory
    size, from as many as spark.sql.shuffle.partitions allows.
    """
    cut = df.repartitionByRange(parts, *by) if parts else df.repartitionByRange(*by)
    return stage(cut.withColumn("_slice", F.spark_partition_id()))


def running(
    df: DataFrame,
    keys: str | Sequence[str] | None,
    order: Sequence[Column],
    sums: dict[str, Column],
    totals: bool = False,
    parts: int | None = None,
) -> DataFrame:
    """Add running sums (row included) of each expression, in order within keys.

    Rows are range-partitioned by (keys, order), so a hot key spreads over many
    slices; each slice is summed alone and shifted by what the slices before it
    hold. A slice continues at most one key from its predecessor, so the shift
    table has at most two rows per slice, which is why it may be broadcast.
    ``order`` should end in a unique column. With ``totals``, ``<name>_total``
    holds the sum over the whole key.
    """
    keys = names(keys)
    v = {f"_v_{k}": e for k, e in sums.items()}
    cut = range_slices(df.withColumns(v), [*[F.col(k) for k in keys], *order], parts)
    per = cut.groupBy("_slice", *keys).agg(*[F.sum(c).alias(f"_s{c}") for c in v])
    whole = Window.partitionBy(*keys)
    prior = whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    shift = per.select(
        "_slice",
        *keys,
        *[F.coalesce(F.sum(f"_s{c}").over(prior), F.lit(0)).alias(f"_b{c}") for c in v],
        *[F.sum(f"_s{c}").over(whole).alias(f"_t{c}") for c in v],
        F.count(F.lit(1)).over(whole).alias("_n_slices"),
    )
    shift = F.broadcast(shift.where("_n_slices > 1").drop("_n_slices"))
    part = Window.partitionBy("_slice", *keys)
    upto = part.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    # a wide output here only sorts within the slice it already sits in
    local = {f"_l{c}": F.sum(c).over(upto) for c in v}
    if totals:
        local |= {f"_a{c}": F.sum(c).over(part) for c in v}
    out = join_null_safe(cut.withColumns(local), shift, ["_slice", *keys], "left")
    zero = F.lit(0)
    final = {k: F.col(f"_l_v_{k}") + F.coalesce(F.col(f"_b_v_{k}"), zero) for k in sums}
    if totals:
        final |= {f"{k}_total": F.coalesce(F.col(f"_t_v_{k}"), F.col(f"_a_v_{k}")) for k in sums}
    return out.select(*[c for c in df.columns if c not in final], *[e.alias(k) for k, e in final.items()])


def row_numbers(
    df: DataFrame, keys: str | Sequence[str] | None, order: Sequence[Column], name: str, totals: str | None = None
) -> DataFrame:
    """row_number() from 1 within keys; ``totals`` names a column for the key's row count."""
    one = F.lit(1).cast("long")
    out = running(df, keys, order, {name: one}, totals=totals is not None)
    return out.withColumnRenamed(f"{name}_total", totals) if totals else out


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int) -> DataFrame | None:
    """Keys with more than hot_rows rows, or None. There are at most rows/hot_rows of them."""
    hot = df.groupBy(*keys).count().where(F.col("count") > hot_rows).select(*keys)
    hot = stage(hot)
    return None if hot.isEmpty() else hot


def near_rows(
    df: DataFrame,
    keys: str | Sequence[str],
    order: Sequence[Column],
    before: int,
    after: int,
    add: Callable[[DataFrame, Window], DataFrame],
    hot_rows: int | None = None,
    block: int | None = None,
) -> DataFrame:
    """Apply window columns whose frames reach at most before/after rows.

    Keys of ordinary size use a plain window. A hot key is numbered with
    ``running``, cut into blocks of rows, and each block also gets copies of the
    few neighbour rows its frames can reach; the copies are dropped afterwards.
    """
    keys = names(keys)
    hot_rows = HOT_ROWS if hot_rows is None else hot_rows
    hot = hot_keys(df, keys, hot_rows)
    if hot is None:
        return add(df, Window.partitionBy(*keys).orderBy(*order))
    cold = join_null_safe(df, hot, keys, "left_anti")
    size = max(block or hot_rows, before, after, 1)
    num = row_numbers(join_null_safe(df, hot, keys, "left_semi"), keys, order, "_rn")
    pos, home = (F.col("_rn") - 1) % size, F.floor((F.col("_rn") - 1) / size)
    none = F.lit(None).cast("long")
    num = num.withColumn("_home", home).withColumn(
        "_blk",
        F.explode(
            F.array_compact(
                F.array(
                    home,
                    F.when(pos >= size - before, home + 1).otherwise(none),
                    F.when((pos < after) & (home > 0), home - 1).otherwise(none),
                )
            )
        ),
    )
    w = Window.partitionBy(*keys, "_blk").orderBy("_rn")
    done = add(num, w).where("_blk = _home").drop("_blk", "_home", "_rn")
    return add(cold, Window.partitionBy(*keys).orderBy(*order)).unionByName(done)


def hash_of(seed: int | str, *cols: str) -> Column:
    """Repeatable pseudo-random text of a row's id, the same on every cluster."""
    return F.md5(F.concat_ws("-", F.lit(str(seed)), *[F.col(c).cast("string") for c in cols]))


def hash_unit(h: Column) -> Column:
    """First 32 bits of an md5 text as a number in [0, 1)."""
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def hash_unit_fine(h: Column) -> Column:
    """First 52 bits of an md5 text as a number in [0, 1)."""
    return F.conv(F.substring(h, 1, 13), 16, 10).cast("double") / F.lit(4503599627370496.0)


def hash_cuts(
    df: DataFrame,
    strata: str | Sequence[str] | None,
    h: Column,
    row_id: str,
    ranks: Callable[[Column], list[Column]],
    prefix: int = 4,
) -> DataFrame:
    """Per stratum, the (hash, id) found at wanted ranks of the hash order.

    One pass counts rows by stratum and leading hash digits; only the buckets
    that hold a wanted rank are then ordered. No payload row is moved. ``ranks``
    maps the stratum's row count to rank expressions; ranks < 1 give no cut.
    Output: strata, n, cuts (sorted array of struct(h, id)).
    """
    strata = names(strata)
    keyed = df.select(*strata, h.alias("_h"), F.col(row_id).alias("_id")).withColumn(
        "_b", F.substring("_h", 1, prefix)
    )
    by_stratum = Window.partitionBy(*strata)
    counts = keyed.groupBy(*strata, "_b").agg(F.count(F.lit(1)).alias("_c"))
    cum = counts.select(
        *strata,
        "_b",
        "_c",
        F.sum("_c").over(by_stratum.orderBy("_b")).alias("_hi"),
        F.sum("_c").over(by_stratum).alias("n"),
    )
    cum = stage(cum)
    want = cum.withColumn("_rank", F.explode(F.array(*[r.cast("long") for r in ranks(F.col("n"))]))).where(
        (F.col("_rank") > F.col("_hi") - F.col("_c")) & (F.col("_rank") <= F.col("_hi"))
    )
    want = want.select(*strata, "_b", (F.col("_rank") - F.col("_hi") + F.col("_c")).alias("_at"))
    want = stage(want.distinct())
    small = broadcast_if_small(want.select(*strata, "_b").distinct())
    few = join_null_safe(keyed, small, [*strata, "_b"], "left_semi")
    w = Window.partitionBy(*strata, "_b").orderBy("_h", "_id")
    few = few.withColumn("_at", F.row_number().over(w).cast("long"))
    found = join_null_safe(few, want, [*strata, "_b", "_at"], "left_semi")
    cuts = found.groupBy(*strata).agg(F.sort_array(F.collect_list(F.struct("_h", "_id"))).alias("cuts"))
    sizes = cum.groupBy(*strata).agg(F.max("n").alias("n"))
    # without strata both sides are one-row aggregates
    return stage(join_null_safe(sizes, cuts, strata, "left") if strata else sizes.crossJoin(F.broadcast(cuts)))


def cut_number(df: DataFrame, cuts: DataFrame, strata: Sequence[str] | None, h: Column, row_id: str, name: str) -> DataFrame:
    """Add the number of cuts strictly below each row (0 for the first piece), and n of its stratum."""
    strata = names(strata)
    small = broadcast_if_small(cuts)
    j = join_null_safe(df, small, strata, "left") if strata else df.crossJoin(F.broadcast(cuts))
    me = F.struct(h.alias("_h"), F.col(row_id).alias("_id"))
    below = F.size(F.filter(F.coalesce(F.col("cuts"), F.array().cast(cuts.schema["cuts"].dataType)), lambda c: c < me))
    return j.withColumn(name, below).drop("cuts")


def value_counts_running(df: DataFrame, keys: Sequence[str], value: str, weights: dict[str, Column], totals: bool = True) -> DataFrame:
    """Collapse to one row per (keys, value) first, then run over the distinct values.

    A value held by a third of all rows becomes one row before any shuffle by order.
    """
    g = df.groupBy(*keys, value).agg(*[F.sum(e).alias(k) for k, e in weights.items()])
    ran = {f"{k}_cum": F.col(k) for k in weights}
    return running(g, keys, [F.col(value)], ran, totals=totals)


ACCURACY = 10_000


def exact_quantiles(df: DataFrame, keys: str | Sequence[str] | None, value: str, probs: dict[str, float], count: str | None = None) -> DataFrame:
    """Linearly interpolated quantiles (the usual type 7) per key, exact at any size.

    ``count`` names a column that says how many rows a row stands for.

    Order statistics are selected, not sorted: a mergeable sketch brackets every
    wanted rank between two values, one pass counts what lies under each bracket
    and keeps the few rows inside, and only those are put in order. The sketch's
    error is bounded, and the counts show whether a bracket holds its ranks;
    if one should not, all distinct values are ordered instead. Rows that stand
    for many go that way too.
    """
    keys = names(keys)
    d = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    d = d.select(*keys, F.col(value).cast("double").alias("_x"), (F.col(count) if count else F.lit(1)).cast("long").alias("_w"))
    if count is None:
        out = _selected_quantiles(d, keys, probs)
        if out is not None:
            return out
    return _sorted_quantiles(d, keys, probs)


def _selected_quantiles(d: DataFrame, keys: list[str], probs: dict[str, float]) -> DataFrame | None:
    """exact_quantiles of (keys, _x) by brackets; None if a bracket misses a rank it should hold."""
    off = 3 / ACCURACY
    sides = [p for v in probs.values() for p in (max(v - off, 0.0), min(v + off, 1.0))]
    few = d.groupBy(*keys).agg(F.percentile_approx("_x", sides, ACCURACY).alias("_q"), F.count(F.lit(1)).alias("_n"))
    few = stage(few)
    met = join_null_safe(d, broadcast_if_small(few), keys, "inner") if keys else d.crossJoin(F.broadcast(few))
    # per wanted rank: 2i says the row lies under the bracket, 2i + 1 inside
    tags = []
    for i in range(len(probs)):
        lo, hi = F.get("_q", F.lit(2 * i)), F.get("_q", F.lit(2 * i + 1))
        tags.append(F.when(F.col("_x") < lo, F.lit(2 * i)).when(F.col("_x") <= hi, F.lit(2 * i + 1)))
    tagged = met.select(*keys, "_n", "_x", F.explode(F.array_compact(F.array(*tags))).alias("_t"))
    # rows under a bracket become one row, rows inside one per value
    inside = F.when(F.col("_t") % 2 == 1, F.col("_x"))
    got = stage(tagged.groupBy(*keys, "_n", (F.floor(F.col("_t") / 2)).cast("int").alias("_i"), inside.alias("_v")).agg(F.count(F.lit(1)).alias("_c")))
    order = [F.col("_v").asc_nulls_first()]
    if got.count() <= ONE_TASK_ROWS:
        upto = F.sum("_c").over(Window.partitionBy(*keys, "_i").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
        ran = got.withColumn("_hi", upto)
    else:
        ran = running(got, [*keys, "_i"], order, {"_hi": F.col("_c")})
    share = F.element_at(F.array(*[F.lit(float(p)) for p in probs.values()]), F.col("_i") + 1)
    at = (F.col("_n") - 1) * share
    k, lo = F.floor(at), F.col("_hi") - F.col("_c")
    nxt = F.least(k + 1, F.col("_n") - 1)
    pick = lambda r: F.max(F.when((lo <= r) & (r < F.col("_hi")), F.col("_v")))
    found = stage(ran.groupBy(*keys, "_i").agg(pick(k).alias("_a"), pick(nxt).alias("_b"), F.max(at - k).alias("_f")))
    state = found.agg(F.count_if(F.col("_a").isNull() | F.col("_b").isNull()).alias("bad"), F.count(F.lit(1)).alias("n")).first()
    if state["bad"] or state["n"] != few.count() * len(probs):
        return None
    value = F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_f")
    return found.groupBy(*keys).agg(*[F.max(F.when(F.col("_i") == i, value)).alias(out) for i, out in enumerate(probs)])


def _sorted_quantiles(d: DataFrame, keys: list[str], probs: dict[str, float]) -> DataFrame:
    """exact_quantiles of (keys, _x, _w) from running sums over the distinct values, spread by range."""
    r = value_counts_running(d, keys, "_x", {"_n": F.col("_w")})
    lo, hi, tot = F.col("_n_cum") - F.col("_n"), F.col("_n_cum"), F.col("_n_cum_total")
    aggs, outs = [], []
    for i, (out, p) in enumerate(probs.items()):
        pos = (tot - 1) * F.lit(float(p))
        k = F.floor(pos)
        nxt = F.least(k + 1, tot - 1)
        aggs += [
            F.max(F.when((lo <= k) & (k < hi), F.col("_x"))).alias(f"_a{i}"),
            F.max(F.when((lo <= nxt) & (nxt < hi), F.col("_x"))).alias(f"_b{i}"),
            F.max(pos - k).alias(f"_f{i}"),
        ]
        outs.append((F.col(f"_a{i}") + (F.col(f"_b{i}") - F.col(f"_a{i}")) * F.col(f"_f{i}")).alias(out))
    return r.groupBy(*keys).agg(*aggs).select(*keys, *outs)


def rank_cut(df: DataFrame, value: str, row_id: str, rank: int, descending: bool = False) -> DataFrame:
    """(_v, _id) of the row at ``rank`` (from 1) in the order of a number and, between equals, of the ascending id; one row, or none.

    Missing numbers come last. Only rows whose number lies in a bracket around
    the rank are put in order; the others are counted where they are.
    """
    x = F.col(value).cast("double")
    last = F.lit(float("inf"))
    v = F.coalesce(-x if descending else x, last)
    d = df.select(F.when(F.isnan(v), last).otherwise(v).alias("_v"), F.col(row_id).alias("_id"))
    n = d.count()
    if not 1 <= rank <= n:
        return d.limit(0)
    p, off = rank / n, 3 / ACCURACY + 1 / n
    lo, hi = d.agg(F.percentile_approx("_v", [max(p - off, 0.0), min(p + off, 1.0)], ACCURACY).alias("q")).first()["q"]
    under = d.where(F.col("_v") < lo).count()
    near = row_numbers(d.where((F.col("_v") >= lo) & (F.col("_v") <= hi)), None, [F.col("_v"), F.col("_id")], "_rn")
    out = stage(near.where(F.col("_rn") == rank - under).select("_v", "_id"))
    if out.isEmpty():
        out = stage(row_numbers(d, None, [F.col("_v"), F.col("_id")], "_rn").where(F.col("_rn") == rank).select("_v", "_id"))
    return out


def before_cut(df: DataFrame, cut: DataFrame, value: str, row_id: str, descending: bool = False, name: str = "_kept") -> DataFrame:
    """df with ``name``: whether a row stands at or before the row rank_cut found; false for all if there is none."""
    x, last = F.col(value).cast("double"), F.lit(float("inf"))
    v = F.coalesce(-x if descending else x, last)
    v = F.when(F.isnan(v), last).otherwise(v)
    one = cut.agg(F.max(F.struct("_v", "_id")).alias("_cut"))
    me = F.struct(v.alias("_v"), F.col(row_id).alias("_id"))
    return df.crossJoin(F.broadcast(one)).withColumn(name, F.coalesce(me <= F.col("_cut"), F.lit(False))).drop("_cut")
