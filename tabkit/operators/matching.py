"""Fuzzy join on one text column."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabkit.functions import text_distance as td
from tabkit.session import stage

# Scores up to which a round settles names; names still open go to the next.
ROUNDS = (0.6, 1.5)


def default_score(d: dict[str, Column]) -> Column:
    return (d["cosine"] + d["jaccard"] + d["jw"]) * (d["soundex"] + 1)


def _score(pairs: DataFrame, f_score: Callable[[dict[str, Column]], Column], at_most: float | None) -> DataFrame:
    x, y = F.col("name_x"), F.col("name_y")
    # few bytes but much work per row, so spread them whatever their size
    n = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    p = pairs.repartition(n).withColumns({"jaccard": td.jaccard(x, y), "soundex": td.soundex(x, y)})
    if at_most is not None:
        # drop what cannot score low enough before the costlier distances
        zero = {"cosine": F.lit(0.0), "jw": F.lit(0.0)}
        p = p.where(f_score(zero | {c: F.col(c) for c in ("jaccard", "soundex")}) <= at_most)
    p = p.withColumn("_d", td.cosine_and_jaro(x, y)).select("name_x", "name_y", "_d.cosine", "jaccard", "_d.jw", "soundex")
    return p.withColumn("score", f_score({c: F.col(c) for c in ("cosine", "jaccard", "jw", "soundex")}))


def _sets(n: DataFrame, rarity: DataFrame, side: str) -> DataFrame:
    """Distinct character sets as arrays of codes, rarest character first."""
    ch = n.select("set", F.explode(F.split("set", "")).alias("ch")).where("ch <> ''").distinct()
    ranked = ch.join(rarity, "ch").groupBy("set").agg(F.sort_array(F.collect_list("code")).alias("codes"))
    return ranked.select(F.col("set").alias(f"set_{side}"), F.col("codes").alias(f"codes_{side}"))


def _alike(xs: DataFrame, ys: DataFrame, theta: float, also: list[str]) -> DataFrame:
    """All pairs with character-set jaccard >= theta and equal ``also`` columns.

    theta 0 means any shared character. Sets alike enough must share one of their
    rarest characters: with the sets sorted by rarity, one within the first
    size - ceil(theta * size) + 1. Pairs meet on such characters, restricted by
    size, and each pair is kept at its first meeting point only.
    """

    def pre(c):
        n = F.size(c)
        return F.slice(c, 1, F.greatest((n - F.ceil(F.lit(theta) * n) + 1).cast("int"), F.lit(1)))

    a = xs.withColumn("pre_x", pre(F.col("codes_x"))).withColumn("code", F.explode("pre_x"))
    b = ys.withColumn("pre_y", pre(F.col("codes_y"))).withColumn("code", F.explode("pre_y"))
    nx, ny = F.size("codes_x"), F.size("codes_y")
    j = a.join(b, ["code", *also]).where((nx >= F.lit(theta) * ny) & (ny >= F.lit(theta) * nx))
    j = j.where(F.col("code") == F.array_min(F.array_intersect("pre_x", "pre_y")))
    shared = F.size(F.array_intersect("codes_x", "codes_y"))
    return j.where(shared >= F.lit(theta) * (nx + ny - shared))


def join_fuzzily(
    x: DataFrame,
    y: DataFrame,
    col: str = "name",
    f_score: Callable[[dict[str, Column]], Column] = default_score,
    strict: bool = True,
    exact: bool = False,
    soundex_doubles: bool = True,
    max_score: float | None = None,
) -> DataFrame:
    """Best partners among the names that have no exact match.

    For every leftover right name the left name with the lowest score, ties by
    name; ``strict`` then keeps the best right name per left name. ``exact``
    also returns exact matches, with score 0.

    The answer equals scoring all pairs. A score must grow with each distance and
    be at least the jaccard distance, at least twice that when the soundex codes
    differ and ``soundex_doubles`` is set. So in a round that settles scores up
    to s, only pairs with a jaccard similarity of at least 1 - s/2 (1 - s for
    equal soundex) can take part. Right names still open after the last round
    are compared with every left name sharing a character; ``max_score`` leaves
    them without a partner instead, which is the setting for large tables.
    """
    xs = x.select(F.col(col).alias("name_x")).where("name_x is not null").distinct()
    ys = y.select(F.col(col).alias("name_y")).where("name_y is not null").distinct()

    def key(c):
        return F.array_join(F.array_sort(F.array_distinct(F.split(c, ""))), "")

    left = stage(xs.join(ys, xs.name_x == ys.name_y, "left_anti").withColumn("set", key("name_x")))
    open_ = stage(ys.join(xs, xs.name_x == ys.name_y, "left_anti").withColumn("set", key("name_y")))

    all_sets = left.select("set").unionAll(open_.select("set")).distinct()
    freq = all_sets.select(F.explode(F.split("set", "")).alias("ch")).where("ch <> ''").groupBy("ch").count()
    # one row per character of the alphabet in use
    rarity = stage(freq.withColumn("code", F.row_number().over(Window.orderBy("count", "ch"))).select("ch", "code"))
    lsets = stage(_sets(left, rarity, "x"))
    lnames = left.withColumnRenamed("set", "set_x")
    best_of = Window.partitionBy("name_y").orderBy("score", "name_x")
    done = []
    limits = [s for s in ROUNDS if max_score is None or s < max_score] + [max_score]
    for limit in limits:
        rsets = _sets(open_, rarity, "y")
        rnames = open_.withColumnRenamed("set", "set_y")

        def alike(theta, lefts=lnames, rights=rnames, sets=rsets):
            near = _alike(lsets, sets, theta, []).select("set_x", "set_y")
            return near.join(lefts, "set_x").join(rights, "set_y").select("name_x", "name_y")

        reach = 2.0 if soundex_doubles else 1.0
        pairs = alike(0.0 if limit is None else max(1 - limit / reach, 0.0))
        if soundex_doubles and limit is not None:
            sx = lnames.join(lsets, "set_x").withColumn("sx", F.soundex("name_x"))
            sy = rnames.join(rsets, "set_y").withColumn("sx", F.soundex("name_y"))
            same = _alike(sx, sy, max(1 - limit, 0.0), ["sx"]).select("name_x", "name_y")
            pairs = pairs.unionAll(same).distinct()
        if limit is None:
            # without shared characters every left name of a soundex class scores
            # the same, so the first of each class stands for all
            firsts = left.groupBy(F.soundex("name_x").alias("sx")).agg(F.min("name_x").alias("name_x"))
            lone = open_.withColumn("sx", F.soundex("name_y")).join(firsts, "sx").select("name_x", "name_y")
            first = left.agg(F.min("name_x").alias("name_x")).where("name_x is not null")
            lone = lone.unionAll(open_.crossJoin(F.broadcast(first)).select("name_x", "name_y"))
            pairs = pairs.unionAll(lone).distinct()
        top = _score(pairs, f_score, limit).withColumn("rk", F.row_number().over(best_of)).where("rk = 1").drop("rk")
        if limit is not None:
            top = top.where(F.col("score") <= limit)
        top = stage(top)
        done.append(top)
        open_ = stage(open_.join(top.select("name_y"), "name_y", "left_anti"))
        if open_.isEmpty():
            break
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    if strict:
        per_left = Window.partitionBy("name_x").orderBy("score", "name_y")
        out = out.withColumn("rk", F.row_number().over(per_left)).where("rk = 1").drop("rk")
    if exact:
        both = xs.join(ys, xs.name_x == ys.name_y).select("name_x", "name_y")
        zero = {c: F.lit(0.0) for c in ("cosine", "jaccard", "jw", "soundex", "score")}
        out = out.unionByName(both.withColumns(zero))
    return out
