"""Connected components of a graph of links, with joins and minima only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabkit.llm.batches import broadcast_below
from tabkit.session import stage


def _stars(e: DataFrame) -> DataFrame:
    """One large-star and one small-star step on (lo, hi) links, lo < hi.

    Neighbours meet the smallest node in their reach. A hub with many links is
    only ever summed (a minimum per node, partial sums first) and joined; both
    join sides are stored tables, so a hot hub is split by adaptive execution,
    or the minima are broadcast after their size was checked.
    """
    both = e.unionByName(e.select(F.col("hi").alias("lo"), F.col("lo").alias("hi")))
    low = both.groupBy("lo").agg(F.min("hi").alias("m"), F.max("hi").alias("x"))
    low = stage(low.where("x > lo").select("lo", F.least("lo", "m").alias("m")).where("m < lo"))
    large = e.join(broadcast_below(low), "lo", "left")
    large = stage(large.select(F.coalesce("m", "lo").alias("lo"), "hi"))
    multi = large.groupBy("hi").agg(F.min("lo").alias("m"), F.max("lo").alias("x")).where("m < x").select("hi", "m")
    multi = stage(multi)
    small = large.join(broadcast_below(multi), "hi", "left")
    near = small.select(F.coalesce("m", "lo").alias("lo"), "hi")
    over = small.where("m is not null and lo <> m").select(F.col("m").alias("lo"), F.col("lo").alias("hi"))
    return stage(near.unionByName(over).distinct())


def _mark(e: DataFrame) -> tuple:
    low = F.xxhash64("lo", "hi").bitwiseAND(F.lit(0x7FFFFFFF))
    return tuple(e.agg(F.count(F.lit(1)), F.sum(low), F.sum(F.hash("hi", "lo").cast("long"))).first())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of a link; component is the smallest node reachable.

    Alternating large-star and small-star steps until the links no longer
    change: then every link points straight at its component's smallest node.
    Each step is written to the shared folder, so no lineage grows. Links with
    a null end and loops are ignored.
    """
    e = edges.select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi"), F.col(a).isNotNull().alias("p"), F.col(b).isNotNull().alias("q"))
    e = stage(e.where("p and q and lo < hi").select("lo", "hi"))
    mark = (-1,)
    while mark[0]:
        e = _stars(e)
        now = _mark(e)
        if now == mark:
            break
        mark = now
    return stage(
        e.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(e.select(F.col("lo").alias("node"), F.col("lo").alias("component"))).distinct()
    )
