"""Splits and folds as columns, decided by a hash of the row id.

The same rows land in the same part on every cluster and partitioning. Exact
sizes come from order statistics of the hash, so no row is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabkit.scale import broadcast_if_small, cut_number, exact_quantiles, hash_cuts, hash_of, hash_unit, hash_unit_fine, names, row_numbers
from tabkit.session import stage


def numeric_strata(df: DataFrame, col: str, name: str = "stratum", bins: int = 4) -> DataFrame:
    """Quantile bins of a numeric column, for stratifying by it."""
    q = exact_quantiles(df, None, col, {f"q{i}": i / bins for i in range(1, bins)})
    j = df.crossJoin(F.broadcast(q))
    b = F.lit(0)
    for i in range(1, bins):
        b = b + (F.col(col) > F.col(f"q{i}")).cast("int")
    return j.withColumn(name, b).drop(*[f"q{i}" for i in range(1, bins)])


def initial_split(df: DataFrame, row_id: str, prop: float = 0.75, strata=None, seed: int = 0, name: str = "is_train") -> DataFrame:
    """Mark floor(prop * n) rows of each stratum as training."""
    h = hash_of(seed, row_id)
    cuts = hash_cuts(df, strata, h, row_id, lambda n: [F.floor(n * F.lit(prop))])
    marked = cut_number(df, cuts, strata, h, row_id, "_piece")
    none = F.floor(F.col("n") * F.lit(prop)) < 1
    return marked.withColumn(name, (F.col("_piece") == 0) & ~none).select(*df.columns, name)


def vfold(df: DataFrame, row_id: str, v: int = 10, strata=None, seed: int = 0, name: str = "fold") -> DataFrame:
    """Folds 1..v, sizes within a stratum differing by at most one."""
    h = hash_of(seed, row_id)

    def ends(n: Column) -> list[Column]:
        q, r = F.floor(n / v), n % v
        return [q * i + F.least(r, F.lit(i)) for i in range(1, v)]

    cuts = hash_cuts(df, strata, h, row_id, ends)
    out = cut_number(df, cuts, strata, h, row_id, name)
    return out.withColumn(name, F.col(name) + 1).select(*[c for c in df.columns if c != name], name)


def group_vfold(df: DataFrame, group: str, v: int = 10, seed: int = 0, name: str = "fold") -> DataFrame:
    """Folds 1..v by hash of the group: a group never spans folds."""
    return df.withColumn(name, (F.floor(hash_unit(hash_of(seed, group)) * v) + 1).cast("int"))


def group_vfold_balanced(df: DataFrame, group: str, v: int = 10, seed: int = 0, name: str = "fold") -> DataFrame:
    """Folds of near-equal row counts: groups, largest first, are dealt out to folds 1..v and back, v..1.

    Ties go by hash. The groups are numbered by distributed running sums, so
    there may be any number of them. Rows without a group get no fold.
    """
    counts = df.where(F.col(group).isNotNull()).groupBy(group).agg(F.count(F.lit(1)).alias("_n"))
    dealt = row_numbers(counts, None, [F.desc("_n"), hash_of(seed, group), F.col(group)], "_rn")
    at, lap = F.pmod(F.col("_rn") - 1, F.lit(v)), F.floor((F.col("_rn") - 1) / v)
    fold = F.when(lap % 2 == 0, at + 1).otherwise(F.lit(v) - at).cast("int")
    return df.join(broadcast_if_small(dealt.select(group, fold.alias(name))), group, "left")


def poisson_weight(u: Column, most: int = 18) -> Column:
    """Poisson(1) count by inverting its distribution at u; 52-bit u cannot tell more than 18 apart."""
    from math import exp, factorial

    out, acc = F.lit(0), 0.0
    for k in range(most):
        acc += exp(-1.0) / factorial(k)
        out = out + (u >= F.lit(acc)).cast("int")
    return out


def bootstraps(df: DataFrame, row_id: str, times: int, seed: int = 0, keep_out_of_bag: bool = True, strata: str | Sequence[str] | None = None, exact: bool = False) -> DataFrame:
    """One row per (row, replicate) with its weight, the times it is drawn; weight 0 is out of bag.

    Weights are independent Poisson(1) counts, drawn without a shuffle. With
    ``strata``, or ``exact``, every replicate makes exactly as many draws in a
    stratum as it has rows (missing strata are one of their own): each row's
    place in a hash order makes a draw of another place, draws are counted and
    meet the rows by place.
    """
    replicates = F.explode(F.sequence(F.lit(1), F.lit(times)))
    if not exact and strata is None:
        d = df.withColumn("replicate", replicates)
        d = d.withColumn("weight", poisson_weight(hash_unit_fine(hash_of(seed, "replicate", row_id))))
        return d if keep_out_of_bag else d.where("weight > 0")
    keys = names(strata)
    key = F.to_json(F.array(*[F.col(k).cast("string") for k in keys])) if keys else F.lit("")
    placed = df.withColumns({"_s": key, "_h": hash_of(seed, row_id)})
    placed = stage(row_numbers(placed, "_s", [F.col("_h"), F.col(row_id)], "_at", totals="_n").drop("_h"))
    rows = placed.withColumn("replicate", replicates)
    u = hash_unit_fine(hash_of(seed, "replicate", "_s", "_at"))
    drawn = rows.select("replicate", "_s", (F.floor(u * F.col("_n")) + 1).alias("_at"))
    drawn = drawn.groupBy("replicate", "_s", "_at").agg(F.count(F.lit(1)).cast("int").alias("weight"))
    out = rows.join(drawn, ["replicate", "_s", "_at"], "left" if keep_out_of_bag else "inner")
    return out.select(*df.columns, "replicate", F.coalesce("weight", F.lit(0)).alias("weight"))


def split_by_ids(df: DataFrame, train_ids: DataFrame, key: str, name: str = "is_train") -> DataFrame:
    """Mark the rows whose key is in a table of ids."""
    t = train_ids.select(key).distinct().withColumn(name, F.lit(True))
    return df.join(t, key, "left").withColumn(name, F.coalesce(name, F.lit(False)))


def fold_ids(df: DataFrame, row_id: str, fold: str = "fold") -> DataFrame:
    """(fold, part, id): each row is assessed in its own fold and analysed in the others."""
    j = df.select(row_id, fold).crossJoin(broadcast_if_small(df.select(F.col(fold).alias("_f")).distinct()))
    return j.select(F.col("_f").alias("fold"), F.when(F.col(fold) == F.col("_f"), "assess").otherwise("analyse").alias("part"), row_id)


def downsample(df: DataFrame, label: str, row_id: str, seed: int = 0) -> DataFrame:
    """Every class cut to the size of the smallest, by hash order."""
    smallest = df.where(F.col(label).isNotNull()).groupBy(label).count().agg(F.min("count")).first()[0]
    h = hash_of(seed, row_id)
    cuts = hash_cuts(df, label, h, row_id, lambda n: [F.least(n, F.lit(smallest))])
    return cut_number(df, cuts, [label], h, row_id, "_piece").where("_piece = 0").select(*df.columns)


def upsample(df: DataFrame, label: str, row_id: str, seed: int = 0) -> DataFrame:
    """Every class raised to the size of the largest: whole copies, then a hash-ordered rest."""
    largest = df.groupBy(label).count().agg(F.max("count")).first()[0]
    h = hash_of(seed, row_id)
    cuts = hash_cuts(df, label, h, row_id, lambda n: [F.lit(largest) % n])
    d = cut_number(df, cuts, [label], h, row_id, "_piece")
    n = F.col("n")
    extra = F.when((F.lit(largest) % n > 0) & (F.col("_piece") == 0), 1).otherwise(0)
    copies = F.floor(F.lit(largest) / n) + extra
    # in two steps, so that no row holds a long list of its copies
    block = 10_000
    d = d.withColumn("_copies", copies).withColumn("_b", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_copies") - 1) / block))))
    if largest and largest > block:
        d = d.repartition(F.col(row_id), F.col("_b"))
    last = F.least(F.col("_copies"), (F.col("_b") + 1) * block)
    return d.withColumn("copy", F.explode(F.sequence(F.col("_b") * block + 1, last))).select(*df.columns, "copy")
