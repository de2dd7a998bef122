"""Level tables: the learned values of a categorical column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabkit.scale import exact_quantiles, join_null_safe, running


def level_table(df: DataFrame, col: str, by: str | None = None) -> DataFrame:
    """(level, code) from 1: alphabetical, or by the median of another column."""
    if by is None:
        lv = df.select(F.col(col).alias("level")).where("level is not null").distinct()
        order = [F.col("level")]
    else:
        q = exact_quantiles(df.where(F.col(col).isNotNull()), col, by, {"_m": 0.5})
        lv = q.select(F.col(col).alias("level"), "_m")
        order = [F.col("_m"), F.col("level")]
    return running(lv, None, order, {"code": F.lit(1).cast("long")}).select("level", "code")


def rank_table(df: DataFrame, col: str) -> DataFrame:
    """(level, code): 1 for the commonest level, ties by name."""
    n = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("level")).agg(F.count(F.lit(1)).alias("n"))
    return running(n, None, [F.desc("n"), F.col("level")], {"code": F.lit(1).cast("long")}).select("level", "code")


def with_codes(df: DataFrame, col: str, levels: DataFrame, name: str) -> DataFrame:
    """Attach codes; a level not in the table gives NULL. The table may be of any size."""
    t = levels.select(F.col("level").alias(col), F.col("code").alias(name))
    return join_null_safe(df, t, [col], "left")


def collect_levels(df: DataFrame, col: str) -> list[str]:
    """Sorted levels on the driver, for things that become columns or classes of a model."""
    rows = df.select(F.col(col).cast("string").alias("v")).where("v is not null").distinct().collect()
    return sorted(r["v"] for r in rows)
