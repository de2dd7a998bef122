"""Wide/long reshaping and multi-valued keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabkit.operators.frames import is_missing


def pivot_longer(df: DataFrame, ids: Sequence[str], cols: Sequence[str], name: str = "name", value: str = "value", cast: str | None = None, drop_na: bool = False) -> DataFrame:
    vals = [F.col(c).cast(cast).alias(c) if cast else F.col(c) for c in cols]
    out = df.select(*ids, *vals).unpivot(list(ids), list(cols), name, value)
    return out.where(~is_missing(out, value)) if drop_na else out


def pivot_wider(
    df: DataFrame,
    ids: Sequence[str],
    name: str,
    levels: Sequence,
    values: Sequence[str],
    glue: str = "{value}_{level}",
    fill: dict[str, object] | None = None,
) -> DataFrame:
    """Long to wide over declared levels, so no pass is spent on finding them."""
    aggs = [
        F.first(F.when(F.col(name) == F.lit(lv), F.col(v)), ignorenulls=True).alias(glue.format(value=v, level=lv))
        for lv in levels
        for v in values
    ]
    out = df.groupBy(*ids).agg(*aggs)
    for v, x in (fill or {}).items():
        out = out.fillna(x, subset=[glue.format(value=v, level=lv) for lv in levels])
    return out


def split_to_rows(df: DataFrame, col: str, pattern: str, value: str, pos: str | None = None) -> DataFrame:
    """One row per part of delimited text, with its 1-based position."""
    parts = F.split(F.col(col), pattern)
    out = df.select("*", F.posexplode(parts).alias("_p", value))
    return out.withColumn(pos, F.col("_p") + 1).drop("_p") if pos else out.drop("_p")


def separate(df: DataFrame, col: str, pattern: str, prefix: str, width: int | None = None) -> DataFrame:
    """Delimited text into numbered columns, filled right with NULL.

    Without ``width`` one pass finds the longest list. The columns are the
    schema, so a width the data can grow without bound belongs in
    ``split_to_rows``.
    """
    parts = F.split(F.col(col), pattern)
    if width is None:
        width = df.agg(F.max(F.size(parts))).first()[0] or 0
    arr = df.withColumn("_parts", parts)
    return arr.withColumns({f"{prefix}_{i + 1:02d}": F.get("_parts", F.lit(i)) for i in range(width)}).drop("_parts")


def roll_up_keys(
    df: DataFrame,
    row_id: str,
    list_col: str,
    pattern: str,
    lookup: DataFrame,
    lookup_key: str,
    measure: str,
    default: float,
    count_name: str = "n_items",
) -> DataFrame:
    """Expand a multi-valued key, look each value up, roll back to one row per id.

    Adds the number of values and the sum, median and maximum of the looked-up
    measure, ``default`` where a value is unknown.
    """
    long = split_to_rows(df.select(row_id, list_col), list_col, pattern, "_key").select(row_id, "_key")
    look = lookup.select(F.col(lookup_key).alias("_key"), F.col(measure).alias("_m"))
    m = F.coalesce(F.col("_m"), F.lit(default))
    agg = (
        long.join(look, "_key", "left")
        .groupBy(row_id)
        .agg(
            F.count(F.lit(1)).alias(count_name),
            F.sum(m).alias(f"{measure}_sum"),
            F.median(m).alias(f"{measure}_med"),
            F.max(m).alias(f"{measure}_max"),
        )
    )
    return df.join(agg, row_id, "left")


def clean_list_text(c: Column) -> Column:
    """Python-style list text ['a', 'b'] to a, b."""
    return F.regexp_replace(F.regexp_replace(c, r"\['|'\]", ""), r"',\s'", ", ")


def nest(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "data") -> DataFrame:
    """Rows of a group as an array of structs sorted by ``order``.

    The array is a value of one row, so this is for groups of bounded size
    (lines of an order); work on unbounded groups stays in rows.
    """
    rest = [c for c in df.columns if c not in keys]
    body = F.struct(*order, *[c for c in rest if c not in order])
    return df.groupBy(*keys).agg(F.sort_array(F.collect_list(body)).alias(name))


def unnest(df: DataFrame, name: str = "data") -> DataFrame:
    return df.select(*[c for c in df.columns if c != name], F.inline(name))
