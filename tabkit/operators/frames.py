"""Column and row verbs with fixed missing-value and tie rules."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabkit.scale import before_cut, broadcast_if_small, hash_cuts, hash_of, hash_unit, join_null_safe, names, rank_cut, row_numbers

# ---- choosing columns -------------------------------------------------------


def matching(df: DataFrame, pattern: str, keep: bool = True) -> list[str]:
    """Names that contain the pattern (case ignored), or those that do not."""
    return [c for c in df.columns if bool(re.search(pattern, c, re.I)) == keep]


def select_matching(df: DataFrame, pattern: str, keep: bool = True) -> DataFrame:
    return df.select(*matching(df, pattern, keep))


def typed(df: DataFrame, kind: str) -> list[str]:
    """Names of numeric, string, boolean or temporal columns."""
    kinds = {
        "numeric": T.NumericType,
        "string": T.StringType,
        "boolean": T.BooleanType,
        "temporal": (T.DateType, T.TimestampType, T.TimestampNTZType),
    }
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds[kind])]


def select_typed(df: DataFrame, kind: str) -> DataFrame:
    return df.select(*typed(df, kind))


def any_of(df: DataFrame, cols: Iterable[str]) -> list[str]:
    """The listed names that exist, in listed order."""
    have = set(df.columns)
    return [c for c in cols if c in have]


def all_of(df: DataFrame, cols: Sequence[str]) -> list[str]:
    """The listed names; a name that does not exist is an error."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {missing}")
    return list(cols)


def relocate(df: DataFrame, *first: str) -> DataFrame:
    return df.select(*first, *[c for c in df.columns if c not in first])


def snake_case(name: str) -> str:
    s = re.sub(r"[^0-9A-Za-z]+", "_", name)
    s = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", s)
    return re.sub(r"_+", "_", s).strip("_").lower()


def clean_names(df: DataFrame) -> DataFrame:
    """Snake-case every name; repeats get _2, _3, ..."""
    out, seen = [], {}
    for c in df.columns:
        s = snake_case(c) or "x"
        seen[s] = seen.get(s, 0) + 1
        out.append(s if seen[s] == 1 else f"{s}_{seen[s]}")
    return df.toDF(*out)


def rename_with(df: DataFrame, fn: Callable[[str], str], cols: Sequence[str] | None = None) -> DataFrame:
    chosen = set(df.columns if cols is None else cols)
    return df.withColumnsRenamed({c: fn(c) for c in df.columns if c in chosen})


def across(
    df: DataFrame,
    cols: Sequence[str],
    fns: dict[str, Callable[[Column], Column]] | Callable[[Column], Column],
    pattern: str = "{col}_{fn}",
) -> DataFrame:
    """Apply one function in place, or several under a name pattern."""
    if callable(fns):
        return df.withColumns({c: fns(F.col(c)) for c in cols})
    return df.withColumns({pattern.format(col=c, fn=n): f(F.col(c)) for c in cols for n, f in fns.items()})


# ---- choosing rows ----------------------------------------------------------


def is_missing(df: DataFrame, c: str) -> Column:
    """NULL, or NaN in a floating column."""
    t = df.schema[c].dataType
    null = F.col(c).isNull()
    return null | F.isnan(c) if isinstance(t, (T.DoubleType, T.FloatType)) else null


def _any_missing(df: DataFrame, cols: Sequence[str] | None) -> Column:
    cond = F.lit(False)
    for c in cols or df.columns:
        cond = cond | is_missing(df, c)
    return cond


def drop_missing(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return df.where(~_any_missing(df, cols))


def incomplete_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return df.where(_any_missing(df, cols))


def where_in(df: DataFrame, col: str, values) -> DataFrame:
    """Membership in literals or in a one-column table."""
    if not isinstance(values, DataFrame):
        return df.where(F.col(col).isin(list(values)))
    return df.join(values.toDF(col), col, "left_semi")


def where_not_in(df: DataFrame, col: str, values) -> DataFrame:
    """Rows whose value is not a member; a missing value is no member, so it stays."""
    if not isinstance(values, DataFrame):
        return df.where(~F.coalesce(F.col(col).isin(list(values)), F.lit(False)))
    return df.join(values.toDF(col), col, "left_anti")


def first_per_key(df: DataFrame, keys: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row per key in the given order.

    A minimum over structs combines on the map side, so a hot key costs one row
    per task. ``order`` columns sort ascending; all others break ties.
    """
    keys = names(keys)
    rest = [c for c in df.columns if c not in keys and c not in order]
    body = F.struct(*[F.col(c) for c in [*order, *rest]])
    return df.groupBy(*keys).agg(F.min(body).alias("_m")).select(*[c if c in keys else F.col(f"_m.`{c}`").alias(c) for c in df.columns])


def row_index(df: DataFrame, order: Sequence[Column], name: str = "idx") -> DataFrame:
    """1-based position in a total order, numbered slice by slice."""
    return row_numbers(df, None, order, name)


def sample_fraction(df: DataFrame, row_id: str, fraction: float, seed: int = 0) -> DataFrame:
    """Rows whose hashed id falls under the fraction; the same rows on every run."""
    return df.where(hash_unit(hash_of(seed, row_id)) < F.lit(fraction))


def sample_n(df: DataFrame, row_id: str, n: int, seed: int = 0) -> DataFrame:
    """Exactly n rows (or all, if fewer), chosen by hash order.

    A short sample is a top-k over tasks; a long one finds the hash at rank n.
    """
    h = hash_of(seed, row_id)
    if n <= 10_000:
        return df.orderBy(h, row_id).limit(n)
    cuts = hash_cuts(df, None, h, row_id, lambda total: [F.least(total, F.lit(n))])
    cut = cuts.select(F.col("cuts")[0].alias("_cut"))
    return df.crossJoin(F.broadcast(cut)).where(F.struct(h.alias("_h"), F.col(row_id).alias("_id")) <= F.col("_cut")).drop("_cut")


def top_fraction(df: DataFrame, order: Sequence[Column] | Sequence[str], fraction: float) -> DataFrame:
    """The first floor(fraction * rows) rows of a total order.

    An order of names, a number ('-x' descends, missing last) and a unique id,
    finds the one row to cut at and moves no other; an order of columns may be
    anything and numbers all rows.
    """
    if all(isinstance(o, str) for o in order):
        (value, row_id), rows = order, df.count()
        down, value = value.startswith("-"), value.removeprefix("-")
        # the same product as a column would give
        cut = rank_cut(df, value, row_id, int(rows * fraction), down)
        return before_cut(df, cut, value, row_id, down).where("_kept").drop("_kept")
    num = row_numbers(df, None, order, "_rn", totals="_n")
    return num.where(F.col("_rn") <= F.floor(F.col("_n") * F.lit(fraction))).drop("_rn", "_n")


def slice_rows(df: DataFrame, order: Sequence[Column], start: int, stop: int) -> DataFrame:
    """Rows start..stop (1-based, inclusive) of a total order."""
    return df.orderBy(*order).offset(start - 1).limit(stop - start + 1)


def arrange(df: DataFrame, *order: str) -> DataFrame:
    """Sort; '-x' descends. Missing values go last either way."""
    return df.orderBy(*[F.col(o[1:]).desc_nulls_last() if o.startswith("-") else F.col(o).asc_nulls_last() for o in order])


# ---- combining --------------------------------------------------------------


def add_rows(df: DataFrame, rows: Sequence[dict]) -> DataFrame:
    """Append literal rows; columns a row does not name become NULL."""
    data = [tuple(r.get(c) for c in df.columns) for r in rows]
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields])
    return df.unionByName(df.sparkSession.createDataFrame(data, schema))


def bind_rows(frames: dict[str, DataFrame] | Sequence[DataFrame], tag: str | None = None) -> DataFrame:
    """Union by name, missing columns NULL, optionally with the source's name."""
    items = frames.items() if isinstance(frames, dict) else enumerate(frames)
    out = None
    for k, f in items:
        f = f.withColumn(tag, F.lit(str(k))) if tag else f
        out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    return out


def bind_cols(df: DataFrame, other: DataFrame, row_id: str | Sequence[str]) -> DataFrame:
    """Column bind on a carried row id (rows have no position here)."""
    return df.join(other, names(row_id), "inner")


def scalar_column(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a table proven to hold one row."""
    if one_row.limit(2).count() != 1:
        raise ValueError("expected exactly one row")
    return df.crossJoin(F.broadcast(one_row))


def fill_missing(df: DataFrame, col: str, value) -> DataFrame:
    """Fill with a constant, or with the column's mean when value is 'mean'."""
    if value != "mean":
        return df.withColumn(col, F.when(is_missing(df, col), F.lit(value)).otherwise(F.col(col)))
    mean = df.agg(F.avg(F.when(~is_missing(df, col), F.col(col))).alias("_mean"))
    j = df.crossJoin(F.broadcast(mean))
    return j.withColumn(col, F.when(is_missing(df, col), F.col("_mean")).otherwise(F.col(col))).drop("_mean")


def standardise(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(x - mean) / sample sd, statistics from one pass over one-row aggregates."""
    stats = df.agg(
        *[F.avg(c).alias(f"_m_{c}") for c in cols], *[F.stddev_samp(c).alias(f"_s_{c}") for c in cols]
    )
    j = df.crossJoin(F.broadcast(stats))
    return j.withColumns({c: F.try_divide(F.col(c) - F.col(f"_m_{c}"), F.col(f"_s_{c}")) for c in cols}).select(*df.columns)
