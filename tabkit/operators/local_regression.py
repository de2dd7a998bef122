"""Local regression and seasonal-trend decomposition over evenly spaced series."""

from __future__ import annotations

from collections.abc import Callable
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabkit.scale import exact_quantiles, join_null_safe, names, row_numbers
from tabkit.session import stage

# Places of a series that one task works on.
BLOCK = 65_536


def _next_odd(x: float) -> int:
    n = ceil(x)
    return n if n % 2 else n + 1


def _line_at(near: Column, at: Column, left: Column, right: Column, wide: Column, n: Column) -> Column:
    """Tricube-weighted line through the points at places left to right, read at ``at``; NULL where nothing has weight.

    ``near`` is an array of (p, y, w), ``wide`` what a window longer than the
    series adds to the kernel's reach.
    """
    reach = (F.greatest(at - left, right - at) + wide).cast("double")
    used = F.filter(near, lambda v: (v["p"] >= left) & (v["p"] <= right) & (v["w"] > 0))
    far = F.transform(used, lambda v: F.struct((F.abs(v["p"] - at) / reach).alias("u"), (v["p"] - at).cast("double").alias("d"), v["w"].alias("w"), v["y"].alias("y")))
    kernel = lambda u: F.when(u <= 0.001, 1.0).when(u <= 0.999, F.pow(1 - u * u * u, F.lit(3))).otherwise(0.0)
    points = F.transform(far, lambda v: F.struct((kernel(v["u"]) * v["w"]).alias("w"), v["d"].alias("d"), v["y"].alias("y")))

    def add(s, v):
        w, wd = v["w"], v["w"] * v["d"]
        return F.struct(
            (s["w"] + w).alias("w"), (s["d"] + wd).alias("d"), (s["dd"] + wd * v["d"]).alias("dd"), (s["y"] + w * v["y"]).alias("y"), (s["dy"] + wd * v["y"]).alias("dy")
        )

    def line(s):
        mean_d, mean_y = s["d"] / s["w"], s["y"] / s["w"]
        spread = s["dd"] / s["w"] - mean_d * mean_d
        slope = (s["dy"] / s["w"] - mean_d * mean_y) / spread
        flat = spread <= F.pow(0.001 * (n - 1), F.lit(2))
        return F.when(s["w"] > 0, F.when(flat, mean_y).otherwise(mean_y - mean_d * slope))

    zero = F.struct(*[F.lit(0.0).alias(c) for c in ("w", "d", "dd", "y", "dy")])
    return F.aggregate(points, zero, add, line)


def _in_blocks(df: DataFrame, keys: list[str], pos: str, reach: int, add: Callable[[DataFrame, Window], DataFrame], block: int) -> DataFrame:
    """Apply window columns whose frames reach at most ``reach`` places, in blocks of places.

    Each block also gets copies of the rows its frames can reach; they are
    dropped afterwards. As the places are dense numbers, blocks need no count
    of the keys.
    """
    size = max(block, reach)
    home, at, none = F.floor(F.col(pos) / size), F.pmod(F.col(pos), F.lit(size)), F.lit(None).cast("long")
    near = F.array(home, F.when(at >= size - reach, home + 1).otherwise(none), F.when(at < reach, home - 1).otherwise(none))
    d = df.withColumn("_home", home).withColumn("_blk", F.explode(F.array_compact(near)))
    return add(d, Window.partitionBy(*keys, "_blk").orderBy(pos)).where("_blk = _home").drop("_blk", "_home")


def _fit(df: DataFrame, keys: list[str], y: str, window: int, name: str, block: int, weight: str | None = None, pos: str = "_p", n: str = "_n", ends: str | None = None) -> DataFrame:
    """Adds ``name``, the local line at each row; ``ends`` adds an array of (place, value) with one place more at both ends."""
    there, here = F.col(y).isNotNull(), F.col(pos)
    point = F.struct(here.alias("p"), F.col(y).alias("y"), F.when(there, F.col(weight) if weight else F.lit(1.0)).otherwise(0.0).alias("w"))
    # the window nearest rows, and what is missing to a window in a shorter series
    left = F.greatest(F.lit(0), F.least(here - (window - 1) // 2, F.col(n) - window))
    df = df.withColumn("_left", left).withColumn("_right", F.least(F.col(n) - 1, F.col("_left") + window - 1))
    df = df.withColumn("_wide", F.greatest(F.lit(0), F.floor((F.lit(window) - F.col(n)) / 2)))

    def add(d, w):
        # a row at an end of the series uses points up to window - 1 rows away
        d = d.withColumn("_near", F.collect_list(point).over(w.rowsBetween(1 - window, window - 1)))
        at = lambda place: _line_at(F.col("_near"), place, F.col("_left"), F.col("_right"), F.col("_wide"), F.col(n))
        # without any weight around it a row keeps its own value
        d = d.withColumn(name, F.coalesce(at(here), F.col(y)))
        if ends is not None:
            out = lambda place: F.struct(place.alias("place"), F.coalesce(at(place), F.col(name)).alias("value"))
            none = F.lit(None).cast("struct<place:bigint,value:double>")
            both = F.array(F.struct(here.alias("place"), F.col(name).alias("value")), F.when(here == 0, out(here - 1)).otherwise(none), F.when(here == F.col(n) - 1, out(here + 1)).otherwise(none))
            d = d.withColumn(ends, F.array_compact(both))
        return d.drop("_near", "_left", "_right", "_wide")

    return _in_blocks(df, keys, pos, window - 1, add, block)


def _numbered(df: DataFrame, keys: list[str], time: str, x: str) -> DataFrame:
    d = df.withColumn("_y", F.when(~F.isnan(F.col(x).cast("double")), F.col(x).cast("double")))
    return row_numbers(d, keys, [F.col(time)], "_p", totals="_n").withColumn("_p", F.col("_p") - 1)


def _odd(window: int, what: str) -> int:
    if window < 3 or window % 2 == 0:
        raise ValueError(f"{what} must be odd and at least 3, not {window}")
    return window


def local_line(df: DataFrame, keys, time: str, x: str, window: int, name: str = "fit", block: int = BLOCK) -> DataFrame:
    """Locally weighted linear smoothing per key over the ``window`` nearest rows (odd), tricube weights.

    Rows count as evenly spaced in the order of ``time``. Missing values have no
    weight but get a fit. Long series are cut into blocks with copies of the
    rows a window reaches, so no task holds a whole series.
    """
    keys, cols = names(keys), df.columns
    d = stage(_numbered(df, keys, time, x))
    return _fit(d, keys, "_y", _odd(window, "window"), name, block).select(*cols, name)


def decompose_locally(
    df: DataFrame,
    keys,
    time: str,
    x: str,
    period: int,
    season_window: int | None = 13,
    trend_window: int | None = None,
    inner: int = 2,
    outer: int = 0,
    block: int = BLOCK,
) -> DataFrame:
    """Trend, season and remainder by local regression (STL of Cleveland et al., 1990), without interpolation jumps.

    Season: a local line through the values of each place in the period, over
    ``season_window`` periods (None: their mean), less its own low-pass. Trend: a
    local line through the values without season. Both are repeated ``inner``
    times; each of ``outer`` rounds then weighs rows down by their remainder
    (bisquare of 6 medians) and repeats that. A row without any weight around it
    keeps its own value. Weighted sums in sliding frames, so
    a long series is worked on in blocks.

    Rows must be evenly spaced per key, at least two periods of them: shorter
    series have null components. Missing values weigh nothing and have no
    remainder; a place in the period without any value has no season.
    """
    if period < 2:
        raise ValueError("period must be at least 2")
    keys, cols = names(keys), df.columns
    if season_window is not None:
        _odd(season_window, "season_window")
    # the usual defaults: a trend window that season_window leaves smooth, the low-pass over one period
    shrink = 1 - 1.5 / season_window if season_window else 1.0
    trend_window = _odd(trend_window or max(3, _next_odd(1.5 * period / shrink)), "trend_window")
    low_window = _next_odd(period) if period > 2 else 3

    place, turn = F.col("_p") % period, F.floor(F.col("_p") / period)
    every = stage(_numbered(df, keys, time, x))
    d = every.where(F.col("_n") >= 2 * period).select(*keys, time, "_y", "_p", "_n").withColumns(
        {"_place": place, "_turn": turn, "_turns": F.floor((F.col("_n") - 1 - place) / period) + 1, "_trend": F.lit(0.0), "_r": F.lit(1.0)}
    )
    # low-pass: running means over period, period and 3 values at once
    kernel = [0.0] * (2 * period + 1)
    for i in range(period):
        for j in range(period):
            for k in range(3):
                kernel[i + j + k] += 1 / (period * period * 3)
    for o in range(outer + 1):
        for _ in range(inner):
            d = d.withColumn("_z", F.col("_y") - F.col("_trend"))
            by_place = [*keys, "_place"]
            if season_window is None:
                got = F.when(F.col("_z").isNotNull(), F.col("_r"))
                means = d.groupBy(*by_place, "_n").agg(F.try_divide(F.sum(F.col("_z") * got), F.sum(got)).alias("_c"), F.max("_turns").alias("_m"))
                turns = F.explode(F.sequence(F.lit(-1).cast("long"), F.col("_m"))).alias("_t")
                wide = means.select(*keys, "_n", "_c", "_place", turns).withColumn("_p", F.col("_t") * period + F.col("_place")).drop("_t", "_place")
            else:
                fit = _fit(d, by_place, "_z", season_window, "_c", block, "_r", "_turn", "_turns", "_ends")
                wide = fit.select(*keys, "_n", "_place", F.explode("_ends").alias("_e"))
                wide = wide.select(*keys, "_n", F.col("_e.value").alias("_c"), (F.col("_e.place") * period + F.col("_place")).alias("_p"))

            def low_pass(t, w):
                near = F.collect_list(F.struct(F.coalesce("_c", F.lit(0.0)).alias("c"))).over(w.rowsBetween(-period, period))
                terms = F.zip_with(near, F.array(*[F.lit(v) for v in kernel]), lambda a, b: a["c"] * b)
                return t.withColumn("_l", F.aggregate(terms, F.lit(0.0), lambda a, b: a + b))

            low = _in_blocks(wide, keys, "_p", period, low_pass, block).where("_p >= 0 and _p < _n")
            low = _fit(stage(low), keys, "_l", low_window, "_low", block)
            season = low.select(*keys, "_p", (F.col("_c") - F.col("_low")).alias("_season"))
            d = join_null_safe(d.drop("_season", "_trend", "_z"), season, [*keys, "_p"], "left").withColumn("_z", F.col("_y") - F.col("_season"))
            d = stage(_fit(stage(d), keys, "_z", trend_window, "_trend", block, "_r"))
        if o < outer:
            d = d.withColumn("_res", F.abs(F.col("_y") - F.col("_season") - F.col("_trend")))
            mid = exact_quantiles(d, keys, "_res", {"_mid": 0.5}).select(*keys, (6 * F.col("_mid")).alias("_h"))
            u = F.col("_res") / F.col("_h")
            r = F.when(F.col("_res") <= 0.001 * F.col("_h"), 1.0).when(F.col("_res") <= 0.999 * F.col("_h"), F.pow(1 - u * u, 2)).otherwise(0.0)
            d = stage(join_null_safe(d.drop("_r"), mid, keys, "left").withColumn("_r", r).drop("_res", "_h"))
    parts = d.select(*keys, "_p", F.col("_trend").alias("trend"), F.col("_season").alias("season"))
    out = join_null_safe(every, parts, [*keys, "_p"], "left")
    return out.withColumn("remainder", F.col("_y") - F.col("trend") - F.col("season")).select(*cols, "trend", "season", "remainder")
