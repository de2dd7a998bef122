"""Aggregates and window operators."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tabkit.operators import aggregates as ag
from tabkit.operators import geo
from tabkit.operators import windows as wn
from tabkit.queries.registry import query, table
from tabkit.scale import exact_quantiles
from tabkit.session import stage


@query(
    "flagship_class_rates",
    """with g as (select o_orderpriority, l_returnflag, count(*) as n, count(*) filter (l_linestatus = 'F') as n_event, quantile_cont(l_extendedprice, 0.5) as med from lineitem join orders on l_orderkey = o_orderkey group by 1, 2)
    select o_orderpriority, l_returnflag, n, n_event, round(n_event / n, 6) as rate, round(n / (sum(n) over ()), 6) as share, round(med, 4) as median_price, row_number() over (order by n desc, o_orderpriority, l_returnflag) as rnk from g""",
)
def class_rates(spark, d):
    """Rate, share of all rows, median and rank of every class, all from one count per class and price."""
    o = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    li = table(spark, d, "lineitem").select("l_orderkey", "l_returnflag", "l_linestatus", "l_extendedprice")
    j = li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    keys = ["o_orderpriority", "l_returnflag"]
    event = F.col("l_linestatus") == "F"
    c = stage(j.groupBy(*keys, F.col("l_extendedprice").cast("double").alias("price")).agg(F.count(F.lit(1)).alias("c"), ag.count_where(event).alias("e")))
    g = c.groupBy(*keys).agg(F.sum("c").alias("n"), F.sum("e").alias("n_event"))
    g = ag.share(g.withColumn("rate", F.col("n_event") / F.col("n")), "n", name="share")
    # one row per class
    g = g.withColumn("rnk", F.row_number().over(Window.orderBy(F.desc("n"), *keys)))
    out = g.join(exact_quantiles(c, keys, "price", {"median_price": 0.5}, count="c"), keys)
    return out.withColumns({"rate": F.round("rate", 6), "share": F.round("share", 6), "median_price": F.round("median_price", 4)})


@query("G1_count", "select o_orderstatus, o_orderpriority, count(*) as nn from orders group by 1, 2")
def _(spark, d):
    return ag.count(table(spark, d, "orders"), "o_orderstatus", "o_orderpriority", name="nn", sort=True)


@query("G2_count_of_counts", "select n, count(*) as nn from (select o_custkey, count(*) as n from orders group by 1) group by 1")
def _(spark, d):
    return ag.count(ag.count(table(spark, d, "orders"), "o_custkey"), "n", name="nn")


@query(
    "G3_share_of_total",
    "with g as (select l_returnflag, l_linestatus, count(*) as n from lineitem group by 1, 2) select *, round(n / (sum(n) over ()), 6) as frac, round(n / (sum(n) over (partition by l_returnflag)), 6) as frac_in_flag from g",
)
def _(spark, d):
    g = ag.count(table(spark, d, "lineitem"), "l_returnflag", "l_linestatus")
    g = ag.share(ag.share(g, "n"), "n", ["l_returnflag"], "frac_in_flag")
    return g.withColumns({"frac": F.round("frac", 6), "frac_in_flag": F.round("frac_in_flag", 6)})


@query(
    "G4_grouped_summary",
    "select l_returnflag, count(*) as n, round(sum(l_quantity), 2) as l_quantity_sum, max(l_quantity) as l_quantity_max, round(avg(l_quantity), 6) as l_quantity_mean, case when count(*) = count(t) then round(sum(t), 4) end as t_sum, case when count(*) = count(t) then max(t) end as t_max, case when count(*) = count(t) then round(avg(t), 6) end as t_mean from (select *, case when l_returnflag = 'A' then nullif(l_tax, 0) else l_tax end as t from lineitem) group by 1",
)
def _(spark, d):
    li = table(spark, d, "lineitem").withColumn("t", F.when(F.col("l_returnflag") == "A", F.nullif("l_tax", F.lit(0.0))).otherwise(F.col("l_tax")))
    out = ag.summarise_across(li, "l_returnflag", ["l_quantity", "t"], {"sum": F.sum, "max": F.max, "mean": F.avg}, na_rm=False)
    return out.withColumns({"l_quantity_sum": F.round("l_quantity_sum", 2), "l_quantity_mean": F.round("l_quantity_mean", 6), "t_sum": F.round("t_sum", 4), "t_mean": F.round("t_mean", 6)})


@query("G5_conditional_rate", "select l_linestatus, count(*) filter (l_returnflag = 'R') as n_returned, round(avg(cast(l_returnflag = 'R' as double)), 6) as rate from lineitem group by 1")
def _(spark, d):
    r = F.col("l_returnflag") == "R"
    return table(spark, d, "lineitem").groupBy("l_linestatus").agg(ag.count_where(r).alias("n_returned"), F.round(ag.rate_where(r), 6).alias("rate"))


@query("G6_exact_quantiles", "select l_returnflag, round(quantile_cont(l_extendedprice, 0.25), 4) as p25, round(median(l_extendedprice), 4) as med, round(quantile_cont(l_extendedprice, 0.9), 4) as p90 from lineitem group by 1")
def _(spark, d):
    q = ag.quantiles(table(spark, d, "lineitem"), "l_returnflag", "l_extendedprice", {"p25": 0.25, "med": 0.5, "p90": 0.9})
    return q.select("l_returnflag", *[F.round(c, 4).alias(c) for c in ("p25", "med", "p90")])


# Beta quantiles by integration: with t = sin(v)^2 the density is a power of sin(v) times a power of cos(v);
# cells of Simpson's rule around its mode, and a quadratic step inside the cell that a quantile falls into.
JEFFREYS = """with g as (select o_orderpriority, count(*) as n, count(*) filter (o_orderstatus = 'F') as k from orders group by 1),
    s as (select *, atan2(sqrt(k), sqrt(n - k)) as mode, 10 / sqrt(2.0 * n) as wide from g),
    r as (select *, greatest(mode - wide, 1e-12) as v0, (least(mode + wide, pi() / 2 - 1e-12) - greatest(mode - wide, 1e-12)) / 4000 as h from s),
    c as (select *, unnest(range(0, 4000)) as i from r),
    e as (select *, [exp(2 * k * ln(sin(v) / greatest(sin(mode), 1e-300)) + 2 * (n - k) * ln(cos(v) / greatest(cos(mode), 1e-300))) for v in [v0 + i * h, v0 + (i + 0.5) * h, v0 + (i + 1) * h]] as f from c),
    t as (select *, h / 6 * (f[1] + 4 * f[2] + f[3]) as cell, sum(h / 6 * (f[1] + 4 * f[2] + f[3])) over (partition by o_orderpriority order by i) as upto, sum(h / 6 * (f[1] + 4 * f[2] + f[3])) over (partition by o_orderpriority) as total from e),
    q as (select *, unnest([0.025, 0.975]) as p from t),
    x as (select *, (p * total - upto + cell) as rest, (p * total - upto + cell) / (f[1] + (f[3] - f[1]) / 2 * ((p * total - upto + cell) / cell)) as step from q where upto >= p * total and upto - cell < p * total)
    select o_orderpriority, any_value(n) as n, any_value(k) as n_event, round(any_value(k / n), 6) as pct, round(max(case when p < 0.5 then sin(v0 + i * h + step) ** 2 end), 6) as low, round(max(case when p > 0.5 then sin(v0 + i * h + step) ** 2 end), 6) as high from x group by 1"""


@query("G7_jeffreys_interval", JEFFREYS)
def _(spark, d):
    j = ag.jeffreys_rate(table(spark, d, "orders"), "o_orderpriority", F.col("o_orderstatus") == "F")
    return j.select("o_orderpriority", "n", "n_event", *[F.round(c, 6).alias(c) for c in ("pct", "low", "high")])


@query(
    "G8_profile",
    """with num as (select 'c_custkey' as col, cast(c_custkey as double) as v from customer union all select 'c_nationkey', c_nationkey from customer union all select 'c_acctbal', c_acctbal from customer),
    txt as (select 'c_name' as col, c_name as v from customer union all select 'c_mktsegment', c_mktsegment from customer)
    select col as "column", 'numeric' as kind, count(*) as n, count(*) - count(v) as n_missing, round(avg(v), 4) as mean, round(stddev_samp(v), 4) as sd, null as min_length, null as max_length, null as n_unique, round(min(v), 4) as p0, round(quantile_cont(v, 0.25), 4) as p25, round(quantile_cont(v, 0.5), 4) as p50, round(quantile_cont(v, 0.75), 4) as p75, round(max(v), 4) as p100 from num group by 1
    union all select col, 'string', count(*), count(*) - count(v), null, null, min(length(v)), max(length(v)), count(distinct v), null, null, null, null, null from txt group by 1""",
)
def _(spark, d):
    p = ag.profile(table(spark, d, "customer"))
    num = ["mean", "sd", "p0", "p25", "p50", "p75", "p100"]
    return p.select("column", "kind", "n", "n_missing", "min_length", "max_length", "n_unique", *[F.round(c, 4).alias(c) for c in num])


@query(
    "G8_top_levels",
    'select * from (select *, row_number() over (partition by "column" order by n desc, level) as rnk from (select \'c_mktsegment\' as "column", c_mktsegment as level, count(*) as n from customer group by 2 union all select \'c_name\', c_name, count(*) from customer group by 2)) where rnk <= 3',
)
def _(spark, d):
    return ag.top_levels(table(spark, d, "customer"), ["c_mktsegment", "c_name"], 3)


CORR = " union all ".join(
    f"select '{a}' as col1, '{b}' as col2, round(corr({a}, {b}), 6) as value from lineitem"
    for a, b in [("l_discount", "l_extendedprice"), ("l_discount", "l_quantity"), ("l_discount", "l_tax"), ("l_extendedprice", "l_quantity"), ("l_extendedprice", "l_tax"), ("l_quantity", "l_tax")]
)


@query("G9_correlations", CORR)
def _(spark, d):
    out = ag.correlations(table(spark, d, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    return out.withColumn("value", F.round("value", 6)).orderBy(F.abs("value").desc())


@query(
    "G10_spearman",
    "with r as (select rank() over (order by l_quantity) + (count(*) over (partition by l_quantity) - 1) / 2.0 as a, rank() over (order by l_extendedprice) + (count(*) over (partition by l_extendedprice) - 1) / 2.0 as b from lineitem) select 'l_extendedprice' as col1, 'l_quantity' as col2, round(corr(a, b), 6) as value from r",
)
def _(spark, d):
    return ag.spearman(table(spark, d, "lineitem"), [], ["l_quantity", "l_extendedprice"]).withColumn("value", F.round("value", 6))


@query(
    "G11_correlation_gap",
    "with g as (select l_returnflag as f, corr(l_discount, l_extendedprice) as a, corr(l_discount, l_quantity) as b, corr(l_extendedprice, l_quantity) as c from lineitem group by 1), l as (select f, 'l_discount' as col1, 'l_extendedprice' as col2, a as v from g union all select f, 'l_discount', 'l_quantity', b from g union all select f, 'l_extendedprice', 'l_quantity', c from g) select col1, col2, round(max(v) filter (f = 'A'), 6) as value_a, round(max(v) filter (f = 'R'), 6) as value_b, round(max(v) filter (f = 'A') - max(v) filter (f = 'R'), 6) as diff from l group by 1, 2 order by abs(diff) desc limit 20",
)
def _(spark, d):
    g = ag.correlation_gap(table(spark, d, "lineitem"), "l_returnflag", "A", "R", ["l_quantity", "l_extendedprice", "l_discount"])
    return g.select("col1", "col2", *[F.round(c, 6).alias(c) for c in ("value_a", "value_b", "diff")])


@query("G13_collapse_text", "select o_custkey, coalesce(string_agg(o_orderpriority, ',' order by o_orderpriority) filter (o_orderstatus = 'F'), 'none') as priorities from orders group by 1")
def _(spark, d):
    o = table(spark, d, "orders").withColumn("v", F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")))
    return o.groupBy("o_custkey").agg(ag.collapse_text("v").alias("priorities"))


@query("G14_histogram", "select cast(floor(l_extendedprice / 5000.0) as bigint) as bin, count(*) as n from lineitem group by 1")
def _(spark, d):
    return ag.histogram(table(spark, d, "lineitem"), "l_extendedprice", 5000.0)


@query(
    "G15_hexagon_summary",
    """with s as (select p_size / 4.0 as sx, (p_retailprice - 900) / 100.0 as sy, p_retailprice as z from part),
    c as (select *, floor(sx + 0.5) as i1, floor(sy + 0.5) as j1, floor(sx) as i2, floor(sy) as j2 from s),
    k as (select *, (sx - i1) ** 2 + 3 * (sy - j1) ** 2 <= (sx - i2 - 0.5) ** 2 + 3 * (sy - j2 - 0.5) ** 2 as near1 from c)
    select case when near1 then i1 else i2 + 0.5 end as hx, case when near1 then j1 else j2 + 0.5 end as hy, count(*) as n, round(avg(ln(z)), 6) as mean_z from k group by 1, 2""",
)
def _(spark, d):
    p = table(spark, d, "part").withColumn("above", F.col("p_retailprice") - 900)
    return geo.hex_summary(p, "p_size", "above", F.log("p_retailprice"), 4.0, 100.0).withColumn("mean_z", F.round("mean_z", 6))


@query(
    "G16_density",
    """with b as (select c_mktsegment, floor(c_acctbal / 100.0) as bin, count(*) as n from customer group by 1, 2), g as (select (-1000 + i * 500.0)::double as x from range(23) t(i))
    select c_mktsegment, x, round(sum(exp(-0.5 * ((x - (bin + 0.5) * 100) / 400) ** 2) * n) / (sum(n) * 400 * 2.506628274631) * 1000, 6) as density from b, g group by 1, 2""",
)
def _(spark, d):
    out = ag.density(table(spark, d, "customer"), "c_acctbal", ["c_mktsegment"], (-1000.0, 10000.0, 23), 400.0, 100.0)
    return out.withColumn("density", F.round(F.col("density") * 1000, 6))


@query(
    "G17_class_summary",
    "with l as (select l_returnflag, 'l_quantity' as metric, l_quantity as v from lineitem union all select l_returnflag, 'l_extendedprice', l_extendedprice from lineitem) select l_returnflag, metric, round(avg(v), 4) as mean, round(min(v), 4) as p0, round(quantile_cont(v, 0.25), 4) as p25, round(median(v), 4) as p50, round(quantile_cont(v, 0.75), 4) as p75, round(max(v), 4) as p100 from l group by 1, 2",
)
def _(spark, d):
    out = ag.class_summary(table(spark, d, "lineitem"), "l_returnflag", ["l_quantity", "l_extendedprice"])
    return out.select("l_returnflag", "metric", *[F.round(c, 4).alias(c) for c in ("mean", "p0", "p25", "p50", "p75", "p100")])


@query("G18_shape_and_integrity", "select count(*) as n_rows, 6 as n_cols, count(distinct o_orderkey) as n_keys, count(*) = count(distinct o_orderkey) as key_is_unique from orders")
def _(spark, d):
    o = table(spark, d, "orders")
    ag.check_rows(o, F.count(F.lit(1)) == F.max("o_orderkey") + 1, "orders are not numbered without gaps")
    return ag.shape(o, "o_orderkey")


# ---- windows ----------------------------------------------------------------


@query("W1_lags", "select event_id, lag(value, 1) over w as value_lag1, lag(value, 2) over w as value_lag2, lag(value, 12) over w as value_lag12 from events window w as (partition by user_id order by ts)")
def _(spark, d):
    return wn.lags(table(spark, d, "events"), "user_id", [F.col("ts")], "value", [1, 2, 12]).select("event_id", "value_lag1", "value_lag2", "value_lag12")


@query("W1_lags_hot_keys", "select event_id, lag(value, 1) over w as value_lag1, lag(value, 3) over w as value_lag3 from events window w as (partition by event_type order by ts, event_id)")
def _(spark, d):
    """Five keys only, so each counts as hot and is cut into blocks."""
    e = table(spark, d, "events")
    return wn.lags(e, "event_type", [F.col("ts"), F.col("event_id")], "value", [1, 3], hot_rows=500).select("event_id", "value_lag1", "value_lag3")


@query("W2_lag_in_order", "select event_id, value - lag(value) over (partition by user_id order by ts) as change from events")
def _(spark, d):
    e = wn.lags(table(spark, d, "events"), "user_id", [F.col("ts")], "value", [1])
    return e.select("event_id", (F.col("value") - F.col("value_lag1")).alias("change"))


@query("W3_rank_desc", "select p_partkey, case when p_retailprice is not null then row_number() over (order by p_retailprice desc nulls last, p_partkey) end as rnk from (select p_partkey, case when p_size <> 7 then p_retailprice end as p_retailprice from part)")
def _(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.when(F.col("p_size") != 7, F.col("p_retailprice")).alias("p_retailprice"))
    return wn.rank_desc(p, "p_retailprice", ["p_partkey"], "rnk").select("p_partkey", "rnk")


@query("W4_number_in_key", "select event_id, row_number() over (partition by event_type order by ts, event_id) as idx from events")
def _(spark, d):
    from tabkit.scale import row_numbers

    e = table(spark, d, "events").select("event_id", "event_type", "ts")
    return row_numbers(e, "event_type", [F.col("ts"), F.col("event_id")], "idx").select("event_id", "idx")


@query("W5_percent_rank", "select event_id, round(percent_rank() over (partition by event_type order by value), 6) as pr from events")
def _(spark, d):
    e = table(spark, d, "events").select("event_id", "event_type", "value")
    return wn.percent_rank(e, "event_type", "value", "pr").select("event_id", F.round("pr", 6).alias("pr"))


@query("W6_rolling_mean", "select event_id, case when count(value) over w = 6 then round(avg(value) over w, 6) end as roll from events window w as (partition by user_id order by ts rows between 5 preceding and current row)")
def _(spark, d):
    return wn.rolling_mean(table(spark, d, "events"), "user_id", [F.col("ts")], "value", 6, "roll").select("event_id", F.round("roll", 6).alias("roll"))


@query("W7_top_with_ties", "select p_partkey, p_brand, p_size from (select *, rank() over (partition by p_brand order by p_size desc) as rk from part) where rk <= 3")
def _(spark, d):
    return wn.slice_top(table(spark, d, "part"), "p_brand", [F.desc("p_size")], 3).select("p_partkey", "p_brand", "p_size")


@query("W7_best_without_ties", "select p_partkey, p_brand from (select *, row_number() over (partition by p_brand order by p_size, p_partkey) as rk from part) where rk = 1")
def _(spark, d):
    return wn.slice_top(table(spark, d, "part"), "p_brand", [F.asc("p_size"), F.asc("p_partkey")], 1, with_ties=False).select("p_partkey", "p_brand")


@query(
    "W8_training_sequences",
    "select event_id, x[1] as first_x, x[24] as last_x, round(list_sum(x), 4) as total, y from (select event_id, list(value) over (partition by user_id order by ts rows between current row and 23 following) as x, lead(value, 24) over (partition by user_id order by ts) as y, lead(1, 24) over (partition by user_id order by ts) as there from events) where there = 1",
)
def _(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id", "ts", "value")
    q = wn.sequences(e, "user_id", [F.col("ts")], "value", 24)
    total = F.aggregate("x", F.lit(0.0), lambda a, v: a + v)
    return q.select("event_id", F.col("x")[0].alias("first_x"), F.col("x")[23].alias("last_x"), F.round(total, 4).alias("total"), "y")
