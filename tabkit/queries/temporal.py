"""Time series."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabkit.operators import local_regression as lr
from tabkit.operators import series as ts
from tabkit.queries.registry import query, table


@query("Q1_duplicate_index", "select l_orderkey, l_linenumber, count(*) as n from lineitem group by 1, 2 having count(*) > 1")
def _(spark, d):
    return ts.duplicate_index(table(spark, d, "lineitem"), "l_orderkey", "l_linenumber")


def hourly(spark, d):
    """Events per type and hour, hours without events as 0."""
    e = table(spark, d, "events").withColumn("hour", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    n = e.groupBy("event_type", "hour").agg(F.count(F.lit(1)).cast("double").alias("x"))
    return ts.complete_series(n, "event_type", "1 hour", "x", "hour", fill=0.0)


HOURLY = """with n as (select event_type, date_trunc('hour', ts) as hour, count(*)::double as x from events group by 1, 2),
    span as (select event_type, min(hour) as lo, max(hour) as hi from n group by 1),
    grid as (select event_type, unnest(generate_series(lo, hi, interval 1 hour)) as hour from span),
    s as (select grid.event_type, grid.hour, coalesce(n.x, 0) as x from grid left join n on grid.event_type = n.event_type and grid.hour = n.hour)"""


@query("Q1_complete_series", HOURLY + " select event_type, strftime(hour, '%Y-%m-%d %H') as hour, x from s")
def _(spark, d):
    return ts.declare_series(hourly(spark, d), "event_type", "hour").withColumn("hour", F.date_format("hour", "yyyy-MM-dd HH"))


@query(
    "Q2_decompose",
    HOURLY
    + """, t as (select *, case when count(x) over (w rows between 12 preceding and 12 following) = 25 then (sum(x) over (w rows between 11 preceding and 11 following) + 0.5 * (lag(x, 12) over w + lead(x, 12) over w)) / 24 end as trend, hour(hour) as ph from s window w as (partition by event_type order by hour)),
    r as (select event_type, ph, avg(x - trend) as v from t group by 1, 2), c as (select *, v - avg(v) over (partition by event_type) as season from r)
    select t.event_type, strftime(t.hour, '%Y-%m-%d %H') as hour, x, round(trend, 9) as trend, round(season, 9) as season, round(x - trend - season, 9) as remainder from t join c on t.event_type = c.event_type and t.ph = c.ph""",
)
def _(spark, d):
    out = ts.decompose(hourly(spark, d), "event_type", "hour", "x", 24, F.hour("hour"))
    return out.select("event_type", F.date_format("hour", "yyyy-MM-dd HH").alias("hour"), "x", *[F.round(c, 9).alias(c) for c in ("trend", "season", "remainder")])


def line_sql(points: str, at: str, q: int) -> str:
    """Local line as SQL over points (event_type, ph, p, n, y) at the places of at (event_type, ph, pos, place, n)."""
    lo = f"greatest(0, least(pos - {(q - 1) // 2}, n - {q}))"
    return f"""(with a as (select *, {lo} as lo, least(n - 1, {lo} + {q - 1}) as hi from {at}),
        b as (select *, greatest(place - lo, hi - place) + case when n < {q} then ({q} - n) // 2 else 0 end as h from a),
        k as (select b.event_type, b.ph, b.pos, b.place, b.n, p.y, p.p - place as d, abs(p.p - place) as r, h from b join {points} p on p.event_type = b.event_type and p.ph = b.ph and p.p between lo and hi),
        w as (select *, case when r <= 0.001 * h then 1 when r <= 0.999 * h then (1 - (r / h) ** 3) ** 3 else 0 end::double as w from k),
        m as (select event_type, ph, place, any_value(n) as n, sum(w * d) / sum(w) as md, sum(w * y) / sum(w) as my, sum(w * d * d) / sum(w) as dd, sum(w * d * y) / sum(w) as dy from w group by 1, 2, 3)
        select event_type, ph, place, case when dd - md * md <= (0.001 * (n - 1)) ** 2 then my else my - md * (dy - md * my) / (dd - md * md) end as v from m)"""


def local_sql(period: int, ns: int, nt: int, nl: int, inner: int) -> str:
    """Seasonal-trend decomposition by local lines as SQL over the hourly events."""
    sql = HOURLY + ", d0 as (select event_type, x as y, row_number() over (partition by event_type order by hour) - 1 as i, count(*) over (partition by event_type) as n, 0.0::double as trend, 0.0::double as season, hour from s)"
    for k in range(inner):
        sql += f""",
        z{k} as (select event_type, i % {period} as ph, i // {period} as p, (n - 1 - i % {period}) // {period} + 1 as n, n as total, y - trend as y from d{k}),
        za{k} as (select event_type, ph, p as pos, p as place, n from z{k} union all select event_type, ph, 0, -1, n from z{k} where p = 0 union all select event_type, ph, n - 1, n, n from z{k} where p = n - 1),
        c{k} as (select event_type, place * {period} + ph as i, v from {line_sql(f'z{k}', f'za{k}', ns)}),
        m1{k} as (select event_type, i, avg(v) over (partition by event_type order by i rows between current row and {period - 1} following) as v from c{k}),
        m2{k} as (select event_type, i, avg(v) over (partition by event_type order by i rows between current row and {period - 1} following) as v from m1{k}),
        m3{k} as (select event_type, i + {period} as i, avg(v) over (partition by event_type order by i rows between current row and 2 following) as v from m2{k}),
        l{k} as (select d.event_type, 0 as ph, d.i as p, d.n, v as y from m3{k} m join d{k} d on m.event_type = d.event_type and m.i = d.i),
        la{k} as (select event_type, ph, p as pos, p as place, n from l{k}),
        e{k} as (select c.event_type, c.i, c.v - l.v as season from c{k} c join {line_sql(f'l{k}', f'la{k}', nl)} l on l.event_type = c.event_type and l.place = c.i),
        t{k} as (select d.event_type, 0 as ph, d.i as p, n, y - e.season as y from d{k} d join e{k} e on d.event_type = e.event_type and d.i = e.i),
        ta{k} as (select event_type, ph, p as pos, p as place, n from t{k}),
        d{k + 1} as (select d.event_type, d.y, d.i, d.n, t.v as trend, e.season, d.hour from d{k} d join e{k} e on d.event_type = e.event_type and d.i = e.i join {line_sql(f't{k}', f'ta{k}', nt)} t on t.event_type = d.event_type and t.place = d.i)"""
    return sql + f" select event_type, strftime(hour, '%Y-%m-%d %H') as hour, round(trend, 6) as trend, round(season, 6) as season, round(y - trend - season, 6) as remainder from d{inner} where n >= {2 * period}"


@query("Q2_local_decompose", local_sql(24, 13, 41, 25, 2))
def _(spark, d):
    out = lr.decompose_locally(hourly(spark, d), "event_type", "hour", "x", 24).where("trend is not null")
    return out.select("event_type", F.date_format("hour", "yyyy-MM-dd HH").alias("hour"), *[F.round(c, 6).alias(c) for c in ("trend", "season", "remainder")])


@query(
    "Q2_local_line",
    HOURLY + f", p as (select event_type, 0 as ph, row_number() over (partition by event_type order by hour) - 1 as p, count(*) over (partition by event_type) as n, x as y from s), a as (select event_type, ph, p as pos, p as place, n from p) select event_type, place, round(v, 6) as fit from {line_sql('p', 'a', 25)}",
)
def _(spark, d):
    out = lr.local_line(hourly(spark, d), "event_type", "hour", "x", 25)
    first = out.groupBy("event_type").agg(F.min("hour").alias("lo"))
    place = F.timestamp_diff("HOUR", F.col("lo"), F.col("hour")).alias("place")
    return out.join(first, "event_type").select("event_type", place, F.round("fit", 6).alias("fit"))


@query(
    "Q3_exponential_smoothing",
    "with recursive e as (select event_id, user_id, value, row_number() over (partition by user_id order by ts) as i from events), r as (select event_id, user_id, i, value as level from e where i = 1 union all select e.event_id, e.user_id, e.i, e.value / 3 + r.level * 2 / 3 from r join e on e.user_id = r.user_id and e.i = r.i + 1) select event_id, round(level, 6) as level from r",
)
def _(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id", "ts", "value")
    return ts.smooth(e, "user_id", "ts", "value", 1 / 3).select("event_id", F.round("level", 6).alias("level"))


@query(
    "Q3_smoothing_with_gaps",
    """with recursive e as (select event_id, user_id, case when event_id % 3 > 0 then value end as v, row_number() over (partition by user_id order by ts) as i from events),
    r as (select event_id, user_id, i, v as level from e where i = 1 union all select e.event_id, e.user_id, e.i, case when e.v is null then r.level when r.level is null then e.v else e.v / 3 + r.level * 2 / 3 end from r join e on e.user_id = r.user_id and e.i = r.i + 1) select event_id, round(level, 6) as level from r""",
)
def _(spark, d):
    """A third of the values is missing and leaves the level as it is."""
    e = table(spark, d, "events").select("event_id", "user_id", "ts", F.when(F.col("event_id") % 3 > 0, F.col("value")).alias("v"))
    return ts.smooth(e, "user_id", "ts", "v", 1 / 3).select("event_id", F.round("level", 6).alias("level"))


@query(
    "Q3_smoothing_weight",
    """with recursive a as (select unnest([0.1::double, 0.3, 0.5, 0.7, 0.9]) as alpha), e as (select user_id, value, row_number() over (partition by user_id order by ts) as i, count(*) over (partition by user_id) as n from events),
    r as (select user_id, alpha, i, n, value as level, 0::double as sse from e, a where i = 1 union all select r.user_id, r.alpha, e.i, r.n, r.alpha * e.value + (1 - r.alpha) * r.level, r.sse + (e.value - r.level) ** 2 from r join e on e.user_id = r.user_id and e.i = r.i + 1)
    select user_id, alpha, round(sse, 2) as sse, round(level, 4) as level from (select *, row_number() over (partition by user_id order by sse, alpha) as k from r where i = n) where k = 1""",
)
def _(spark, d):
    b = ts.smooth_best(table(spark, d, "events"), "user_id", "ts", "value", [0.1, 0.3, 0.5, 0.7, 0.9])
    return b.select("user_id", "alpha", F.round("sse", 2).alias("sse"), F.round("level", 4).alias("level"))


DAY = "date_diff('day', date '1992-01-01', cast(o_orderdate as date))::double"


@query(
    "Q4_trend_by_month",
    f"""with b as (select o_orderpriority, month(o_orderdate) as month, {DAY} as t, o_totalprice as x from orders), m as (select *, avg(t) over (partition by o_orderpriority, month) as mt, avg(x) over (partition by o_orderpriority, month) as mx from b),
    s as (select o_orderpriority, sum((t - mt) * (x - mx)) / sum((t - mt) ** 2) as slope from m group by 1)
    select o_orderpriority, month, round(slope, 4) as slope, round(mx - slope * mt, 2) as intercept from (select distinct o_orderpriority, month, mt, mx from m) join s using (o_orderpriority)""",
)
def _(spark, d):
    t = F.date_diff(F.col("o_orderdate").cast("date"), F.lit("1992-01-01").cast("date"))
    f = ts.trend_month_fit(table(spark, d, "orders"), "o_orderpriority", t, F.month("o_orderdate"), "o_totalprice")
    return f.select("o_orderpriority", "month", F.round("slope", 4).alias("slope"), F.round("intercept", 2).alias("intercept"))


def forecasts(spark, d):
    """Two forecasts of the last week of hourly counts: level by type, and level by type and hour of day."""
    h = hourly(spark, d).withColumn("test", F.col("hour") >= F.lit("2024-01-24").cast("timestamp_ntz"))
    lvl = h.where("NOT test").groupBy("event_type").agg(F.avg("x").alias("pred"))
    byh = h.where("NOT test").groupBy("event_type", F.hour("hour").alias("ph")).agg(F.avg("x").alias("pred"))
    t = h.where("test").withColumn("ph", F.hour("hour"))
    a = t.join(lvl, "event_type").withColumn("model_id", F.lit("level"))
    b = t.join(byh, ["event_type", "ph"]).withColumn("model_id", F.lit("hour_of_day"))
    return a.unionByName(b).select("model_id", "event_type", "hour", F.col("x").alias("actual"), "pred")


FORECAST = (
    HOURLY
    + """, q as (select *, hour >= timestamp '2024-01-24' as test from s), f as (select 'level' as model_id, q.x as actual, p.pred from q join (select event_type, avg(x) as pred from q where not test group by 1) p using (event_type) where test union all select 'hour_of_day', q.x, p.pred from q join (select event_type, hour(hour) as ph, avg(x) as pred from q where not test group by 1, 2) p on q.event_type = p.event_type and hour(q.hour) = p.ph where test),
    acc as (select model_id, count(*) as n, round(sqrt(avg((actual - pred) ** 2)), 6) as rmse, round(avg(abs(actual - pred)), 6) as mae, round(avg(case when actual <> 0 then abs((actual - pred) / actual) end) * 100, 6) as mape, round(corr(actual, pred) ** 2, 6) as rsq from f group by 1)"""
)


@query("Q5_forecast_accuracy", FORECAST + " select * from acc")
def _(spark, d):
    a = ts.accuracy_table(forecasts(spark, d))
    return a.select("model_id", "n", *[F.round(c, 6).alias(c) for c in ("rmse", "mae", "mape", "rsq")])


@query("Q5_best_model", FORECAST + " select model_id, rmse from acc order by rmse limit 1")
def _(spark, d):
    return ts.best_model(forecasts(spark, d)).select("model_id", F.round("rmse", 6).alias("rmse"))


@query(
    "Q6_period_summary",
    "select cast(cast(date_trunc('month', o_orderdate) as date) as varchar) as period, count(*) as n, round(avg(o_totalprice), 4) as mean, round(median(o_totalprice), 4) as median from orders where month(o_orderdate) = 7 group by 1",
)
def _(spark, d):
    o = table(spark, d, "orders").where(F.month("o_orderdate") == 7)
    s = ts.period_summary(o, "o_orderdate", "month", "o_totalprice")
    return s.select(F.col("period").cast("string").alias("period"), "n", F.round("mean", 4).alias("mean"), F.round("median", 4).alias("median"))
