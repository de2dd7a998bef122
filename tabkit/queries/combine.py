"""Joins, matching, geometry and reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabkit.functions import scalars
from tabkit.operators import geo, joins, matching, reshape
from tabkit.queries.registry import query, soundex_sql, table

# ---- joins ------------------------------------------------------------------


@query(
    "J1_left_natural_join",
    "select c_custkey, nationkey, n_name from (select c_custkey, nullif(c_nationkey, 3) as nationkey from customer) c left join (select nullif(n_nationkey, 3) as nationkey, n_name from nation) n using (nationkey) where nationkey is not null union all select c_custkey, null, 'NATION_3' from customer where c_nationkey = 3",
)
def _(spark, d):
    c = table(spark, d, "customer").select("c_custkey", F.nullif("c_nationkey", F.lit(3)).alias("nationkey"))
    n = table(spark, d, "nation").select(F.nullif("n_nationkey", F.lit(3)).alias("nationkey"), "n_name")
    return joins.natural_join(c, n)


@query("J1_lookup_join", "select l_orderkey, l_linenumber, p_brand, s_name from lineitem left join part on l_partkey = p_partkey left join supplier on l_suppkey = s_suppkey")
def _(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("p_partkey"), F.col("l_suppkey").alias("s_suppkey"))
    out = joins.natural_join(li, table(spark, d, "part").select("p_partkey", "p_brand"))
    return joins.natural_join(out, table(spark, d, "supplier").select("s_suppkey", "s_name")).drop("p_partkey", "s_suppkey")


@query(
    "J2_full_join",
    "select nationkey, nc, ns from (select c_nationkey as nationkey, count(*) as nc from customer group by 1) full join (select s_nationkey + 5 as nationkey, count(*) as ns from supplier group by 1) using (nationkey)",
)
def _(spark, d):
    c = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("nationkey")).agg(F.count(F.lit(1)).alias("nc"))
    sup = table(spark, d, "supplier").groupBy((F.col("s_nationkey") + 5).alias("nationkey")).agg(F.count(F.lit(1)).alias("ns"))
    return joins.natural_join(c, sup, "full")


@query("J3_inner_join", "select o_orderkey, c_name, c_mktsegment from orders join customer on o_custkey = c_custkey")
def _(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    return joins.natural_join(o, table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment"), "inner").drop("c_custkey")


@query("J4_semi_join", "select c_custkey from customer where exists (select 1 from orders where o_custkey = c_custkey and o_totalprice > 400000)")
def _(spark, d):
    o = table(spark, d, "orders").where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return joins.natural_join(table(spark, d, "customer").select("c_custkey"), o, "left_semi")


@query("J5_anti_join", "select c_custkey from customer where not exists (select 1 from orders where o_custkey = c_custkey and o_totalprice > 400000)")
def _(spark, d):
    o = table(spark, d, "orders").where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return joins.natural_join(table(spark, d, "customer").select("c_custkey"), o, "left_anti")


@query("J6_region_stats", "select n_nationkey, n_name, r_name, n_cust from nation left join region on n_regionkey = r_regionkey left join (select c_nationkey, count(*) as n_cust from customer group by 1) on n_nationkey = c_nationkey")
def _(spark, d):
    n = joins.natural_join(table(spark, d, "nation").withColumnRenamed("n_regionkey", "r_regionkey"), table(spark, d, "region"))
    stats = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("n_cust"))
    return geo.region_join(n, stats, "n_nationkey").select("n_nationkey", "n_name", "r_name", "n_cust")


@query("J7_crossing", "select a.n_name as v1, b.n_name as v2 from nation a, nation b where a.n_name <> b.n_name")
def _(spark, d):
    n = table(spark, d, "nation")
    return joins.crossing(n.select(F.col("n_name").alias("v1")), n.select(F.col("n_name").alias("v2"))).where("v1 <> v2")


def _names(spark, d):
    parts = table(spark, d, "part").select(F.concat_ws(" ", "p_name", "p_type").alias("name"))
    brands = table(spark, d, "part").select(F.concat_ws(" ", "p_type", F.split("p_name", " ")[1]).alias("name"))
    return parts, brands


NAMES = "x as (select distinct p_name || ' ' || p_brand as nx from part), y as (select distinct regexp_replace(p_name, '^(.)(.)', '\\2\\1') || p_brand as ny from part)"


@query(
    "J8_fuzzy_join",
    f"""with {NAMES},
    cx as (select nx, ch, count(*) as n from (select nx, unnest(string_split(nx, '')) as ch from x) group by 1, 2), cy as (select ny, ch, count(*) as n from (select ny, unnest(string_split(ny, '')) as ch from y) group by 1, 2),
    nx as (select nx, sqrt(sum(n * n)) as v, any_value({soundex_sql('nx')}) as sx from cx group by 1), ny as (select ny, sqrt(sum(n * n)) as v, any_value({soundex_sql('ny')}) as sx from cy group by 1),
    dot as (select nx, ny, sum(cx.n * cy.n) as v from cx join cy using (ch) group by 1, 2),
    s as (select nx.nx, ny.ny, round((greatest(1 - coalesce(dot.v, 0) / (nx.v * ny.v), 0) + 1 - jaccard(nx.nx, ny.ny) + 1 - jaro_similarity(nx.nx, ny.ny)) * (case when nx.sx = ny.sx then 1 else 2 end), 9) as score from nx cross join ny left join dot on dot.nx = nx.nx and dot.ny = ny.ny),
    b as (select * from (select *, row_number() over (partition by ny order by score, nx) as rk from s) where rk = 1)
    select nx as name_x, ny as name_y, round(score, 6) as score from (select *, row_number() over (partition by nx order by score, ny) as r2 from b) where r2 = 1""",
)
def _(spark, d):
    """Part names with a brand against misspelt ones without the blank."""
    p = table(spark, d, "part")
    x = p.select(F.concat_ws(" ", "p_name", "p_brand").alias("name"))
    y = p.select(F.concat(F.regexp_replace("p_name", "^(.)(.)", "$2$1"), "p_brand").alias("name"))
    out = matching.join_fuzzily(x, y, f_score=lambda k: F.round(matching.default_score(k), 9))
    return out.select("name_x", "name_y", F.round("score", 6).alias("score"))


PAIRS = """with x as (select distinct p_name || ' ' || p_type as nx from part), y as (select distinct p_type || ' ' || split_part(p_name, ' ', 2) as ny from part),
    s as (select nx, ny, (1 - jaccard(nx, ny)) + (1 - jaro_similarity(nx, ny)) as score from x, y),
    b as (select * from (select *, row_number() over (partition by ny order by round(score, 9), nx) as rk from s) where rk = 1)"""


@query("J8_fuzzy_join_own_score", PAIRS + " select nx as name_x, ny as name_y, round(score, 6) as score from (select *, row_number() over (partition by nx order by round(score, 9), ny) as r2 from b) where r2 = 1")
def _(spark, d):
    x, y = _names(spark, d)
    out = matching.join_fuzzily(x, y, f_score=lambda k: F.round(k["jaccard"] + k["jw"], 9), soundex_doubles=False)
    return out.select("name_x", "name_y", F.round("score", 6).alias("score"))


def _squares(spark, d):
    """One diamond per nation around a point given by its keys."""
    n = table(spark, d, "nation").select(
        F.col("n_nationkey").alias("poly_id"), (F.col("n_nationkey") % 5 * 10 + 5.0).alias("cx"), (F.floor(F.col("n_nationkey") / 5) * 2000 + 1000.0).alias("cy")
    )
    corners = F.array(*[F.struct(F.lit(i).alias("seq"), F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for i, (dx, dy) in enumerate([(-5.0, 0.0), (0.0, -1000.0), (5.0, 0.0), (0.0, 1000.0)])])
    v = n.select("poly_id", "cx", "cy", F.inline(corners))
    return v.select("poly_id", "seq", (F.col("cx") + F.col("dx")).alias("x"), (F.col("cy") + F.col("dy")).alias("y"))


@query(
    "J9_points_in_polygons",
    "with p as (select p_partkey, p_size + 0.37 as x, p_retailprice * 7 % 10000 as y from part), n as (select n_nationkey, n_nationkey % 5 * 10 + 5.0 as cx, floor(n_nationkey / 5) * 2000 + 1000.0 as cy from nation) select p_partkey, n_nationkey as poly_id from p join n on abs(x - cx) / 5 + abs(y - cy) / 1000 < 1",
)
def _(spark, d):
    pts = table(spark, d, "part").select("p_partkey", (F.col("p_size") + 0.37).alias("x"), (F.col("p_retailprice") * 7 % 10000).alias("y"))
    # the grid wants comparable extents in x and y
    pts = pts.withColumn("y", F.col("y") / 200)
    polys = _squares(spark, d).withColumn("y", F.col("y") / 200)
    return geo.points_in_polygons(pts, polys, cell=5.0, point_id="p_partkey")


@query(
    "J10_near_pairs",
    "with a as (select p_partkey, p_size * 10.0 as x, p_retailprice as y from part), b as (select s_suppkey, (s_nationkey + 3) * 17 % 500 * 1.0 as x, s_acctbal / 10 + 900 as y from supplier) select p_partkey, s_suppkey, round(sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) * 0.01, 6) as d from a join b on sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) * 0.01 < 1",
)
def _(spark, d):
    a = table(spark, d, "part").select("p_partkey", (F.col("p_size") * 10.0).alias("x"), F.col("p_retailprice").alias("y"))
    b = table(spark, d, "supplier").select("s_suppkey", ((F.col("s_nationkey") + 3) * 17 % 500 * 1.0).alias("x"), (F.col("s_acctbal") / 10 + 900).alias("y"))
    return geo.near_pairs(a, b, 1.0, "p_partkey", "s_suppkey", scale=0.01).withColumn("d", scalars.round_fast("d", 6))


@query(
    "J11_compare_outputs",
    "select o_orderkey, round(o_totalprice, 2) as price_old, case when o_orderstatus <> 'P' then round(o_totalprice * 2, 2) end as price_new from orders",
)
def _(spark, d):
    o = table(spark, d, "orders")
    new = o.where("o_orderstatus <> 'P'").select("o_orderkey", F.round(F.col("o_totalprice") * 2, 2).alias("price"))
    old = o.select("o_orderkey", F.round("o_totalprice", 2).alias("price"))
    return joins.compare_tables(old, new, "o_orderkey", ["price"])


@query("J12_polygon_centroids", "select n_nationkey as poly_id, round((n_nationkey % 5 * 10 + 5.0)::double, 6) as cx, round((floor(n_nationkey / 5) * 2000 + 1000.0)::double, 6) as cy from nation")
def _(spark, d):
    return geo.centroids(_squares(spark, d)).select("poly_id", F.round("cx", 6).alias("cx"), F.round("cy", 6).alias("cy"))


# ---- reshape ----------------------------------------------------------------


@query(
    "R1_pivot_longer",
    "select l_orderkey, l_partkey, l_linenumber, name, value from (select l_orderkey, l_partkey, l_linenumber, l_quantity, l_discount, nullif(l_tax, 0) as l_tax from lineitem) unpivot (value for name in (l_quantity, l_discount, l_tax))",
)
def _(spark, d):
    li = table(spark, d, "lineitem").withColumn("l_tax", F.nullif("l_tax", F.lit(0.0)))
    return reshape.pivot_longer(li, ["l_orderkey", "l_partkey", "l_linenumber"], ["l_quantity", "l_discount", "l_tax"], drop_na=True)


@query(
    "R2_pivot_wider",
    """with g as (select o_custkey, o_orderstatus, count(*) as n, round(sum(o_totalprice), 2) as total from orders group by 1, 2)
    select o_custkey, coalesce(max(n) filter (o_orderstatus = 'F'), 0) as n_F, coalesce(max(n) filter (o_orderstatus = 'O'), 0) as n_O, coalesce(max(n) filter (o_orderstatus = 'P'), 0) as n_P,
    max(total) filter (o_orderstatus = 'F') as total_F, max(total) filter (o_orderstatus = 'O') as total_O, max(total) filter (o_orderstatus = 'P') as total_P from g group by 1""",
)
def _(spark, d):
    g = table(spark, d, "orders").groupBy("o_custkey", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    return reshape.pivot_wider(g, ["o_custkey"], "o_orderstatus", ["F", "O", "P"], ["n", "total"], fill={"n": 0})


@query("R3_separate", "select p_partkey, split_part(p_name, ' ', 1) as word_01, nullif(split_part(p_name, ' ', 2), '') as word_02, nullif(split_part(p_name, ' ', 3), '') as word_03 from part")
def _(spark, d):
    return reshape.separate(table(spark, d, "part").select("p_partkey", "p_name"), "p_name", " ", "word", width=3).drop("p_name")


@query("R3_split_to_rows", "select p_partkey, generate_subscripts(string_split(p_name, ' '), 1) as pos, unnest(string_split(p_name, ' ')) as word from part")
def _(spark, d):
    return reshape.split_to_rows(table(spark, d, "part").select("p_partkey", "p_name"), "p_name", " ", "word", "pos").drop("p_name")


@query(
    "R4_multi_key_roll_up",
    """with w as (select p_partkey, unnest(string_split(p_name, ' ')) as w from part),
    look as (select w, cast(count(*) as double) as popularity from w group by 1 having count(*) % 2 = 0)
    select p_partkey, count(*) as n_items, sum(coalesce(popularity, 27)) as popularity_sum, median(coalesce(popularity, 27)) as popularity_med, max(coalesce(popularity, 27)) as popularity_max from w left join look using (w) group by 1""",
)
def _(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.concat(F.lit("['"), F.regexp_replace("p_name", " ", "', '"), F.lit("']")).alias("words"))
    p = p.withColumn("words", reshape.clean_list_text(F.col("words")))
    long = reshape.split_to_rows(p, "words", ", ", "w")
    look = long.groupBy("w").agg(F.count(F.lit(1)).cast("double").alias("popularity")).where("popularity % 2 = 0")
    return reshape.roll_up_keys(p, "p_partkey", "words", ", ", look, "w", "popularity", 27.0).drop("words")


@query("G12_nest_unnest", "select o_custkey, o_orderkey, o_orderstatus, count(*) over (partition by o_custkey) as n from orders")
def _(spark, d):
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    nested = reshape.nest(o, ["o_custkey"], ["o_orderkey"]).withColumn("n", F.size("data").cast("long"))
    return reshape.unnest(nested)
