"""Sources, projection, filters, sampling, sorting, sets and scalar functions."""

from __future__ import annotations

import uuid

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tabkit.functions import scalars as s
from tabkit.functions import text_distance as td
from tabkit.operators import frames as fr
from tabkit.operators import joins
from tabkit.operators.windows import rank_desc
from tabkit.queries.registry import query, soundex_sql, table
from tabkit.session import scratch_dir
from tabkit.sources import tables as io


def fresh(spark, tag: str) -> str:
    return f"{scratch_dir(spark)}/{tag}-{uuid.uuid4().hex}"


# ---- sources and sinks ------------------------------------------------------

ORDERS_SQL = "select o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 2) as o_totalprice, cast(cast(o_orderdate as date) as varchar) as o_orderdate, o_orderpriority from orders"


def plain_orders(df):
    return df.withColumn("o_totalprice", F.round("o_totalprice", 2)).withColumn(
        "o_orderdate", F.col("o_orderdate").cast("date").cast("string")
    )


@query("S1_read_csv_inferred", ORDERS_SQL)
def _(spark, d):
    path = fresh(spark, "csv")
    io.write_csv(table(spark, d, "orders"), path)
    back = io.read_csv(spark, path)
    return plain_orders(back.select(F.col("o_orderkey").cast("long"), F.col("o_custkey").cast("long"), *back.columns[2:]))


@query("S2_read_csv_declared", "select cast(o_orderkey as bigint) as o_orderkey, o_orderstatus, round(o_totalprice, 2) as o_totalprice, o_orderpriority, cast(o_custkey as varchar) as o_custkey from orders")
def _(spark, d):
    path = fresh(spark, "csv")
    io.write_csv(table(spark, d, "orders").drop("o_orderdate"), path)
    cols = io.csv_columns(spark, path)
    back = io.read_csv_as(spark, path, cols, {"o_orderkey": "long", "o_totalprice": "double"})
    return back.withColumn("o_totalprice", F.round("o_totalprice", 2))


@query(
    "S3_read_many_files",
    "select year(l_shipdate) as yr, count(*) as n, round(sum(l_extendedprice), 2) as total, count(distinct year(l_shipdate)) as n_files from lineitem group by 1",
)
def _(spark, d):
    path = fresh(spark, "years")
    li = table(spark, d, "lineitem").withColumn("yr", F.year("l_shipdate"))
    li.write.partitionBy("yr").parquet(path)
    years = [r["yr"] for r in li.select("yr").distinct().collect()]
    li = io.read_many(spark, [f"{path}/yr={y}" for y in years], source="file")
    li = li.withColumn("yr", F.year("l_shipdate")).withColumn("part", F.regexp_extract("file", r"yr=(\d+)", 1))
    return li.groupBy("yr").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("total"), F.count_distinct("part").alias("n_files")
    )


@query("S4_save_and_load", "select l_returnflag, count(*) as n, round(regr_slope(l_extendedprice, l_quantity), 3) as slope from (select l_returnflag, (select regr_slope(l_extendedprice, l_quantity) from lineitem) * l_quantity as l_extendedprice, l_quantity from lineitem) group by 1")
def _(spark, d):
    li = io.save_table(table(spark, d, "lineitem").select("l_returnflag", "l_quantity", "l_extendedprice"), fresh(spark, "table"))
    va = VectorAssembler(inputCols=["l_quantity"], outputCol="features")
    lr = LinearRegression(featuresCol="features", labelCol="l_extendedprice", solver="normal", predictionCol="pred")
    path = fresh(spark, "model")
    io.save_model(Pipeline(stages=[va, lr]).fit(li), path)
    scored = PipelineModel.load(path).transform(li)
    return scored.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.regr_slope("pred", "l_quantity"), 3).alias("slope")
    )


@query("S5_materialize_once", "select o_orderstatus, 2 * count(*) as n from orders group by 1")
def _(spark, d):
    path = fresh(spark, "once")
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    io.materialize(spark, lambda: o, path)
    io.materialize(spark, lambda: o.limit(0), path)  # already there: read, not replaced
    return io.materialize(spark, lambda: o, path, mode="append").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("S6_write_csv_blank_na", "select o_orderkey, nullif(o_orderstatus, 'P') as o_orderstatus from orders")
def _(spark, d):
    path = fresh(spark, "csv")
    o = table(spark, d, "orders").select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"))
    io.write_csv(o, path, null_text="")
    return spark.read.schema("o_orderkey long, o_orderstatus string").option("header", True).csv(path)


@query("S7_submission", "select o_orderkey, cast(o_totalprice > 200000 as double) as is_large from orders")
def _(spark, d):
    o = table(spark, d, "orders").withColumn("p", (F.col("o_totalprice") > 200000).cast("int"))
    template = spark.createDataFrame([], "o_orderkey long, is_large double").schema
    return io.submission(o, "o_orderkey", "is_large", "p", template)


# ---- projection, filter, sampling -------------------------------------------


@query("P1_select_drop", "select o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 2) as o_totalprice from orders")
def _(spark, d):
    return table(spark, d, "orders").drop("o_orderdate", "o_orderpriority").withColumn("o_totalprice", F.round("o_totalprice", 2))


@query("P2_select_matching", "select l_orderkey, l_partkey, l_suppkey from lineitem")
def _(spark, d):
    return fr.select_matching(table(spark, d, "lineitem"), "KEY$")


@query("P2_drop_matching", "select l_linenumber, l_quantity, l_returnflag, l_linestatus from lineitem")
def _(spark, d):
    return fr.select_matching(table(spark, d, "lineitem"), "key|price|disc|tax|date", keep=False)


@query("P3_select_by_type", "select c_custkey, c_nationkey, c_acctbal from customer")
def _(spark, d):
    return fr.select_typed(table(spark, d, "customer"), "numeric")


@query("P4_tolerant_columns", "select p_partkey, p_brand, p_size from part")
def _(spark, d):
    p = table(spark, d, "part")
    return p.select(*fr.any_of(p, ["p_partkey", "p_colour", "p_brand"]), *fr.all_of(p, ["p_size"]))


@query("P5_rename_clean", "select n_nationkey as nation_key, n_name as nation_name, n_regionkey as region_key_id from nation")
def _(spark, d):
    n = table(spark, d, "nation").toDF("Nation Key", "NationName", "regionKey")
    return fr.rename_with(fr.clean_names(n), lambda c: f"{c}_id", ["region_key"])


@query("P6_relocate", "select s_acctbal, s_nationkey, s_suppkey, s_name from supplier")
def _(spark, d):
    return fr.relocate(table(spark, d, "supplier"), "s_acctbal", "s_nationkey")


@query(
    "P7_computed_columns",
    "select l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 6) as net, round(l_extendedprice * (1 - l_discount) * (1 + l_tax), 6) as gross, round(case when l_discount = 0 then null else l_tax / l_discount end, 6) as ratio from lineitem",
)
def _(spark, d):
    li = table(spark, d, "lineitem").withColumns(
        {
            "net": F.col("l_extendedprice") * (1 - F.col("l_discount")),
            "gross": F.col("net") * (1 + F.col("l_tax")),
            "ratio": s.safe_divide("l_tax", "l_discount"),
        }
    )
    return li.select("l_orderkey", "l_linenumber", *[F.round(c, 6).alias(c) for c in ("net", "gross", "ratio")])


@query(
    "P8_across",
    "select l_orderkey, round(ln(l_quantity), 6) as l_quantity_log, round(sqrt(l_quantity), 6) as l_quantity_root, round(ln(l_extendedprice), 6) as l_extendedprice_log, round(sqrt(l_extendedprice), 6) as l_extendedprice_root from lineitem",
)
def _(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_quantity", "l_extendedprice")
    fns = {"log": lambda c: F.round(F.log(c), 6), "root": lambda c: F.round(F.sqrt(c), 6)}
    return fr.across(li, ["l_quantity", "l_extendedprice"], fns).drop("l_quantity", "l_extendedprice")


@query("P9_filter", "select o_orderkey, o_custkey from orders where o_orderstatus = 'F' and o_totalprice > 100000")
def _(spark, d):
    return table(spark, d, "orders").where((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 100000)).select("o_orderkey", "o_custkey")


@query(
    "P10_membership",
    "select c_custkey, c_mktsegment from customer where c_mktsegment in ('BUILDING', 'MACHINERY') and not exists (select 1 from orders where o_custkey = c_custkey and o_orderstatus = 'P')",
)
def _(spark, d):
    c = fr.where_in(table(spark, d, "customer"), "c_mktsegment", ["BUILDING", "MACHINERY"])
    pending = table(spark, d, "orders").where("o_orderstatus = 'P'").select("o_custkey")
    return fr.where_not_in(c, "c_custkey", pending).select("c_custkey", "c_mktsegment")


@query("P11_range_filter", "select l_orderkey, l_partkey, l_linenumber from lineitem where l_discount between 0.03 and 0.05 and l_quantity >= 10 and l_quantity <= 20")
def _(spark, d):
    li = table(spark, d, "lineitem")
    return li.where(F.col("l_discount").between(0.03, 0.05) & (F.col("l_quantity") >= 10) & (F.col("l_quantity") <= 20)).select("l_orderkey", "l_partkey", "l_linenumber")


WITH_GAPS = "(select event_id, case when event_type = 'error' then null else value end as value, nullif(event_type, 'click') as event_type from events)"


def _gappy(spark, d):
    e = table(spark, d, "events")
    return e.select(
        "event_id",
        F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value")).alias("value"),
        F.nullif("event_type", F.lit("click")).alias("event_type"),
    )


@query("P12_drop_missing", f"select event_id, round(value, 4) as value, event_type from {WITH_GAPS} where value is not null and event_type is not null")
def _(spark, d):
    return fr.drop_missing(_gappy(spark, d)).withColumn("value", F.round("value", 4))


@query("P12_incomplete_rows", f"select event_id, event_type from {WITH_GAPS} where value is null or event_type is null")
def _(spark, d):
    return fr.incomplete_rows(_gappy(spark, d)).select("event_id", "event_type")


@query("P13_distinct", "select distinct o_orderstatus, o_orderpriority from orders")
def _(spark, d):
    return table(spark, d, "orders").select("o_orderstatus", "o_orderpriority").distinct()


@query("P14_row_index", "select o_orderkey, row_number() over (order by o_orderdate, o_orderkey) as idx from orders")
def _(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return fr.row_index(o, [F.col("o_orderdate"), F.col("o_orderkey")]).select("o_orderkey", "idx")


@query("P15_bind_columns", "select o_orderkey, o_custkey, round(o_totalprice * 2, 2) as pred from orders")
def _(spark, d):
    o = table(spark, d, "orders")
    preds = o.select("o_orderkey", F.round(F.col("o_totalprice") * 2, 2).alias("pred"))
    return fr.bind_cols(o.select("o_orderkey", "o_custkey"), preds, "o_orderkey")


U32 = "(('0x' || substr(md5(concat('{seed}-', {id})), 1, 8))::bigint / 4294967296.0)"


@query("P16_sample_fraction", f"select o_orderkey from orders where {U32.format(seed=42, id='o_orderkey')} < 0.1")
def _(spark, d):
    return fr.sample_fraction(table(spark, d, "orders"), "o_orderkey", 0.1, seed=42).select("o_orderkey")


@query("P16_sample_n", "select o_orderkey from orders order by md5(concat('42-', o_orderkey)), o_orderkey limit 1000")
def _(spark, d):
    return fr.sample_n(table(spark, d, "orders"), "o_orderkey", 1000, seed=42).select("o_orderkey")


@query("P16_sample_n_large", "select count(*) as n, sum(event_id)::bigint as total from (select event_id from events order by md5(concat('42-', event_id)), event_id limit 10001)")
def _(spark, d):
    e = fr.sample_n(table(spark, d, "events"), "event_id", 10001, seed=42)
    return e.agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("total"))


@query(
    "P17_first_per_key",
    "select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity from (select *, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity) as rn from lineitem) where rn = 1",
)
def _(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return fr.first_per_key(li, "l_orderkey", ["l_linenumber", "l_partkey", "l_suppkey"])


@query("P18_add_rows", "select n_nationkey, n_name, n_regionkey from nation union all select 100, 'UK', null union all select null, 'Atlantis', 3")
def _(spark, d):
    return fr.add_rows(table(spark, d, "nation"), [{"n_nationkey": 100, "n_name": "UK"}, {"n_name": "Atlantis", "n_regionkey": 3}])


@query("P19_scalar_pull", "select o_orderkey, round(o_totalprice - (select avg(o_totalprice) from orders), 4) as centred from orders")
def _(spark, d):
    o = table(spark, d, "orders")
    j = fr.scalar_column(o, o.agg(F.avg("o_totalprice").alias("m")))
    return j.select("o_orderkey", F.round(F.col("o_totalprice") - F.col("m"), 4).alias("centred"))


# ---- sort, limit, sets ------------------------------------------------------


@query("O1_sort_missing_last", "select o_orderkey, o_orderdate_n from (select o_orderkey, case when o_orderstatus = 'P' then null else o_orderkey end as o_orderdate_n from orders) order by o_orderdate_n desc nulls last, o_orderkey")
def _(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")).alias("o_orderdate_n"))
    return fr.arrange(o, "-o_orderdate_n", "o_orderkey")


@query("O2_top_rows", "select c_custkey, c_name from customer order by c_acctbal desc, c_custkey limit 20")
def _(spark, d):
    return table(spark, d, "customer").orderBy(F.desc("c_acctbal"), "c_custkey").limit(20).select("c_custkey", "c_name")


@query("O2_slice_positions", "select c_custkey, c_name from customer order by c_acctbal, c_custkey limit 5 offset 6")
def _(spark, d):
    return fr.slice_rows(table(spark, d, "customer"), [F.col("c_acctbal"), F.col("c_custkey")], 7, 11).select("c_custkey", "c_name")


@query(
    "O3_top_fraction",
    "select o_orderkey from (select o_orderkey, row_number() over (order by o_totalprice desc, o_orderkey) as rn, count(*) over () as n from orders) where rn <= floor(0.8 * n)",
)
def _(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return fr.top_fraction(o, ["-o_totalprice", "o_orderkey"], 0.8).select("o_orderkey")


@query(
    "U1_union_tagged",
    "select 'customer' as src, c_nationkey as nationkey, c_name as name, c_mktsegment as segment from customer union all select 'supplier', s_nationkey, s_name, null from supplier",
)
def _(spark, d):
    c = table(spark, d, "customer").selectExpr("c_nationkey as nationkey", "c_name as name", "c_mktsegment as segment")
    sup = table(spark, d, "supplier").selectExpr("s_nationkey as nationkey", "s_name as name")
    return fr.bind_rows({"customer": c, "supplier": sup}, tag="src")


@query("U2_set_difference", "select c_custkey from customer except select o_custkey from orders where o_orderstatus = 'F'")
def _(spark, d):
    return table(spark, d, "customer").select("c_custkey").subtract(table(spark, d, "orders").where("o_orderstatus = 'F'").select("o_custkey"))


@query("U3_set_intersection", "select c_custkey from customer intersect select o_custkey from orders where o_orderstatus = 'F'")
def _(spark, d):
    return table(spark, d, "customer").select("c_custkey").intersect(table(spark, d, "orders").where("o_orderstatus = 'F'").select("o_custkey"))


# ---- scalar functions -------------------------------------------------------


@query(
    "T1_text_replace",
    "select p_partkey, regexp_replace(p_name, '[aeiou]', '') as cut_first, regexp_replace(p_name, '[aeiou]', '', 'g') as cut_all, regexp_replace(p_brand, '#', '-', 'g') as brand from part",
)
def _(spark, d):
    return table(spark, d, "part").select(
        "p_partkey",
        s.remove_first("p_name", "[aeiou]").alias("cut_first"),
        s.remove_all("p_name", "[aeiou]").alias("cut_all"),
        s.replace_all("p_brand", "#", "-").alias("brand"),
    )


@query("T2_text_detect", "select p_partkey, regexp_matches(p_name, '^(red|blue).*t$') as hit from part")
def _(spark, d):
    return table(spark, d, "part").select("p_partkey", s.detect("p_name", "^(red|blue).*t$").alias("hit"))


@query("T3_text_split", "select p_partkey, split_part(p_name, ' ', 1) as first_word, split_part(p_name, ' ', 2) as second_word, p_name[:-2] as chopped from part")
def _(spark, d):
    parts = F.split("p_name", " ")
    return table(spark, d, "part").select("p_partkey", parts[0].alias("first_word"), parts[1].alias("second_word"), s.drop_last("p_name").alias("chopped"))


@query(
    "T4_text_format",
    "select o_orderkey, printf('%04d-%02d-01', year(o_orderdate), month(o_orderdate)) as ym, o_orderstatus || '/' || nullif(o_orderpriority, '5-LOW') as tag from orders",
)
def _(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey",
        F.format_string("%04d-%02d-01", F.year("o_orderdate"), F.month("o_orderdate")).alias("ym"),
        F.concat("o_orderstatus", F.lit("/"), F.nullif("o_orderpriority", F.lit("5-LOW"))).alias("tag"),
    )


@query(
    "T5_title_number_blank",
    "select p_partkey, array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') as title, cast(nullif(regexp_extract(p_brand, '(-?\\d+(\\.\\d+)?)', 1), '') as double) as num, nullif(p_type, 'ECONOMY') as type from part",
)
def _(spark, d):
    return table(spark, d, "part").select(
        "p_partkey", s.title_case("p_name").alias("title"), s.parse_number("p_brand").alias("num"), s.blank_to_null("p_type", "ECONOMY").alias("type")
    )


@query("T6_percent_text", "select l_orderkey, l_linenumber, round(cast(replace(cast(round(l_discount * 100, 2) as varchar) || '%', '%', '') as double) * 0.01, 6) as frac from lineitem")
def _(spark, d):
    li = table(spark, d, "lineitem").withColumn("txt", F.concat(F.round(F.col("l_discount") * 100, 2).cast("string"), F.lit("%")))
    return li.select("l_orderkey", "l_linenumber", F.round(s.percent_to_fraction("txt"), 6).alias("frac"))


def _word_pairs(spark, d):
    p = table(spark, d, "part").select(F.concat_ws(" ", "p_type", "p_name").alias("a"), F.concat_ws(" ", "p_name", "p_brand").alias("b"), "p_partkey")
    return p


@query(
    "T7_cosine_distance",
    """with p as (select p_partkey, p_type || ' ' || p_name as a, p_name || ' ' || p_brand as b from part),
    ca as (select p_partkey, ch, count(*) as n from (select p_partkey, unnest(string_split(a, '')) as ch from p) group by 1, 2),
    cb as (select p_partkey, ch, count(*) as n from (select p_partkey, unnest(string_split(b, '')) as ch from p) group by 1, 2),
    na as (select p_partkey, sqrt(sum(n * n)) as v from ca group by 1), nb as (select p_partkey, sqrt(sum(n * n)) as v from cb group by 1),
    dot as (select ca.p_partkey, sum(ca.n * cb.n) as v from ca join cb on ca.p_partkey = cb.p_partkey and ca.ch = cb.ch group by 1)
    select na.p_partkey, round(1 - coalesce(dot.v, 0) / (na.v * nb.v), 6) as dist from na join nb using (p_partkey) left join dot using (p_partkey)""",
)
def _(spark, d):
    return _word_pairs(spark, d).select("p_partkey", F.round(td.cosine(F.col("a"), F.col("b")), 6).alias("dist"))


@query("T8_jaccard_distance", "select p_partkey, round(1 - jaccard(p_type || ' ' || p_name, p_name || ' ' || p_brand), 6) as dist from part")
def _(spark, d):
    return _word_pairs(spark, d).select("p_partkey", F.round(td.jaccard(F.col("a"), F.col("b")), 6).alias("dist"))


@query("T9_jaro_distance", "select p_partkey, round(1 - jaro_similarity(p_type || ' ' || p_name, p_name || ' ' || p_brand), 6) as dist from part")
def _(spark, d):
    return _word_pairs(spark, d).select("p_partkey", F.round(td.jaro(F.col("a"), F.col("b")), 6).alias("dist"))


@query("T10_soundex_distance", f"select p_partkey, case when {soundex_sql('a')} = {soundex_sql('b')} then 0.0 else 1.0 end::double as dist, {soundex_sql('b')} as code from (select p_partkey, split_part(p_name, ' ', 1) as a, split_part(p_name, ' ', 2) as b from part)")
def _(spark, d):
    p = table(spark, d, "part")
    return p.select("p_partkey", td.soundex(F.split("p_name", " ")[0], F.split("p_name", " ")[1]).alias("dist"), F.soundex(F.split("p_name", " ")[1]).alias("code"))


@query(
    "T11_date_parts",
    "select o_orderkey, cast(strptime(strftime(o_orderdate, '%Y-%m-%d'), '%Y-%m-%d')::date as varchar) as day, month(o_orderdate) as mon, year(o_orderdate) as yr, cast(floor((dayofyear(o_orderdate) - 1) / 7) + 1 as bigint) as week from orders",
)
def _(spark, d):
    o = table(spark, d, "orders").withColumn("txt", F.date_format("o_orderdate", "yyyy-MM-dd"))
    day = F.to_date("txt")
    return o.select("o_orderkey", day.cast("string").alias("day"), F.month(day).alias("mon"), F.year(day).alias("yr"), s.week_of_year(day).cast("long").alias("week"))


@query("T12_month_names", "select o_orderkey, cast(month(o_orderdate) as bigint) as num, strftime(o_orderdate, '%b') as abb, strftime(o_orderdate, '%B') as full_name from orders")
def _(spark, d):
    o = table(spark, d, "orders").withColumn("full_name", F.date_format("o_orderdate", "MMMM"))
    return o.select("o_orderkey", s.month_number("full_name").alias("num"), s.month_name(F.month("o_orderdate")).alias("abb"), "full_name")


@query(
    "T13_conditionals",
    "select p_partkey, case when nullif(p_type, 'ECONOMY') is null then null when p_type = 'STANDARD' then 'yes' else 'no' end as flag, case when p_size < 10 then 'small' when p_size < 30 then 'medium' else 'large' end as band from part",
)
def _(spark, d):
    t = F.nullif("p_type", F.lit("ECONOMY"))
    band = s.case_when((F.col("p_size") < 10, "small"), (F.col("p_size") < 30, "medium"), default="large")
    return table(spark, d, "part").select("p_partkey", s.if_else(t == "STANDARD", "yes", "no").alias("flag"), band.alias("band"))


@query(
    "T14_coalesce_fill",
    "select event_id, coalesce(nullif(event_type, 'click'), 'na') as event_type, round(coalesce(case when event_type = 'error' then null else value end, (select avg(value) from events where event_type <> 'error')), 4) as value from events",
)
def _(spark, d):
    e = fr.fill_missing(_gappy(spark, d), "event_type", "na")
    return fr.fill_missing(e, "value", "mean").withColumn("value", F.round("value", 4))


@query("T15_casts", "select l_orderkey, l_linenumber, cast(l_quantity as integer) as qty, cast(l_linenumber as double) as num, cast(l_linenumber as varchar) as txt, l_quantity > 0 as flag, try_cast(l_returnflag as integer) as bad from lineitem")
def _(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_quantity").cast("int").alias("qty"),
        F.col("l_linenumber").cast("double").alias("num"),
        F.col("l_linenumber").cast("string").alias("txt"),
        F.col("l_quantity").cast("boolean").alias("flag"),
        F.col("l_returnflag").try_cast("int").alias("bad"),
    )


@query(
    "T16_math",
    "select c_custkey, round(case when c_acctbal > 0 then ln(c_acctbal) else null end, 6) as lg, round(log10(abs(c_acctbal) + 1), 6) as lg10, round(ln(abs(c_acctbal) + 1), 6) as l1p, round(exp(ln(abs(c_acctbal) + 1)) - 1, 4) as back, round(sqrt(abs(c_acctbal)), 6) as root, floor(c_acctbal) as fl, cast(sign(c_acctbal) as double) as sg, round_even(c_acctbal, 0) as half_even from customer",
)
def _(spark, d):
    x = F.col("c_acctbal")
    return table(spark, d, "customer").select(
        "c_custkey",
        F.round(F.when(x > 0, s.safe_log(x)), 6).alias("lg"),
        F.round(F.log10(F.abs(x) + 1), 6).alias("lg10"),
        F.round(F.log1p(F.abs(x)), 6).alias("l1p"),
        F.round(F.expm1(F.log1p(F.abs(x))), 4).alias("back"),
        F.round(F.sqrt(F.abs(x)), 6).alias("root"),
        F.floor(x).cast("double").alias("fl"),
        F.signum(x).alias("sg"),
        F.rint(x).alias("half_even"),
    )


@query(
    "T17_factor_levels",
    "with m as (select p_brand, row_number() over (order by quantile_cont(p_retailprice, 0.5), p_brand) as code from part group by 1) select p_partkey, m.code as by_price, cast(dense_rank() over (order by part.p_brand) as bigint) as by_name from part join m using (p_brand)",
)
def _(spark, d):
    from tabkit.features.levels import level_table, with_codes

    p = table(spark, d, "part")
    by_price = level_table(p, "p_brand", by="p_retailprice")
    by_name = level_table(p, "p_brand")
    out = with_codes(with_codes(p, "p_brand", by_price, "by_price"), "p_brand", by_name, "by_name")
    return out.select("p_partkey", "by_price", "by_name")


@query("T18_ordinal_code", "select o_orderkey, case o_orderpriority when '1-URGENT' then 1 when '2-HIGH' then 2 when '3-MEDIUM' then 3 when '5-LOW' then 5 end::bigint as code from orders")
def _(spark, d):
    levels = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    return table(spark, d, "orders").select("o_orderkey", s.ordinal_code("o_orderpriority", levels, "4-NOT SPECIFIED").alias("code"))


@query("T19_cut_right_closed", "select p_partkey, case when p_size > 5 and p_size <= 10 then '(5,10]' when p_size > 10 and p_size <= 30 then '(10,30]' when p_size > 30 and p_size <= 45 then '(30,45]' end as bin from part")
def _(spark, d):
    return table(spark, d, "part").select("p_partkey", s.cut_right("p_size", [5, 10, 30, 45]).alias("bin"))


@query("T19_cut_equal_count", "select p_partkey, 1 + cast(p_retailprice > q.a as int) + cast(p_retailprice > q.b as int) + cast(p_retailprice > q.c as int) as bin from part, (select quantile_cont(p_retailprice, 0.25) as a, quantile_cont(p_retailprice, 0.5) as b, quantile_cont(p_retailprice, 0.75) as c from part) q")
def _(spark, d):
    from tabkit.modelling.resample import numeric_strata

    return numeric_strata(table(spark, d, "part"), "p_retailprice", "b", 4).select("p_partkey", (F.col("b") + 1).alias("bin"))


@query(
    "T20_compass_degrees",
    "select event_id, case event_type when 'click' then 0.0 when 'view' then 90.0 when 'error' then 202.5 else null end::double as deg from events",
)
def _(spark, d):
    e = table(spark, d, "events").withColumn("dir", F.nullif(s.recode("event_type", {"click": "N", "view": "E", "error": "SSW"}), F.col("event_type")))
    return e.select("event_id", s.compass_degrees("dir").alias("deg"))


@query("T21_list_length", "select p_partkey, len(string_split(p_name, ' ')) as n from part")
def _(spark, d):
    return table(spark, d, "part").select("p_partkey", s.list_length(F.split("p_name", " ")).cast("long").alias("n"))


@query("T22_standardise", "select c_custkey, round((c_acctbal - (select avg(c_acctbal) from customer)) / (select stddev_samp(c_acctbal) from customer), 6) as c_acctbal from customer")
def _(spark, d):
    return fr.standardise(table(spark, d, "customer").select("c_custkey", "c_acctbal"), ["c_acctbal"]).withColumn("c_acctbal", F.round("c_acctbal", 6))


@query("T23_null_tests", f"select event_id, value is null as no_value, event_type is null as no_type from {WITH_GAPS}")
def _(spark, d):
    e = _gappy(spark, d)
    return e.select("event_id", fr.is_missing(e, "value").alias("no_value"), fr.is_missing(e, "event_type").alias("no_type"))


# ---- user functions ---------------------------------------------------------


@query("X1_scalar_functions", "select o_orderkey, upper(o_orderstatus) || '!' as a, case when o_orderpriority = '1-URGENT' then 1 end::bigint as b from orders")
def _(spark, d):
    shout = s.compose(F.upper, lambda c: F.concat(c, F.lit("!")))
    return table(spark, d, "orders").select("o_orderkey", shout(F.col("o_orderstatus")).alias("a"), s.level_code("o_orderpriority", ["1-URGENT"]).alias("b"))


@query("X2_user_metric", "select l_returnflag, 'under' as metric, round(avg(greatest(l_extendedprice - l_quantity * 1500, 0)), 4) as value from lineitem group by 1 union all select l_returnflag, 'rmsle', round(sqrt(avg(power(ln(1 + l_extendedprice) - ln(1 + l_quantity * 1500), 2))), 4) from lineitem group by 1")
def _(spark, d):
    from tabkit.modelling import metrics as m

    m.register("under", lambda t, e: F.avg(F.greatest(F.col(t) - F.col(e), F.lit(0.0))), minimize=True)
    li = table(spark, d, "lineitem").withColumn("est", F.col("l_quantity") * 1500)
    return m.evaluate(li, "l_extendedprice", "est", ["under", "rmsle"], ["l_returnflag"]).withColumn("value", F.round("value", 4))


@query("X4_custom_tokenizer", "select doc_id, unnest(string_split(text, ', ')) as token from documents")
def _(spark, d):
    return table(spark, d, "documents").select("doc_id", F.explode(F.split("text", ", ")).alias("token"))


@query("X5_error_tolerant_map", "select c_nationkey, case when c_nationkey <> 7 then count(*) end as size, case when c_nationkey <> 7 then round(max(c_acctbal)::double, 2) end as top, case when c_nationkey = 7 then 'ValueError: no data' end as error from customer group by 1")
def _(spark, d):
    from tabkit.functions.udf import map_groups_safely

    def fn(pdf):
        if pdf["c_nationkey"].iloc[0] == 7:
            raise ValueError("no data")
        return pdf[["c_nationkey"]].drop_duplicates().assign(size=len(pdf), top=float(pdf["c_acctbal"].max()))

    c = table(spark, d, "customer")
    out = map_groups_safely(c.select("c_nationkey", "c_acctbal"), ["c_nationkey"], fn, "c_nationkey int, size long, top double")
    return out.select("c_nationkey", "size", F.round("top", 2).alias("top"), "error")
