"""Models, tuning, explanation and ensembling."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabkit.functions import udf
from tabkit.modelling import ensemble, explain, metrics, models, neighbours, resample, tune
from tabkit.operators import joins
from tabkit.modelling.tree_shap import tree_contributions
from tabkit.plans import adversarial, modelling as runs
from tabkit.queries.registry import query, table
from tabkit.session import stage

NUM = ["l_quantity", "l_discount", "l_tax"]


def lines(spark, d):
    """Line items with a row id (the listed keys are not unique) and the part's price."""
    li = table(spark, d, "lineitem")
    key = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round(F.col("l_extendedprice") * 100).cast("long"), "l_shipdate")
    p = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_retailprice", "p_size")
    out = li.withColumn("id", F.xxhash64(key)).join(p, "l_partkey")
    return out.select("id", "l_orderkey", *NUM, "l_extendedprice", "p_retailprice", F.col("p_size").cast("double").alias("p_size"), "l_returnflag", "l_linestatus")


def folded(spark, d, v=3):
    return stage(resample.group_vfold(lines(spark, d), "l_orderkey", v))


def rounded(df, *cols, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in cols})


def stumps(spark, d):
    return lines(spark, d).withColumn("big", (F.col("l_quantity") > 25).cast("int"))


# ---- models -----------------------------------------------------------------


@query("M1_univariate_logistic")
def _(spark, d):
    li = lines(spark, d).withColumn("y", (F.col("l_returnflag") == "R").cast("int"))
    return rounded(models.univariate_logistic(li, "y", NUM), "estimate", "std_error", "statistic", "p_value", digits=4)


@query(
    "M1_univariate_logistic_odds",
    "with t as (select l_quantity > 25 as big, l_returnflag = 'R' as y from lineitem), c as (select (count(*) filter (y and big))::double as a, (count(*) filter (not y and big))::double as b, (count(*) filter (y and not big))::double as c, (count(*) filter (not y and not big))::double as d from t), e as (select 'big' as term, ln(a / b) - ln(c / d) as estimate, sqrt(1 / a + 1 / b + 1 / c + 1 / d) as std_error from c union all select '(Intercept)', ln(c / d), sqrt(1 / c + 1 / d) from c) select term, round(estimate, 4) as estimate, round(std_error, 4) as std_error, round(estimate / std_error, 3) as statistic from e",
)
def _(spark, d):
    """On a 0/1 predictor the slope is the log odds ratio."""
    li = stumps(spark, d).withColumn("y", (F.col("l_returnflag") == "R").cast("int"))
    out = models.univariate_logistic(li, "y", ["big"]).select("term", "estimate", "std_error", F.round("statistic", 3).alias("statistic"))
    return rounded(out, "estimate", "std_error", digits=4)


@query(
    "M2_linear_model",
    "with f as (select regr_slope(l_extendedprice, l_quantity) as b, regr_intercept(l_extendedprice, l_quantity) as a from lineitem) select l_linestatus, count(*) as n, round(avg(a + b * l_quantity), 3) as mean_pred, round(sqrt(avg((l_extendedprice - a - b * l_quantity) ** 2)), 3) as rmse from lineitem, f group by 1",
)
def _(spark, d):
    li = table(spark, d, "lineitem")
    p = models.linear_reg().fit(li, "l_extendedprice", ["l_quantity"]).predict(li)
    g = p.groupBy("l_linestatus").agg(F.count(F.lit(1)).alias("n"), F.avg("pred").alias("mean_pred"), metrics.rmse("l_extendedprice", "pred").alias("rmse"))
    return rounded(g, "mean_pred", "rmse", digits=3)


def class_report(fit, df, truth="l_returnflag"):
    return rounded(fit.predict(df).groupBy(F.col(truth).alias("truth"), "pred").agg(F.count(F.lit(1)).alias("n"), F.avg(fit.score_expr()).alias("mean_prob")), "mean_prob")


def value_report(fit, df, truth="l_extendedprice"):
    m = metrics.evaluate(fit.predict(df), truth, "pred", ["rmse", "mae", "rsq"])
    return rounded(m, "value", digits=4)


@query("M3_elastic_net")
def _(spark, d):
    li = lines(spark, d)
    return value_report(models.linear_reg(penalty=10.0, mixture=0.5).fit(li, "l_extendedprice", NUM + ["p_retailprice"]), li)


SHARES = "with n as (select (l_quantity > 25)::int as big, l_returnflag as level, count(*) as n from lineitem group by 1, 2) select big, level, round(n / sum(n) over (partition by big), 4) as prob from n"


def class_shares(fit, df):
    """Mean probability of every level per group of the 0/1 predictor."""
    p = fit.predict(df).groupBy("big").agg(*[F.avg(c).alias(v) for v, c in models.prob_columns(fit.levels).items()])
    return rounded(p.unpivot(["big"], fit.levels, "level", "prob"), "prob", digits=4)


@query("M3_multinomial_shares", SHARES)
def _(spark, d):
    """Without a penalty, one 0/1 predictor gives each group its own shares."""
    li = stumps(spark, d)
    return class_shares(models.linear_reg("classification", epochs=100).fit(li, "l_returnflag", ["big"]), li)


@query("M3_multinomial")
def _(spark, d):
    li = lines(spark, d)
    return class_report(models.linear_reg("classification", penalty=0.001, mixture=0.5, epochs=30).fit(li, "l_returnflag", NUM), li)


@query("M4_neural_network")
def _(spark, d):
    li = lines(spark, d).withColumn("l_quantity", F.col("l_quantity") / 50)
    return class_report(models.mlp(hidden_units=4, epochs=20).fit(li, "l_returnflag", NUM), li)


@query("M4_network_shares", SHARES)
def _(spark, d):
    """A network on one 0/1 predictor reaches each group's shares."""
    li = stumps(spark, d)
    return class_shares(models.mlp(hidden_units=0, epochs=60).fit(li, "l_returnflag", ["big"]), li)


@query(
    "M4_network_penalised_regression",
    """with t as (select l_extendedprice as y, l_quantity as x, 1 + 100 * l_tax as w from lineitem), s as (select sum(w * x) / sum(w) as mx, sum(w * y) / sum(w) as my, sum(w * x * x) / sum(w) as xx, sum(w * y * y) / sum(w) as yy, sum(w * x * y) / sum(w) as xy from t)
    select l_linestatus, round(avg(my + (xy - mx * my) / (xx - mx * mx) / (1 + 0.5) * (l_quantity - mx)), 2) as pred, count(*) as n from lineitem, s group by 1""",
)
def _(spark, d):
    """With weights and a penalty of a half, the scaled slope shrinks to its two thirds."""
    li = table(spark, d, "lineitem").withColumn("w", 1 + 100 * F.col("l_tax"))
    p = models.mlp("regression", hidden_units=0, penalty=0.5, epochs=40).fit(li, "l_extendedprice", ["l_quantity"], weight="w").predict(li)
    return rounded(p.groupBy("l_linestatus").agg(F.avg("pred").alias("pred"), F.count(F.lit(1)).alias("n")), "pred", digits=2)


@query("M5_random_forest")
def _(spark, d):
    li = lines(spark, d)
    return class_report(models.rand_forest(trees=10, mtry=2, min_n=5, tree_depth=5).fit(li, "l_returnflag", NUM), li)


@query("M5_random_forest_regression")
def _(spark, d):
    li = lines(spark, d)
    return value_report(models.rand_forest("regression", trees=10, mtry=2, min_n=5, tree_depth=5).fit(li, "l_extendedprice", NUM), li)


# one 0/1 predictor: a round moves a group's value by learn_rate * n / (n + penalty) of what it lacks
STEP = "select {f} as f, l_quantity > 25 as big, count(*) as n, avg({y}) as m from lineitem where {w} group by 1, 2"
PATH = "b.m + (g.m - b.m) * (1 - pow(1 - {eta} * g.n / (g.n + 1.0), {t}))"


@query(
    "M6_boosted_trees",
    f"with g as ({STEP.format(f=1, y='l_extendedprice', w='l_orderkey % 5 <> 0')}), b as (select avg(l_extendedprice) as m from lineitem where l_orderkey % 5 <> 0) select big::int as big, n, round({PATH.format(eta=0.3, t=15)}, 4) as pred from g, b",
)
def _(spark, d):
    """Boosting with a held-out fifth follows its closed form on one predictor."""
    li = stumps(spark, d).withColumn("valid", F.col("l_orderkey") % 5 == 0)
    p = models.boost_tree("regression", trees=15, tree_depth=3, learn_rate=0.3).fit(li, "l_extendedprice", ["big"], valid="valid").predict(li.where("not valid"))
    return rounded(p.groupBy("big").agg(F.count(F.lit(1)).alias("n"), F.avg("pred").alias("pred")), "pred", digits=4)


SOFT = """with n as (select l_quantity > 25 as big, l_returnflag as k, count(*)::double as n from lineitem group by 1, 2), p as (select k, sum(n) / (select sum(n) from n) as p from n group by k),
g as (select n.big, n.k, p.p, ln(p.p) + 0.3 * (n.n - t.t * p.p) / (t.t * 2 * p.p * (1 - p.p) + 1) as m from n join p using (k) join (select big, sum(n) as t from n group by 1) t using (big))
select big::int as big, k as level, round(exp(m) / sum(exp(m)) over (partition by big), 6) as prob from g"""


@query("M6_boosted_trees_multiclass", SOFT)
def _(spark, d):
    """One softmax round: a Newton step of every class's margin from its share."""
    li = stumps(spark, d)
    fit = models.boost_tree(trees=1, tree_depth=3).fit(li, "l_returnflag", ["big"])
    p = fit.predict(li).groupBy("big").agg(*[F.avg(c).alias(v) for v, c in models.prob_columns(fit.levels).items()])
    return rounded(p.unpivot(["big"], fit.levels, "level", "prob"), "prob")


# losses of every round by closed form; the fit ends 2 rounds after the best held-out loss
STOPS = f"""with y as (select l_orderkey % {{v}} as f, l_quantity > 25 as big, {{y}} as y from lineitem), fs as (select distinct f from y), t as (select unnest(range(1, {{most}} + 1)) as t), c as (select unnest({{etas}}) as eta),
g as (select fs.f, y.big, count(*) as n, avg(y) as m from fs join y on y.f <> fs.f group by 1, 2), b as (select fs.f, avg(y) as m from fs join y on y.f <> fs.f group by 1),
q as (select g.f, g.big, c.eta, t.t, {PATH.format(eta='c.eta', t='t.t')} as pred from g join b using (f), c, t),
l as (select q.f, q.eta, q.t, sqrt(avg((y - pred) ** 2) filter (y.f <> q.f)) as trn, sqrt(avg((y - pred) ** 2) filter (y.f = q.f)) as tst from q join y using (big) group by q.f, q.eta, q.t),"""


@query(
    "M6_boosting_stops_early",
    STOPS.format(v=5, y="l_extendedprice", most=12, etas="[0.9]").replace("fs as (select distinct f from y)", "fs as (select 0 as f)")
    + " r as (select t, tst, arg_min(t, tst) over (order by t) as top from l), e as (select coalesce(min(t) filter (t - top >= 2), 12) as e from r) select (max(top) filter (t = e))::int as rounds, count(*)::int as ran, round(min(tst), 4) as loss from r, e where t <= e",
)
def _(spark, d):
    """The held-out fifth ends the fit two rounds after its best."""
    li = stumps(spark, d).withColumn("valid", F.col("l_orderkey") % 5 == 0)
    m = models.boost_tree("regression", trees=12, tree_depth=1, learn_rate=0.9, stop_iter=2).fit(li, "l_extendedprice", ["big"], valid="valid").model
    return rounded(spark.createDataFrame([(len(m.rounds), len(m.history), min(h["loss_tst"] for h in m.history))], "rounds int, ran int, loss double"), "loss", digits=4)


@query("M7_bagged_trees")
def _(spark, d):
    li = lines(spark, d)
    return value_report(models.bag_tree(min_n=10, tree_depth=5, trees=10).fit(li, "l_extendedprice", NUM), li)


@query("M8_hinge_regression")
def _(spark, d):
    li = lines(spark, d)
    return value_report(models.mars(num_terms=12, prod_degree=2).fit(li, "l_extendedprice", NUM), li)


BENT = "select l_orderkey, l_linenumber, 5 + 3 * greatest(l_quantity - 20, 0) - 2 * greatest(35 - l_quantity, 0) + (case when l_tax > 0.03 then 100 * (l_tax - 0.03) else 0 end) as y from lineitem"


@query("M8_hinge_knots", f"select l_orderkey, l_linenumber, round(y, 4) as pred, count(*) as n from ({BENT}) group by 1, 2, 3")
def _(spark, d):
    """Planted knots are found and the noise column dropped, so the fit is the function itself."""
    li = table(spark, d, "lineitem")
    bend = lambda x, k: F.greatest(x - k, F.lit(0.0))
    y = 5 + 3 * bend(F.col("l_quantity"), 20) - 2 * F.greatest(35 - F.col("l_quantity"), F.lit(0.0)) + 100 * bend(F.col("l_tax"), 0.03)
    p = models.mars(num_terms=9).fit(li.withColumn("y", y), "y", ["l_quantity", "l_tax", "l_discount"]).predict(li)
    return rounded(p, "pred", digits=4).groupBy("l_orderkey", "l_linenumber", "pred").agg(F.count(F.lit(1)).alias("n"))


@query("M9_kmeans_feature")
def _(spark, d):
    li = lines(spark, d)
    add = models.kmeans_feature(li.where("l_orderkey % 2 = 0"), NUM, k=3, seed=7)
    return rounded(add(li).groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.avg("l_quantity").alias("q")), "q", digits=3)


@query(
    "M10_case_weights",
    "with w as (select *, case when l_returnflag = 'R' then 3.0 else 1.0 end as w from lineitem), m as (select sum(w * l_quantity) / sum(w) as mx, sum(w * l_extendedprice) / sum(w) as my from w), f as (select sum(w * (l_quantity - mx) * (l_extendedprice - my)) / sum(w * (l_quantity - mx) ** 2) as b from w, m) select round(b, 2) as slope, round(my - b * mx, 1) as intercept from f, m",
)
def _(spark, d):
    li = table(spark, d, "lineitem").withColumn("w", F.when(F.col("l_returnflag") == "R", 3.0).otherwise(1.0))
    fit = models.linear_reg().fit(li, "l_extendedprice", ["l_quantity"], weight="w")
    # slope and intercept as the fitted rows show them
    p = fit.predict(li)
    return p.agg(F.round(F.regr_slope("pred", "l_quantity"), 2).alias("slope"), F.round(F.regr_intercept("pred", "l_quantity"), 1).alias("intercept"))


DIST = "round(sqrt(list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda z: (z[1]::double - z[2]::double) ** 2))), 9)"


@query(
    "M11_nearest_neighbours",
    f"select q_id, r_id, round(d, 5) as d, rk from (select *, row_number() over (partition by q_id order by d, r_id) as rk from (select a.vec_id as q_id, b.vec_id as r_id, {DIST} as d from embeddings a, embeddings b)) where rk <= 5",
)
def _(spark, d):
    e = table(spark, d, "embeddings")
    return rounded(neighbours.knn(e, e, 5, "vec_id", "vec_id", "embedding", "embedding"), "d", digits=5)


@query(
    "M11_neighbour_vote",
    f"with n as (select q_id, r_id from (select *, row_number() over (partition by q_id order by d, r_id) as rk from (select a.vec_id as q_id, b.vec_id as r_id, {DIST} as d from embeddings a, embeddings b where b.vec_id % 2 = 0)) where rk <= 7), v as (select q_id, label, count(*) as v from n join embeddings on r_id = vec_id group by 1, 2) select q_id, label as pred, round(v / 7.0, 6) as prob from (select *, row_number() over (partition by q_id order by v desc, label) as k from v) where k = 1",
)
def _(spark, d):
    e = table(spark, d, "embeddings")
    ref = e.where("vec_id % 2 = 0")
    n = neighbours.knn(e, ref, 7, "vec_id", "vec_id", "embedding", "embedding")
    return rounded(neighbours.knn_predict(n, ref, "vec_id", "label", classify=True), "prob")


@query(
    "M12_predict_on",
    "with f as (select regr_slope(l_extendedprice, l_quantity) as b, regr_intercept(l_extendedprice, l_quantity) as a from lineitem where l_orderkey % 2 = 0) select l_orderkey, count(*) as n, round(sum(a + b * l_quantity), 2) as total from lineitem, f where l_orderkey % 2 = 1 group by 1",
)
def _(spark, d):
    li = table(spark, d, "lineitem")
    p = models.predict_on(models.linear_reg(), li.where("l_orderkey % 2 = 0"), li.where("l_orderkey % 2 = 1"), "l_extendedprice", ["l_quantity"], ["l_orderkey"])
    return rounded(p.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), F.sum("pred").alias("total")), "total", digits=2)


@query("V6_adversarial_validation")
def _(spark, d):
    li = lines(spark, d)
    dr = adversarial.drift(li.where("l_linestatus = 'F'"), li.where("l_linestatus = 'O'"), NUM + ["p_retailprice"], models.rand_forest(trees=5, tree_depth=4))
    kept = adversarial.split_by_likeness(dr.scored, "id").groupBy("is_train").agg(F.count(F.lit(1)).alias("n"))
    return kept.crossJoin(F.broadcast(rounded(dr.auc, "auc", digits=3)))


@query(
    "V6_rank_by_likeness",
    "select o_orderkey, row_number() over (order by o_totalprice desc, o_orderkey) <= floor(0.8 * count(*) over ()) as is_train from orders where o_orderstatus <> 'P'",
)
def _(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice", F.when(F.col("o_orderstatus") == "P", "yes").otherwise("no").alias("is_hold"))
    return adversarial.split_by_likeness(o, "o_orderkey", score="o_totalprice").select("o_orderkey", "is_train")


# ---- tuning -----------------------------------------------------------------


@query("H1_parameter_grid", "select a.size as trees, b.size as mtry from (select distinct p_size * 20 as size from part) a, (select distinct p_size as size from part) b")
def _(spark, d):
    p = table(spark, d, "part")
    trees = p.select((F.col("p_size") * 20).alias("trees"))
    return joins.crossing(trees, p.select(F.col("p_size").alias("mtry")))


@query("H2_space_filling_grid")
def _(spark, d):
    """Bounds close with what the data holds: mtry with the columns, min_n with the smallest class."""
    n = table(spark, d, "lineitem").groupBy("l_returnflag").count().agg(F.min("count")).first()[0]
    r = tune.finalize_mtry({"mtry": (1, None), "min_n": (2, max(3, n // 1000)), "learn_rate": (-3, -1, "log10")}, NUM)
    return rounded(tune.grid_table(spark, tune.latin_hypercube(12, seed=1, **r)), "learn_rate")


@query("H3_tune_grid")
def _(spark, d):
    wf = tune.Workflow(models.linear_reg("classification", epochs=10), "l_linestatus", NUM)
    r = tune.tune_grid(wf, folded(spark, d), tune.crossing(penalty=[0.001, 0.1], mixture=[0.0, 1.0]), "id", ["log_loss", "accuracy", "roc_auc"])
    return rounded(r.metrics, "value", digits=3)


@query(
    "H4_boosting_rounds",
    STOPS.format(v=3, y="l_extendedprice", most=8, etas="[0.3, 0.9]")
    + " m as (select eta, t, avg(trn) as trn, avg(tst) as tst from l group by 1, 2), r as (select *, arg_min(t, tst) over (partition by eta order by t) as top from m), e as (select eta, coalesce(min(t) filter (t - top >= 2), 8) as e from r group by eta), w as (select r.eta, max(top) filter (t = e) as iter, max(e) as ran from r join e using (eta) group by r.eta) select (1 + (w.eta > 0.5)::int)::int as config, iter::int as iter, round(m.trn, 3) as loss_trn, round(m.tst, 3) as loss_tst, ran::int as ran, (round(iter / (2 / 3)) + 2)::int as rounds from w join m on m.eta = w.eta and m.t = w.iter",
)
def _(spark, d):
    """Folds boosted side by side stop together."""
    li = stumps(spark, d).withColumn("fold", F.col("l_orderkey") % 3)
    t = tune.tune_boost_rounds(models.boost_tree("regression", trees=8, tree_depth=1), li, [{"learn_rate": 0.3}, {"learn_rate": 0.9}], "l_extendedprice", ["big"], early_stop=2)
    return rounded(t, "loss_trn", "loss_tst", digits=3)


METRIC = "(select cast(substr(o_orderpriority, 1, 1) as int) as config, (o_custkey % 6)::int as fold, 'rmse' as metric, avg(o_totalprice) / 1000 as value from orders group by 1, 2)"


def metric_table(spark, d):
    """A table of the shape tuning gives: five configurations by six folds."""
    o = table(spark, d, "orders").groupBy(F.substring("o_orderpriority", 1, 1).cast("int").alias("config"), (F.col("o_custkey") % 6).cast("int").alias("fold"))
    return o.agg((F.avg("o_totalprice") / 1000).alias("value")).withColumn("metric", F.lit("rmse"))


@query(
    "H5_race_elimination",
    f"with m as {METRIC}, l as (select config from m group by 1 order by avg(value), config limit 1), b as (select fold, value as best from m where config = (select config from l)), d as (select config, avg(value - best) as diff, count(*) as n, stddev_samp(value - best) / sqrt(count(*)) as se from m join b using (fold) group by 1) select config, round(diff, 6) as diff, n, round(diff - 2.015048372669157 * se, 4) as lower, diff - 2.015048372669157 * se <= 0 as stays from d",
)
def _(spark, d):
    r = tune.race_step(metric_table(spark, d), "rmse", alpha=0.05)
    return r.select("config", F.round("diff", 6).alias("diff"), "n", F.round("lower", 4).alias("lower"), "stays")


@query("H5_race")
def _(spark, d):
    wf = tune.Workflow(models.rand_forest("regression", trees=3, min_n=5), "l_extendedprice", NUM)
    r = tune.tune_race(wf, folded(spark, d, 5), [{"tree_depth": 1}, {"tree_depth": 4}], "id", "rmse")
    return rounded(tune.collect_metrics(r.metrics), "mean", "std_err", digits=0)


@query("H6_annealing")
def _(spark, d):
    wf = tune.Workflow(models.linear_reg(epochs=10, mixture=0.0), "l_extendedprice", NUM)
    best, log = tune.tune_anneal(wf, folded(spark, d), {"penalty": 50.0}, {"penalty": (0.0, 100.0)}, "id", "rmse", iters=3)
    out = spark.createDataFrame([(r["iter"], float(r["penalty"]), float(r["value"]), r["penalty"] == best["penalty"]) for r in log], "iter int, penalty double, value double, is_best boolean")
    return rounded(out, "penalty", "value", digits=2)


@query("H7_workflow_set")
def _(spark, d):
    from tabkit.features.recipe import Recipe, all_numeric_predictors
    from tabkit.features.steps import StepNormalize

    li = folded(spark, d).select("id", "fold", *NUM, "l_extendedprice")
    rec = Recipe("l_extendedprice", ids=["id", "fold"]).add(StepNormalize(all_numeric_predictors()))
    wfs = tune.workflow_set("l_extendedprice", {"plain": ["l_quantity"], "scaled": rec}, {"lm": models.linear_reg(), "tree": models.rand_forest("regression", trees=3, tree_depth=4)})
    r = tune.workflow_map(wfs, li, {}, "id", ["rmse", "rsq"])
    return rounded(tune.rank_results(r.metrics, "rmse", ["wflow_id", "config"]), "mean", "std_err", digits=2)


@query("H8_collect_metrics", f"select config, metric, round(avg(value), 6) as mean, count(*) as n, round(stddev_samp(value) / sqrt(count(*)), 6) as std_err from {METRIC} group by 1, 2")
def _(spark, d):
    return rounded(tune.collect_metrics(metric_table(spark, d)), "mean", "std_err")


@query("H9_show_best", f"select config, round(avg(value), 6) as mean, row_number() over (order by avg(value), config) as rank from {METRIC} group by 1 order by 3 limit 3")
def _(spark, d):
    return tune.show_best(metric_table(spark, d), "rmse", 3).select("config", F.round("mean", 6).alias("mean"), F.col("rank").cast("long").alias("rank"))


@query("H10_finalize_last_fit")
def _(spark, d):
    li = stage(resample.initial_split(lines(spark, d), "id", 0.75))
    wf = tune.Workflow(models.linear_reg(), "l_extendedprice", NUM + ["p_retailprice"])
    _, test = tune.last_fit(wf, li, {"penalty": 0.1})
    return rounded(metrics.evaluate(test, "l_extendedprice", "pred", ["rmse", "rsq"]), "value", digits=3)


@query("H10_tune_and_submit")
def _(spark, d):
    li = lines(spark, d)
    wf = tune.Workflow(models.linear_reg("classification", epochs=10), "l_linestatus", NUM)
    _, sub = runs.tune_and_submit(wf, li.where("l_orderkey % 4 > 0"), li.where("l_orderkey % 4 = 0"), [{"penalty": 0.01}, {"penalty": 0.5}], "id", "log_loss", "is_open", v=3)
    return rounded(sub, "is_open", digits=3)


@query("E8_evaluate_fit")
def _(spark, d):
    li = lines(spark, d)
    fit = models.linear_reg("classification", epochs=20).fit(li.where("l_orderkey % 3 > 0"), "l_returnflag", NUM)
    return rounded(runs.evaluate_classes(fit, li.where("l_orderkey % 3 = 0"), "l_returnflag").metrics, "value", digits=3)


# ---- explanation ------------------------------------------------------------


@query("I1_importance")
def _(spark, d):
    fit = models.rand_forest("regression", trees=5, tree_depth=4).fit(lines(spark, d), "l_extendedprice", NUM)
    return rounded(explain.importance(fit, spark), "importance", digits=3)


@query("I1_permutation_importance")
def _(spark, d):
    li = stage(lines(spark, d))
    fit = models.linear_reg().fit(li, "l_extendedprice", NUM)
    return rounded(explain.permutation_importance(fit, li, "id", metrics.rmse("l_extendedprice", "pred"), True), "importance", digits=0)


@query(
    "I1_permutation_of_one_feature",
    f"with r as (select p_size, p_retailprice as y, row_number() over (order by md5(concat('0-', p_partkey)), p_partkey) - 1 as pos, count(*) over () as n from part), f as (select regr_slope(y, p_size) as b, regr_intercept(y, p_size) as a from r), m as (select (pos + 1 + {explain.shift_of(0, 'p_size')} % (n - 1)) % n as pos, p_size from r) select 'p_size' as feature, round(sqrt(avg((r.y - a - b * m.p_size) ** 2)) - sqrt(avg((r.y - a - b * r.p_size) ** 2)), 4) as importance from r join m using (pos), f",
)
def _(spark, d):
    """Values move along the hash order of the ids by a step that hangs on seed and name."""
    p = table(spark, d, "part")
    fit = models.linear_reg().fit(p, "p_retailprice", ["p_size"])
    return rounded(explain.permutation_importance(fit, p, "p_partkey", metrics.rmse("p_retailprice", "pred"), True), "importance", digits=4)


@query("I2_shapley_monte_carlo", "with f as (select regr_slope(l_extendedprice, l_quantity) as b, regr_intercept(l_extendedprice, l_quantity) as a from lineitem) select l_orderkey, l_linenumber, round(a + b * l_quantity, 2) as total from lineitem, f")
def _(spark, d):
    """Values and baseline of each row add up to its prediction."""
    key = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate")
    # 80 bits stand for the key, which is several times as long
    li = table(spark, d, "lineitem").withColumn("id", F.substring(F.unhex(F.md5(key)), 1, 10))
    fit = models.linear_reg().fit(li, "l_extendedprice", ["l_quantity"])
    phi = explain.shapley(fit.predict, li, li, ["l_quantity"], "id", nsim=3)
    total = F.round(F.col("phi") + F.col("baseline"), 2).alias("total")
    out = li.select("id", "l_orderkey", "l_linenumber").join(phi.withColumnRenamed("l_quantity", "phi").select("id", total), "id")
    return out.select("l_orderkey", "l_linenumber", "total")


@query(
    "I2_shapley_three_features",
    "select p_partkey, round((2 * p_size + 3 * (p_partkey % 7) + (case when p_type like 'S%' then 10 else 0 end))::double, 6) as total, 0.0::double as off from part",
)
def _(spark, d):
    """Three features of a linear function: values and baseline add up, and every value is its weight times the distance from a mean of background rows."""
    p = table(spark, d, "part").select("p_partkey", F.col("p_size").cast("double").alias("a"), (F.col("p_partkey") % 7).cast("double").alias("b"), F.col("p_type").startswith("S").cast("double").alias("c"))
    weights = {"a": 2.0, "b": 3.0, "c": 10.0}
    score = lambda df: df.withColumn("pred", sum((F.lit(w) * F.col(f) for f, w in weights.items()), F.lit(0.0)))
    phi = explain.shapley(score, p, p, list(weights), "p_partkey", nsim=4).withColumnsRenamed({f: f"phi_{f}" for f in weights})
    total = F.col("baseline") + sum((F.col(f"phi_{f}") for f in weights), F.lit(0.0))
    # each value tells the same mean background row: their sum is the baseline
    mean = sum((F.lit(w) * F.col(f) - F.col(f"phi_{f}") for f, w in weights.items()), F.lit(0.0))
    return p.join(phi, "p_partkey").select("p_partkey", F.round(total, 6).alias("total"), (F.round(F.abs(mean - F.col("baseline")), 6) + 0.0).alias("off"))


def binary_means(spark, d):
    return table(spark, d, "part").select("p_partkey", (F.col("p_size") % 2).cast("double").alias("a"), (F.col("p_partkey") % 2).cast("double").alias("b"), F.lit(1.0).alias("c"))


@query(
    "I2_shapley_of_one_background_row",
    "select p_partkey, 5.0 * (p_size % 2) as a, 7.0 * (p_partkey % 2) + 2 * (p_partkey % 2) * (p_size % 2) / 2 as b, 0.0::double as c, 4.0::double as baseline from part",
)
def _(spark, d):
    """Against one background row of zeros: weights, halves of the product, nothing for a constant. The order of features is drawn, so the halves hold over all rows alike."""
    p = binary_means(spark, d)
    zero = spark.createDataFrame([(0, 0.0, 0.0, 1.0)], "p_partkey long, a double, b double, c double")
    score = lambda df: df.withColumn("pred", 4 + 5 * F.col("a") + 7 * F.col("b") + 2 * F.col("a") * F.col("b"))
    phi = explain.shapley(score, p, zero, ["a", "b", "c"], "p_partkey", nsim=2)
    both = (F.col("xa") * F.col("xb") == 1.0)
    j = p.select("p_partkey", F.col("a").alias("xa"), F.col("b").alias("xb")).join(phi, "p_partkey")
    # the product goes whole to whichever of the two comes later in a draw; what a has of it is moved to b's half
    extra = F.when(both, F.col("a") - 5).otherwise(0.0)
    return j.select("p_partkey", (F.col("a") - extra).alias("a"), (F.col("b") + extra - F.when(both, 1.0).otherwise(0.0)).alias("b"), (F.col("c") + 0.0).alias("c"), "baseline")


TWO = "select l_quantity > 25 as a, l_tax > 0.04 as b, 10 * l_quantity + 40 * (l_tax > 0.04)::int + 30 * (l_tax > 0.04 and l_quantity > 25)::int as y from lineitem"


@query(
    "I3_tree_contributions",
    f"with t as ({TWO}), g as (select a, b, count(*) as n, avg(y) as m from t group by 1, 2), z as (select avg(y) as v0 from t), v as (select g.*, sum(n * m) over (partition by a) / sum(n) over (partition by a) as va, v0 from g, z), w as (select b, sum(m * p) as vb from (select g.b, g.m, (select sum(n) from g x where x.a = g.a) / (select sum(n) from g) as p from g) group by b) select a::double as a, b::double as b, n, round(((va - v0) + (m - vb)) / 2, 4) as phi_a, round(((vb - v0) + (m - va)) / 2, 4) as phi_b, round(v0, 4) as baseline, round(m, 4) as total from v join w using (b)",
)
def _(spark, d):
    """A tree that holds every group of two predictors: the values are those of all subsets of known predictors."""
    li = lines(spark, d).withColumns({"a": (F.col("l_quantity") > 25).cast("double"), "b": (F.col("l_tax") > 0.04).cast("double")})
    li = li.withColumn("y", 10 * F.col("l_quantity") + 40 * F.col("b") + 30 * F.col("a") * F.col("b"))
    fit = models.boost_tree("regression", trees=1, tree_depth=2, learn_rate=1.0, penalty=0.0).fit(li, "y", ["a", "b"])
    phi = tree_contributions(fit, li, "id").withColumnsRenamed({"a": "phi_a", "b": "phi_b"})
    g = li.select("id", "a", "b").join(phi, "id").withColumn("total", F.col("phi_a") + F.col("phi_b") + F.col("baseline"))
    g = g.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(c) for c in ("phi_a", "phi_b", "baseline", "total")])
    return rounded(g, "phi_a", "phi_b", "baseline", "total", digits=4)


@query("I3_forest_contributions", "select p_partkey, 0.0::double as off from part")
def _(spark, d):
    """Values and baseline of a forest add up to its prediction, row by row."""
    p = table(spark, d, "part").withColumns({"p_size": F.col("p_size").cast("double"), "brand": F.substring("p_brand", 7, 2).cast("double")})
    fit = models.rand_forest("regression", trees=5, tree_depth=4, seed=3).fit(p, "p_retailprice", ["p_size", "brand"])
    phi = tree_contributions(fit, p, "p_partkey").select("p_partkey", (F.col("p_size") + F.col("brand") + F.col("baseline")).alias("total"))
    out = fit.predict(p).select("p_partkey", "pred").join(phi, "p_partkey")
    return out.select("p_partkey", (F.abs(F.round(F.col("pred") - F.col("total"), 6)) + 0.0).alias("off"))


@query("I4_linear_shapley", "select c_custkey, round(2.5 * (c_acctbal - avg(c_acctbal) over ()), 4) as c_acctbal, round(-3.0 * (c_nationkey - avg(c_nationkey) over ()), 6) as c_nationkey from customer")
def _(spark, d):
    s = explain.linear_shapley(table(spark, d, "customer"), {"c_acctbal": 2.5, "c_nationkey": -3.0}, "c_custkey")
    return s.select("c_custkey", F.round("c_acctbal", 4).alias("c_acctbal"), F.round("c_nationkey", 6).alias("c_nationkey"))


@query(
    "I5_global_importance",
    "with c as (select c_acctbal - avg(c_acctbal) over () as c_acctbal, 10 * (c_nationkey - avg(c_nationkey) over ()) as c_nationkey from customer), l as (select 'c_acctbal' as feature, avg(abs(c_acctbal)) as importance from c union all select 'c_nationkey', avg(abs(c_nationkey)) from c) select feature, round(importance, 4) as importance, row_number() over (order by importance desc) as rnk from l",
)
def _(spark, d):
    s = explain.linear_shapley(table(spark, d, "customer"), {"c_acctbal": 1.0, "c_nationkey": 10.0}, "c_custkey")
    return rounded(explain.global_importance(s, ["c_acctbal", "c_nationkey"]), "importance", digits=4)


# ---- ensembling -------------------------------------------------------------

OOF = "(select o_orderkey, config, o_totalprice as truth, (o_custkey % 3)::int as fold, o_totalprice * (1 + (config - 2) * 0.1) + (o_custkey * config) % 1000 as pred from orders, (values (1), (2), (3)) c(config))"


def oof(spark, d):
    o = table(spark, d, "orders").withColumn("config", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))))
    pred = F.col("o_totalprice") * (1 + (F.col("config") - 2) * 0.1) + (F.col("o_custkey") * F.col("config")) % 1000
    return o.select("o_orderkey", "config", F.col("o_totalprice").alias("truth"), (F.col("o_custkey") % 3).cast("int").alias("fold"), pred.alias("pred"))


@query("B1_candidates", f"select o_orderkey, round(any_value(truth), 4) as truth, round(max(pred) filter (config = 1), 4) as cand_1, round(max(pred) filter (config = 2), 4) as cand_2, round(max(pred) filter (config = 3), 4) as cand_3 from {OOF} group by 1")
def _(spark, d):
    c = ensemble.candidates(oof(spark, d), "o_orderkey", "truth", [1, 2, 3])
    return rounded(c, "truth", "cand_1", "cand_2", "cand_3", digits=4)


@query("B2_blend")
def _(spark, d):
    c = stage(ensemble.candidates(oof(spark, d), "o_orderkey", "truth", [1, 2, 3], keep=["fold"]))
    return rounded(ensemble.weights_table(spark, ensemble.blend(c, "truth", ["cand_1", "cand_2", "cand_3"])), "weight", digits=4)


@query("B3_weighted_sum", f"select o_orderkey, round(5 + 0.25 * max(pred) filter (config = 1) + 0.75 * max(pred) filter (config = 3), 4) as pred from {OOF} group by 1")
def _(spark, d):
    c = ensemble.candidates(oof(spark, d), "o_orderkey", "truth", [1, 2, 3])
    return rounded(ensemble.blend_predict(c, {"cand_1": 0.25, "cand_2": 0.0, "cand_3": 0.75}, 5.0).select("o_orderkey", "pred"), "pred", digits=4)


@query("B3_stack")
def _(spark, d):
    li = folded(spark, d).select("id", "fold", *NUM, "p_retailprice", "l_extendedprice")
    wf = tune.Workflow(models.linear_reg(), "l_extendedprice", NUM + ["p_retailprice"])
    grid = [{"penalty": 0.0}, {"penalty": 5000.0}]
    r = tune.tune_grid(wf, li, grid, "id", ["rmse"])
    st = runs.stack(r, {i + 1: (lambda g=g: wf.set(**g).fit(li)) for i, g in enumerate(grid)}, "id", "l_extendedprice")
    p = st.predict(li, "id").join(li.select("id", "l_extendedprice"), "id")
    return rounded(metrics.evaluate(p, "l_extendedprice", "pred", ["rmse", "rsq"]), "value", digits=3)


@query("B3_stack_classes", SHARES)
def _(spark, d):
    """Members that each reach the shares of two groups blend to those shares, whatever their weights."""
    li = stage(stumps(spark, d).select("id", "big", "l_returnflag", (F.col("l_orderkey") % 3).alias("fold")))
    wf = tune.Workflow(models.linear_reg("classification"), "l_returnflag", ["big"])
    grid = [{"epochs": 60}, {"epochs": 100}]
    r = tune.tune_grid(wf, li, grid, "id", ["log_loss"])
    st = runs.stack_classes(r, {i + 1: (lambda g=g: wf.set(**g).fit(li)) for i, g in enumerate(grid)}, "id", "l_returnflag", ["A", "N", "R"])
    p = st.predict(li, "id").join(li.select("id", "big"), "id").groupBy("big").agg(*[F.avg(c).alias(v) for v, c in st.probs.items()])
    return rounded(p.unpivot(["big"], ["A", "N", "R"], "level", "prob"), "prob", digits=4)


@query("X3_group_tables", "select o_custkey, min(o_orderkey) as first_key, max(o_orderkey) as last_key, count(*) as n from orders group by 1")
def _(spark, d):
    import pandas as pd

    def span(p):
        return pd.DataFrame({"o_custkey": [p["o_custkey"].iloc[0]], "first_key": [p["o_orderkey"].min()], "last_key": [p["o_orderkey"].max()], "n": [len(p)]})

    o = table(spark, d, "orders").select("o_custkey", "o_orderkey")
    return udf.map_groups(o, ["o_custkey"], span, "o_custkey long, first_key long, last_key long, n long")


@query(
    "M11_neighbour_model",
    "with e as (select *, vec_id % 3 as fold, case label % 3 when 0 then 'a' when 1 then 'b' else 'c' end as y, embedding[1]::double as x1, embedding[2]::double as x2 from embeddings), "
    "n as (select q.vec_id, r.y as vote, row_number() over (partition by q.vec_id order by round(sqrt((q.x1 - r.x1) ** 2 + (q.x2 - r.x2) ** 2), 9), r.vec_id) as k from e q join e r on q.fold <> r.fold), "
    "v as (select vec_id, vote, count(*) as c from n where k <= 5 group by 1, 2), p as (select vec_id, vote, row_number() over (partition by vec_id order by c desc, vote) as k from v) "
    "select e.fold::int as fold, round(avg((p.vote = e.y)::int), 3) as accuracy from e join p using (vec_id) where k = 1 group by 1",
)
def _(spark, d):
    """Neighbours tuned like any other model; distances between random vectors have no ties."""
    y = F.when(F.col("label") % 3 == 0, "a").when(F.col("label") % 3 == 1, "b").otherwise("c")
    e = table(spark, d, "embeddings").select("vec_id", (F.col("vec_id") % 3).cast("int").alias("fold"), y.alias("y"), F.col("embedding")[0].cast("double").alias("x1"), F.col("embedding")[1].cast("double").alias("x2"))
    r = tune.tune_grid(tune.Workflow(models.nearest_neighbor(), "y", ["x1", "x2"]), e, [{"neighbors": 5}], "vec_id", ["accuracy"])
    return r.metrics.select("fold", F.round("value", 3).alias("accuracy"))


@query(
    "B2_blend_classes",
    "with m as (select event_id, case when event_id % 5 < 2 then 'x' else 'y' end as y, unnest([1, 2]) as config from events), "
    "p as (select event_id, y, config, case when config = 1 then 0.4 else case when event_id % 5 < 2 then 0.9 else 0.3 end end as px from m) "
    "select config, case config when 1 then 0.0 else 1.0 end as weight, round((select avg(-ln(case when y = 'x' then px else 1 - px end)) from p where config = 2), 6) as log_loss from (select distinct config from p)",
)
def _(spark, d):
    """Of a member that knows the shares only and a sharper one the blend keeps the sharper."""
    e = table(spark, d, "events").select("event_id", F.when(F.col("event_id") % 5 < 2, "x").otherwise("y").alias("y"), F.explode(F.array(F.lit(1), F.lit(2))).alias("config"))
    px = F.when(F.col("config") == 1, 0.4).when(F.col("y") == "x", 0.9).otherwise(0.3)
    oof = e.withColumn("prob_x", px).withColumn("prob_y", 1 - F.col("prob_x"))
    fit = ensemble.blend_classes(oof, "event_id", "y", {"x": "prob_x", "y": "prob_y"}, [1, 2])
    rows = [(c, round(w, 3), round(fit["log_loss"], 6)) for c, w in fit["weights"].items()]
    return spark.createDataFrame(rows, "config int, weight double, log_loss double")
