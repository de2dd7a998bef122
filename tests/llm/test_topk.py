import numpy as np
from pyspark.sql import functions as F

from tabkit.llm import topk


def brute(rows, k):
    good = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            good[i] = min(good.get(i, v), v)
    out = []
    for q, a in good.items():
        if q % 2:
            continue
        s = sorted((-sum(int(x * y) for x, y in zip(a, b)), c) for c, b in good.items() if c != q and len(a) == len(b))[:k]
        out += [(q, r + 1, c, -p) for r, (p, c) in enumerate(s)]
    return sorted(out)


def test_top_k_is_exact_with_ties_nulls_copies_and_lengths(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 40)
    monkeypatch.setattr(topk, "QUERY_ROWS", 16)
    monkeypatch.setattr(topk, "LEAF_ROWS", 8)
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 4)]) for i in range(200)]
    rows += [(300, None), (301, [1.0, None, 0.0, 0.0]), (302, [1.0, float("nan"), 0.0, 0.0]), (303, [float("inf")] * 4), (304, [2.0, 1.0]), (306, [1.0, 1.0]), (None, [1.0] * 4), (7, rows[7][1]), (8, [-9.0] * 4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit("clash")).withColumn("score", F.lit(1))
    got = sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") % 2 == 0, k=5).collect())
    assert got == brute(rows, 5)


def test_large_products_stay_exact_and_empty_input_gives_no_rows(spark):
    big = float(2**40)
    rows = [(0, [big, 1.0]), (1, [big, 3.0]), (2, [1.0, 5.0]), (4, [float(2**20), 0.0])]
    df = spark.createDataFrame(rows[:1] + rows[2:], "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") == 0, k=3).collect())
    assert got == [(0, 1, 4, 2**60), (0, 2, 2, 2**40 + 5)]
    assert topk.top_k(df.where("vec_id < 0"), F.lit(True)).count() == 0


def test_whole_numbers(spark):
    df = spark.createDataFrame([([0.5, -0.01, 1e300, None, float("nan")],), (None,)], "embedding array<double>")
    got = [r[0] for r in topk.whole_numbers(df).collect()]
    assert got[0][:2] == [32.0, -1.0] and got[0][2] == 6.4e301 and got[0][3] is None and np.isnan(got[0][4]) and got[1] is None


def test_bounds_cut_branches(monkeypatch):
    monkeypatch.setattr(topk, "LEAF_ROWS", 32)  # leaves well under the 600 rows of a cluster
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(size=(600, 8)) + 40 * np.eye(8)[i % 8] for i in range(8)])
    tree = topk.ball_tree(x)
    seen = []
    old = topk._products
    topk._products = lambda q, y: seen.append(len(y)) or old(q, y)
    try:
        topk.search(np.array([-1]), x[:1], np.array([-np.inf]), np.arange(len(x)), x, tree, 5)
    finally:
        topk._products = old
    assert sum(seen) < len(x) / 2
