"""Exact top-k search by inner product: a ball tree per shard, branch and bound, a shared k-th score."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabkit.llm.vectors import blob, matrix, unblob, whole
from tabkit.session import stage

SHARD_ROWS, QUERY_ROWS, LEAF_ROWS = 8192, 1024, 256
EXACT = 2.0**53


def ball_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row order, from, to, centre, radius) of nodes in heap order: children of i are 2i+1 and 2i+2.

    A node is cut at the median along the line between two far points of it.
    """
    n = len(x)
    depth = max(0, int(np.ceil(np.log2(max(n, 1) / LEAF_ROWS))))
    nodes = 2 ** (depth + 1) - 1
    order = np.arange(n)
    lo, hi = np.zeros(nodes, dtype=np.int64), np.zeros(nodes, dtype=np.int64)
    centre, radius = np.zeros((nodes, x.shape[1])), np.zeros(nodes)
    hi[0] = n
    for i in range(nodes):
        rows = x[order[lo[i] : hi[i]]]
        if len(rows):
            centre[i] = rows.mean(axis=0)
            away = np.sqrt(((rows - centre[i]) ** 2).sum(axis=1))
            radius[i] = away.max() * (1 + 1e-9)
        if 2 * i + 2 < nodes:
            mid = (lo[i] + hi[i]) // 2
            if len(rows):
                a = rows[away.argmax()]
                b = rows[((rows - a) ** 2).sum(axis=1).argmax()]
                cut = np.argsort(rows @ (b - a), kind="stable")
                order[lo[i] : hi[i]] = order[lo[i] : hi[i]][cut]
            lo[2 * i + 1], hi[2 * i + 1], lo[2 * i + 2], hi[2 * i + 2] = lo[i], mid, mid, hi[i]
    return order, lo, hi, centre, radius


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Whole-number inner products, exact: doubles below 2**53, else Python's integers."""
    if not q.size or not x.size:
        return np.zeros((len(q), len(x)))
    if np.abs(q).max() * np.abs(x).max() * q.shape[1] < EXACT:
        return q @ x.T
    whole = lambda a: np.array([[int(v) for v in row] for row in a], dtype=object)
    return whole(q) @ whole(x).T


class Best:
    """The k best (score, id) per query so far; floor is the k-th score, below which nothing can enter."""

    def __init__(self, queries: int, k: int, floor: np.ndarray):
        self.k, self.floor = k, floor
        self.q, self.id, self.s = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)

    def add(self, q: np.ndarray, ids: np.ndarray, s: np.ndarray) -> None:
        q, ids, s = np.concatenate([self.q, q]), np.concatenate([self.id, ids]), np.concatenate([self.s, s])
        order = np.lexsort((ids, -s, q))
        q, ids, s = q[order], ids[order], s[order]
        new = np.ones(len(q), dtype=bool)
        new[1:] = q[1:] != q[:-1]
        first = np.flatnonzero(new)
        rank = np.arange(len(q)) - np.repeat(first, np.diff([*first, len(q)]))
        at_k = rank == self.k - 1
        self.floor[q[at_k]] = np.maximum(self.floor[q[at_k]], s[at_k].astype(np.float64))
        keep = (rank < self.k) & (s >= self.floor[q])
        self.q, self.id, self.s = q[keep], ids[keep], s[keep]


def search(q_ids: np.ndarray, q: np.ndarray, floor: np.ndarray, ids: np.ndarray, x: np.ndarray, tree, k: int) -> Best:
    """Branch and bound for a block of queries: the node with the highest bound above some query's k-th score comes first.

    floor holds each query's best known k-th score from other shards. A query
    leaves a branch as soon as centre . q + radius * |q| is under its floor;
    equal scores stay, since a smaller id may win the tie.
    """
    order, lo, hi, centre, radius = tree
    best = Best(len(q), k, floor.copy())
    size = np.sqrt((q**2).sum(axis=1))
    far = float(np.abs(x).max(initial=0)) * max(1, q.shape[1])
    slack = 1e-9 * (1 + size * far)

    def bound(node: int, rows: np.ndarray) -> np.ndarray:
        return q[rows] @ centre[node] + radius[node] * size[rows] + slack[rows]

    every = np.arange(len(q))
    todo: list[tuple[float, int, np.ndarray]] = []

    def push(node: int, rows: np.ndarray) -> None:
        if hi[node] > lo[node] and len(rows):
            b = bound(node, rows)
            live = b >= best.floor[rows]
            if live.any():
                heapq.heappush(todo, (-float((b[live]).max()), node, rows[live]))

    push(0, every)
    while todo:
        _, node, rows = heapq.heappop(todo)
        if 2 * node + 2 < len(lo):
            push(2 * node + 1, rows)
            push(2 * node + 2, rows)
            continue
        rows = rows[bound(node, rows) >= best.floor[rows]]
        if not len(rows):
            continue
        at = order[lo[node] : hi[node]]
        s = _products(q[rows], x[at])
        r, c = np.nonzero((s >= best.floor[rows][:, None]) & (q_ids[rows][:, None] != ids[at][None, :]))
        best.add(rows[r], ids[at][c], s[r, c])
    return best


def top_k(df: DataFrame, is_query: Column, k: int = 20, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k highest inner products, ties to the smaller id.

    Vectors are taken as given; cast them beforehand (see whole_numbers).
    Candidates are hashed into shards of about SHARD_ROWS rows, each with its
    own ball tree in one stored row; queries into blocks of QUERY_ROWS. A block
    first searches one shard; its k-th scores then travel with it to all other
    shards and cut their branches. Work is one task per (block, shard).

    Vectors that are null or hold null or non-finite components, and rows
    without an id, take no part. Rows with an equal id count once (the smallest
    vector). Vectors of different length do not meet. A query with fewer
    candidates gets them all. is_query is a condition on the input's columns.
    """
    base = df.where(whole(vector) & F.col(id_column).isNotNull())
    base = base.select(F.col(id_column).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"), is_query.alias("is_query"))
    base = base.groupBy("id").agg(F.min("v").alias("v"), F.max("is_query").alias("is_query")).withColumn("dim", F.size("v").cast("long"))
    base = stage(base)
    sizes = base.agg(F.count(F.lit(1)), F.sum(F.col("is_query").cast("long"))).first()
    shards, blocks = max(1, -(-sizes[0] // SHARD_ROWS)), max(1, -(-(sizes[1] or 0) // QUERY_ROWS))

    def build(key: tuple, t: pa.Table) -> pa.Table:
        dim, shard = key[0].as_py(), key[1].as_py()
        x, ids = matrix(t["v"].combine_chunks(), dim), t["id"].to_numpy()
        order, lo, hi, centre, radius = ball_tree(x)
        return pa.table({"dim": [dim], "shard": [shard], "ids": [blob(ids)], "x": [blob(x)], "tree": [[blob(order), blob(lo), blob(hi), blob(centre), blob(radius)]]})

    index = base.select("id", "v", "dim", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("long").alias("shard"))
    index = stage(index.groupBy("dim", "shard").applyInArrow(build, "dim long, shard long, ids binary, x binary, tree array<binary>"))

    def pack(key: tuple, t: pa.Table) -> pa.Table:
        dim, block = key[0].as_py(), key[1].as_py()
        x, ids = matrix(t["v"].combine_chunks(), dim), t["id"].to_numpy()
        return pa.table({"dim": [dim], "block": [block], "home": [block % shards], "q_ids": [blob(ids)], "q": [blob(x)], "floor": [blob(np.full(len(ids), -np.inf))]})

    asked = base.where("is_query").select("id", "v", "dim", F.pmod(F.xxhash64("id", F.lit(7)), F.lit(blocks)).cast("long").alias("block"))
    asked = stage(asked.groupBy("dim", "block").applyInArrow(pack, "dim long, block long, home long, q_ids binary, q binary, floor binary"))

    def find(it: Iterator[pa.RecordBatch], keep_block: bool) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for row in range(batch.num_rows):
                g = {name: batch.column(name)[row].as_py() for name in batch.schema.names}
                dim = g["dim"]
                q_ids, ids = unblob(g["q_ids"], np.int64), unblob(g["ids"], np.int64)
                q, x = unblob(g["q"], np.float64, len(q_ids), dim), unblob(g["x"], np.float64, len(ids), dim)
                order, lo, hi = (unblob(b, np.int64) for b in g["tree"][:3])
                tree = (order, lo, hi, unblob(g["tree"][3], np.float64, len(lo), dim), unblob(g["tree"][4], np.float64))
                best = search(q_ids, q, unblob(g["floor"], np.float64), ids, x, tree, k)
                found = [{"query_id": int(a), "vec_id": int(b), "score": int(s)} for a, b, s in zip(q_ids[best.q], best.id, best.s)]
                if keep_block:
                    own = {n: [g[n]] for n in ("dim", "block", "home", "q_ids", "q")}
                    yield pa.RecordBatch.from_pydict(own | {"floor": [blob(best.floor)], "found": pa.array([found], type=FOUND)}, schema=FIRST)
                else:
                    yield pa.RecordBatch.from_arrays([pa.array([f[n] for f in found], type=pa.int64()) for n in ("query_id", "vec_id", "score")], ["query_id", "vec_id", "score"])

    first = asked.join(index.withColumnRenamed("shard", "home"), ["dim", "home"], "left").where("ids is not null")
    first = stage(
        first.repartition(F.col("block"), F.col("dim"))
        .mapInArrow(lambda it: find(it, True), "dim long, block long, home long, q_ids binary, q binary, floor binary, found array<struct<query_id:bigint,vec_id:bigint,score:bigint>>")
    )
    # a block whose home shard holds no vector of its length still visits the others
    rest = asked.join(first.select("dim", "block"), ["dim", "block"], "left_anti").withColumn("home", F.lit(-1).cast("long"))
    tours = first.drop("found").unionByName(rest).withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long")))).where("shard <> home")
    tours = tours.join(index, ["dim", "shard"]).repartition(F.col("block"), F.col("shard"), F.col("dim"))
    later = tours.mapInArrow(lambda it: find(it, False), "query_id long, vec_id long, score long")
    every = first.select(F.inline("found")).unionByName(later)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


FOUND = pa.list_(pa.struct([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())]))
FIRST = pa.schema([("dim", pa.int64()), ("block", pa.int64()), ("home", pa.int64()), ("q_ids", pa.binary()), ("q", pa.binary()), ("floor", pa.binary()), ("found", FOUND)])


def whole_numbers(df: DataFrame, vector: str = "embedding", times: int = 64) -> DataFrame:
    """Each component x becomes floor(times * x), computed in double precision; null and non-finite ones stay as they are."""
    def step(x: Column) -> Column:
        y = F.lit(float(times)) * x
        # from 2**53 on a double is a whole number already
        return F.when(F.isnan(y) | (F.abs(y) >= EXACT), y).otherwise(F.floor(y).cast("double"))

    return df.withColumn(vector, F.transform(F.col(vector).cast("array<double>"), step))
