"""Mixing sources to target weights: cube-method balanced sampling, block by block, level by level."""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabkit.scale import broadcast_if_small, join_null_safe, row_numbers, running
from tabkit.session import stage

BLOCK_ROWS = 1024
EPS = 1e-9


def n_words(text: str) -> Column:
    """Number of words [^\\x20\\x09-\\x0D]+; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3) -> DataFrame:
    """source, source_size, target per distinct source.

    Sources by code point, null last, get the weights in turn. The whole size
    is shared by weight; a target stops at most * its source's size and the
    excess goes to the others by weight. That is min(cap, level * weight) for
    one level, found from running sums over the sources ordered by
    cap / weight, so any number of sources is fine.
    """
    s = stage(sized.groupBy("source").agg(F.sum("size").alias("source_size")))
    s = row_numbers(s, None, [F.col("source").asc_nulls_last()], "rank")
    turn = F.array(*[F.lit(float(w)) for w in weights])
    s = s.withColumn("w", F.get(turn, F.pmod(F.col("rank") - 1, F.lit(len(weights))).cast("int"))).withColumn("cap", (F.col("source_size") * most).cast("double"))
    ran = stage(running(s, None, [F.col("cap") / F.col("w"), F.col("rank")], {"caps": F.col("cap"), "ws": F.col("w")}, totals=True))
    level = (F.col("caps_total") / most - (F.col("caps") - F.col("cap"))) / (F.col("ws_total") - (F.col("ws") - F.col("w")))
    first = ran.withColumn("level", level).where(F.col("level") * F.col("w") <= F.col("cap"))
    first = first.agg(F.min_by("level", F.struct(F.col("cap") / F.col("w"), F.col("rank"))).alias("level"))  # one row
    share = F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("level") * F.col("w")))
    return stage(ran.crossJoin(F.broadcast(first)).select("source", "source_size", share.alias("target")))


def flight(size: np.ndarray, p: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Move inclusion probabilities inside [0, 1] until at most two are fractional, keeping their sum and the sum of size * p.

    Three fractional units at a time step along the null space of the two
    balancing rows (1, 1, 1) and (their sizes): its direction is the cross
    product. The step's sign is drawn so that every probability stays unbiased.
    """
    p, s = p.astype(float).tolist(), size.astype(float).tolist()
    live: list[int] = []
    draws = iter(rng.random(len(p) + 8).tolist())
    waiting = iter(range(len(p)))
    while True:
        while len(live) < 3:
            i = next(waiting, None)
            if i is None:
                break
            if EPS < p[i] < 1 - EPS:
                live.append(i)
            else:
                p[i] = float(round(p[i]))
        if len(live) == 3:
            i, j, k = live
            u = [s[k] - s[j], s[i] - s[k], s[j] - s[i]]
            if u[0] == u[1] == u[2] == 0:
                u = [1.0, -1.0, 0.0]
        elif len(live) == 2 and s[live[0]] == s[live[1]]:
            u = [1.0, -1.0]
        else:
            return np.array(p)
        up = min(((1 - p[i]) / v if v > 0 else p[i] / -v) for i, v in zip(live, u) if v)
        down = min((p[i] / v if v > 0 else (1 - p[i]) / -v) for i, v in zip(live, u) if v)
        step = up if next(draws, 0.5) * (up + down) < down else -down
        for i, v in zip(live, u):
            p[i] = min(1.0, max(0.0, p[i] + step * v))
            if p[i] < EPS or p[i] > 1 - EPS:
                p[i] = float(round(p[i]))
        live = [i for i in live if 0 < p[i] < 1]


def landing(size: np.ndarray, p: np.ndarray, wanted: float, swaps: int = 16) -> np.ndarray:
    """Round the last one or two fractional units, then bring the total size as near to wanted as single changes can.

    A very long document among the last units would else leave an error of up
    to half its size: each change takes one more unit in, or one out, as long
    as that comes nearer. It sees one block, which is all that is left.
    """
    odd = np.flatnonzero((p > 0) & (p < 1))
    p = p.copy()
    if len(odd):
        p[odd] = min(itertools.product((0.0, 1.0), repeat=len(odd)), key=lambda x: (abs(float(((np.array(x) - p[odd]) * size[odd]).sum())), abs(sum(x) - p[odd].sum()), x))
    for _ in range(swaps):
        over = float((size * p).sum()) - wanted
        after = np.abs(over + np.where(p > 0, -size, size))
        i = int(after.argmin()) if len(p) else 0
        if not len(p) or after[i] >= abs(over):
            break
        p[i] = 1 - p[i]
    return p


def _flights(level: int, seed: int, fields: list[str]):
    def fly(key: tuple, t: pa.Table) -> pa.Table:
        order = np.lexsort((t["p"].to_numpy(), t["size"].to_numpy(), t["h"].to_numpy()))
        t = t.take(pa.array(order))
        size, h = t["size"].to_numpy(), t["h"].to_numpy()
        mark = int(np.bitwise_xor.reduce(h.view(np.uint64)))
        before = t["p"].to_numpy()
        p = flight(size, before, np.random.default_rng([seed, level, mark]))
        if t["blocks"][0].as_py() == 1:
            p = landing(size, p, float((size * before).sum()))
        return t.set_column(t.schema.get_field_index("p"), "p", pa.array(p)).select(fields)

    return fly


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3, seed: int = 0, id_column: str = "doc_id", sized: DataFrame | None = None) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies: how often the mix repeats each document.

    A source needs rate = target / source_size passes over its documents: every
    document is taken floor(rate) times, and once more with probability
    rate - floor(rate), drawn by the cube method so that the words and the
    number of documents taken stay at their expectation. Documents of a source
    are hashed into blocks of about BLOCK_ROWS; a block's flight leaves at most
    two undecided, and the undecided of all blocks form the blocks of the next
    level until one block per source is left, where at most two units land.
    A hot source is many blocks; no task sees more than a block.

    Null text has size 0; a source without words gets target 0 and takes 0
    copies of its documents. A null source is a source. Rows that repeat a
    doc_id are units of their own. The same input gives the same result in any
    partitioning: units are ordered by a hash of their id and size.
    """
    base = sized if sized is not None else docs.select(F.col(id_column).alias("id"), F.col("source").cast("string").alias("source"), n_words("text").alias("size"))
    base = stage(base)
    targets = source_targets(base, weights, most)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    units = join_null_safe(base, broadcast_if_small(targets), ["source"], "left").withColumn("rate", rate)
    fixed = F.when(F.col("rate") - F.floor("rate") > 1 - 1e-6, F.ceil("rate")).otherwise(F.floor("rate"))
    units = units.withColumn("copies", fixed.cast("long")).withColumn("p", F.greatest(F.lit(0.0), F.col("rate") - F.col("copies"))).drop("rate")
    schema = units.schema
    done = units.where(F.col("p") <= 1e-6)
    todo, level = stage(units.where(F.col("p") > 1e-6)), 0
    fields = [f.name for f in schema]
    decided = [done]
    while not todo.isEmpty():
        counts = todo.groupBy("source").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("blocks"))
        dealt = join_null_safe(todo, broadcast_if_small(stage(counts)), ["source"], "inner")
        h = F.xxhash64(F.lit(seed), F.col("id"), F.col("size"))
        dealt = dealt.withColumn("h", h).withColumn("block", F.pmod(F.xxhash64(F.lit(level), F.col("h")), F.col("blocks")).cast("int"))

        flown = stage(dealt.groupBy("source", "block").applyInArrow(_flights(level, seed, fields), schema))
        whole = flown.where("p <= 0 or p >= 1").withColumn("copies", F.col("copies") + F.col("p").cast("long"))
        decided.append(whole)
        todo, level = stage(flown.where("p > 0 and p < 1")), level + 1
    out = decided[0]
    for d in decided[1:]:
        out = out.unionByName(d)
    return out.select(F.col("id").alias(id_column), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")
