"""Prefix trie of conversations from sorted turn sequences: LCPs, sparse-table range minima and binary search, no stack.

Conversations are sorted by the digests of their turns. Every prefix of every conversation is a candidate that
searches, for itself, how far to the left and right all neighbouring LCPs reach its depth; that gives its members
as an interval of rows. The copy that stands at its own left end is the node. Node order by (row, depth) is
preorder, so sums over subtrees are differences of running sums.

Rows are cut into range slices. An interval that touches a slice's edge may go on in the next: such open nodes
are parts, merged by the digest of their prefix; there are at most two conversations' worth of them per slice.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabkit.llm.batches import broadcast_below, stage_batched
from tabkit.scale import running
from tabkit.session import stage

SLICE_TURNS = 1 << 15
DIGEST = 16


def turn_sequences(turns: DataFrame, n_words: Column, id_column: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turns): per conversation its turns in order, as an array of (digest, words).

    Order is by turn, null first, then role, then digest, so repeated turns
    have one order too. Null role and text are empty. Rows without id belong to
    no conversation and are left out.
    """
    who, said = F.coalesce(F.col(role).cast("string"), F.lit("")), F.coalesce(F.col(text).cast("string"), F.lit(""))
    digest = F.md5(F.concat(F.length(who).cast("string"), F.lit(":"), who, said))
    one = F.struct(F.col(turn).alias("turn"), who.alias("role"), digest.alias("digest"), n_words.cast("int").alias("words"))
    own = turns.where(F.col(id_column).isNotNull()).groupBy(F.col(id_column).cast("long").alias("conv")).agg(F.sort_array(F.collect_list(one)).alias("turns"))
    return own.select("conv", F.transform("turns", lambda t: F.struct(t["digest"].alias("digest"), t["words"].alias("words"))).alias("turns"))


def rebuilt(sequences: DataFrame, base: Column, head: Column, most: int) -> DataFrame:
    """(conv, turns): the first ``head`` turns of conversation ``base``, then the own turns after the first ``head``.

    ``base`` and ``head`` are expressions over ``conv``; head is at most
    ``most``, so only so many turns of a base travel.
    """
    s = stage(sequences.withColumn("base", base).withColumn("head", head.cast("int")))
    bases = s.select(F.col("conv").alias("base"), F.slice("turns", 1, most).alias("theirs")).join(s.select("base").distinct(), "base", "left_semi")
    none = F.array().cast(s.schema["turns"].dataType)
    theirs = F.coalesce(F.slice("theirs", F.lit(1), F.col("head")), none)
    own = F.filter("turns", lambda t, i: i >= F.col("head"))
    return s.join(bases, "base", "left").select("conv", F.concat(theirs, own).alias("turns"))


class Minima:
    """Sparse table of range minima; rows 0 to n - 1."""

    def __init__(self, values: np.ndarray):
        self.n, self.rows = len(values), [np.asarray(values)]
        while 2 << (len(self.rows) - 1) <= self.n:
            a, step = self.rows[-1], 1 << (len(self.rows) - 1)
            self.rows.append(np.minimum(a[:-step], a[step:]))

    def of(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Minimum of each range lo..hi, both ends included."""
        level = np.frexp((hi - lo + 1).astype(float))[1] - 1
        out = np.empty(len(lo), dtype=self.rows[0].dtype)
        for k in np.unique(level):
            own = np.flatnonzero(level == k)
            out[own] = np.minimum(self.rows[k][lo[own]], self.rows[k][hi[own] - (1 << int(k)) + 1])
        return out

    def reach_right(self, row: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Last r with values[row + 1..r] all >= least; the search halves its step from table row to table row."""
        r = row.copy()
        for k in range(len(self.rows) - 1, -1, -1):
            can = r + (1 << k) <= self.n - 1
            at = np.where(can, r + 1, 0)
            go = can & (self.rows[k][np.minimum(at, len(self.rows[k]) - 1)] >= least)
            r = np.where(go, r + (1 << k), r)
        return r

    def reach_left(self, row: np.ndarray, least: np.ndarray) -> np.ndarray:
        """First l with values[l + 1..row] all >= least."""
        left = row.copy()
        for k in range(len(self.rows) - 1, -1, -1):
            at = left - (1 << k) + 1
            can = at >= 1
            go = can & (self.rows[k][np.where(can, at, 0)] >= least)
            left = np.where(go, left - (1 << k), left)
        return left


def neighbour_lcps(first: np.ndarray, sizes: np.ndarray, digests: np.ndarray) -> np.ndarray:
    """Common leading turns of each row with the row before it; -1 for row 0. Row i has digests[first[i]:first[i] + sizes[i]]."""
    n = len(sizes)
    out = np.full(n, -1, dtype=np.int64)
    if n > 1:
        both = np.minimum(sizes[:-1], sizes[1:])
        at = np.cumsum(both) - both
        i = np.arange(both.sum()) - np.repeat(at, both)
        differ = (digests[np.repeat(first[:-1], both) + i] != digests[np.repeat(first[1:], both) + i]).any(axis=1)
        out[1:] = both
        where = np.flatnonzero(differ)
        np.minimum.at(out, np.repeat(np.arange(1, n), both)[where], i[where])
    return out


def _slice_nodes(slice_: int, convs: np.ndarray, keys: list[bytes], words: np.ndarray) -> tuple[dict, dict]:
    """(closed nodes, open parts) of one slice of rows sorted by (key, conv)."""
    n = len(convs)
    sizes = np.array([len(k) // DIGEST for k in keys], dtype=np.int64)
    first = np.cumsum(sizes) - sizes
    digests = np.frombuffer(b"".join(keys), dtype=np.uint64).reshape(-1, 2)
    lcp = neighbour_lcps(first, sizes, digests)
    near, low_conv = Minima(lcp), Minima(convs)
    # candidate (row i, depth d), 0 <= d <= sizes[i], stands at place[i] + d
    place = np.cumsum(sizes + 1) - (sizes + 1)
    row = np.repeat(np.arange(n), sizes + 1)
    depth = np.arange(len(row)) - place[row]
    left, right = near.reach_left(row, depth), near.reach_right(row, depth)
    at = np.flatnonzero(left == row)  # nodes, in preorder
    node_of = np.full(len(row), -1, dtype=np.int64)
    node_of[at] = np.arange(len(at))
    l, r, d = row[at], right[at], depth[at]
    up = np.where(d > 0, place[left[np.maximum(at - 1, 0)]] + d - 1, 0)
    parent = np.where(d > 0, node_of[up], -1)
    size = r - l + 1
    is_open = (l == 0) | (r == n - 1)
    last = np.where(d > 0, words[np.maximum(first[l] + d - 1, 0)] if len(words) else 0, 0).astype(np.int64)
    children = np.zeros(len(at), dtype=np.int64)
    closed_child = np.flatnonzero(~is_open & (parent >= 0))
    np.add.at(children, parent[closed_child], 1)
    leaf = (~is_open & (children == 0)).astype(np.int64)
    saved = np.where(is_open, 0, (size - 1) * last)
    # a node's subtree is all nodes from its own to the last one its last row brings
    upto = np.searchsorted(at, place[r] + sizes[r], side="right")
    total = lambda v: np.concatenate([[0], np.cumsum(v)])
    sum_leaf, sum_saved, here = total(leaf), total(saved), np.arange(len(at))
    leaves, saved = sum_leaf[upto] - sum_leaf[here], sum_saved[upto] - sum_saved[here]
    least = low_conv.of(l, r)
    # rows that end at the node are the first of its interval
    same = np.concatenate([[False], (lcp[1:] == sizes[1:]) & (lcp[1:] == sizes[:-1])]) if n else np.zeros(0, bool)
    group_end = np.append(np.flatnonzero(~same)[1:], n) if n else np.zeros(0, int)
    end_of = np.repeat(group_end, np.diff(np.append(np.flatnonzero(~same), n))) if n else group_end
    ends = [",".join(map(str, convs[i : end_of[i]])) if sizes[i] == k else "" for i, k in zip(l, d)]

    prefix: dict[int, bytes] = {}

    def name(k: int) -> bytes:
        """Digest of a node's prefix."""
        if k not in prefix:
            prefix[k] = hashlib.blake2b(keys[l[k]][: DIGEST * int(d[k])], digest_size=16).digest()
        return prefix[k]

    o, c = np.flatnonzero(is_open), np.flatnonzero(~is_open)
    outer = is_open[parent[c]] if len(c) else np.zeros(0, bool)
    closed = {
        "slice": np.full(len(c), slice_, np.int32), "conv_id": least[c], "depth": d[c],
        "parent_conv_id": pa.array(least[parent[c]], mask=outer), "parent": [name(p) if x else None for p, x in zip(parent[c], outer)],
        "n_convs": size[c], "n_children": children[c], "n_leaves": leaves[c], "saved_tokens": saved[c],
        "ends_sha256": [hashlib.sha256(ends[k].encode()).hexdigest() for k in c],
    }
    parts = {
        "slice": np.full(len(o), slice_, np.int32), "id": [name(k) for k in o], "parent": [name(p) if p >= 0 else None for p in parent[o]],
        "depth": d[o], "lo": l[o], "hi": r[o], "conv_id": least[o], "n_convs": size[o], "words": last[o],
        "n_children": children[o], "n_leaves": leaves[o], "saved_tokens": saved[o], "ends": [ends[k] for k in o],
    }
    return closed, parts


CLOSED = "slice int, conv_id long, depth long, parent_conv_id long, parent binary, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
PARTS = "slice int, id binary, parent binary, depth long, lo long, hi long, conv_id long, n_convs long, words long, n_children long, n_leaves long, saved_tokens long, ends string"
OUT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def prefix_trie(sequences: DataFrame) -> DataFrame:
    """One row per distinct prefix of the sequences (conv, turns): a node of their trie, from the empty prefix down.

    conv_id is the smallest member, depth the prefix's length; these two name a
    node, and parent_conv_id with depth - 1 its parent (null for the root).
    n_convs counts members, n_children children, n_leaves the childless nodes
    of the subtree; saved_tokens sums (n_convs - 1) * words of the last turn
    over the subtree, itself included. ends_sha256 is the SHA-256 of the sorted,
    comma-joined ids of the members that end here.

    conv is unique. No sequences: no nodes. Sequences without turns are members
    of the root only. One conversation has to fit a task, a prefix's members
    need not: copies of a conversation spread over slices by id.
    """
    key = F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), ""))
    rows = stage(sequences.select("conv", key.alias("key"), F.transform("turns", lambda t: t["words"]).alias("words")))
    turns = rows.agg(F.sum(F.size("words").cast("long") + 1)).first()[0] or 0
    cut = rows.repartitionByRange(max(1, -(-turns // SLICE_TURNS)), "key", "conv")
    cut = cut.withColumn("slice", F.spark_partition_id()).sortWithinPartitions("key", "conv").select("slice", "conv", "key", "words")
    names = [c.split()[0] for c in CLOSED.split(", ")] + ["p_" + c.split()[0] for c in PARTS.split(", ")]

    def nodes(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = [b for b in it if b.num_rows]
        if not batches:
            return
        t = pa.Table.from_batches(batches)
        words = t["words"].combine_chunks()
        closed, parts = _slice_nodes(t["slice"][0].as_py(), t["conv"].to_numpy(), t["key"].to_pylist(), words.flatten().to_numpy())
        for mine, other, kinds in ((closed, parts, 0), (parts, closed, 1)):
            schema = [CLOSED, PARTS][kinds]
            own = [v if isinstance(v, pa.Array) else pa.array(v, type=_TYPES[f.split()[1]]) for v, f in zip(mine.values(), schema.split(", "))]
            n = len(own[0])
            none = [pa.nulls(n, _TYPES[f.split()[1]]) for f in [PARTS, CLOSED][kinds].split(", ")]
            whole = pa.RecordBatch.from_arrays(own + none if not kinds else none + own, names)
            for i in range(0, n, 1000):
                yield whole.slice(i, 1000)

    schema = CLOSED + ", " + ", ".join("p_" + c for c in PARTS.split(", "))
    found = stage(cut.mapInArrow(nodes, schema))
    closed = found.where("slice is not null").select([c.split()[0] for c in CLOSED.split(", ")])
    parts = found.where("p_slice is not null").select([F.col("p_" + c.split()[0]).alias(c.split()[0]) for c in PARTS.split(", ")])
    return _joined(closed, parts)


_TYPES = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}


def _joined(closed: DataFrame, parts: DataFrame) -> DataFrame:
    """Whole nodes from the closed ones and the parts of the open ones."""
    spot = lambda row: F.struct(F.col("slice").alias("slice"), F.col(row).alias("row"))
    merged = parts.groupBy("id").agg(
        F.first("depth").alias("depth"), F.first("parent").alias("parent"), F.first("words").alias("words"), F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.min(spot("lo")).alias("lo"), F.max(spot("hi")).alias("hi"),
    )
    merged = stage(merged)
    born = merged.where("parent is not null").groupBy(F.col("parent").alias("id")).agg(F.count(F.lit(1)).alias("_open_children"))
    merged = merged.join(born, "id", "left").withColumn("n_children", F.col("n_children") + F.coalesce("_open_children", F.lit(0)))
    merged = stage(merged.drop("_open_children"))
    # open nodes in preorder, and behind each subtree an asker: the sums between the two are those of the open nodes in it
    zero, far = F.lit(0).cast("long"), F.lit(1 << 62).cast("long")
    leaf, saved = F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long"), (F.col("n_convs") - 1) * F.col("words")
    own = merged.select("id", F.lit(0).alias("asks"), "lo.slice", "lo.row", "depth", leaf.alias("leaf"), saved.alias("saved"))
    ask = merged.select("id", F.lit(1).alias("asks"), "hi.slice", "hi.row", (far + F.col("depth")).alias("depth"), zero.alias("leaf"), zero.alias("saved"))
    order = [F.col("slice"), F.col("row"), F.col("depth"), F.col("asks")]
    ran = running(own.unionByName(ask), None, order, {"leaf_upto": F.col("leaf"), "saved_upto": F.col("saved")})
    between = lambda c, mine: F.sum(F.when(F.col("asks") == 1, F.col(c)).otherwise(F.col(mine) - F.col(c)))
    below = ran.groupBy("id").agg(between("leaf_upto", "leaf").alias("_leaf"), between("saved_upto", "saved").alias("_saved"))
    # ids of members that end at an open node: slice by slice through one digest
    pieces = parts.where("ends <> ''").select("id", "slice", "ends").repartition("id").sortWithinPartitions("id", "slice")
    ended = stage_batched(pieces.mapInArrow(_stream_digest, "id binary, ends_sha256 string"), rows=8)
    whole = merged.join(below, "id").join(ended, "id", "left")
    nothing = hashlib.sha256(b"").hexdigest()
    named = stage(merged.select(F.col("id").alias("parent"), F.col("conv_id").alias("_parent_conv")))
    whole = whole.join(broadcast_below(named), "parent", "left").select(
        "conv_id", "depth", F.col("_parent_conv").alias("parent_conv_id"), "n_convs", "n_children",
        (F.col("n_leaves") + F.col("_leaf")).alias("n_leaves"), (F.col("saved_tokens") + F.col("_saved")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
    )
    # an open parent is looked up per slice, so the root's many children do not meet in one task
    by_slice = stage(parts.select("slice", F.col("id").alias("parent")).join(broadcast_below(named), "parent"))
    rest = closed.join(broadcast_below(by_slice), ["slice", "parent"], "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_parent_conv"))
    return rest.select(OUT).unionByName(whole.select(OUT))


def _stream_digest(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the comma-joined pieces of every id, rows sorted by id; a batch at a time."""
    now, digest = None, None
    row = lambda: pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([digest.hexdigest()])], ["id", "ends_sha256"])
    for batch in it:
        for k, ends in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if k != now:
                if digest:
                    yield row()
                now, digest = k, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ends.encode())
    if digest:
        yield row()
