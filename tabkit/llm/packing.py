"""Conflict-constrained best-fit packing of documents into bins of fixed capacity."""

from __future__ import annotations

from bisect import insort

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabkit.session import stage

SHARD_ROWS = 8192


class Bins:
    """Bins ordered by residual space, each with a bitmap of the sources and duplicate clusters it holds.

    A tree over the residuals keeps, per node, the AND of its bins' bitmaps: a
    set bit there means that every bin below holds that source or cluster. The
    successor search walks residuals upward from the wanted size, skips such
    nodes, and stops at the first bin that fits and conflicts with nothing.
    """

    def __init__(self, capacity: int):
        self.capacity, self.leaves = capacity, 1 << max(1, capacity).bit_length()
        self.node = [-1] * (2 * self.leaves)  # -1: no bin below, all bits set
        self.at: dict[int, list[int]] = {}
        self.held: list[int] = []
        self.left: list[int] = []

    def _update(self, r: int, value: int) -> None:
        i = r + self.leaves
        node = self.node
        node[i] = value
        i >>= 1
        while i:
            now = node[2 * i] & node[2 * i + 1]
            if node[i] == now:
                return
            node[i] = now
            i >>= 1

    def _put(self, b: int) -> None:
        r = self.left[b]
        insort(self.at.setdefault(r, []), b)
        self._update(r, self.node[r + self.leaves] & self.held[b])

    def _take(self, b: int) -> None:
        r = self.left[b]
        bins = self.at[r]
        bins.remove(b)
        both = -1
        for x in bins:
            both &= self.held[x]
        self._update(r, both)

    def find(self, size: int, bits: int) -> int | None:
        """The compatible bin with the smallest residual >= size, the oldest among equals."""
        node, leaves = self.node, self.leaves
        todo = [(1, 0, leaves)]
        while todo:
            i, lo, n = todo.pop()
            if lo + n <= size or node[i] & bits:
                # all bins below are too full, or all hold this source or all hold this cluster
                continue
            if i >= leaves:
                for b in self.at.get(i - leaves, ()):
                    if not self.held[b] & bits:
                        return b
                continue
            todo.append((2 * i + 1, lo + n // 2, n // 2))
            todo.append((2 * i, lo, n // 2))
        return None

    def add(self, size: int, bits: int) -> tuple[int, int]:
        """Place one piece; (bin, space used in it before)."""
        b = self.find(size, bits)
        if b is None:
            b = len(self.left)
            self.left.append(self.capacity)
            self.held.append(0)
        else:
            self._take(b)
        start = self.capacity - self.left[b]
        self.left[b] -= size
        self.held[b] |= bits
        self._put(b)
        return b, start


def pack_shard(sizes: list[int], sources: list, clusters: list, capacity: int) -> tuple[list[int], list[int]]:
    """Best fit over one shard's pieces in the given order; a bin takes one piece per source and per cluster."""
    bit: dict = {}
    bins = Bins(capacity)
    out_bin, out_start = [], []
    seen: dict = {}
    for c in clusters:
        seen[c] = seen.get(c, 0) + 1
    for size, source, cluster in zip(sizes, sources, clusters):
        bits = 1 << bit.setdefault(("s", source), len(bit))
        if cluster is not None and seen[cluster] > 1:  # a cluster with one piece cannot conflict
            bits |= 1 << bit.setdefault(("c", cluster), len(bit))
        b, start = bins.add(size, bits)
        out_bin.append(b)
        out_start.append(start)
    return out_bin, out_start


def best_fit(df: DataFrame, size: Column, cluster: Column, capacity: int = 2048, id_column: str = "doc_id", source: str = "source") -> DataFrame:
    """One row per piece: doc_id, piece, first (offset of the piece in its document), size, bin, start, source.

    A document longer than capacity is cut into full pieces and a rest. Pieces
    are hashed into shards of about SHARD_ROWS, placed largest first, and a
    bin never holds two pieces of one source or of one duplicate cluster (a
    piece is not in conflict with pieces of its own document only by these two
    rules). bin is shard * 2**32 + the shard's bin number; a full piece has a
    bin of its own. Shards are independent, so a lost task is repeated alone;
    they cost at most a part-filled set of bins each.

    Size 0 or null gives no piece. A null source is a source of its own; a null
    cluster conflicts with nothing. Repeated rows are pieces of their own, kept
    apart by their cluster. Ties are placed in the order of hash, id and piece.
    """
    base = df.select(F.col(id_column).alias("id"), F.col(source).cast("string").alias("source"), F.coalesce(size, F.lit(0)).cast("long").alias("n"), cluster.cast("string").alias("cluster"))
    base = base.where("n > 0").withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / capacity))))
    base = base.select("id", "source", "cluster", "piece", (F.col("piece") * capacity).alias("first"), F.least(F.lit(capacity).cast("long"), F.col("n") - F.col("piece") * capacity).alias("size"))
    base = stage(base.withColumn("h", F.xxhash64("id", "piece")))
    shards = max(1, -(-base.count() // SHARD_ROWS))
    kind = base.schema["id"].dataType.simpleString()

    def pack(key: tuple, t: pa.Table) -> pa.Table:
        order = np.lexsort((t["piece"].to_numpy(), t["h"].to_numpy(), -t["size"].to_numpy()))
        t = t.take(pa.array(order))
        bins, start = pack_shard(t["size"].to_pylist(), t["source"].to_pylist(), t["cluster"].to_pylist(), capacity)
        whole = pa.array((np.int64(key[0].as_py()) << 32) + np.array(bins, dtype=np.int64))
        return pa.table([t["id"], t["piece"], t["first"], t["size"], whole, pa.array(start, type=pa.int64()), t["source"]], names=["doc_id", "piece", "first", "size", "bin", "start", "source"])

    # the salt by row spreads copies that share an id
    dealt = base.withColumn("shard", F.pmod(F.xxhash64("h", "size"), F.lit(shards)).cast("int"))
    return dealt.groupBy("shard").applyInArrow(pack, f"doc_id {kind}, piece long, first long, size long, bin long, start long, source string")


def same_text(text: str) -> Column:
    """Cluster key of a document's exact copies (case and outer space aside); null for texts without a word."""
    t = F.trim(F.lower(F.col(text).cast("string")))
    return F.when(F.length(t) > 0, F.md5(t))
