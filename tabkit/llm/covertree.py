"""Product codes of vectors: Lloyd's steps over cover trees that are local to a partition.

Every part position of a block of rows gets a cover tree: nested nets from a farthest-first order, each net's
points at least its radius apart and every point within it of one of them. Rows stand in tree order with running
sums, so a node's sum and count are two differences. Down the tree a node keeps only the codebook entries the
triangle inequality leaves possible for some point in its ball; one left: the whole subtree is assigned. Leaves
with several left compare their points with those entries exactly. All arithmetic that decides is on integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabkit.llm.batches import broadcast_below, stage_batched
from tabkit.llm.vectors import blob, unblob, whole
from tabkit.scale import join_null_safe
from tabkit.session import stage

BLOCK_ROWS, LEAF_ROWS = 4096, 16
MOST = 1 << 25  # squared distances of components below it stay exact in 64 bits for 1,024 components
SLACK = 1e-9


class CoverTree:
    """Tree over integer points (rows x dim). perm lists rows in tree order; nodes are arrays, parents before children."""

    def __init__(self, x: np.ndarray, centre: np.ndarray, radius: np.ndarray, start: np.ndarray, end: np.ndarray, child: np.ndarray, n_child: np.ndarray, perm: np.ndarray):
        self.x, self.centre, self.radius, self.start, self.end, self.child, self.n_child, self.perm = x, centre, radius, start, end, child, n_child, perm

    @staticmethod
    def build(x: np.ndarray) -> CoverTree:
        n = len(x)
        # farthest-first order: the first k points are a net whose radius is the distance at which point k came in
        most = max(1, -(-n // LEAF_ROWS))
        net, came = [0], []
        away = ((x - x[0]) ** 2).sum(axis=1)
        while len(net) < most:
            far = int(away.argmax())
            if away[far] == 0:
                break
            came.append(float(away[far]) ** 0.5)
            net.append(far)
            np.minimum(away, ((x - x[far]) ** 2).sum(axis=1), out=away)
        came = np.array([np.inf, *came])
        # nets of halving radius
        counts, radius = [1], came[1] if len(net) > 1 else 0.0
        while counts[-1] < len(net):
            radius /= 2
            inside = int((came > radius).sum())
            if inside > counts[-1]:
                counts.append(inside)
        pts = x[np.array(net)]
        # own[level][i]: net point of the level that net point i, or row i at the last, belongs to
        up = [np.zeros(counts[0], dtype=np.int64)]
        for small, large in zip(counts, counts[1:]):
            up.append(_nearest(pts[:large], pts[:small]))
        rows = _nearest(x, pts)
        path = [rows]
        for level in range(len(counts) - 1, 0, -1):
            path.append(up[level][path[-1]])
        path.reverse()  # path[level][row]: its node's net point at each level
        perm = np.lexsort(path[::-1])
        centre, radii, start, end, child, n_child = [], [], [], [], [], []
        base = 0
        new = np.zeros(n, dtype=bool)
        new[0] = True
        for level, own in enumerate(path):
            o = own[perm]
            new[1:] |= o[1:] != o[:-1]
            s = np.flatnonzero(new)
            d = ((x[perm] - pts[o]) ** 2).sum(axis=1)
            centre.append(np.array(net)[o[s]])
            radii.append(np.sqrt(np.maximum.reduceat(d, s).astype(float)))
            start.append(s)
            end.append(np.append(s[1:], n))
            if level:
                # children of the level above stand in a row, in tree order
                first = np.searchsorted(s, start[level - 1])
                child[level - 1] = base + first
                n_child[level - 1] = np.diff(np.append(first, len(s)))
            child.append(np.zeros(len(s), dtype=np.int64))
            n_child.append(np.zeros(len(s), dtype=np.int64))
            base += len(s)
        join = np.concatenate
        return CoverTree(x[perm], _places(perm, join(centre)), join(radii), join(start), join(end), join(child), join(n_child), perm)

    def assign(self, codebook: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """(entry per row in tree order, sums, counts per entry, points compared one by one)."""
        k = len(codebook)
        total = np.concatenate([np.zeros((1, self.x.shape[1]), np.int64), np.cumsum(self.x, axis=0)])
        entry = np.zeros(len(self.x), dtype=np.int64)
        sums, counts, compared = np.zeros((k, self.x.shape[1]), np.int64), np.zeros(k, np.int64), 0
        nodes, may = np.array([0]), np.ones((1, k), dtype=bool)
        while len(nodes):
            d = _squares(self.x[self.centre[nodes]], codebook)
            best = np.where(may, d, np.iinfo(np.int64).max).argmin(axis=1)
            root = np.sqrt(d.astype(float))
            r = self.radius[nodes]
            # |p - e| >= |c - e| - r and |p - b| <= |c - b| + r for every point p of the ball
            reach = (root[np.arange(len(nodes)), best] + 2 * r) * (1 + SLACK) + SLACK
            may &= root <= reach[:, None]
            may[np.arange(len(nodes)), best] = True
            sure = (may.sum(axis=1) == 1) | (r == 0)
            for i in np.flatnonzero(sure):
                a, b, e = self.start[nodes[i]], self.end[nodes[i]], best[i]
                entry[a:b] = e
                sums[e] += total[b] - total[a]
                counts[e] += b - a
            leaf = ~sure & (self.n_child[nodes] == 0)
            if leaf.any():
                size = self.end[nodes[leaf]] - self.start[nodes[leaf]]
                rows = np.repeat(self.start[nodes[leaf]] - (np.cumsum(size) - size), size) + np.arange(size.sum())
                d = np.where(np.repeat(may[leaf], size, axis=0), _squares(self.x[rows], codebook), np.iinfo(np.int64).max)
                e = d.argmin(axis=1)
                entry[rows] = e
                np.add.at(sums, e, self.x[rows])
                counts += np.bincount(e, minlength=k)
                compared += len(rows)
            down = np.flatnonzero(~sure & ~leaf)
            size = self.n_child[nodes[down]]
            may = np.repeat(may[down], size, axis=0)
            nodes = np.repeat(self.child[nodes[down]] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        return entry, sums, counts, compared


def _places(perm: np.ndarray, rows: np.ndarray) -> np.ndarray:
    back = np.empty(len(perm), dtype=np.int64)
    back[perm] = np.arange(len(perm))
    return back[rows]


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows; differences first, so no large products cancel."""
    out = np.zeros((len(x), len(y)), dtype=np.int64)
    for j in range(x.shape[1]):
        out += (x[:, j, None] - y[None, :, j]) ** 2
    return out


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.concatenate([_squares(x[i : i + 1024], centres).argmin(axis=1) for i in range(0, len(x), 1024)])


FIELDS = (("x", np.int64), ("centre", np.int64), ("radius", np.float64), ("start", np.int64), ("end", np.int64), ("child", np.int64), ("n_child", np.int64), ("perm", np.int64))


def _pack(t: CoverTree) -> list[bytes]:
    return [blob(getattr(t, name).astype(np.int32) if kind == np.int64 else getattr(t, name)) for name, kind in FIELDS]


def _unpack(blobs: list, width: int) -> CoverTree:
    got = [unblob(b, np.int32 if kind == np.int64 else kind).astype(kind) for b, (_, kind) in zip(blobs, FIELDS)]
    got[0] = got[0].reshape(-1, width)
    return CoverTree(*got)


def floors(vector: str, scale: int) -> Column:
    """floor(scale * x) of every component, or null for vectors that are not whole or reach MOST."""
    out = F.transform(F.col(vector).cast("array<double>"), lambda x: F.floor(x * F.lit(float(scale))).cast("long"))
    fits = ~F.exists(F.col(vector).cast("array<double>"), lambda x: F.abs(x * F.lit(float(scale))) >= float(MOST))
    return F.when(whole(vector) & fits, out)


def product_codes(df: DataFrame, vector: Column, parts: int = 8, entries: int = 16, rounds: int = 6, id_column: str = "vec_id", label: str | None = "label") -> DataFrame:
    """id, code, error, label_error, codebooks_sha256 per row; vector gives integer components below MOST in size.

    Vectors are cut into ``parts`` equal pieces, each position with a codebook
    of at most ``entries`` entries that starts as the pieces of the smallest
    ids (repeated ids in the order of their vectors; rows without id are coded,
    but start no entry). ``rounds`` steps assign every piece to its nearest
    entry, ties to the lower index, and replace entries by floored means;
    entries without pieces stay. code has two hex digits per part, error is the
    sum of squared distances, label_error its sum over rows of equal label
    (null labels together; without ``label`` the column is null).

    A null vector, and one of another length than that of the smallest id with
    a length divisible by ``parts``, has a null code and error and counts
    nowhere; where no vector fits, codebooks_sha256 is that of the empty text.
    Without any id no entry can start: all codes are null. Empty tables give
    empty tables, other columns are ignored.

    A task meets one block of at most BLOCK_ROWS rows at a time. Trees are built
    and stored once; each round reads them and moves one sum per task and entry.
    """
    spark, kind = df.sparkSession, df.schema[id_column].dataType
    group = F.col(label) if label else F.lit(None).cast("string")
    rows = df.select(F.col(id_column).alias("id"), group.alias("label"), vector.alias("v"))
    usable = rows.where(F.col("v").isNotNull() & (F.size("v") > 0) & (F.size("v") % parts == 0) & F.col("id").isNotNull())
    head = usable.orderBy("id", "v").select(F.size("v")).first()
    dim = head[0] if head else 0
    width = dim // parts
    first = usable.where(F.size("v") == dim).orderBy("id", "v").select("v").limit(entries).collect() if dim else []
    books = np.array([r[0] for r in first], dtype=np.int64).reshape(len(first), parts, width).transpose(1, 0, 2) if first else np.zeros((parts, 0, 0), np.int64)
    id_name, label_name = kind.simpleString(), rows.schema["label"].dataType.simpleString()
    fits = F.col("v").isNotNull() & (F.size("v") == dim) & F.lit(bool(first))

    def trees(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(it):
            x = np.asarray(batch.column(2).flatten().to_numpy(zero_copy_only=False), dtype=np.int64).reshape(batch.num_rows, parts, width)
            built = [_pack(CoverTree.build(np.ascontiguousarray(x[:, p]))) for p in range(parts)]
            own = [pa.array([batch.column(k).to_pylist()], type=pa.list_(batch.column(k).type)) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*own, pa.array([built], type=pa.list_(pa.list_(pa.binary())))], ["ids", "labels", "trees"])

    forest = stage_batched(rows.where(fits).mapInArrow(trees, f"ids array<{id_name}>, labels array<{label_name}>, trees array<array<binary>>"), rows=BLOCK_ROWS, size="16m")
    known = spark.sparkContext.broadcast(books)
    for _ in range(rounds if first else 0):
        books = _round(forest, known.value, width)
        known = spark.sparkContext.broadcast(books)  # parts * entries * width numbers
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    sent = known

    def codes(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for i in range(batch.num_rows):
                ids, labels = batch.column(0).slice(i, 1).flatten(), batch.column(1).slice(i, 1).flatten()
                code, error = np.zeros((len(ids), parts), np.int64), np.zeros(len(ids), np.int64)
                for p, blobs in enumerate(batch.column(2)[i].as_py()):
                    tree = _unpack(blobs, width)
                    entry, _, _, _ = tree.assign(sent.value[p])
                    code[tree.perm, p] = entry
                    error[tree.perm] += ((tree.x - sent.value[p][entry]) ** 2).sum(axis=1)
                text = ["".join(f"{e:02x}" for e in c) for c in code.tolist()]
                yield pa.RecordBatch.from_arrays([ids, labels, pa.array(text), pa.array(error)], ["id", "label", "code", "error"])

    coded = forest.mapInArrow(codes, f"id {id_name}, label {label_name}, code string, error long")
    rest = rows.where(~F.coalesce(fits, F.lit(False))).select("id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    done = stage_batched(coded.unionByName(rest), rows=8)
    if label:
        sums = stage(done.groupBy("label").agg(F.sum("error").alias("label_error")))
        done = join_null_safe(done, broadcast_below(sums), ["label"], "left")
    else:
        done = done.withColumn("label_error", F.lit(None).cast("long"))
    return done.select(F.col("id").alias(id_column), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _blocks(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches, small ones put together to about BLOCK_ROWS rows."""
    held, size = [], 0
    for batch in it:
        if not batch.num_rows:
            continue
        if size + batch.num_rows > BLOCK_ROWS and held:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
        held.append(batch)
        size += batch.num_rows
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _round(forest: DataFrame, books: np.ndarray, width: int) -> np.ndarray:
    """One Lloyd step: sums and counts per task, added up by Spark; floored means here, entry by entry."""
    sent = forest.sparkSession.sparkContext.broadcast(books)

    def sums(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        all_sums, all_counts = np.zeros(sent.value.shape, np.int64), np.zeros(sent.value.shape[:2], np.int64)
        for batch in it:
            for i in range(batch.num_rows):
                for p, blobs in enumerate(batch.column(0)[i].as_py()):
                    _, s, c, _ = _unpack(blobs, width).assign(sent.value[p])
                    all_sums[p] += s
                    all_counts[p] += c
        part, entry = np.nonzero(all_counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(all_counts[part, entry]), pa.array(all_sums[part, entry].tolist(), type=pa.list_(pa.int64()))],
            ["part", "entry", "n", "s"],
        )

    found = stage_batched(forest.select("trees").mapInArrow(sums, "part int, entry int, n long, s array<long>"), rows=8)
    totals = [F.sum(F.get("s", F.lit(j))).alias(f"s{j}") for j in range(width)]
    out = books.copy()
    for r in found.groupBy("part", "entry").agg(F.sum("n").alias("n"), *totals).collect():  # parts * entries rows
        out[r["part"], r["entry"]] = [r[f"s{j}"] // r["n"] for j in range(width)]
    return out
