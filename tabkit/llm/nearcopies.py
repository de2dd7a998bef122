"""MinHash near-duplicates: one-permutation hashing, optimal densification, banded buckets, star-shaped candidates."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabkit.llm.batches import broadcast_below, stage_batched
from tabkit.llm.graph import components
from tabkit.llm.words import SPACES, U, as_long, grams, mix, words_of
from tabkit.session import stage

BANDS, ROWS = 24, 6
PAIRS_UP_TO = 16
CELLS = 512
PARITY = [f"p{i}" for i in range(CELLS // 64)]
EMPTY = U(0xFFFFFFFFFFFFFFFF)
_jumps = mix(np.arange(1, 1025, dtype=np.uint64)[:, None] * U(0x2545F4914F6CDD1D) + mix(np.arange(BANDS * ROWS, dtype=np.uint64))[None, :])
JUMPS = (_jumps % U(BANDS * ROWS)).astype(np.int64)
ROW_FACTORS = mix(np.arange(1, ROWS + 1, dtype=np.uint64)) | U(1)
BAND_SALTS = mix(np.arange(101, 101 + BANDS, dtype=np.uint64))


def shingle_sets(w, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles, sorted by row, then hash."""
    h, row, _ = grams(w.hashes(), w.first, k, whole_short=True)
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return row[new], h[new]


def one_permutation(row: np.ndarray, h: np.ndarray, rows: int) -> np.ndarray:
    """rows x bins signature. Sorted hashes fall into bins by their leading bits, so a bin's first is its minimum.

    An empty bin takes the value of the first non-empty bin on its own fixed random walk, the same walk in every
    document (optimal densification), so equal bins stay equally likely to agree.
    """
    bins = BANDS * ROWS
    b = ((h >> U(32)) * U(bins) >> U(32)).astype(np.int64)
    new = np.ones(len(h), dtype=bool)
    new[1:] = (b[1:] != b[:-1]) | (row[1:] != row[:-1])
    sig = np.full((rows, bins), EMPTY)
    full = np.zeros((rows, bins), dtype=bool)
    sig[row[new], b[new]] = h[new]
    full[row[new], b[new]] = True
    r, c = np.nonzero(~full & full.any(axis=1)[:, None])
    for step in range(len(JUMPS)):
        if not len(r):
            return sig
        j = JUMPS[step][c]
        hit = full[r, j]
        sig[r[hit], c[hit]] = sig[r[hit], j[hit]]
        r, c = r[~hit], c[~hit]
    sig[r, c] = sig[r, full[r].argmax(axis=1)]
    return sig


def band_keys(sig: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        s = (mix(sig).reshape(len(sig), BANDS, ROWS) * ROW_FACTORS).sum(axis=2, dtype=np.uint64)
        return mix(s + BAND_SALTS)


def parities(row: np.ndarray, h: np.ndarray, rows: int) -> np.ndarray:
    """rows x CELLS / 64 numbers; bit c of a row says whether an odd number of its hashes fall into cell c."""
    odd = np.bincount(row * CELLS + (h & U(CELLS - 1)).astype(np.int64), minlength=rows * CELLS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64).reshape(rows, CELLS // 64)


def may_link(a: str, b: str, per_cent: int) -> Column:
    """Whether sets of sizes {a}n and {b}n with their parities can have 100 * intersection >= per_cent * union.

    A cell whose parity differs holds a shingle of one set alone, so such cells
    count no more than the shingles outside the intersection. Linked sets have
    at most (100 - per_cent) / (100 + per_cent) of both sizes' sum outside it.
    No pair of linked sets is turned away.
    """
    apart = reduce(lambda x, y: x + y, [F.bit_count(F.col(f"{a}{p}").bitwiseXOR(F.col(f"{b}{p}"))) for p in PARITY])
    return apart * (100 + per_cent) <= (F.col(f"{a}n") + F.col(f"{b}n")) * (100 - per_cent)


SIGNATURE = "doc_id {id}, n_shingles long, k1 long, k2 long, bands array<long>, " + ", ".join(f"{p} long" for p in PARITY)


def signatures(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, set size, 128-bit key of the set, its band keys (null without words) and the parities of its cells."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for w in words_of(batch.column(1), SPACES, lower=True):
                row, h = shingle_sets(w, k)
                size = np.bincount(row, minlength=w.rows)
                with np.errstate(over="ignore"):
                    at = np.concatenate([[0], np.cumsum(size)])
                    one = np.concatenate([[U(0)], np.cumsum(mix(h), dtype=np.uint64)])
                    two = np.concatenate([[U(0)], np.cumsum(mix(h ^ U(0xA5A5A5A5A5A5A5A5)), dtype=np.uint64)])
                    k1, k2 = one[at[1:]] - one[at[:-1]], two[at[1:]] - two[at[:-1]]
                keys = band_keys(one_permutation(row, h, w.rows)).view(np.int64)
                flat = pa.array(keys[size > 0].ravel())
                ends = np.concatenate([[0], np.cumsum(np.where(size > 0, BANDS, 0))]).astype(np.int32)
                bands = pa.ListArray.from_arrays(pa.array(ends), flat)
                cells = [pa.array(c) for c in np.ascontiguousarray(parities(row, h, w.rows).T)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(w.row0, w.rows), pa.array(size.astype(np.int64)), as_long(k1), as_long(k2), bands, *cells],
                    ["doc_id", "n_shingles", "k1", "k2", "bands", *PARITY],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(batches, SIGNATURE.format(id=kind))


def verified(pairs: DataFrame, docs: DataFrame, k: int, per_cent: int) -> DataFrame:
    """The (a, b) pairs whose full shingle sets have 100 * intersection >= per_cent * union.

    Only the texts of named documents are shuffled when pairs and ids are small
    enough to broadcast (their size is checked), those of all documents otherwise.
    """

    def check(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            keep = np.zeros(batch.num_rows, dtype=bool)
            for lo in range(0, batch.num_rows, 64):
                sides = []
                for c in (2, 3):
                    sets: list[np.ndarray] = []
                    for w in words_of(batch.column(c).slice(lo, 64), SPACES, lower=True):
                        row, h = shingle_sets(w, k)
                        sets += np.split(h, np.cumsum(np.bincount(row, minlength=w.rows))[:-1])
                    sides.append(sets)
                for i, (x, y) in enumerate(zip(*sides)):
                    same = len(np.intersect1d(x, y, assume_unique=True))
                    keep[lo + i] = same > 0 and 100 * same >= per_cent * (len(x) + len(y) - same)
            mask = pa.array(keep)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])

    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ids = stage(pairs.select(F.col("b").alias("doc_id")).distinct())
    left = text.toDF("a", "ta").join(broadcast_below(pairs), "a")
    right = text.join(broadcast_below(ids), "doc_id", "left_semi").toDF("b", "tb")
    return left.join(right, "b").select("a", "b", "ta", "tb").mapInArrow(check, "a long, b long")


def near_copies(docs: DataFrame, k: int = 5, per_cent: int = 80) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id, kept.

    Documents are linked when the Jaccard similarity of their sets of k-word
    shingles (A-Z lower-cased) is at least per_cent / 100, confirmed on the
    full sets. component_id is the smallest doc_id reachable over links.

    Documents with equal sets form one class first, named by its smallest
    doc_id, so a mass of exact copies costs one row from there on. Classes that
    share a band's bucket are candidates. In a bucket of up to PAIRS_UP_TO
    classes every two are compared. In a larger one a round compares all
    classes with a few centres, a star. Then the centres leave the bucket, as
    they have met everything in it; all others stay, linked or not. Buckets
    that lie in one component are done. The number of centres grows eightfold
    a round until no bucket is open, so every two classes of a bucket are
    compared, or in one component already, or surely not linked by their sizes
    and the parities of their hash cells (``may_link``): nothing is capped, and
    copies of one original that do not resemble each other cost a few bit
    counts a pair, no row. The first centres are the classes that meet the most others, as an
    original does among its edited copies, so most buckets close early.

    Null, empty or wordless text: n_shingles 0, its own component. Null doc_id:
    component null, kept. Rows that repeat a doc_id each go by their own text.
    Other columns are not read. doc_id must be a whole number.
    """
    kind = docs.schema["doc_id"].dataType
    base = stage_batched(signatures(docs, k))
    sets = base.where("n_shingles > 0 and doc_id is not null")
    classes = stage(sets.groupBy("k1", "k2", "n_shingles").agg(F.min_by("bands", "doc_id").alias("bands"), F.min("doc_id").cast("long").alias("doc"), *[F.first(p).alias(p) for p in PARITY]))
    rows = stage(classes.select("doc", F.col("n_shingles").alias("n"), F.explode("bands").alias("key")))
    named = stage(classes.select("k1", "k2", "n_shingles", F.col("doc").alias("rep")))
    shared = stage(rows.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1"))
    # a class is one row with the keys of its open buckets, so components are attached per class, not per bucket
    held = rows.join(broadcast_below(shared), "key").groupBy("doc", "n").agg(F.sum("m").alias("met"), F.collect_list("key").alias("keys"))
    held = stage(held.join(classes.select("doc", *PARITY), "doc"))
    links, labels, tested = None, None, None
    few = 1
    while True:
        now = held.withColumn("comp", F.col("doc"))
        if labels is not None:
            now = held.join(broadcast_below(labels.withColumnRenamed("node", "doc")), "doc", "left").withColumn("comp", F.coalesce("component", "doc")).drop("component")
        now = now.select("doc", "n", "met", "comp", *PARITY, F.explode("keys").alias("key"))
        # buckets that still hold two components
        torn = now.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count(F.lit(1)).alias("m"))
        torn = stage(torn.where("low < high").select("key", "m"))
        now = stage(now.join(broadcast_below(torn), "key"))
        if now.isEmpty():
            break
        mate = F.struct("doc", "n", "comp", *PARITY)
        small = now.where(F.col("m") <= PAIRS_UP_TO).select("key", mate.alias("c"))
        large = now.where(F.col("m") > PAIRS_UP_TO)
        if few == 1:
            # the class that meets most others, the smallest of equals, from partial maxima
            large = large.groupBy("key").agg(F.max_by(mate, F.struct("met", -F.col("doc"))).alias("c"))
        else:
            order = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("met"), "doc"))
            large = large.withColumn("r", order).where(F.col("r") <= few).select("key", mate.alias("c"))
        top = stage(small.unionByName(large).select("key", F.col("c.doc").alias("c_doc"), F.col("c.n").alias("c_n"), F.col("c.comp").alias("c_comp"), *[F.col(f"c.{p}").alias(f"c_{p}") for p in PARITY]))
        star = now.join(broadcast_below(top), "key").where("comp <> c_comp")
        # sets whose sizes differ too much cannot be similar enough, nor sets with too many shingles of their own
        star = star.where((F.least("n", "c_n") * 100 >= F.greatest("n", "c_n") * per_cent) & may_link("", "c_", per_cent))
        star = star.select(F.least("doc", "c_doc").alias("a"), F.greatest("doc", "c_doc").alias("b")).distinct()
        if tested is not None:
            star = star.join(tested, ["a", "b"], "left_anti")
        star = stage(star)
        if not star.isEmpty():
            tested = star if tested is None else tested.unionByName(star)
            new = stage_batched(verified(star, docs, k, per_cent), rows=500)
            links = new if links is None else links.unionByName(new)
            if not new.isEmpty():
                labels = components(links)
        met = broadcast_below(top.select("key", F.col("c_doc").alias("doc")))
        held = stage(now.join(met, ["key", "doc"], "left_anti").groupBy("doc", "n", "met", *PARITY).agg(F.collect_list("key").alias("keys")))
        few *= 8
    if labels is not None:
        named = stage(named.join(broadcast_below(labels), F.col("rep") == F.col("node"), "left").select("k1", "k2", "n_shingles", F.coalesce("component", "rep").alias("rep")))
    out = base.drop("bands", *PARITY).join(named, ["k1", "k2", "n_shingles"], "left")
    own = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("rep")).otherwise(F.col("doc_id")).cast(kind)
    return out.select("doc_id", "n_shingles", own.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
