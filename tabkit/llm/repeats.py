"""Substring dedup by fixed-block anchors: repeats of WINDOW words across documents are found and cut out.

Passes, each a map over stored packs of texts, no text is ever shuffled:

1. anchors  Every rolling run of BLOCK words is a probe; runs at multiples of BLOCK are the reference blocks. Any
            window of 2 * BLOCK - 1 words holds one whole reference block, so a window that repeats has a probe that
            meets a block of the other document. Probes are dealt by hash and answered with one bit each.
2. windows  Anchor hits are extended to the windows around them, on the reference side and on the probing side;
            their full hashes are dealt and answered with one bit: does it start in a smaller document?
3. cut      All words covered by such windows go. Overlapping windows make up the maximal repeats.

A run or window that many documents of a pack hold is sent twice or once for the whole pack, not per document, so
what one hot passage costs grows with the number of packs.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabkit.llm.batches import stage_batched
from tabkit.llm.words import SPACES, U, pieces, spans_hash, split_words
from tabkit.session import keep_until_release, scratch_dir

WINDOW, BLOCK = 13, 7
PACK_BYTES = 2 << 20
BUCKET_BYTES = 9 << 20
FAR = np.iinfo(np.int64).max
ZSTD = "zstd"


def _squeeze(a: np.ndarray | bytes) -> bytes:
    raw = a if isinstance(a, bytes) else np.ascontiguousarray(a).tobytes()
    return pa.compress(raw, codec=ZSTD, asbytes=True) if raw else b""


def _restore(b: bytes, size: int, dtype) -> np.ndarray:
    return np.frombuffer(pa.decompress(b, decompressed_size=size * np.dtype(dtype).itemsize, codec=ZSTD, asbytes=True) if size else b"", dtype=dtype)


PACKS = "part int, seq int, n int, size long, ids binary, at binary, texts binary"


def _packs(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, seq = TaskContext.get().partitionId(), 0
    for batch in it:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for row, data, at in pieces(batch.column(1), PACK_BYTES):
            n = len(at) - 1
            values = [part, seq, n, len(data), _squeeze(ids[row : row + n].astype(np.int64)), _squeeze(at.astype(np.int64)), _squeeze(data.tobytes())]
            yield pa.RecordBatch.from_arrays([pa.array([v], type=t) for v, t in zip(values, PACK_TYPES)], PACK_NAMES)
            seq += 1


PACK_NAMES = ["part", "seq", "n", "size", "ids", "at", "texts"]
PACK_TYPES = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]


class Pack:
    """A pack's words and everything that is derived from them alone, the same in every pass."""

    def __init__(self, row: dict):
        n = row["n"]
        self.ids = _restore(row["ids"], n, np.int64)
        at = _restore(row["at"], n + 1, np.int64)
        self.words = split_words(_restore(row["texts"], row["size"], np.uint8), at, SPACES)
        first = self.words.first
        self.counts = np.diff(first)
        self.hashes = self.words.hashes()
        # runs of BLOCK words, of documents long enough to hold a window
        self.runs = np.where(self.counts >= WINDOW, self.counts - BLOCK + 1, 0)
        self.run0 = np.concatenate([[0], np.cumsum(self.runs)])
        self.run_row = np.repeat(np.arange(n), self.runs)
        self.run_pos = np.arange(self.run0[-1]) - self.run0[:-1][self.run_row]
        start = first[:-1][self.run_row] + self.run_pos
        self.run_hash = spans_hash(self.hashes, start, start + BLOCK)

    def sent(self) -> tuple[np.ndarray, np.ndarray]:
        """(indices of the runs to send, runs known as hits without asking), from the pack alone.

        Of a run that three or more documents of the pack hold, one reference
        block of the smallest document that has one and one run of the largest
        document stand for all; the rest are hits, to be judged by their windows.
        """
        n = len(self.run_hash)
        hit = np.zeros(n, dtype=bool)
        if not n:
            return np.zeros(0, dtype=np.int64), hit
        doc = self.ids[self.run_row]
        order = np.lexsort((doc, self.run_hash))
        h, d = self.run_hash[order], doc[order]
        new = np.ones(n, dtype=bool)
        new[1:] = h[1:] != h[:-1]
        first = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        other = np.ones(n, dtype=bool)
        other[1:] = new[1:] | (d[1:] != d[:-1])
        docs = np.add.reduceat(other.astype(np.int64), first)
        wide = docs[group] >= 3
        keep = ~wide
        aligned = self.run_pos[order] % BLOCK == 0
        at = np.where(aligned, np.arange(n), n)
        lead = np.minimum.reduceat(at, first)
        last = np.append(first[1:], n) - 1
        many = docs >= 3
        keep[lead[many & (lead < n)]] = True
        keep[last[many]] = True
        hit[order[wide]] = True
        return np.sort(order[keep]), hit


def _rows(t: pa.Table | pa.RecordBatch) -> Iterator[dict]:
    for i in range(t.num_rows):
        yield {name: t.column(k)[i].as_py() for k, name in enumerate(t.schema.names)}


def _by_bucket(bucket: np.ndarray, buckets: int) -> list[tuple[int, np.ndarray]]:
    order = np.argsort(bucket, kind="stable")
    ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
    return [(b, order[ends[b] : ends[b + 1]]) for b in range(buckets) if ends[b + 1] > ends[b]]


def _bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h >> U(32)) * U(buckets) >> U(32)).astype(np.int64)


PROBES = "bucket int, part int, seq int, n int, k int, docs binary, starts binary, hashes binary, gaps binary"


def _anchors(buckets: int):
    def send(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for row in _rows(batch):
                p = Pack(row)
                at, _ = p.sent()
                ids, starts = _squeeze(p.ids), _squeeze(p.run0)
                out = []
                for b, own in _by_bucket(_bucket_of(p.run_hash[at], buckets), buckets):
                    flat = at[own]
                    gaps = np.diff(flat, prepend=0).astype(np.uint32)
                    out.append((b, row["part"], row["seq"], len(p.ids), len(flat), ids, starts, (p.run_hash[flat] & U(0xFFFFFFFF)).astype(np.uint32).tobytes(), _squeeze(gaps)))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*out), [pa.int32()] * 5 + [pa.binary()] * 4)], [c.split()[0] for c in PROBES.split(", ")])

    return send


BITS = "kind int, part int, seq int, bucket int, bits binary"
BIT_NAMES, BIT_TYPES = ["kind", "part", "seq", "bucket", "bits"], [pa.int32()] * 4 + [pa.binary()]


def _bits(out: list[tuple]) -> pa.Table:
    return pa.table([pa.array([o[i] for o in out], type=t) for i, t in enumerate(BIT_TYPES)], names=BIT_NAMES)


def _groups(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.argsort(h, kind="stable")
    s = h[order]
    new = np.ones(len(s), dtype=bool)
    new[1:] = s[1:] != s[:-1]
    return order, np.flatnonzero(new), np.cumsum(new) - 1


def _answer_anchors(t: pa.Table) -> pa.Table:
    """One bit per probe: a reference block of a smaller document has its hash, or it is a block that a larger one probes."""
    h, doc, aligned, back = [], [], [], []
    for row in _rows(t):
        ids, starts = _restore(row["docs"], row["n"], np.int64), _restore(row["starts"], row["n"] + 1, np.int64)
        flat = np.cumsum(_restore(row["gaps"], row["k"], np.uint32).astype(np.int64))
        at = np.searchsorted(starts, flat, side="right") - 1
        h.append(np.frombuffer(row["hashes"], dtype=np.uint32))
        doc.append(ids[at])
        aligned.append((flat - starts[at]) % BLOCK == 0)
        back.append((0, row["part"], row["seq"], row["bucket"], row["k"]))
    d, a = np.concatenate(doc), np.concatenate(aligned)
    order, first, group = _groups(np.concatenate(h))
    d2, a2 = d[order], a[order]
    low = np.minimum.reduceat(np.where(a2, d2, FAR), first)[group]
    high = np.maximum.reduceat(d2, first)[group]
    hit = np.empty(len(d), dtype=bool)
    hit[order] = (d2 > low) | (a2 & (d2 < high))
    ends = np.cumsum([b[4] for b in back])
    return _bits([(*b[:4], np.packbits(hit[e - b[4] : e]).tobytes()) for b, e in zip(back, ends) if hit[e - b[4] : e].any()])


def _open_bits(answers: dict, kind: int, seq: int, bucket: int, n: int) -> np.ndarray:
    b = answers.get((kind, seq, bucket))
    return np.zeros(n, dtype=bool) if b is None else np.unpackbits(np.frombuffer(b, dtype=np.uint8), count=n).astype(bool)


class Windows:
    """The windows of a pack around its anchor hits: their hash, document and place; distinct hashes with their smallest document."""

    def __init__(self, p: Pack, answers: dict, seq: int, buckets: int):
        at, hit = p.sent()
        for b, own in _by_bucket(_bucket_of(p.run_hash[at], buckets), buckets):
            flat = at[own]
            hit[flat] |= _open_bits(answers, 0, seq, b, len(flat))
        near = np.concatenate([[0], np.cumsum(hit)])
        n = len(hit)
        # a window starts where BLOCK runs follow in the same document
        start = np.flatnonzero(p.run_pos + BLOCK <= p.runs[p.run_row]) if n else np.zeros(0, dtype=np.int64)
        start = start[near[start + WINDOW - BLOCK + 1] > near[start]]
        self.row = p.run_row[start]
        self.word = p.words.first[:-1][self.row] + p.run_pos[start]
        self.hash = spans_hash(p.hashes, self.word, self.word + WINDOW)
        self.doc = p.ids[self.row]
        order = np.lexsort((self.doc, self.hash))
        h = self.hash[order]
        new = np.ones(len(h), dtype=bool)
        new[1:] = h[1:] != h[:-1]
        self.lead = order[new]  # a window of the smallest document, per distinct hash
        self.kind = np.empty(len(h), dtype=np.int64)
        self.kind[order] = np.cumsum(new) - 1


def _by_seq(t: pa.Table) -> dict:
    return {(r["kind"], r["seq"], r["bucket"]): r["bits"] for r in _rows(t)}


ASKED = "bucket int, part int, seq int, n int, hashes binary, docs binary"


def _windows(buckets: int):
    def send(packs: pa.Table, bits: pa.Table) -> pa.Table:
        answers, out = _by_seq(bits), []
        for row in _rows(packs):
            w = Windows(Pack(row), answers, row["seq"], buckets)
            for b, own in _by_bucket(_bucket_of(w.hash[w.lead], buckets), buckets):
                lead = w.lead[own]
                lead = lead[np.argsort(w.doc[lead], kind="stable")]
                out.append((b, row["part"], row["seq"], len(lead), w.hash[lead].tobytes(), _squeeze(w.doc[lead])))
        return pa.table([pa.array([o[i] for o in out], type=t) for i, t in enumerate([pa.int32()] * 4 + [pa.binary()] * 2)], names=[c.split()[0] for c in ASKED.split(", ")])

    return send


def _answer_windows(t: pa.Table) -> pa.Table:
    """One bit per distinct window of a pack: it also stands in a document smaller than the pack's smallest."""
    rows = list(_rows(t))
    h = np.concatenate([np.frombuffer(r["hashes"], dtype=np.uint64) for r in rows])
    d = np.concatenate([_restore(r["docs"], r["n"], np.int64) for r in rows])
    order, first, group = _groups(h)
    low = np.minimum.reduceat(d[order], first)[group]
    hit = np.empty(len(d), dtype=bool)
    hit[order] = d[order] > low
    ends = np.cumsum([r["n"] for r in rows])
    return _bits([(1, r["part"], r["seq"], r["bucket"], np.packbits(hit[e - r["n"] : e]).tobytes()) for r, e in zip(rows, ends) if hit[e - r["n"] : e].any()])


def _joined(p: Pack, gone: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Kept words of all documents, each followed by a space, and the documents' byte offsets."""
    w = p.words
    s, e = w.starts[~gone], w.ends[~gone]
    size = e - s + 1
    to = np.concatenate([[0], np.cumsum(size)])
    data = np.append(w.data, np.uint8(0x20))
    out = data[np.arange(to[-1]) + np.repeat(s - to[:-1], size)] if len(s) else np.zeros(0, dtype=np.uint8)
    out[to[1:] - 1] = 0x20
    kept = np.concatenate([[0], np.cumsum(~gone)])[w.first]
    return out.tobytes(), to[kept]


def _cut(buckets: int, with_text: bool):
    def cut(packs: pa.Table, bits: pa.Table) -> pa.Table:
        answers = _by_seq(bits)
        ids, n, removed, sha, text = [], [], [], [], []
        for row in _rows(packs):
            p = Pack(row)
            w = Windows(p, answers, row["seq"], buckets)
            bad = np.zeros(len(w.lead), dtype=bool)
            for b, own in _by_bucket(_bucket_of(w.hash[w.lead], buckets), buckets):
                own = own[np.argsort(w.doc[w.lead[own]], kind="stable")]
                bad[own] = _open_bits(answers, 1, row["seq"], b, len(own))
            covered = bad[w.kind] | (w.doc > w.doc[w.lead][w.kind])
            edge = np.zeros(len(p.hashes) + 1, dtype=np.int64)
            np.add.at(edge, w.word[covered], 1)
            np.add.at(edge, w.word[covered] + WINDOW, -1)
            gone = np.cumsum(edge)[:-1] > 0
            out, at = _joined(p, gone)
            cuts = np.concatenate([[0], np.cumsum(gone)])[p.words.first]
            for i in range(row["n"]):
                kept = out[at[i] : max(at[i], at[i + 1] - 1)]
                sha.append(hashlib.sha256(kept).hexdigest())
                text.append(kept.decode("utf-8", "replace") if with_text else None)
            ids.append(p.ids)
            n.append(p.counts)
            removed.append(np.diff(cuts))
        join = lambda a: pa.array(np.concatenate(a).astype(np.int64) if a else [], type=pa.int64())
        return pa.table([join(ids), join(n), join(removed), pa.array(sha, type=pa.string()), pa.array(text, type=pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256", "text"])

    return cut


def cut_repeats(docs: DataFrame, id_column: str = "doc_id", text: str = "text", with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (and the kept text if asked) of every document.

    Removed is each word covered by a window of WINDOW words whose words also
    start, in the same order, in a document with a smaller doc_id. Windows are
    judged on the input. kept_sha256 is of the kept words joined by one space.

    Texts are packed into a table bucketed by the part that wrote them, so the
    later passes meet their answers without moving texts. Anchors are compared
    by 39 or more bits, which may add windows to judge; windows by 64 bits.

    Null and empty text: no words. A null doc_id: its text is kept whole and is
    nobody's reference. Rows that repeat a doc_id are documents of their own;
    neither is smaller than the other. doc_id must be a whole number.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    # a null id sorts behind all others, and is taken out of the comparison below
    path, name = f"{scratch_dir(spark)}/packs-{uuid.uuid4().hex}", f"packs_{uuid.uuid4().hex}"
    parts = max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))
    named = rows.where("id is not null").mapInArrow(_packs, PACKS)
    named.write.bucketBy(parts, "part").option("path", path).saveAsTable(name)
    keep_until_release(spark, path, name)
    packs = spark.table(name)
    size = packs.agg(F.sum("size")).first()[0] or 0
    buckets = max(8, -(-size // BUCKET_BYTES))
    asked = packs.mapInArrow(_anchors(buckets), PROBES)
    hits = stage_batched(asked.groupBy("bucket").applyInArrow(_answer_anchors, BITS), rows=200)
    near = packs.groupBy("part").cogroup(hits.groupBy("part")).applyInArrow(_windows(buckets), ASKED)
    covered = stage_batched(near.groupBy("bucket").applyInArrow(_answer_windows, BITS), rows=200)
    answers = hits.unionByName(covered)
    out = stage_batched(packs.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(_cut(buckets, with_text), "doc_id long, n_words long, n_removed long, kept_sha256 string, text string"), rows=200)

    def whole(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for row, data, at in pieces(batch.column(1), PACK_BYTES):
                n = len(at) - 1
                p = Pack({"n": n, "size": len(data), "ids": _squeeze(np.zeros(n, dtype=np.int64)), "at": _squeeze(at), "texts": _squeeze(data.tobytes())})
                joined, ends = _joined(p, np.zeros(len(p.hashes), dtype=bool))
                kept = [joined[ends[i] : max(ends[i], ends[i + 1] - 1)] for i in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(n, pa.int64()), pa.array(p.counts.astype(np.int64)), pa.array(np.zeros(n, dtype=np.int64)), pa.array([hashlib.sha256(k).hexdigest() for k in kept]), pa.array([k.decode("utf-8", "replace") for k in kept], type=pa.string())],
                    ["doc_id", "n_words", "n_removed", "kept_sha256", "text"],
                )

    out = out.unionByName(rows.where("id is null").mapInArrow(whole, out.schema)).withColumnRenamed("doc_id", id_column)
    return out if with_text else out.drop("text")
