"""Token ids in directly addressable codes: byte levels with continuation bitmaps and rank directories, in files of Parquet rows.

An id is cut into bytes, lowest first. Level k holds the k-th byte of every id that has one, and a bitmap that
says which of them go on to level k + 1; a directory of running counts, one per BLOCK_BITS bits, answers how many
do so before a position. Token i is then found by one rank per level, without decoding any other token.
"""

from __future__ import annotations

import itertools
import re
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabkit.llm.batches import broadcast_below, small_batches, stage_batched
from tabkit.scale import running
from tabkit.session import scratch_dir, stage

BLOCK_BITS = 512
CHUNK_IDS = 1 << 18
SLICE_BYTES = 32 << 20
KEPT_PIECES, LONGEST_KEPT = 800_000, 48


class Codes:
    """n ids as directly addressable codes; levels are (bytes, bitmap, rank directory)."""

    def __init__(self, n: int, levels: list[tuple[bytes, bytes, bytes]]):
        self.n = n
        self.levels = [(np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8), np.frombuffer(c, np.uint32)) for a, b, c in levels]

    @staticmethod
    def encode(ids: np.ndarray) -> list[tuple[bytes, bytes, bytes]]:
        """Levels of an array of ids below 2**32; the last level in use has no bitmap. No ids: no levels."""
        left, out = np.asarray(ids, dtype=np.uint32), []
        while len(left):
            low, high = (left & 0xFF).astype(np.uint8), left >> 8
            more = high > 0
            if more.any():
                bits = np.packbits(more, bitorder="little")
                counts = np.add.reduceat(more, np.arange(0, len(more), BLOCK_BITS), dtype=np.uint32)
                ranks = np.concatenate([np.zeros(1, np.uint32), np.cumsum(counts[:-1], dtype=np.uint32)])
                out.append((low.tobytes(), bits.tobytes(), ranks.tobytes()))
            else:
                out.append((low.tobytes(), b"", b""))
            left = high[more]
        return out

    def rank(self, level: int, at: np.ndarray) -> np.ndarray:
        """Ids of the level before each position that go on to the next level."""
        _, bits, ranks = self.levels[level]
        at = np.asarray(at, dtype=np.int64)
        if len(at) > 8192:  # the bits looked at are one block per position
            return np.concatenate([self.rank(level, at[i : i + 8192]) for i in range(0, len(at), 8192)])
        block = at // BLOCK_BITS
        # a position just behind a full last block counts from that block's start
        block = np.minimum(block, len(ranks) - 1)
        start, span = block * (BLOCK_BITS // 8), BLOCK_BITS // 8
        byte = start[:, None] + np.arange(span)
        full = byte < (at // 8)[:, None]
        inside = np.bitwise_count(np.where(full, bits[np.minimum(byte, len(bits) - 1)], 0)).sum(axis=1, dtype=np.int64)
        rest = bits[np.minimum(at // 8, len(bits) - 1)] & ((1 << (at % 8)) - 1).astype(np.uint8)
        return ranks[block].astype(np.int64) + inside + np.bitwise_count(rest)

    def access(self, at: np.ndarray) -> np.ndarray:
        """The ids at any positions, each from one byte and one rank per level."""
        at = np.asarray(at, dtype=np.int64)
        out, own = np.zeros(len(at), dtype=np.uint32), np.arange(len(at))
        for k, (low, bits, _) in enumerate(self.levels):
            out[own] |= low[at].astype(np.uint32) << np.uint32(8 * k)
            if not len(bits):
                break
            more = (bits[at // 8] >> (at % 8).astype(np.uint8)) & 1 == 1
            own, at = own[more], at[more]
            if not len(at):
                break
            at = self.rank(k, at)
        return out

    def read(self, lo: int, hi: int) -> np.ndarray:
        """The ids lo to hi - 1: one rank per level finds where the run stands there."""
        own, out = np.arange(hi - lo), np.zeros(hi - lo, dtype=np.uint32)
        for k, (low, bits, _) in enumerate(self.levels):
            if lo >= hi:
                break
            out[own] |= low[lo:hi].astype(np.uint32) << np.uint32(8 * k)
            if not len(bits):
                break
            more = np.unpackbits(bits[lo // 8 : (hi + 7) // 8], bitorder="little")[lo % 8 : lo % 8 + hi - lo] == 1
            own = own[more]
            lo = int(self.rank(k, np.array([lo]))[0])
            hi = lo + len(own)
        return out


SPACE = " \t\n\r\x0b\x0c"  # fixed: white space to every pattern engine
LETTER = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff"  # fixed: letters to every pattern engine
WORD = f" ?[{LETTER}]++(?![^\x00-\x7f])"
PIECES = re.compile(f"{WORD}|[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
ONE_WORD = re.compile(f" ?[{LETTER}]+")
OTHER_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200d\u2028\u2029\u202f\u205f\u2060\u3000\ufeff]")


def byte_letters() -> dict[int, int]:
    """The byte-level alphabet: visible Latin-1 characters stand for themselves, the other bytes for 256 and up."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: b for b in own} | {b: 256 + k for k, b in enumerate(rest)}


class Encoder(dict):
    """Ids of texts by a byte-level BPE file of the tokenizers library, as bytes; remembers KEPT_PIECES pieces.

    Pieces repeat, texts do not. The file's word pattern reads from left to
    right and looks ahead only behind white space, so a text may be cut before
    white space that follows something else, and behind a run of letters. A
    piece that is one word of the pattern goes straight to the model, others
    through the whole tokenizer. Texts with other kinds of white space or with
    the name of an added token, and files with another word pattern or a
    normalizer, are encoded whole.
    """

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.letters = self.tokenizer.model, byte_letters()
        self.number = [i.to_bytes(4, sys.byteorder) for i in range(self.tokenizer.get_vocab_size())]
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        words = spec.get("pre_tokenizer") or {}
        plain = words.get("type") == "ByteLevel" and not words.get("add_prefix_space") and words.get("use_regex", True)
        self.by_piece = bool(plain and not any(spec.get(k) for k in ("normalizer", "truncation", "padding")))
        names = [t["content"] for t in spec.get("added_tokens", [])]
        self.names = re.compile("|".join(map(re.escape, names))) if names else None

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32).tobytes()

    def word(self, piece: str) -> bytes:
        tokens = self.model.tokenize(piece.encode().decode("latin-1").translate(self.letters))
        return b"".join([self.number[t.id] for t in tokens])

    def __missing__(self, piece: str) -> bytes:
        ids = self.word(piece) if ONE_WORD.fullmatch(piece) else self.whole(piece)
        if len(piece) <= LONGEST_KEPT:
            if len(self) >= KEPT_PIECES:
                self.clear()
            self[piece] = ids
        return ids

    def ids(self, text: str) -> np.ndarray:
        if not self.by_piece or OTHER_SPACE.search(text) or self.names and self.names.search(text):
            return np.frombuffer(self.whole(text), dtype=np.uint32)
        return np.frombuffer(b"".join(map(self.__getitem__, PIECES.findall(text))), dtype=np.uint32)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


LEVELS = "bytes array<binary>, bitmaps array<binary>, ranks array<binary>"


def _chunk(slice_: int, seq: int, docs: list, counts: list[int], ids: list[np.ndarray], kind: pa.DataType) -> pa.RecordBatch:
    levels = Codes.encode(np.concatenate(ids))
    blobs = [pa.array([[level[i] for level in levels]], type=pa.list_(pa.binary())) for i in range(3)]
    return pa.RecordBatch.from_arrays(
        [pa.array([slice_], pa.int32()), pa.array([seq], pa.int32()), pa.array([sum(counts)], pa.int64()), pa.array([docs], type=pa.list_(kind)), pa.array([counts], pa.list_(pa.int64())), *blobs],
        ["slice", "seq", "n", "docs", "counts", "bytes", "bitmaps", "ranks"],
    )


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int | None = 0, id_column: str = "doc_id", text: str = "text") -> None:
    """Write the ids of every whole text, each with end_id behind it, in ascending order of id_column.

    ``path/ids`` gets one Parquet row per chunk of whole documents (about
    CHUNK_IDS ids; a longer document has a chunk of its own) with the levels of
    its codes, ``path/chunks`` the place of every chunk in the whole sequence.
    Rows are range-partitioned in slices of about SLICE_BYTES of text and
    encoded where they are sorted; only chunk sizes meet in the running sum.

    Null and empty texts have no ids but end_id. Rows without an id come first,
    rows that repeat an id stand in the order of a hash of their text. An empty
    table gives an empty sequence. Other columns are ignored.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("doc"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))
    total = rows.agg(F.sum(F.octet_length("t").cast("long"))).first()[0] or 0
    tie = F.xxhash64("t")
    cut = rows.withColumn("tie", tie).repartitionByRange(max(1, -(-total // SLICE_BYTES)), "doc", "tie")
    cut = cut.withColumn("slice", F.spark_partition_id()).sortWithinPartitions("doc", "tie", "t").select("slice", "doc", "t")

    def encode(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, seq, slice_, docs_, counts, ids, size, kind_ = None, 0, 0, [], [], [], 0, None
        for batch in it:
            enc = enc or encoder(tokenizer)
            kind_ = batch.column(1).type
            for slice_, doc, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                own = enc.ids(t)
                if end_id is not None:
                    own = np.append(own, np.uint32(end_id))
                if docs_ and size + len(own) > CHUNK_IDS:
                    yield _chunk(slice_, seq, docs_, counts, ids, kind_)
                    seq, docs_, counts, ids, size = seq + 1, [], [], [], 0
                docs_.append(doc)
                counts.append(len(own))
                ids.append(own)
                size += len(own)
        if docs_:
            yield _chunk(slice_, seq, docs_, counts, ids, kind_)

    chunks = cut.mapInArrow(encode, f"slice int, seq int, n long, docs array<{kind}>, counts array<long>, {LEVELS}")
    with small_batches(docs.sparkSession, rows=500):
        chunks.write.parquet(f"{path}/ids")
    sizes = running(docs.sparkSession.read.parquet(f"{path}/ids").select("slice", "seq", "n"), None, [F.col("slice"), F.col("seq")], {"upto": F.col("n")})
    sizes.select("slice", "seq", "n", (F.col("upto") - F.col("n")).alias("first")).write.parquet(f"{path}/chunks")


def _codes(batch: pa.RecordBatch, i: int, n: int, first: int) -> Codes:
    parts = [batch.column(first + k)[i].as_py() for k in range(3)]
    return Codes(n, list(zip(*parts)))


def read_documents(spark: SparkSession, path: str, id_column: str = "doc_id") -> DataFrame:
    """id_column, start, n_tokens, ids_crc32 per written document, read back from the codes of its chunk."""
    files = spark.read.parquet(f"{path}/ids")
    kind = files.schema["docs"].dataType.elementType

    def check(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for i in range(batch.num_rows):
                slice_, seq, n = (batch.column(k)[i].as_py() for k in range(3))
                counts = np.array(batch.column(4)[i].as_py(), dtype=np.int64)
                at = np.concatenate([[0], np.cumsum(counts)])
                codes = _codes(batch, i, n, 5)
                ids = memoryview(codes.read(0, n).astype("<u4")).cast("B")
                sums = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in itertools.pairwise(at.tolist())]
                docs = batch.column(3).slice(i, 1).flatten()
                m = len(counts)
                yield pa.RecordBatch.from_arrays([pa.array([slice_] * m, pa.int32()), pa.array([seq] * m, pa.int32()), docs, pa.array(at[:-1]), pa.array(counts), pa.array(sums, pa.int64())], ["slice", "seq", id_column, "at", "n_tokens", "ids_crc32"])

    rows = stage_batched(files.mapInArrow(check, f"slice int, seq int, {id_column} {kind.simpleString()}, at long, n_tokens long, ids_crc32 long"), rows=8)
    places = spark.read.parquet(f"{path}/chunks").select("slice", "seq", "first")
    return rows.join(broadcast_below(places), ["slice", "seq"]).select(id_column, (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def read_tokens(spark: SparkSession, path: str, positions: DataFrame, position: str = "position") -> DataFrame:
    """positions with the column token, the id at that place of the whole sequence; null outside it and for null.

    A running count of chunk starts gives every position its chunk; a chunk
    then answers its distinct positions, at most as many as it has ids. Other
    columns and repeated rows stay.
    """
    places = spark.read.parquet(f"{path}/chunks")
    starts = places.select(F.col("first").alias("p"), F.lit(1).cast("long").alias("is_start"), "slice", "seq", "n")
    none = F.lit(None)
    asked = positions.select(F.col(position).cast("long").alias("p")).where("p >= 0").distinct()
    asked = asked.select("p", F.lit(0).cast("long").alias("is_start"), none.cast("int").alias("slice"), none.cast("int").alias("seq"), none.cast("long").alias("n"))
    met = stage(running(starts.unionByName(asked), None, [F.col("p"), F.col("is_start").desc()], {"chunk": F.col("is_start")}))
    home = met.where("is_start = 1").select("chunk", "slice", "seq", "n", F.col("p").alias("first"))
    wanted = met.where("is_start = 0").select("chunk", "p").join(home, "chunk").where("p < first + n").select("slice", "seq", (F.col("p") - F.col("first")).alias("at"), "p")
    wanted = stage(wanted.select("slice", "seq", "at", "p"))
    files = spark.read.parquet(f"{path}/ids").join(wanted.select("slice", "seq").distinct(), ["slice", "seq"], "left_semi").drop("docs", "counts")

    def answer(key: tuple, asked_: pa.Table, chunk: pa.Table) -> pa.Table:
        batch = chunk.combine_chunks().to_batches()[0]
        codes = _codes(batch, 0, batch.column(2)[0].as_py(), 3)
        return pa.table({"p": asked_["p"], "token": pa.array(codes.access(asked_["at"].to_numpy()).astype(np.int64))})

    found = wanted.groupBy("slice", "seq").cogroup(files.select("slice", "seq", "n", "bytes", "bitmaps", "ranks").groupBy("slice", "seq")).applyInArrow(answer, "p long, token long")
    own = stage(found).withColumnsRenamed({"p": "_p", "token": "_token"})
    out = positions.join(own, positions[position].cast("long") == own["_p"], "left")
    return out.select(*positions.columns, F.col("_token").alias("token"))


def token_ids(docs: DataFrame, tokenizer: str, end_id: int | None = 0, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the ids to a new folder of the shared scratch space and read every document back from it."""
    import uuid

    from tabkit.session import keep_until_release

    spark = docs.sparkSession
    path = f"{scratch_dir(spark)}/ids-{uuid.uuid4().hex}"
    keep_until_release(spark, path)
    write_ids(docs, path, tokenizer, end_id, id_column, text)
    return read_documents(spark, path, id_column)
