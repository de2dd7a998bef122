import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tabkit.llm import tokenids
from tabkit.llm.tokenids import Codes, encoder, read_documents, read_tokens, token_ids, write_ids

public = pytest.importorskip("public_tokenizers")
PATH = public.path("byte_bpe_50k.json")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=1500), st.randoms())
def test_codes_give_every_id_back(ids, rnd):
    a = np.array(ids, dtype=np.uint32)
    codes = Codes(len(a), Codes.encode(a))
    assert codes.read(0, len(a)).tolist() == ids
    at = [rnd.randrange(len(ids)) for _ in range(20)] if ids else []
    assert codes.access(np.array(at, dtype=np.int64)).tolist() == [ids[i] for i in at]
    lo = rnd.randint(0, len(ids))
    hi = rnd.randint(lo, len(ids))
    assert codes.read(lo, hi).tolist() == ids[lo:hi]


@pytest.mark.parametrize("n", [511, 512, 513, 1024, 20000])
def test_rank_at_block_edges(n):
    a = (np.arange(n) * 7919 % 70000).astype(np.uint32)
    codes = Codes(n, Codes.encode(a))
    assert codes.access(np.arange(n)).tolist() == a.tolist()
    assert codes.rank(0, np.array([0, n])).tolist() == [0, int((a > 255).sum())]


def test_pieces_give_the_ids_of_whole_texts():
    e, rnd = encoder(PATH), random.Random(3)
    letters = list("ab'std ,.  \n\t\r1²½é߼ªº中٣×÷_-") + ["don't", " I'll", "'s", "<|endoftext|>", "  ", "\x85", "\x1c", " ", "​", "é", "ж"]
    for _ in range(20000):
        t = "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 14)))
        assert e.ids(t).tolist() == e.tokenizer.encode(t, add_special_tokens=False).ids, t


def brute(rows):
    """Rows in order of id; equal ids here have equal texts."""
    from tokenizers import Tokenizer

    tok, start, out = Tokenizer.from_file(PATH), 0, []
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4")
        out.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_documents_and_tokens_read_back(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(tokenids, "CHUNK_IDS", 64)
    monkeypatch.setattr(tokenids, "SLICE_BYTES", 2000)
    rnd = random.Random(1)
    words = ["the", "Straße", "naïve", "data", "x1", "\n", "  ", "中文", "isn't"]
    rows = [(i * 3 - 20, " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 40)))) for i in range(120)]
    rows += [(500, None), (501, ""), (502, "word " * 3000), (None, "no id"), (503, "twice"), (503, "twice")]
    df = spark.createDataFrame([(d, t, "clash", 1) for d, t in rows], "doc_id long, text string, slice string, n int").repartition(5)
    path = f"{tmp_path}/ids"
    write_ids(df, path, PATH)
    want = brute(rows)
    got = [tuple(r) for r in read_documents(spark, path).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert spark.read.parquet(f"{path}/ids").count() > 20
    tok = encoder(PATH).tokenizer
    every = [i for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0])) for i in [*tok.encode(t or "", add_special_tokens=False).ids, 0]]
    asked = [rnd.randrange(len(every)) for _ in range(300)] + [0, len(every) - 1, len(every), -1, None]
    out = read_tokens(spark, path, spark.createDataFrame([(p, "keep") for p in asked], "position long, token_note string"))
    assert out.columns == ["position", "token_note", "token"]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(((p, "keep", every[p] if p is not None and 0 <= p < len(every) else None) for p in asked), key=str)


def test_one_id_for_many_rows(spark, monkeypatch):
    monkeypatch.setattr(tokenids, "SLICE_BYTES", 500)
    df = spark.createDataFrame([(7, f"text {i % 3}") for i in range(300)], "doc_id long, text string")
    got = token_ids(df, PATH).collect()
    assert sorted(r["start"] for r in got) == sorted(np.cumsum([0] + [3] * 299).tolist()) and {r["doc_id"] for r in got} == {7}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    out = token_ids(df, PATH)
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and out.count() == 0


def test_query(spark):
    from tabkit.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted(map(tuple, QUERIES["op13_directly_addressable_ids"](spark, sf).collect())) == sorted(brute(rows))
