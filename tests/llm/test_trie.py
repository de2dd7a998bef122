import hashlib
import random
import zlib

import numpy as np
import pytest

from tabkit.llm import trie
from tabkit.llm.mixing import n_words
from tabkit.llm.queries import QUERIES
from tabkit.llm.trie import Minima, prefix_trie, rebuilt, turn_sequences

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    """Nodes of the op12 contract from (conv_id, turn, role, text) rows, prefix by prefix."""
    own = {}
    for c, t, r, x in rows:
        if c is not None:
            own.setdefault(c, []).append((t is not None, t or 0, r or "", hashlib.md5(f"{len(r or '')}:{r or ''}{x or ''}".encode()).hexdigest(), x or ""))
    seq = {c: [(r, x) for _, _, r, _, x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, v in seq.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(seq.get(c - c % 20, [])[:h] + v[h:])
    members = {}
    for c, v in built.items():
        for d in range(len(v) + 1):
            members.setdefault(v[:d], []).append(c)
    words = lambda t: len("".join(" " if ch in " \t\n\x0b\x0c\r" else ch for ch in t).split(" ")) - "".join(" " if ch in " \t\n\x0b\x0c\r" else ch for ch in t).split(" ").count("")
    out = []
    for p, m in members.items():
        below = [q for q in members if q[: len(p)] == p]
        kids = [q for q in below if len(q) == len(p) + 1]
        leaves = [q for q in below if not any(len(x) == len(q) + 1 and x[: len(q)] == q for x in below)]
        saved = sum((len(members[q]) - 1) * words(q[-1][1]) for q in below if q)
        ends = ",".join(str(c) for c in sorted(m) if len(built[c]) == len(p))
        up = min(members[p[:-1]]) if p else None
        out.append((min(m), len(p), up, len(m), len(kids), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out)


def query(spark, rows, tmp_path):
    spark.createDataFrame([(*r, "clash", b"x") for r in rows], "conv_id long, turn long, role string, text string, slice string, key binary").write.parquet(f"{tmp_path}/conversations.parquet")
    out = QUERIES["op12_prefix_trie"](spark, str(tmp_path))
    assert out.columns == COLUMNS
    return sorted(map(tuple, out.collect()))


def test_minima():
    rnd = np.random.default_rng(4)
    for n in (1, 2, 3, 17, 64, 200):
        v = rnd.integers(0, 5, n)
        m = Minima(v)
        lo = rnd.integers(0, n, 50)
        hi = np.array([rnd.integers(a, n) for a in lo])
        assert m.of(lo, hi).tolist() == [v[a : b + 1].min() for a, b in zip(lo, hi)]
        least = rnd.integers(0, 6, 50)
        for r, d, right, left in zip(lo, least, m.reach_right(lo, least), m.reach_left(lo, least)):
            e, s = r, r
            while e + 1 < n and v[e + 1] >= d:
                e += 1
            while s >= 1 and v[s] >= d:
                s -= 1
            assert (right, left) == (e, s)


@pytest.mark.parametrize("slice_turns", [8, 60, 1 << 15])
def test_against_all_prefixes(spark, monkeypatch, tmp_path, slice_turns):
    monkeypatch.setattr(trie, "SLICE_TURNS", slice_turns)
    rnd = random.Random(slice_turns)
    texts = ["hello there", "a  b\tc", "", None, "same words again", "x"]
    rows = []
    for c in range(140):
        for t in range(rnd.choice([1, 1, 2, 3, 5])):
            rows.append((c, t, rnd.choice(["user", "assistant"]) if t > 1 else "user", rnd.choice(texts[:3] if t < 2 else texts)))
    rows += [(c, t, "user", "copy") for c in range(200, 260) for t in range(6)]  # one long passage of copies over many slices
    rows += [(300, None, None, None), (300, None, "user", "tie a"), (300, 1, "user", "tie b"), (300, 1, "user", "tie b"), (None, 1, "user", "nobody"), (-7, 1, "user", "minus")]
    rnd.shuffle(rows)
    # % follows the sign of its left side, as in SQL
    want = brute([r for r in rows if r[0] != -7])
    got = query(spark, [r for r in rows if r[0] != -7], tmp_path)
    assert got == want
    assert (-7 in {r[0] for r in query(spark, rows, f"{tmp_path}/with")})


def test_long_conversation(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(trie, "SLICE_TURNS", 100)
    rows = [(c, t, "user", "again and again") for c in (1, 2, 3) for t in range(400 + c)] + [(9, 0, "user", "z " * 100_000)]
    assert query(spark, rows, tmp_path) == brute(rows)


def test_empty_and_turnless(spark, tmp_path):
    assert query(spark, [], tmp_path) == []
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert turn_sequences(none, n_words("text")).count() == 0
    bare = spark.createDataFrame([(4, []), (2, [])], "conv long, turns array<struct<digest: string, words: int>>")
    assert [tuple(r) for r in prefix_trie(bare).collect()] == [(2, 0, None, 2, 0, 1, 0, hashlib.sha256(b"2,4").hexdigest())]


def test_rebuilt_takes_the_base(spark):
    from pyspark.sql import functions as F

    s = spark.createDataFrame([(20, [("a", 1), ("b", 1), ("c", 1)]), (21, [("x", 2), ("y", 2)]), (45, [("q", 1)])], "conv long, turns array<struct<digest: string, words: int>>")
    out = rebuilt(s, F.col("conv") - F.col("conv") % 20, F.lit(2), most=3)
    assert {r["conv"]: [t["digest"] for t in r["turns"]] for r in out.collect()} == {20: ["a", "b", "c"], 21: ["a", "b"], 45: []}
