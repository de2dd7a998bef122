import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabkit.llm import covertree
from tabkit.llm.covertree import CoverTree, floors, product_codes
from tabkit.llm.queries import QUERIES


def lloyd(vectors, parts=8, entries=16, rounds=6):
    """Codes, errors and books of (id, label, list of integers) rows by plain comparison."""
    rows = sorted(vectors, key=lambda r: (r[0], r[2]))
    x = np.array([r[2] for r in rows], dtype=np.int64).reshape(len(rows), parts, -1)
    books = [x[:entries, p].copy() for p in range(parts)]
    near = lambda p: ((x[:, p, None] - books[p][None]) ** 2).sum(axis=2)
    for _ in range(rounds):
        for p in range(parts):
            own = near(p).argmin(axis=1)
            for e in range(len(books[p])):
                if (own == e).any():
                    books[p][e] = [int(s) // int((own == e).sum()) for s in x[own == e, p].sum(axis=0)]
    code = np.stack([near(p).argmin(axis=1) for p in range(parts)], axis=1)
    error = sum(near(p).min(axis=1) for p in range(parts))
    digest = hashlib.sha256(",".join(str(v) for b in books for v in b.ravel().tolist()).encode()).hexdigest()
    by = {}
    for r, e in zip(rows, error.tolist()):
        by[r[1]] = by.get(r[1], 0) + e
    return sorted((r[0], "".join(f"{c:02x}" for c in cs), e, by[r[1]], digest) for r, cs, e in zip(rows, code.tolist(), error.tolist()))


@pytest.mark.parametrize("kind", ["clusters", "noise", "copies", "one"])
def test_tree_assigns_like_plain_comparison(kind):
    rng = np.random.default_rng(7)
    x = rng.integers(-400, 400, (1500, 4))
    if kind == "clusters":
        x = rng.integers(-40, 40, (6, 4))[rng.integers(0, 6, 1500)] * 1000 + rng.integers(-9, 9, (1500, 4))
    if kind == "copies":
        x = np.repeat(x[:5], 300, axis=0)
    if kind == "one":
        x = x[:1]
    tree = CoverTree.build(x)
    books = np.concatenate([x[:12], x[:3]])  # repeated entries tie
    entry, sums, counts, compared = tree.assign(books)
    want = ((x[:, None] - books[None]) ** 2).sum(axis=2).argmin(axis=1)
    own = np.empty(len(x), dtype=np.int64)
    own[tree.perm] = entry
    assert own.tolist() == want.tolist()
    assert counts.tolist() == np.bincount(want, minlength=len(books)).tolist()
    assert sums.tolist() == [x[want == e].sum(axis=0).tolist() for e in range(len(books))]
    if kind in ("clusters", "copies"):
        assert compared < len(x)
    if kind == "copies":
        assert compared == 0


def test_nets_cover_and_stay_apart():
    rng = np.random.default_rng(2)
    x = rng.integers(-1000, 1000, (2000, 3))
    t = CoverTree.build(x)
    for i in range(len(t.start)):
        d = np.sqrt(((t.x[t.start[i] : t.end[i]] - t.x[t.centre[i]]) ** 2).sum(axis=1))
        assert d.max() <= t.radius[i] + 1e-9
        if t.n_child[i]:
            kids = range(t.child[i], t.child[i] + t.n_child[i])
            assert t.start[kids[0]] == t.start[i] and t.end[kids[-1]] == t.end[i] and all(t.end[a] == t.start[a + 1] for a in kids[:-1])
            assert t.centre[i] in [t.centre[k] for k in kids]
    # the points of the last level are a net: no two of them as near as any point is to its own
    last = t.centre[t.n_child == 0]
    apart = np.sqrt(((t.x[last][:, None] - t.x[last][None]) ** 2).sum(axis=2))
    assert apart[~np.eye(len(last), dtype=bool)].min() >= t.radius[t.n_child == 0].max() - 1e-9


def rows_of(rng, n, dim=16):
    return [(i * 2 % (n + 1), int(rng.integers(0, 4)) if rng.random() < 0.8 else None, (rng.normal(size=dim) / 3).tolist()) for i in range(n)]


def test_codes_against_plain_lloyd(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(covertree, "BLOCK_ROWS", 64)
    rng = np.random.default_rng(11)
    rows = rows_of(rng, 400)
    rows += [(1000 + i, 1, rows[3][2]) for i in range(150)]  # a hot vector
    odd = [(2001, 1, None), (2002, 1, [1.0, None] * 8), (2003, None, [float("nan")] * 16), (2004, 2, [float("inf")] * 16)]
    spark.createDataFrame([(*r, "c", 0.5) for r in rows + odd], "vec_id long, label int, embedding array<double>, code string, error double").repartition(7).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = QUERIES["op11_cover_tree_codes"](spark, str(tmp_path))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    whole = [(i, k, [int(np.floor(4096 * x)) for x in v]) for i, k, v in rows]
    assert sorted(map(tuple, got.collect())) == lloyd(whole)


def test_odd_rows(spark):
    kind = "vec_id long, label int, embedding array<double>"
    good = [(i, 0, [i / 10, -i / 7] * 4) for i in range(5)]
    odd = [(None, 0, [0.5] * 8), (10, 0, [1.0] * 7), (11, None, []), (12, 3, None), (13, 3, [1e30] * 8), (14, 3, [1.0] * 16)]
    out = product_codes(spark.createDataFrame(good + odd, kind), floors("embedding", 4096))
    got = {r["vec_id"]: (r["code"], r["error"], r["label_error"]) for r in out.collect()}
    assert len(got) == 11 and got[None][0] is not None
    assert all(got[i][:2] == (None, None) for i in (10, 11, 12, 13, 14)) and got[12][2] is None
    want = lloyd([(i, 0, [int(np.floor(4096 * x)) for x in v]) for i, _, v in good])
    assert all(len(c) == 16 for c, *_ in (got[i] for i in range(5))) and len(want) == 5
    assert product_codes(spark.createDataFrame([], kind), floors("embedding", 4096)).count() == 0
    none = product_codes(spark.createDataFrame([(None, 1, [0.1] * 8)], kind), floors("embedding", 4096)).collect()
    assert [(r["code"], r["codebooks_sha256"]) for r in none] == [(None, hashlib.sha256(b"").hexdigest())]


def test_repeated_ids_and_no_label(spark):
    rows = [(1, [0.0] * 8)] * 3 + [(1, [1.0] * 8), (2, [1.0] * 8)]
    out = product_codes(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.transform("embedding", lambda x: x.cast("long")), entries=4, label=None).collect()
    assert sorted((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in out) == [(1, "00" * 8, 0, None)] * 3 + [(1, "03" * 8, 0, None), (2, "03" * 8, 0, None)]
