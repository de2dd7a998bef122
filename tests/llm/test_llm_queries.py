"""Queries of the subpackage beside their SQL twins on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tabkit.llm import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def plain(v):
    return str(v) if v is None or isinstance(v, (str, bool)) else f"{float(v):.9g}"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_twin(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels", "conversations"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    res = con.execute(queries.ORACLE[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == cols
    want = sorted(tuple(plain(r[names.index(c)]) for c in cols) for r in res.fetchall())
    assert sorted(tuple(plain(r[c]) for c in cols) for r in df.collect()) == want


def test_all_are_registered():
    names = entry.queries()
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names
