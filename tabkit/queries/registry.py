from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def put(fn):
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def soundex_sql(x: str) -> str:
    """The soundex code as DuckDB SQL, which has no such function; a sign that is no letter parts like a vowel."""
    w = f"regexp_replace(upper({x}), '[^A-Z]', 'A', 'g')"
    codes = f"translate({w}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '01230127022455012623017202')"
    body = f"({codes}[1] || replace({codes}[2:], '7', ''))"
    for digit in "0123456":
        body = f"regexp_replace({body}, '{digit}+', '{digit}', 'g')"
    return f"({w}[1] || (replace({body}[2:], '0', '') || '000')[:3])"
