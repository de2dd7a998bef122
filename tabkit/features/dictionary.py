"""Stored dictionaries of levels and tokens, and features as sparse blocks.

A dictionary is a table (level, code) written once; levels meet rows by a join,
so a column may have any number of them and none is on the driver. A block is
one sparse vector column that stands for all 0/1 or count columns of a
dictionary; models take it beside plain columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabkit.features.levels import level_table, rank_table
from tabkit.features.recipe import Step, resolve
from tabkit.scale import broadcast_if_small
from tabkit.session import stage, stage_path


def block_name(c: str) -> str:
    return f"{c}_block"


def block_size(df: DataFrame, c: str) -> int | None:
    """Length of a block column, None for any other."""
    return df.schema[c].metadata.get("ml_attr", {}).get("num_attrs") if isinstance(df.schema[c].dataType, VectorUDT) else None


class _Writer(DefaultParamsWriter):
    def saveImpl(self, path):
        super().saveImpl(path)
        for i, (_, table, _) in enumerate(self.instance.dictionaries()):
            self.sparkSession.read.parquet(table).write.parquet(f"{path}/dictionary_{i}")


class _Reader(DefaultParamsReader):
    def load(self, path):
        m = super().load(path)
        m._set(tables=[[c, f"{path}/dictionary_{i}", n] for i, (c, _, n) in enumerate(m.dictionaries())])
        return m


class Dictionaries(Model, MLWritable, MLReadable):
    """Fitted form with one stored dictionary per column; saved together with them."""

    tables = Param(Params._dummy(), "tables", "column, path of its dictionary, number of levels", TypeConverters.identity)
    options = Param(Params._dummy(), "options", "what is made of the codes", TypeConverters.identity)

    def __init__(self, tables=None, options=None):
        super().__init__()
        self._set(tables=[list(t) for t in (tables or [])], options=dict(options or {}))

    def dictionaries(self) -> list[tuple[str, str, int]]:
        return [tuple(t) for t in self.getOrDefault(self.tables)]

    def dictionary(self, df: DataFrame, c: str) -> DataFrame:
        """(level, code from 1) of a column."""
        return df.sparkSession.read.parquet({k: p for k, p, _ in self.dictionaries()}[c]).select("level", "code")

    def write(self):
        return _Writer(self)

    @classmethod
    def read(cls):
        return _Reader(cls)

    def _coded(self, df: DataFrame, c: str) -> DataFrame:
        """df with _code, null where the level is missing or unknown. Nulls are dealt out by the other columns' hash, not to one task."""
        t = self.dictionary(df, c).select(F.col("level").alias("_level"), F.col("code").alias("_code"))
        return df.join(broadcast_if_small(t), F.col(c).cast("string") == F.col("_level"), "left").drop("_level")


class LevelCodes(Dictionaries):
    """Columns rewritten from their codes: kept or pooled, binary digits, index or rank."""

    def _transform(self, df: DataFrame) -> DataFrame:
        o = self.getOrDefault(self.options)
        for c, _, n in self.dictionaries():
            d, code, own = self._coded(df, c), F.col("_code"), F.col(f"`{c}`")
            if o["form"] == "novel":
                made = {c: F.when(own.isNull() | code.isNotNull(), own).otherwise(F.lit(o["new"]))}
            elif o["form"] == "index":
                made = {c: F.coalesce(code - 1, F.lit(n).cast("long"))}
            elif o["form"] == "rank":
                made = {c: code}
            else:
                bits = max(1, n.bit_length())
                made = {f"{c}_{i}": F.shiftright(F.coalesce(code, F.lit(0).cast("long")), bits - 1 - i).bitwiseAND(F.lit(1).cast("long")) for i in range(bits)}
            d = d.withColumns(made)
            df = d.drop("_code") if c in made else d.drop("_code", c)
        return df


def _vectors(df: DataFrame, sizes: dict[str, int]) -> DataFrame:
    """Columns (indices, values) stored and read back as sparse vectors of the given sizes, in the form Parquet keeps them in."""
    form = {c: F.struct(F.lit(0).cast("byte").alias("type"), F.lit(n).alias("size"), F.col(f"`{c}`.indices").alias("indices"), F.col(f"`{c}`.values").alias("values")) for c, n in sizes.items()}
    path = stage_path(df.withColumns(form))
    fields = [T.StructField(f.name, VectorUDT(), True, {"ml_attr": {"num_attrs": sizes[f.name]}}) if f.name in sizes else f for f in df.schema.fields]
    return df.sparkSession.read.schema(T.StructType(fields)).parquet(path)


class SparseBlocks(Dictionaries):
    """One block column per categorical or token column in place of a column per level or token.

    Missing, unknown and (without keep_first) first levels are all zeros. The
    rows are written once with their blocks.
    """

    def _transform(self, df: DataFrame) -> DataFrame:
        o, sizes = self.getOrDefault(self.options), {}
        skip = 0 if o["keep_first"] else 1
        none = F.array().cast("array<int>"), F.array().cast("array<double>")
        for c, _, n in self.dictionaries():
            sizes[block_name(c)] = max(n - skip, 0)
            if o["form"] == "level":
                d = self._coded(df, c)
                at = F.col("_code") - 1 - skip
                pair = F.struct(F.when(at >= 0, F.array(at.cast("int"))).otherwise(none[0]).alias("indices"), F.when(at >= 0, F.array(F.lit(1.0))).otherwise(none[1]).alias("values"))
                df = d.withColumn(block_name(c), pair).drop("_code", c)
                continue
            df = stage(df.withColumn("_row", F.monotonically_increasing_id()))
            t = self.dictionary(df, c)
            held = df.select("_row", F.explode(c).alias("level")).groupBy("_row", "level").agg(F.count(F.lit(1)).cast("double").alias("n"))
            held = held.join(broadcast_if_small(t), "level")
            pairs = F.sort_array(F.collect_list(F.struct((F.col("code") - 1 - skip).cast("int").alias("i"), F.col("n").alias("n"))))
            rows = held.where(F.col("code") > skip).groupBy("_row").agg(pairs.alias("_p"))
            rows = rows.select("_row", F.struct(F.transform("_p", lambda p: p["i"]).alias("indices"), F.transform("_p", lambda p: p["n"]).alias("values")).alias("_pair"))
            df = df.join(rows, "_row", "left").withColumn(block_name(c), F.coalesce("_pair", F.struct(none[0].alias("indices"), none[1].alias("values")))).drop("_row", "_pair", c)
        return _vectors(df, sizes) if sizes else df


def learn_levels(df: DataFrame, cols: Sequence[str], order: str = "name") -> list[list]:
    """[column, path of its stored dictionary, number of levels]; codes from 1 by name or by falling count."""
    out = []
    for c in cols:
        own = df.select(F.col(c).cast("string").alias(c))
        path = stage_path(level_table(own, c) if order == "name" else rank_table(own, c))
        out.append([c, path, df.sparkSession.read.parquet(path).count()])
    return out


def learn_tokens(df: DataFrame, cols: Sequence[str], max_tokens: int | None = None, min_times: int = 0) -> list[list]:
    """Dictionaries of token columns: the max_tokens commonest (None: all) seen at least min_times, coded by name."""
    out = []
    for c in cols:
        n = stage(df.select(F.explode(c).alias(c)).where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_times))
        if max_tokens is not None:
            n = n.orderBy(F.desc("n"), c).limit(max_tokens)
        path = stage_path(level_table(n, c))
        out.append([c, path, df.sparkSession.read.parquet(path).count()])
    return out


class DictionaryStep(Step):
    """A step that learns a dictionary per column. ``form``: novel, digits, index or rank."""

    form, order = "index", "name"

    def options(self) -> dict:
        return {"form": self.form}

    def _fit(self, df):
        return LevelCodes(learn_levels(df, resolve(self.select, df, self.roles), self.order), self.options())


def block_entries(df: DataFrame, c: str, keep: Sequence[str], fitted: SparseBlocks) -> DataFrame:
    """The non-zero entries of the block of column c in long form: the kept columns, level, value."""
    block, skip = block_name(c), 0 if fitted.getOrDefault(fitted.options)["keep_first"] else 1
    path = stage_path(df.select(*keep, block))
    kind = T.StructType.fromDDL("type byte, size int, indices array<int>, values array<double>")
    fields = [T.StructField(f.name, kind) if f.name == block else f for f in df.select(*keep, block).schema.fields]
    pairs = df.sparkSession.read.schema(T.StructType(fields)).parquet(path)
    pairs = pairs.select(*keep, F.explode(F.arrays_zip(F.col(f"{block}.indices").alias("i"), F.col(f"{block}.values").alias("value"))).alias("_p"))
    pairs = pairs.select(*keep, (F.col("_p.i") + 1 + skip).cast("long").alias("_code"), F.col("_p.value").alias("_value"))
    names = fitted.dictionary(df, c).toDF("_level", "_code")
    return pairs.join(broadcast_if_small(names), "_code").select(*keep, F.col("_level").alias("level"), F.col("_value").alias("value"))


def level_weights(fitted, step: SparseBlocks, c: str, df: DataFrame) -> DataFrame:
    """(level, weight) of a linear fit that took the block of column c; a level the block leaves out weighs 0.

    The weights are the model's own vector, which every fit holds; levels join them by code.
    """
    start, width = 0, 0
    for f, n in zip(fitted.features, fitted.extra["widths"]):
        if f == block_name(c):
            width = n
            break
        start += n
    skip = 0 if step.getOrDefault(step.options)["keep_first"] else 1
    own = fitted.model.coefficients.toArray()[start : start + width]
    rows = df.sparkSession.createDataFrame(((i + 1 + skip, float(w)) for i, w in enumerate(own)), "code long, weight double")
    return step.dictionary(df, c).join(rows, "code", "left").select("level", F.coalesce("weight", F.lit(0.0)).alias("weight"))


def level_contributions(fitted, step: SparseBlocks, c: str, df: DataFrame, row_id: str) -> DataFrame:
    """(row_id, contribution) of a categorical column in a linear fit with its block: its level's weight less the mean weight over df's rows."""
    w = stage(level_weights(fitted, step, c, df).toDF("_level", "_weight"))
    met = df.select(F.col(row_id).alias("_id"), F.col(c).cast("string").alias("_level")).join(broadcast_if_small(w), "_level", "left")
    met = met.select(F.col("_id").alias(row_id), F.coalesce("_weight", F.lit(0.0)).alias("_weight"))
    mean = met.agg(F.avg("_weight").alias("_mean"))
    return met.crossJoin(F.broadcast(mean)).select(row_id, (F.col("_weight") - F.col("_mean")).alias("contribution"))
