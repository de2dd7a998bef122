"""Corpus preparation: quality filter, line dedup, near dedup, source mix, packing. Part of the subpackage tabkit.llm."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabkit.llm.batches import broadcast_below
from tabkit.llm.lines import dedup_lines
from tabkit.llm.mixing import mix_sources, n_words
from tabkit.llm.nearcopies import near_copies
from tabkit.llm.packing import best_fit, same_text
from tabkit.llm.quality import keep_good
from tabkit.session import stage

CAPACITY = 2048
LEAST_QUALITY = 0.3


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose line CRF score is at least LEAST_QUALITY; unlabelled ones are scored like all others.

    Null and empty texts are one empty line and are scored as such. Rows with
    null or repeated ids are scored one by one. Without labels every document
    stays. Other columns pass through, whatever their names; an empty table
    stays empty.
    """
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), LEAST_QUALITY)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their texts without lines that repeat an earlier one; n_chars follows the text.

    A text that loses all its lines is empty and its row goes on, as does a null
    text; both are without words, so later stages neither link nor pack them.
    Rows with null ids stay whole, rows that repeat an id keep the same line
    numbers. Other columns pass through, but n_lines and n_removed, if the
    documents have columns of that name, come out as they went in. An empty
    table stays empty.
    """
    columns = docs.columns
    # the operator's own counts go; columns of their names are put by meanwhile
    aside = {c: f"_own_{c}" for c in ("n_lines", "n_removed") if c in columns}
    out = dedup_lines(docs.withColumnsRenamed(aside)).drop("n_lines", "n_removed").withColumnsRenamed({v: k for k, v in aside.items()})
    return out.withColumn("n_chars", F.length("text").cast("long")).select(columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest doc_id, of every group linked by 5-word shingles with similarity 0.8 or more.

    Documents without words and rows without doc_id are in no group and stay.
    """
    gone = stage(near_copies(docs, k=5, per_cent=80).where("not kept").select("doc_id").distinct())
    return docs.join(broadcast_below(gone), "doc_id", "left_anti").select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it: not at all, or in up to three rows.

    Rows without doc_id cannot be named by the mix and stay once; rows that
    repeat a doc_id get the largest number of copies drawn for it.
    """
    named = docs.where("doc_id is not null")
    copies = mix_sources(named).groupBy("doc_id").agg(F.max("copies").alias("_copies")).where("_copies > 0")
    taken = named.join(copies, "doc_id").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))))
    return taken.select(docs.columns).unionByName(docs.where("doc_id is null"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all texts in bins of CAPACITY words; copies of a text and texts of one source never share a bin.

    Texts without words, null or empty, are in no bin and give no rows; longer
    texts than a bin are cut. Rows with null ids are packed like others, rows
    that repeat an id are texts of their own. An empty table gives no bins.
    """
    return best_fit(docs, n_words("text"), same_text("text"), CAPACITY)


STAGES = [("quality", quality), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("mix", mix), ("pack", pack)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, step in STAGES:
        docs = stage(step(spark, docs, sf_dir))
    return docs
