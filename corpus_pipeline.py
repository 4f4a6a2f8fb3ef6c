"""From raw documents to packed sequences: five stages, each written as Parquet and read again by the next.

The first four keep the columns of documents, whatever further columns there are and however they are named. A document
whose text is wholly made of strings of earlier documents ends at the fourth stage; bytes of a sign that lost part of its
own are dropped. Tables may hold nulls, empty texts and repeated rows: each stage treats them as its operator says. Of
repeated rows of one document the third stage keeps one, if their document stays.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from facetforge.llm import packing, quality, simhash, suffixes, toxicity
from facetforge.llm.common import Stored, cleared, fold, labels, packed, tuned, unpacked
from facetforge.llm.queries import TOKENIZER


def beside(docs: DataFrame, own: str, judge: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows that `judge` leaves, with the documents' own columns, also those that start as the judge's do."""
    names = [f"kept {i}" if c.lower().startswith(own) else c for i, c in enumerate(docs.columns)]
    return judge(docs.toDF(*names)).select(*(F.col(f"`{n}`") for n in names)).toDF(*docs.columns)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality posterior is at least a half."""
    known = labels(spark, sf_dir)
    return beside(docs, "quality_", lambda rows: quality.judged(rows, known, F.col("source"), F.col("lang")).where("quality_keep"))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score under a half."""
    known = labels(spark, sf_dir)
    return beside(docs, "toxicity_", lambda rows: toxicity.judged(rows, known, fold(F.col("id"), 5) != 0).where("toxicity_score < 0.5"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document that names its component, for each component; of repeated rows with its id, the first by their texts'
    hashes. Rows with a null id stay: they name no component."""
    found = simhash.near_duplicates(tuned(spark) and docs)
    stays = found.where("doc_id is not null and doc_id = component_id").select(F.col("doc_id").alias("id")).distinct()
    rows = packed(docs, id=F.col("doc_id"))
    order = Window.partitionBy("id").orderBy(F.xxhash64("row.text"), "row.text")
    once = rows.join(stays, "id", "left_semi").withColumn("n", F.row_number().over(order)).where("n = 1").select("row")
    return unpacked(once.unionByName(rows.where("id is null").select("row")))


def suffix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the strings of 50 bytes that earlier ones have; those with nothing left go."""
    tuned(spark)
    found = suffixes.without_repeats(docs, keep_row=True)
    cut = F.size("spans") > 0
    rest = lambda c: F.col("row").getField(c)
    made = {"text": F.col("kept_text"), "n_chars": F.when(cut, F.length("kept_text").cast("long")).otherwise(rest("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None))}
    rows = found.where(~cut | (F.col("kept_text") != ""))
    return rows.select(*((made[c] if c in made else rest(c)).alias(c) for c in docs.columns))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each sequence, with its ids."""
    return packing.pack(tuned(spark) and docs, TOKENIZER)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("suffix_dedup", suffix_stage),
    ("packing", packing_stage),
]
#: No SQL expresses the trained stages; tests/llm/test_pipeline.py holds each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. What a stage stored by the way, and its input, goes once its own rows are written."""
    docs, before = tuned(spark).read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        with cleared():
            rows = stage(spark, docs, sf_dir)
            after = Stored(rows, name, lasting=True)
        if before:
            before.drop()
        docs, before = after.df, after
    return docs
