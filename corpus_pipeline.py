"""Five stages over ``documents``: quality rules, line dedup, near-dedup, decontamination, SentencePiece ids."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm._shared import Scratch
from sparkloom.llm.decontaminate import decontaminate
from sparkloom.llm.line_dedup import line_dedup
from sparkloom.llm.near_dedup import near_duplicates
from sparkloom.llm.quality_rules import quality_rules
from sparkloom.llm.sentencepiece_codec import sentencepiece_encode

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
MODEL = os.path.join(os.environ.get("SPARKLOOM_TOKENIZERS", "/opt/tokenizers"), "piece_bpe_32k.model")


def _with_text(df: DataFrame, text: str) -> DataFrame:
    """The columns of documents with another text, and its length."""
    return df.withColumn("text", F.col(text)).withColumn("n_chars", F.length(text).cast("long")).select(*COLUMNS)


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass, without the lines that fail."""
    return _with_text(quality_rules(docs, COLUMNS).filter("kept"), "clean_text")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of 20 code points that three documents hold stay in one; documents left without a word go."""
    return _with_text(line_dedup(docs, columns=COLUMNS).filter(F.col("kept_text").rlike(r"[^\x20\x09-\x0D]")), "kept_text")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group that 5-word shingles link at 0.8, the one with the least doc_id; rows without doc_id or with one
    that others share too are rows of their own, behind all others."""
    scratch = Scratch(spark, "near-rows")
    shared = scratch.save(docs.groupBy("doc_id").count().filter("count > 1 or doc_id is null").select(F.col("doc_id").alias("_id")), "shared")
    rows = docs.withColumn("_row", F.col("doc_id").cast("long"))
    if not shared.isEmpty():
        top = max(docs.agg(F.max("doc_id")).first()[0] or 0, 0)
        same = F.col("doc_id").eqNullSafe(F.col("_id"))
        odd = scratch.save(docs.join(shared, same, "left_semi").withColumn("_row", F.monotonically_increasing_id() + F.lit(top + 1)), "odd")
        rows = rows.join(shared, same, "left_anti").unionByName(odd)
    kept = near_duplicates(rows.select(F.col("_row").alias("doc_id"), "text"), k=5, percent=80).filter("kept").select(F.col("doc_id").alias("_row"))
    return rows.join(kept, "_row", "left_semi").select(*COLUMNS)


def clean_of_tests(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated with the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate(docs, benchmark, COLUMNS).filter(~F.col("contaminated")).select(*COLUMNS)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their SentencePiece ids."""
    return sentencepiece_encode(docs, MODEL, COLUMNS).select(*COLUMNS, "ids", "n_tokens")


STAGES = [("quality rules", rules), ("line dedup", lines), ("near-dedup", near), ("decontamination", clean_of_tests), ("sentencepiece", pieces)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet in the shared folder and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
