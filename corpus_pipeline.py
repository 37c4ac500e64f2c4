"""Corpus pipeline over the documents table.

``STAGES`` are (name, function) pairs; each function takes (spark, docs, sf_dir),
where docs is what the stage before it kept, and returns the documents it keeps,
with the columns of ``documents``. The last returns the packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entwise.llm import decontaminate, language, near_dedup, packing, secrets
from entwise.llm.common import Work, row_ids, without


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, whose language nobody can tell (``und``), go. A
    document without a lang gets the predicted one. A corpus without any label
    teaches nothing: then documents that have a letter stay as they are."""
    found = language.identify(docs)
    lettered = F.coalesce(F.col("text").cast("string").rlike(r"\p{L}"), F.lit(False))
    learned = F.col("lang_pred") != "und"
    return found.filter(learned | lettered).withColumn(
        "lang", F.when(F.col("lang").isNull() & learned, F.col("lang_pred")).otherwise(F.col("lang"))).select(*docs.columns)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates stays, that of the smallest doc_id
    (5-word shingles, similarity 0.8). Every row is a document of its own,
    whether its doc_id is repeated or null; a null one counts as the largest."""
    work = Work(spark, "kept")
    rows, row = row_ids(docs, work)
    found = work.table(near_dedup.near_duplicates(rows.select(F.col(row).alias("doc_id"), "text"), width=5, percent=80)
                       .select(F.col("doc_id").alias(row), "component_id").filter("component_id IS NOT NULL"), "found")
    gone = near_dedup.all_but_first(found, rows, row, work)
    return without(rows, work.table(gone, "gone"), row).select(*docs.columns)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of whose words a twentieth lies in benchmark passages go. Every
    row is judged by its own text, whether its doc_id is repeated or null."""
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    work = Work(spark, "contaminated")
    rows, row = row_ids(docs, work)
    bad = work.table(
        decontaminate.contamination(rows.select(F.col(row).alias("doc_id"), "text"), benchmark)
        .filter("contaminated").select(F.col("doc_id").alias(row)), "contaminated")
    return without(rows, bad, row).select(*docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark in the text; every document stays."""
    return secrets.redact(docs).withColumn("n_chars", F.when(
        F.col("text").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 4096 ids, of documents with a null doc_id too."""
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    if docs.filter("doc_id IS NULL").limit(1).count() == 0:
        return packing.pack(docs, tokenizer, end_id=2)
    rows, row = row_ids(docs, Work(spark, "packed"))
    packed = packing.pack(rows.select(F.col(row).alias("doc_id"), "text"), tokenizer, end_id=2)
    return packed.withColumnRenamed("doc_id", row).join(rows.select(row, "doc_id"), row).select(*packed.columns)


STAGES = [("language", language_id), ("near_dedup", near_dedup_stage), ("decontaminate", decontaminate_stage),
          ("secrets", secret_scan), ("packing", pack)]

#: SQL can't express string kernels or tokenizers; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each result written and read again for the next."""
    work = Work(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = work.table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
