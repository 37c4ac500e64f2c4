"""Registered queries of this package: (spark, sf_dir) -> DataFrame over the
whole tables, and DuckDB SQL where SQL can express the result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entwise.llm import (alignment, decontaminate, language, lexical, licenses, near_dedup, packing, pieces, repeats, secrets,
                         sharding, token_files, topk)
from entwise.llm.common import Work

Query = Callable[[SparkSession, str], DataFrame]


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = Work(spark, "token-files").path
    token_files.write_token_files(_read(spark, sf_dir, "documents"), out,
                                  public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return token_files.read_token_files(spark, out).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def _op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(_read(spark, sf_dir, "documents"), telling=licenses.TELLING)
    return found.select("doc_id", "n_words", F.size("found").cast("long").alias("n_licenses"),
                        F.array_join("found.license", ",").alias("licenses"),
                        F.round(F.array_max("found.containment"), 6).alias("containment"))


def _op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    remainder = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4))
    docs = language.identify(_read(spark, sf_dir, "documents"), train="pmod(crc32(cast(doc_id AS string)), 4) <> 2")
    return docs.select("doc_id", (remainder == 2).alias("held_out"), "lang_pred", "score")


QUERIES: dict[str, Query] = {
    "op1_near_dedup": lambda s, d: near_dedup.near_duplicates(_read(s, d, "documents"), width=3, percent=85),
    "op2_token_files": _op2,
    "op3_repeats": lambda s, d: repeats.remove_repeats(_read(s, d, "documents"), 400),
    "op4_secrets": lambda s, d: secrets.report(_read(s, d, "documents")),
    "op5_packing": lambda s, d: packing.pack(
        _read(s, d, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2),
    "op6_decontaminate": lambda s, d: decontaminate.contamination(
        _read(s, d, "documents"), _read(s, d, "benchmark")).drop("spans", "items"),
    "op7_topk": lambda s, d: topk.top_products(_read(s, d, "embeddings"), k=20, every=20),
    "op8_licenses": _op8,
    "op9_sharding": lambda s, d: sharding.shard_documents(_read(s, d, "documents"), 24),
    "op10_language": _op10,
    "op11_ranked_search": lambda s, d: lexical.rank_documents(_read(s, d, "documents"), _read(s, d, "benchmark"), k=10),
    "op12_sentencepiece": lambda s, d: pieces.round_trip(
        _read(s, d, "documents"), public_tokenizers.path("piece_bpe_32k.model")),
    "op13_alignment": lambda s, d: alignment.align(
        _read(s, d, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")),
}

ORACLE: dict[str, str] = {
    "op7_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e
            FROM embeddings
            WHERE embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
                   CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
        ), r AS (
            SELECT query_id, vec_id, score,
                   row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
            FROM s
        )
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
    """,
    "op11_ranked_search": r"""
        WITH t AS (
            SELECT doc_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM documents
        ), q AS (
            SELECT item_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM benchmark
        ), q_counts AS (
            SELECT item_id, term, count(*) AS repeats FROM q GROUP BY item_id, term
        ), tf AS (
            SELECT doc_id, term, count(*) AS tf FROM t GROUP BY doc_id, term
        ), lengths AS (
            SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY doc_id
        ), whole AS (
            SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS length FROM lengths
        ), weights AS (
            SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM tf, whole GROUP BY term, n_docs
        ), ms AS (
            SELECT doc_id, 25 + ((75 * n * n_docs) // length) AS m FROM lengths, whole
        ), scores AS (
            SELECT item_id, doc_id,
                   CAST(sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
            FROM q_counts JOIN tf USING (term) JOIN weights USING (term) JOIN ms USING (doc_id)
            GROUP BY item_id, doc_id
        ), ranks AS (
            SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
            FROM scores WHERE score > 0
        )
        SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranks WHERE rank <= 10
    """,
}
