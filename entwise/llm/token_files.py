"""Token files: every document's ids compressed on its own with a shared
dictionary, in ascending doc_id order, with an index for single documents.

Layout of a token folder (all parts are tables, so any store that Spark writes
to will do, and a lost executor's task is simply written again):

``dictionary``  one row: hash, zstandard dictionary, bytes per id
``blocks``      a row for each block of neighbouring documents: part, block (its
                place), dictionary hash, first_doc, last_doc, tokens before it in
                its part, n_tokens, and as binary columns the documents' ids,
                token counts and frame ends, then their frames in a row
``parts``       a row for each part: part, base (tokens before the part)

A frame is one document: ids as little-endian unsigned integers (two bytes if
the vocabulary fits, else four), compressed with the dictionary. A single
document is read from its block's binary offsets without touching other frames.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entwise.llm.common import running_offsets
from entwise.llm.tokens import encoder

#: The dictionary is trained on the first SAMPLE_IDS ids of SAMPLE_DOCS documents
#: (those with the smallest hash of doc_id); everything else covers all ids.
SAMPLE_DOCS = 1_000
SAMPLE_IDS = 4_096
DICTIONARY_BYTES = 65_536
BLOCK_DOCS = 256
BLOCK_BYTES = 1 << 20
LEVEL = 3

BLOCK_SCHEMA = ("part int, block int, hash string, first_doc long, last_doc long, before long, n_tokens long, "
                "ids binary, counts binary, ends binary, frames binary")


def _narrow(ids: np.ndarray, end_id: int | None, width: int) -> bytes:
    if end_id is not None:
        ids = np.append(ids, np.uint32(end_id))
    return ids.astype(f"<u{width}").tobytes()


def _sample(path: str, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, False)
        for b in batches:
            got = [_narrow(x[:SAMPLE_IDS], None, width) for x in enc.batch(b.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array(got, pa.binary())], ["ids"])
    return run


def train_dictionary(docs: DataFrame, path: str, width: int) -> bytes:
    """A zstandard dictionary from serialized ids of a bounded sample; empty if
    there is too little to train on."""
    picked = (docs.select(F.col("doc_id"), F.xxhash64("doc_id").alias("h"))
              .orderBy("h", "doc_id").limit(SAMPLE_DOCS).select("doc_id").distinct())
    texts = docs.join(F.broadcast(picked), "doc_id").select("text")
    got = [bytes(r.ids) for r in texts.mapInArrow(_sample(path, width), "ids binary").limit(2 * SAMPLE_DOCS).collect()]
    got = sorted(x for x in got if x)
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, max(256, sum(map(len, got)) // 8)), got).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def _dict_data(dictionary: bytes):
    return {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}


def _pack(path: str, end_id: int | None, width: int, dictionary: bytes, digest: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, z = encoder(path, False), zstandard.ZstdCompressor(level=LEVEL, **_dict_data(dictionary))
        part, block, before = TaskContext.get().partitionId(), 0, 0
        ids, counts, frames, size = [], [], [], 0

        def flush() -> pa.RecordBatch:
            ends = np.cumsum([len(x) for x in frames], dtype="<u8")
            row = {"part": part, "block": block, "hash": digest, "first_doc": ids[0], "last_doc": ids[-1],
                   "before": before, "n_tokens": sum(counts), "ids": np.array(ids, "<i8").tobytes(),
                   "counts": np.array(counts, "<u8").tobytes(), "ends": ends.tobytes(), "frames": b"".join(frames)}
            types = [pa.int32(), pa.int32(), pa.string(), *[pa.int64()] * 4, *[pa.binary()] * 4]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row.values(), types)], list(row))

        for b in batches:
            for doc, got in zip(b.column(0).to_pylist(), enc.batch(b.column(1))):
                body = _narrow(got, end_id, width)
                ids.append(doc)
                counts.append(len(body) // width)
                frames.append(z.compress(body))
                size += len(frames[-1])
                if len(ids) >= BLOCK_DOCS or size >= BLOCK_BYTES:
                    yield flush()
                    block, size, before = block + 1, 0, before + sum(counts)
                    ids, counts, frames = [], [], []
        if ids:
            yield flush()
    return run


def write_token_files(docs: DataFrame, out: str, tokenizer_file: str, end_id: int | None = None,
                      vocabulary: int = 1 << 16, partitions: int | None = None) -> None:
    """Encode every text of ``docs`` (doc_id, text) into a token folder.

    A null or empty text has no ids but the end id; names of special tokens in a
    text are those tokens. Rows with a null doc_id are left out; rows that share a
    doc_id are written one after another, by a hash of the text, and may lie in
    several files.
    Extra columns are ignored; an empty table gives a folder without blocks.
    """
    spark = docs.sparkSession
    width = 2 if vocabulary <= 1 << 16 else 4
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .filter("doc_id IS NOT NULL")
    dictionary = train_dictionary(rows, tokenizer_file, width)
    digest = hashlib.sha256(dictionary).hexdigest()
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # a doc_id with very many rows is cut by its texts, and equal texts by where they come from
    keyed = rows.withColumn("h", F.xxhash64("text"))
    (keyed.repartitionByRange(n, "doc_id", "h", F.monotonically_increasing_id()).sortWithinPartitions("doc_id", "h", "text")
     .select("doc_id", "text").mapInArrow(_pack(tokenizer_file, end_id, width, dictionary, digest), BLOCK_SCHEMA)
     .write.option("compression", "none").parquet(f"{out}/blocks"))
    spark.createDataFrame([(digest, bytearray(dictionary), width)], "hash string, dictionary binary, width int") \
        .write.parquet(f"{out}/dictionary")
    parts = spark.read.parquet(f"{out}/blocks").groupBy("part").agg(F.sum("n_tokens").alias("t"))
    running_offsets(parts, [], ["part"], "t", "base").select("part", "base").coalesce(1).write.parquet(f"{out}/parts")


def _unpack(width: int, dictionary: bytes, digest: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdDecompressor(**_dict_data(dictionary))
        for b in batches:
            for r in b.to_pylist():
                if r["hash"] != digest:
                    raise ValueError("block was written with another dictionary")
                ids = np.frombuffer(r["ids"], "<i8")
                counts = np.frombuffer(r["counts"], "<u8").astype(np.int64)
                ends = np.frombuffer(r["ends"], "<u8")
                starts = r["base"] + r["before"] + np.concatenate([[0], np.cumsum(counts)[:-1]])
                frames = memoryview(r["frames"])
                out, low = [], 0
                for k in ends.tolist():
                    out.append(np.frombuffer(z.decompress(frames[low:k]), f"<u{width}").astype("<u4").tobytes())
                    low = k
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids), pa.array(starts, pa.int64()), pa.array(counts), pa.array(out, pa.binary())],
                    ["doc_id", "start", "n_tokens", "ids"])
    return run


def read_token_files(spark: SparkSession, path: str, doc_id: int | None = None) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids (binary,
    little-endian unsigned 32-bit). With ``doc_id`` only that document's block is
    read, by the statistics of first_doc and last_doc."""
    d = spark.read.parquet(f"{path}/dictionary").first()
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks")
    parts = spark.read.parquet(f"{path}/parts")  # as many rows as the writer had partitions
    if doc_id is not None:
        blocks = blocks.filter((F.col("first_doc") <= doc_id) & (F.col("last_doc") >= doc_id))
    got = blocks.join(F.broadcast(parts), "part").select("hash", "base", "before", "ids", "counts", "ends", "frames").mapInArrow(
        _unpack(d.width, bytes(d.dictionary), d.hash), "doc_id long, start long, n_tokens long, ids binary")
    return got if doc_id is None else got.filter(F.col("doc_id") == doc_id)
