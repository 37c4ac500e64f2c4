"""Exact highest inner products of integer vectors, by norm-sorted pruning.

Vectors are dealt into blocks by descending length. Every query first meets the
block of the longest vectors, which gives it ``k`` good scores; by
Cauchy-Schwarz it then needs only those later blocks whose longest vector times
its own length reaches its k-th score. Inside a block, vectors come in slices,
longest first: a slice ends a query's search if no product can reach its k-th
score any more; otherwise the first ``HEAD`` coordinates after an SVD rotation
give a partial sum, the lengths of what is left bound the rest, and only
vectors whose bound reaches the k-th score get their exact integer product.

The rotation is fitted on a bounded sample; it decides how much is pruned, not
what is found. Queries and vectors meet in blocks of fixed size, each pair of
blocks a group of its own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from entwise.llm.common import Work

BLOCK = 16_384
QUERY_BLOCK = 4_096
SLICE = 1_024
HEAD = 16
SAMPLE = 2_048
#: Levels of length: below 1, where integer vectors are zero, to 2**63.
LOWEST, HIGHEST = -2, 2_206
#: Largest squared length for which sums of products are exact in doubles.
EXACT = float(1 << 52)


def _deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the rows of a sorted partition in blocks."""
    part, n = TaskContext.get().partitionId(), 0
    for b in batches:
        at = (np.arange(n, n + b.num_rows) // BLOCK) + part * (1 << 32)
        n += b.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), *b.columns], ["place", *b.schema.names])


def _matrix(col: pa.ChunkedArray, dim: int) -> np.ndarray:
    """Rows of equal width; shorter vectors are filled with zeros."""
    lists = [np.asarray(x, np.int64) for c in col.chunks for x in _rows(c)]
    if all(len(x) == dim for x in lists):
        return np.array(lists, np.int64).reshape(len(lists), dim)
    out = np.zeros((len(lists), dim), np.int64)
    for i, x in enumerate(lists):
        out[i, :len(x)] = x
    return out


def _rows(c: pa.ListArray) -> Iterator[np.ndarray]:
    off, val = c.offsets.to_numpy(), c.values.to_numpy()
    for a, b in zip(off[:-1], off[1:]):
        yield val[a:b]


def rotation(sample: np.ndarray) -> np.ndarray:
    """Right singular vectors: coordinates in order of falling spread."""
    rows, dim = sample.shape
    padded = np.zeros((max(rows, dim), dim))
    padded[:rows] = sample
    _, _, vt = np.linalg.svd(padded, full_matrices=False)
    return vt.T


def _search(k: int, dim: int, turn: np.ndarray):
    def run(queries: pa.Table, vectors: pa.Table) -> pa.Table:
        qid, least = queries["query_id"].to_numpy(), queries["least"].to_numpy().astype(float)
        vid, norm = vectors["vec_id"].to_numpy(), vectors["norm"].to_numpy()
        q, v = _matrix(queries["v"], dim), _matrix(vectors["v"], dim)
        order = np.lexsort((vid, -norm))
        vid, norm, v = vid[order], norm[order], v[order]
        exact = float if max(float((q.astype(float) ** 2).sum(1).max(initial=0)),
                             float((v.astype(float) ** 2).sum(1).max(initial=0))) < EXACT else np.int64
        qr, h = q @ turn, min(HEAD, dim)
        q_norm, q_rest = np.sqrt((qr ** 2).sum(1)), np.sqrt((qr[:, h:] ** 2).sum(1))
        best_s = [np.zeros(0, np.int64)] * len(qid)
        best_v = [np.zeros(0, np.int64)] * len(qid)
        live = np.arange(len(qid))
        for a in range(0, len(vid), SLICE):
            part = slice(a, a + SLICE)
            top = float(norm[part].max())
            slack = 1e-6 * (1 + q_norm[live] * top)  # rounding in the bounds, never in the scores
            live = live[q_norm[live] * top + slack >= least[live]]
            if not len(live):
                break
            vr = v[part] @ turn
            rest = np.sqrt((vr[:, h:] ** 2).sum(1))
            ve = v[part].astype(exact)
            for x in range(0, len(live), 512):
                some = live[x:x + 512]
                bound = qr[some, :h] @ vr[:, :h].T + np.outer(q_rest[some], rest) + 1e-6 * (1 + q_norm[some] * top)[:, None]
                near = bound >= least[some][:, None]
                cols = np.flatnonzero(near.any(0))
                if not len(cols):
                    continue
                score = (q[some].astype(exact) @ ve[cols].T).astype(np.int64)
                ok = near[:, cols] & (score >= least[some][:, None]) & (vid[part][cols][None, :] != qid[some][:, None])
                for r in np.flatnonzero(ok.any(1)):
                    i = some[r]
                    s = np.concatenate([best_s[i], score[r, ok[r]]])
                    w = np.concatenate([best_v[i], vid[part][cols][ok[r]]])
                    keep = np.lexsort((w, -s))[:k]
                    best_s[i], best_v[i] = s[keep], w[keep]
                    if len(keep) == k:
                        least[i] = max(least[i], s[keep][-1])
        n = [len(x) for x in best_s]
        return pa.table({"query_id": pa.array(np.repeat(qid, n), pa.int64()),
                         "vec_id": pa.array(np.concatenate(best_v) if n else [], pa.int64()),
                         "score": pa.array(np.concatenate(best_s) if n else [], pa.int64())})
    return run


def _level(length: Column) -> Column:
    """Lengths in steps of two per cent."""
    return F.floor(F.ln(length) / math.log(1.02)).cast("int")


def _ends(blocks: DataFrame) -> list[tuple[int, int]]:
    """For each level the number of the last block whose longest vector reaches it.
    There are as many levels as lengths may have steps, whatever the rows."""
    level = F.when(F.col("top") > 0, F.greatest(_level(F.col("top")), F.lit(LOWEST))).otherwise(F.lit(LOWEST))
    found = {r.level: r.last for r in blocks.groupBy(F.least(level, F.lit(HIGHEST)).alias("level"))
             .agg(F.max("block").alias("last")).collect()}
    out, last = [], 0
    for k in range(HIGHEST, LOWEST - 1, -1):
        last = max(last, found.get(k, 0))
        out.append((k, last))
    return out


def top_products(vectors: DataFrame, k: int = 20, every: int = 20, scale: int = 64) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` highest integer inner
    products of every query (rows whose vec_id is divisible by ``every``) with all
    other rows of ``vectors`` (vec_id, embedding); all of them, if fewer. Ties go
    to the smaller vec_id.

    A component x counts as floor(scale * x), x as double. Vectors that are null
    or hold a null or non-finite component, and rows with a null vec_id, take no
    part; vectors of other widths count as filled with zeros, empty ones as zero.
    vec_id names a row: rows that share it are never each other's results. Extra
    columns are ignored; an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    work = Work(spark, "topk")
    ok = "embedding IS NOT NULL AND vec_id IS NOT NULL AND " \
         "forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(cast(x AS double)) < double('Infinity'))"
    ints = vectors.filter(ok).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.expr(f"transform(embedding, x -> cast(floor({scale} * cast(x AS double)) AS long))").alias("v"))
    ints = ints.withColumn("norm", F.expr(
        "sqrt(aggregate(v, cast(0 AS double), (s, x) -> s + cast(x AS double) * cast(x AS double)))"))
    ints = work.table(ints, "ints")
    dim = ints.agg(F.max(F.size("v"))).first()[0]
    schema = "query_id long, vec_id long, score long"
    if not dim:
        if dim is None:
            return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
        dim = 1
    sample = ints.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").collect()
    full = np.zeros((len(sample), dim))
    for i, r in enumerate(sample):
        full[i, :len(r.v)] = r.v
    search = _search(k, dim, rotation(full))

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = ints.repartitionByRange(n, F.desc("norm"), "vec_id").sortWithinPartitions(F.desc("norm"), "vec_id") \
        .mapInArrow(_deal, "place long, vec_id long, v array<long>, norm double")
    dealt = work.table(dealt, "dealt")
    # a row for each block: its number in order of length, and its longest vector
    blocks = dealt.groupBy("place").agg(F.max("norm").alias("top")) \
        .withColumn("block", F.row_number().over(Window.orderBy("place")) - 1)
    blocks = work.table(blocks, "blocks")
    n_blocks = blocks.count()
    cands = dealt.join(blocks.select("place", "block"), "place").select("block", "vec_id", "v", "norm")
    queries = ints.filter(F.pmod("vec_id", F.lit(every)) == 0)
    q_blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    queries = queries.select(F.col("vec_id").alias("query_id"), "v", F.col("norm").alias("q_norm"),
                             F.pmod(F.xxhash64("vec_id"), F.lit(q_blocks)).cast("int").alias("q_block"))

    def meet(q: DataFrame, c: DataFrame) -> DataFrame:
        keys = ["block", "q_block"]
        # a block goes to the query blocks that ask for it
        asked = q.select(F.col("block").alias("b"), F.col("q_block").alias("qb")).distinct()
        c = c.join(asked, F.col("block") == F.col("b")).select(
            F.col("b").alias("block"), "vec_id", "v", "norm", F.col("qb").alias("q_block"))
        return q.groupBy(*keys).cogroup(c.groupBy(*keys)).applyInArrow(search, schema)

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    lowest = F.lit(float("-inf"))
    first = work.table(meet(queries.select(F.lit(0).alias("block"), "q_block", "query_id", "v", lowest.alias("least")),
                            cands.filter("block = 0")), "first")
    found = first
    if n_blocks > 1:
        least = first.groupBy("query_id").agg(
            F.when(F.count(F.lit(1)) >= k, F.min("score").cast("double")).otherwise(lowest).alias("least"))
        # only the blocks that a query's length times their longest vector can matter in: blocks fall
        # by that length, so they are the first ones, and how many is looked up by what the length must reach
        reach = F.when(F.col("least") > 0.000001, (F.col("least") - 0.000001) / (F.col("q_norm") * 1.000001))
        level = F.when(reach.isNull(), F.lit(LOWEST)).otherwise(F.greatest(_level(reach) - 1, F.lit(LOWEST)))
        ends = F.broadcast(spark.createDataFrame(_ends(blocks), "level int, last long"))
        ask = queries.join(least, "query_id", "left").withColumn("least", F.coalesce("least", lowest)) \
            .withColumn("level", F.least(level, F.lit(HIGHEST))).join(ends, "level").filter("last > 0") \
            .withColumn("block", F.explode(F.sequence(F.lit(1).cast("long"), "last"))) \
            .join(blocks.select("block", "top"), "block") \
            .filter("q_norm * top * 1.000001 + 0.000001 >= least") \
            .select("block", "q_block", "query_id", "v", "least")
        found = found.unionAll(work.table(meet(ask, cands.filter("block > 0")), "later"))
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k) \
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
