"""Token sequences of fixed capacity by cutting-stock column generation.

Every document is cut into full pieces of ``CAPACITY`` ids, each a sequence of its
own, and one rest. Rests are a cutting-stock problem over their length histogram,
which has at most CAPACITY rows whatever the corpus. Lengths are rounded up to
one of 328 bins, and short ones bundled to whole units of UNIT ids; a pattern says
how many bundles of each size share a sequence, and a linear program chooses how
often each pattern is used. Patterns are generated: the master program's dual
prices go to a knapsack, solved by dynamic programming over the capacity, and its
best pattern enters the basis until none improves. Pattern counts are rounded
down; rests are ranked within their bin, and ranks are dealt to the patterns'
places by intervals. The few rests beyond (fewer than a bundle for each bin and
the places of a pattern for each size) are laid end to end and cut at the capacity.

Only the histogram and the plan reach the driver; ranks are distributed.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from entwise.llm.common import Work, by_row, local_rows, ranked
from entwise.llm.tokens import encoder

CAPACITY = 4096
#: Rests count as rounded up to ``step`` ids if they have at most ``top``; the
#: others, up to UNIT. That is 328 bins.
STEPS = ((32, 1), (128, 4), (512, 8))
UNIT = 16
#: Rounds of column generation; stopping early costs padding, not validity.
COLUMNS = 4_000
#: Generation ends when the program's value is proven within this share.
CLOSE = 1e-3


def rounded(length):
    """Length up to the next bin: steps grow with the length, so that little of a
    short rest is lost too. For a number or a Column."""
    if isinstance(length, int):
        step = next((s for top, s in STEPS if length <= top), UNIT)
        return -(-length // step) * step
    column = F.ceil(length / UNIT) * UNIT
    for top, step in reversed(STEPS):
        column = F.when(length <= top, F.ceil(length / step) * step).otherwise(column)
    return column.cast("int")


def knapsack(price: np.ndarray, size: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The dearest multiset of items of integer ``size`` (ascending) within
    ``capacity``."""
    value = np.zeros(capacity + 1)
    item = np.full(capacity + 1, -1)
    upto = np.searchsorted(size, np.arange(capacity + 1), side="right")
    for c in range(int(size[0]), capacity + 1):
        got = value[c - size[:upto[c]]] + price[:upto[c]]
        k = int(got.argmax())
        value[c] = value[c - 1]
        if got[k] > value[c] + 1e-12:
            value[c], item[c] = got[k], k
    pattern, c = np.zeros(len(size), np.int64), capacity
    while c > 0:
        if item[c] < 0:
            c -= 1
        else:
            pattern[item[c]] += 1
            c -= int(size[item[c]])
    return float(value[capacity]), pattern


def generate_patterns(size: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(patterns, uses) of the linear program that meets ``demand`` items of each
    ``size`` with the fewest patterns, by the simplex method on generated columns."""
    m = len(size)
    basis = np.diag(capacity // size).astype(float)
    inverse = np.diag(1 / np.diag(basis))
    uses, bound = inverse @ demand, 0.0
    for _ in range(COLUMNS):
        price = inverse.sum(0)
        best, pattern = knapsack(price, size, capacity)
        bound = max(bound, uses.sum() / best)
        if uses.sum() <= bound * (1 + CLOSE):
            break
        enter = inverse @ pattern
        ratio = np.where(enter > 1e-9, uses / np.maximum(enter, 1e-9), np.inf)
        out = int(ratio.argmin())
        step = ratio[out]
        uses = uses - step * enter
        uses[out] = step
        basis[:, out] = pattern
        pivot = inverse[out] / enter[out]
        inverse = inverse - np.outer(enter, pivot)
        inverse[out] = pivot
    assert basis.shape == (m, m)
    return basis.T.astype(np.int64), np.maximum(uses, 0)


def plan(lengths: dict[int, int]) -> tuple[list[tuple[int, int, int, int, int, int, int]], int]:
    """From a histogram of rest lengths: intervals (bin, low, high, bundle, shift,
    each, first) and the number of sequences they fill. Rest ``rank`` of a bin, low
    <= rank < high, goes to sequence first + (rank // bundle + shift) // each. Ranks
    in no interval are left over."""
    bins: dict[int, int] = {}
    for n, count in lengths.items():
        bins[rounded(n)] = bins.get(rounded(n), 0) + count
    # an item is a bundle of equal rests of a whole number of units; bins whose
    # bundles have the same size stand in one row of the program, one after another
    rows: dict[int, list[tuple[int, int, int]]] = {}
    for b in sorted(bins):
        bundle = UNIT // math.gcd(b, UNIT)
        if items := bins[b] // bundle:
            row = rows.setdefault(b * bundle // UNIT, [])
            row.append((b, bundle, items))
    if not rows:
        return [], 0
    size = np.array(sorted(rows), np.int64)
    demand = np.array([sum(x[2] for x in rows[s]) for s in size.tolist()], np.int64)
    patterns, uses = generate_patterns(size, demand.astype(float), CAPACITY // UNIT)
    used = np.zeros(len(size), np.int64)
    intervals, sequences = [], 0
    for k in np.argsort(-uses, kind="stable"):
        pattern, n = patterns[k], int(uses[k] + 1e-6)
        held = np.flatnonzero(pattern)
        n = min([n, *((demand[held] - used[held]) // pattern[held]).tolist()])
        if n <= 0:
            continue
        for i in held.tolist():
            each, low, before = int(pattern[i]), int(used[i]), 0
            high = low + n * each
            for b, bundle, items in rows[int(size[i])]:
                x, y = max(low, before), min(high, before + items)
                if x < y:
                    intervals.append((b, (x - before) * bundle, (y - before) * bundle, bundle, before - low, each, sequences))
                before += items
            used[i] = high
        sequences += n
    return intervals, sequences


_PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def _tokenized(path: str, end_id: int, keep_ids: bool):
    """Pieces of each document: cut at the capacity, or at the given places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, True)
        for batch in batches:
            cuts = batch.column(2).to_pylist() if batch.num_columns > 2 else [None] * batch.num_rows
            out: list[tuple] = []
            for doc, cut, got in zip(batch.column(0).to_pylist(), cuts, enc.batch(batch.column(1))):
                body = np.append(got, np.uint32(end_id)).astype("<u4").tobytes()
                n = len(body) // 4
                where = [(x["start"], x["length"]) for x in cut] if cut is not None else \
                    [(a, min(CAPACITY, n - a)) for a in range(0, n, CAPACITY)]
                for a, k in where:
                    ids = body[4 * a:4 * (a + k)]
                    out.append((doc, a, k, zlib.crc32(ids), n, ids))
            cols = list(zip(*out)) if out else [[]] * 6
            arrays = [pa.array(c, pa.int64()) for c in cols[:5]]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if keep_ids:
                arrays, names = [*arrays, pa.array(cols[5], pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(arrays, names)
    return run


def pack(docs: DataFrame, tokenizer_file: str, end_id: int = 2, keep_ids: bool = False) -> DataFrame:
    """A row for each piece of each row of ``docs`` (doc_id, text): doc_id, start
    (its document's ids before it), length, ids_crc32, doc_tokens, sequence_id,
    offset (its place there, gapless from 0) and, with ``keep_ids``, ids
    (little-endian unsigned 32-bit).

    A document's ids are those of its whole text and ``end_id``; a null or empty
    text has the end id only. Rows with a null doc_id are left out; rows that
    share a doc_id are documents of their own. Extra columns are ignored; an
    empty table gives an empty result.
    """
    work = Work(docs.sparkSession, "packing")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .filter("doc_id IS NOT NULL")
    return by_row(rows, work, lambda rows: _pack(rows, tokenizer_file, end_id, keep_ids, work)).drop("row")


def _pack(rows: DataFrame, tokenizer_file: str, end_id: int, keep_ids: bool, work: Work) -> DataFrame:
    spark = rows.sparkSession
    schema = _PIECE + (", ids binary" if keep_ids else "")
    pieces = work.table(rows.mapInArrow(_tokenized(tokenizer_file, end_id, keep_ids), schema), "pieces")
    rests = pieces.filter(F.col("length") < CAPACITY)
    lengths = {r.length: r.n for r in rests.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    intervals, n_planned = plan(lengths)

    order = work.table(ranked(rests.withColumn("bin", rounded(F.col("length"))), ["bin"], ["doc_id"], "rank"), "ranked")
    places = F.broadcast(local_rows(spark, {
        "b": pa.int32(), "low": pa.int64(), "high": pa.int64(), "bundle": pa.int32(), "shift": pa.int64(),
        "each": pa.int32(), "first": pa.int64()}, intervals))
    dealt = order.join(places, (F.col("bin") == F.col("b")) & (F.col("rank") >= F.col("low"))
                       & (F.col("rank") < F.col("high")), "left")
    item = F.floor(F.col("rank") / F.col("bundle")) + F.col("shift")
    dealt = work.table(dealt.withColumn("sequence_id", F.col("first") + F.floor(item / F.col("each")))
                       .select(*pieces.columns, "sequence_id"), "dealt")
    earlier = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "doc_id") \
        .rowsBetween(Window.unboundedPreceding, -1)
    planned = dealt.filter("sequence_id IS NOT NULL").withColumn(
        "offset", F.coalesce(F.sum("length").over(earlier), F.lit(0)))

    # the rests beyond the plan, end to end, cut where a sequence is full
    line = Window.orderBy("doc_id").rowsBetween(Window.unboundedPreceding, -1)
    left = dealt.filter("sequence_id IS NULL").select("doc_id", "start", "length") \
        .withColumn("at", F.coalesce(F.sum("length").over(line), F.lit(0)))
    left = left.withColumn("nth", F.explode(F.sequence(
        F.floor(F.col("at") / CAPACITY), F.floor((F.col("at") + F.col("length") - 1) / CAPACITY))))
    low = F.greatest("at", F.col("nth") * CAPACITY)
    high = F.least(F.col("at") + F.col("length"), (F.col("nth") + 1) * CAPACITY)
    left = work.table(left.select("doc_id", (F.col("start") + low - F.col("at")).alias("start"), (high - low).alias("length"),
                                  (F.col("nth") + n_planned).alias("sequence_id"),
                                  (low - F.col("nth") * CAPACITY).alias("offset")), "left")
    n_left = left.agg(F.max("sequence_id")).first()[0]
    cuts = left.groupBy("doc_id").agg(F.collect_list(F.struct("start", "length")).alias("cuts"))
    cut = rows.join(F.broadcast(cuts), "doc_id").select("doc_id", "text", "cuts") \
        .mapInArrow(_tokenized(tokenizer_file, end_id, keep_ids), schema)
    leftover = cut.join(F.broadcast(left.drop("length")), ["doc_id", "start"])

    first = n_planned if n_left is None else n_left + 1
    full = ranked(pieces.filter(F.col("length") == CAPACITY), [], ["doc_id", "start"], "nth") \
        .withColumn("sequence_id", F.col("nth") + first).drop("nth").withColumn("offset", F.lit(0).cast("long"))
    columns = [*pieces.columns, "sequence_id", "offset"]
    return planned.select(*columns).unionAll(leftover.select(*columns)).unionAll(full.select(*columns)) \
        .withColumns({"sequence_id": F.col("sequence_id").cast("long"), "offset": F.col("offset").cast("long")})
