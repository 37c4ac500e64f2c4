"""Helpers shared by the operators of this package: written intermediate tables,
distributed ranks, and iteration over Arrow batches in bounded slices."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from entwise.operators.runtime_filter import KeyFilter


def work_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A private folder is made only where the setting is absent and the master is
    a local one (tests); on a cluster without the setting this raises, since a
    machine-local folder would not outlive its machine.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="entwise-llm-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


#: Texts are wide rows: a batch for Python holds at most so many rows and bytes.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "512", "spark.sql.execution.arrow.maxBytesPerBatch": "16m"}


def prepare(spark: SparkSession) -> None:
    """Bound the batches that go to Python workers, and let local workers import
    this package from where the driver found it, whatever the current folder.
    On a cluster ship the package with ``--py-files``."""
    for k, v in BATCH.items():
        spark.conf.set(k, v)
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH")]))


#: Bits of a filter of keys that rules rows out before a join (1 MB).
FILTER_BITS = 1 << 23


def without(rows: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """``rows`` whose ``column`` is none of ``keys`` (a one-column table of it,
    written, without NULL), with the rows moved as little as can be: those that a
    bit filter of the keys rules out stay where they are, only the others meet the
    keys in a join. Rows with a NULL stay."""
    maybe = KeyFilter(keys, column, FILTER_BITS).holds(column)
    return rows.filter(~maybe).unionAll(rows.filter(maybe).join(keys, column, "left_anti").select(*rows.columns))


class Work:
    """A folder of written intermediate tables for one operator call.

    A written table cuts lineage: it survives lost executors, and a later join
    reads it by a plain scan, so AQE can split a hot key on either side.
    """

    def __init__(self, spark: SparkSession, name: str):
        prepare(spark)
        self.spark = spark
        self.path = f"{work_root(spark)}/{name}-{uuid.uuid4().hex}"
        self._n = 0

    def table(self, df: DataFrame, name: str) -> DataFrame:
        self._n += 1
        out = f"{self.path}/{self._n:02d}-{name}"
        # small row groups: a writer holds one in memory, next to the Python workers
        df.write.option("parquet.block.size", 32 << 20).parquet(out)
        return self.spark.read.schema(df.schema).parquet(out)


def by_row(docs: DataFrame, work: Work, run: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``run`` over rows (doc_id, text) whose doc_id is unique. If some doc_id
    repeats, each row gets a number of its own for the run, and its doc_id back
    in the result, which then has the numbers as ``row``."""
    if docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1).count() == 0:
        return run(docs)
    own = work.table(docs.withColumn("_row", F.monotonically_increasing_id()), "rows")
    out = run(own.select(F.col("_row").alias("doc_id"), "text"))
    names = own.select(F.col("_row"), F.col("doc_id").alias("_name"))
    return out.withColumnRenamed("doc_id", "_row").join(names, "_row").select(
        F.col("_name").alias("doc_id"), *[c for c in out.columns if c != "doc_id"], F.col("_row").alias("row"))


def row_ids(docs: DataFrame, work: Work) -> tuple[DataFrame, str]:
    """``docs`` with a column that tells its rows apart, and that column's name.

    That is doc_id itself where each row has another one and none is null, so
    that nothing is written; else a number in a column whose name no other has,
    in a written copy, so that every reader sees the same numbers.
    """
    one = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 OR doc_id IS NULL")
    if docs.schema["doc_id"].dataType.typeName() == "long" and one.limit(1).count() == 0:
        return docs, "doc_id"
    name = "_row"
    while name in docs.columns:
        name += "_"
    return work.table(docs.withColumn(name, F.monotonically_increasing_id()), "numbered"), name


def local_rows(spark: SparkSession, kinds: dict[str, pa.DataType], rows: Iterable[tuple]) -> DataFrame:
    """A small table of the driver's rows. It goes through Arrow: Python objects
    would be read by workers of another kind, which stay beside those of the operators."""
    cols = list(zip(*rows)) or [()] * len(kinds)
    return spark.createDataFrame(pa.table({n: pa.array(c, k) for (n, k), c in zip(kinds.items(), cols)}))


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread(spark: SparkSession, *cols: str | Column) -> Column:
    """A salt in [0, shuffle partitions) from the given columns."""
    return F.pmod(F.xxhash64(*cols), F.lit(shuffle_width(spark))).cast("int")


def running_offsets(parts: DataFrame, group: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """``parts`` plus ``out``: the sum of ``value`` over earlier rows of the group.
    ``parts`` holds one row per (group, salt), not per data row."""
    w = Window.partitionBy(*group) if group else Window.partitionBy()
    w = w.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn(out, F.coalesce(F.sum(value).over(w), F.lit(0)).cast("long"))


def ranked(df: DataFrame, group: list[str], order: list[str], out: str) -> DataFrame:
    """Gapless ranks from 0 within ``group``, without one task per group.

    Rows are dealt by (group, salt); a window ranks inside each part, and the
    parts' row counts (groups x shuffle partitions rows) give each part its
    offset. ``order`` must identify a row, so a retried task ranks alike. The
    order across parts is by salt.
    """
    spark = df.sparkSession
    salted = df.withColumn("_salt", spread(spark, *order))
    local = Window.partitionBy(*group, "_salt").orderBy(*order)
    parts = running_offsets(salted.groupBy(*group, "_salt").agg(F.count(F.lit(1)).alias("_n")),
                            group, ["_salt"], "_n", "_before").drop("_n")
    if group:
        parts = parts.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)],
                             F.col("_salt").alias("_s"), "_before")
        on = (F.col("_salt") == F.col("_s"))
        for i, g in enumerate(group):
            on = on & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    else:
        parts = parts.select(F.col("_salt").alias("_s"), "_before")
        on = F.col("_salt") == F.col("_s")
    ranks = salted.withColumn("_local", F.row_number().over(local) - 1)
    return (ranks.join(parts, on, "left")
            .withColumn(out, (F.col("_local") + F.col("_before")).cast("long"))
            .drop("_salt", "_local", "_s", "_before", *[f"_g{i}" for i in range(len(group))]))


# --- what a worker process holds between tasks --------------------------------

_HELD: dict = {}


def held(key, make: Callable[[], object]):
    """What an operator's tasks hand on to each other in a worker process (a
    tokenizer, its word table). Only one thing is held, and ``release`` drops it:
    a worker serves other operators' tasks too, which need the memory."""
    if key not in _HELD:
        release()
        _HELD[key] = make()
    return _HELD[key]


def release() -> None:
    if _HELD:
        _HELD.clear()
        gc.collect()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
            trim(0)  # else the C library keeps what small objects took


# --- Arrow batches in slices -------------------------------------------------

def string_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; a null is an empty value."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_binary())
    if col.null_count:
        col = col.fill_null(b"")
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, np.int64)[col.offset:col.offset + len(col) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each; a longer row stands alone."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


# --- hashing of byte spans -----------------------------------------------------

#: Spans are hashed by two polynomials modulo this prime. A power of two would do
#: without divisions, but then self-similar strings collide for every multiplier.
PRIME = (1 << 31) - 1
# Multipliers below the prime.
_MULTIPLIERS = (1_103_515_245, 1_664_525_017)


def _folded(x: np.ndarray, times: int = 2) -> np.ndarray:
    """A smaller number that is the same modulo PRIME, in place: for ``x`` below
    2**63 under 2**33 after one fold, and at most 2**31 + 2 after two."""
    for _ in range(times):
        high = x >> np.uint64(31)
        x &= np.uint64(PRIME)
        x += high
    return x


def _reduced(x: np.ndarray) -> np.ndarray:
    """``x`` (below 2**63) modulo PRIME, in place."""
    _folded(x)
    x -= (x >= np.uint64(PRIME)) * np.uint64(PRIME)
    return x


class _Powers:
    """Powers of a multiplier and of its inverse modulo PRIME, grown on demand."""

    def __init__(self, base: int) -> None:
        self.base, self.back = base, pow(base, -1, PRIME)
        self.up, self.down = np.ones(1, np.uint32), np.ones(1, np.uint32)

    @staticmethod
    def _doubled(powers: np.ndarray, base: int) -> np.ndarray:
        more = _reduced(powers.astype(np.uint64) * np.uint64(pow(base, len(powers), PRIME)))
        return np.concatenate([powers, more.astype(np.uint32)])

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            self.up, self.down = self._doubled(self.up, self.base), self._doubled(self.down, self.back)
        return self.up, self.down


_POWERS = [_Powers(m) for m in _MULTIPLIERS]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits depend on all input bits."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_CODES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
#: A value below PRIME for each byte, for either polynomial.
BYTE_CODES = (_CODES % np.uint64(PRIME), (_CODES >> np.uint64(32)) % np.uint64(PRIME))


class SpanHashes:
    """Hashes of byte spans of one buffer from prefix sums: equal bytes give
    equal values wherever they stand. 62 bits come from the bytes, mixed with the
    length; different spans of n bytes have equal polynomials with a chance of
    about (n / 2**31) squared."""

    def __init__(self, raw: np.ndarray):
        n = len(raw)
        self.sides = []
        for powers, codes in zip(_POWERS, BYTE_CODES):
            up, down = powers.get(n + 1)
            sums = np.zeros(n + 1, np.uint64)  # below 2**63 for up to 2**30 bytes
            np.cumsum(_folded(codes[raw] * up[:n], 1), out=sums[1:])
            self.sides.append((sums, down))

    @staticmethod
    def _mixed(parts: list[np.ndarray], length: np.ndarray) -> np.ndarray:
        one, two = parts
        return mix64(((one << np.uint64(31)) | two) + length * np.uint64(0x9E3779B97F4A7C15))

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        parts = [_reduced(_folded(sums[end] - sums[start]) * down[start]) for sums, down in self.sides]
        return self._mixed(parts, (end - start).astype(np.uint64))

    def windows(self, width: int) -> np.ndarray:
        """Hash of each window of ``width`` bytes, by its start."""
        n = len(self.sides[0][0]) - width
        if n <= 0:
            return np.zeros(0, np.uint64)
        parts = [_reduced(_folded(sums[width:] - sums[:n]) * down[:n]) for sums, down in self.sides]
        return self._mixed(parts, np.full(1, width, np.uint64))


# --- words ---------------------------------------------------------------------

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_spans(raw: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every run of word bytes, and the index of each
    document's first word (one more at the end). Runs end with their document."""
    n = len(raw)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = is_word[raw]
    begins = inside[1:-1] & ~inside[:-2]
    ends = inside[1:-1] & ~inside[2:]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    last = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    begins[first] = inside[first + 1]
    ends[last] = inside[last + 1]
    start = np.flatnonzero(begins)
    end = np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(start, offsets)
