"""A row-level filter from the keys of one join side, applied at the scan of the other.

An equi-join keeps a row of its large side only if the key occurs on the small
side. ``KeyFilter`` writes the small side's keys into a bit array (a Bloom
filter): each key sets a few bits that hashes choose, all of them in one word, so
that a test looks up a single word. The array comes from one aggregate with
map-side combining and is a scalar subquery of the plan, so the test of a row is
a built-in expression above the scan, before any exchange, and the rows that
cannot match are never shuffled. Some rows pass without a match; the join that
follows decides, so the result is the same with or without. Each mention of the
array in the test is a copy of it in every closure that the driver serializes, so
the test mentions it twice, not once for each bit.

Its size does not depend on the data but on the width of the session's shuffles,
so it grows with the cluster up to ``MOST_BITS`` (8 MB). With more keys than about
a tenth of the bits, more rows pass; the rows of the join stay the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bits for each shuffle partition, and the fewest.
BITS_EACH, LEAST_BITS = 1 << 17, 1 << 20
#: Largest bit array (8 MB): it travels with the tasks.
MOST_BITS = 1 << 26
#: Bits that a key sets in its word; each takes other digits of the key's hash, and the word those above.
HASHES, STEP = 3, 6


def bits_for(spark: SparkSession) -> int:
    """Bits that suit the session: the next power of two."""
    wanted = BITS_EACH * int(spark.conf.get("spark.sql.shuffle.partitions"))
    return min(MOST_BITS, max(LEAST_BITS, 1 << (wanted - 1).bit_length()))


class KeyFilter:
    """The keys in ``column`` of ``keys``; ``bits`` is a power of two, by default
    ``bits_for`` the session."""

    def __init__(self, keys: DataFrame, column: str, bits: int | None = None):
        bits = bits_for(keys.sparkSession) if bits is None else bits
        if bits & (bits - 1) or not 64 <= bits <= MOST_BITS:
            raise ValueError(f"bits must be a power of two from 64 to {MOST_BITS}")
        self.bits, self.kind = bits, keys.schema[column].dataType.simpleString()
        chosen = keys.selectExpr(f"{self._word(column)} AS word", f"{self._mask(column, range(HASHES))} AS bit")
        # a row for every word, so that the array has no gaps
        blank = keys.sparkSession.range(bits // 64).selectExpr("CAST(id AS INT) AS word", "0L AS bit")
        words = chosen.unionAll(blank).groupBy("word").agg(F.bit_or("bit").alias("bit"))
        row = F.array_sort(F.collect_list(F.struct("word", "bit")))
        self.words = words.agg(F.transform(row, lambda x: x["bit"]).alias("words")).scalar()

    def _digits(self, column: str, i: int) -> str:
        return f"shiftrightunsigned(xxhash64(CAST(`{column}` AS {self.kind})), {STEP * i})"

    def _word(self, column: str) -> str:
        return f"CAST({self._digits(column, HASHES)} & {self.bits // 64 - 1}L AS INT)"

    def _place(self, column: str, i: int) -> str:
        return f"CAST({self._digits(column, i)} & 63 AS INT)"

    def _mask(self, column: str, which: range) -> str:
        return " | ".join(f"shiftleft(1L, {self._place(column, i)})" for i in which)

    def holds(self, column: str) -> Column:
        """False only for rows whose ``column`` is none of the keys. A key of
        another type is cast to the keys' type, as a join on it would compare."""
        word = F.element_at(self.words, F.expr(f"{self._word(column)} + 1"))
        rest = F.expr(self._mask(column, range(1, HASHES)))
        return (F.getbit(word, F.expr(self._place(column, 0))) == F.lit(1)) & (word.bitwiseAND(rest) == rest)
