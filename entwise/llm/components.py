"""Connected components of an undirected edge table by repeated Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entwise.llm.common import Work


def _state(edges: DataFrame) -> tuple:
    """Number and 128 bits of hashes of a set of edges, to tell two rounds apart."""
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")),
                           F.bit_xor(F.xxhash64("v", "u", F.lit(1)))).first())


def components(edges: DataFrame, work: Work, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``edges``; root is the smallest node
    reachable.

    Each round re-hangs every node's larger neighbours on its smallest
    neighbour and then every node's smaller neighbours likewise (large star and
    small star), which keeps the components and turns each into a star in
    logarithmically many rounds. A node's minimum is combined map-side, and the
    join back to the edges reads two written tables, so AQE splits a node with
    very many edges. Only a count and a checksum of the edges reach the driver.
    """
    cur = work.table(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                     .filter("u <> v").distinct(), "edges")
    state = _state(cur)
    while True:
        both = cur.unionAll(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = work.table(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "low")
        # large star: neighbours above the node hang on the smallest neighbour
        large = work.table(
            both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u <> v").distinct(), "large")
        # small star: neighbours below, and the node itself, hang on the smallest
        low = work.table(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        nxt = work.table(
            large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionAll(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct(), "small")
        before, state, cur = state, _state(nxt), nxt
        if state == before:
            break
    roots = cur.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return cur.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(roots)
