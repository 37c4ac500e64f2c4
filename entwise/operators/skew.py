"""Joins that stay balanced when one key holds a large share of the rows.

Where both inputs of a join are bare shuffles, AQE splits a hot key itself; plain
joins are used there. It does not when one input is an aggregate on the join
keys, because no shuffle stands between the aggregate and the join. The two
helpers here are for that case:

* ``spread_join``: a fixed salt factor. Left rows take a salt from a hash of the
  row, the right side's keys are repeated once for each salt. For small right
  sides (key sets), which are cheaper to repeat than to look at twice.
* ``attach_group_aggregates``: the right side is the left side's own aggregate
  and may be as large, so only hot keys are spread. Their exact row counts come
  from that aggregate. A key is hot if it holds more rows than a shuffle
  partition's share, so there are fewer hot keys than shuffle partitions, which
  bounds the broadcast that carries their values.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Tasks that the rows of one key may be dealt to by ``spread_join``.
SALTS = 16

_SALT, _SALTS, _ROWS, _HOT = "_ew_salt", "_ew_salts", "_ew_rows", "_ew_hot_"


def _any_null(keys: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def _row_hash(cols: list[str]) -> Column:
    # the partition id spreads exact copies that sit in different input
    # partitions; it is the same when a task is run again
    return F.expr("xxhash64(spark_partition_id(), " + ", ".join(f"`{c}`" for c in cols) + ")")


def spread_join(left: DataFrame, right: DataFrame, keys: list[str], how: str,
                salts: int = SALTS) -> DataFrame:
    """``left.join(right, keys, how)`` with the columns in ``left``'s order;
    ``how`` is "inner", "left", "left_semi" or "left_anti"."""
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError("spread_join supports inner, left, left_semi and left_anti joins")
    salted = left.withColumn(_SALT, F.pmod(_row_hash(left.columns), F.lit(salts)).cast("int"))
    repeated = right.withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    out = salted.join(repeated, [*keys, _SALT], how)
    more = [] if how in ("left_semi", "left_anti") else [c for c in right.columns if c not in keys]
    return out.select(*left.columns, *more)


def attach_group_aggregates(detail: DataFrame, keys: list[str], aggs: dict[str, Column]) -> DataFrame:
    """Every detail row with a non-NULL key plus the aggregates of its key group.

    Same rows as ``detail.join(detail.groupBy(keys).agg(...), keys)`` or as a
    window over ``keys``, but the aggregate is combined map-side and computed
    once for both the hot keys and the shuffle join. A row of a hot key takes
    its values from the broadcast, and a salt that spreads it in the shuffle;
    every other row has salt 0 and meets its group there. Rows with a NULL key
    part are dropped, as an equi-join would drop them.
    """
    clash = set(aggs) & set(detail.columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    partitions = int(detail.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kept = detail.filter(~_any_null(keys))
    agg = kept.groupBy(*keys).agg(*[e.alias(n) for n, e in aggs.items()], F.count(F.lit(1)).alias(_ROWS))
    total = agg.agg(F.sum(_ROWS)).scalar()
    hot = agg.filter(F.col(_ROWS) * F.lit(partitions) > total)
    share = F.ceil(F.col(_ROWS) * F.lit(partitions) / total).cast("int")
    hot = F.broadcast(hot.select(*keys, share.alias(_SALTS), *[F.col(n).alias(_HOT + n) for n in aggs]))
    salt = F.when(F.col(_SALTS).isNull(), F.lit(0)).otherwise(
        F.pmod(_row_hash(detail.columns), F.col(_SALTS).cast("long")))
    marked = kept.join(hot, keys, "left").withColumn(_SALT, salt.cast("int"))
    # salt 0 for every group, written so that the optimizer cannot fold it: a
    # literal would become a filter after a join that is partitioned on the keys
    zero = F.expr("CAST(pmod(xxhash64(" + ", ".join(f"`{c}`" for c in agg.columns) + "), 1) AS INT)")
    joined = marked.join(agg.withColumn(_SALT, zero), [*keys, _SALT], "left")
    return joined.selectExpr(
        *[f"`{c}`" for c in detail.columns],
        *[f"CASE WHEN {_SALTS} IS NOT NULL THEN `{_HOT}{n}` ELSE `{n}` END AS `{n}`" for n in aggs])
