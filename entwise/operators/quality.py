"""Data-quality counts: flag audits, value profiles, step row counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

AUDITED_FLAGS = ["rsdl", "comml", "comp_addr", "non_phys"]


def flag_audit(classified: DataFrame, flags: Sequence[str] = AUDITED_FLAGS) -> DataFrame:
    """One row per flag: (flag, ones, zeros, nulls) from a single aggregate pass."""
    aggs = []
    for f in flags:
        c = F.col(f)
        aggs += [F.count_if(c == F.lit("1")).alias(f"{f}__ones"),
                 F.count_if(c == F.lit("0")).alias(f"{f}__zeros"),
                 F.count_if(c.isNull()).alias(f"{f}__nulls")]
    wide = classified.agg(*aggs)
    rows = [F.struct(F.lit(f).alias("flag"), F.col(f"{f}__ones").alias("ones"),
                     F.col(f"{f}__zeros").alias("zeros"), F.col(f"{f}__nulls").alias("nulls"))
            for f in flags]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def value_counts(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    """(value, count) for one column, NULL included as its own value."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(name))


def dedupe_counts(df: DataFrame) -> DataFrame:
    """One row: (rows, distinct_rows) — the row count before and after a
    whole-row dedupe, from one pass: group by every column (NULLs group
    together, as in ``dropDuplicates``; copies combine map-side), then sum the
    group sizes and count the groups."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(F.sum("_n").cast("long").alias("rows"),
                      F.count(F.lit(1)).alias("distinct_rows"))


def row_metrics(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Attach a row counter that is filled in by whatever action runs ``df``
    (no extra job). Read ``observation.get`` after the action."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs
