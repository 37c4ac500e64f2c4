"""Table writers. Each is a single Spark job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from entwise.sources.scratch import scratch


def overwrite(df: DataFrame, table: str, fmt: str = "parquet") -> None:
    """Replace a table with ``df`` and refresh cached metadata."""
    df.write.mode("overwrite").format(fmt).saveAsTable(table)
    df.sparkSession.catalog.refreshTable(table)


def _in_target_order(df: DataFrame, table: str) -> DataFrame:
    target_cols = df.sparkSession.table(table).columns
    missing, extra = set(target_cols) - set(df.columns), set(df.columns) - set(target_cols)
    if missing or extra:
        raise ValueError(f"{table}: missing columns {sorted(missing)}, unknown columns {sorted(extra)}")
    return df.select(*target_cols)


def append_by_name(df: DataFrame, table: str) -> None:
    """Append to an existing table, matching columns by name (``insertInto``
    alone matches by position, which silently swaps same-typed columns). Missing
    and surplus columns are errors."""
    _in_target_order(df, table).write.insertInto(table)


def replace_rows(df: DataFrame, table: str) -> None:
    """Truncate-and-reload as one overwrite job (no window with an empty table).
    ``df`` must not read ``table`` itself."""
    _in_target_order(df, table).write.insertInto(table, overwrite=True)


def replace_partitions(df: DataFrame, table: str, column: str, values: Sequence[str]) -> None:
    """Replace the partitions ``values`` of a table that is partitioned by
    ``column`` alone by ``df``'s rows, which belong to no other partition; those
    without rows become empty. The others stay as they are. ``df`` is computed once,
    into a scratch folder. Writing again gives the same table. Emptied partitions
    are dropped in steps of their own: readers may see them until then, which
    ``sinks.store`` avoids."""
    spark = df.sparkSession
    parts = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    if parts != [column]:
        raise ValueError(f"{table} must be partitioned by {column}, not by {parts}")
    aside = scratch(spark, "partitions")
    df.write.parquet(aside)
    df = spark.read.schema(df.schema).parquet(aside)
    filled = {r[0] for r in df.select(column).distinct().collect()}  # at most the values given
    if not filled <= set(values):
        raise ValueError(f"rows of other partitions: {sorted(filled - set(values))}")
    mode = "spark.sql.sources.partitionOverwriteMode"  # insertInto takes it from the session only
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        _in_target_order(df, table).write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(mode, before)
    for v in sorted(set(values) - filled):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({column} = '{v}')")


def append_or_create(df: DataFrame, table: str, fmt: str = "parquet") -> None:
    """Append; the first write creates the table with ``df``'s schema."""
    df.write.mode("append").format(fmt).saveAsTable(table)


def export_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV with a header line, one file per partition."""
    df.write.mode(mode).option("header", True).csv(path)
