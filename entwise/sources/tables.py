"""Table scans by catalog name or Parquet path."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, name_or_path: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Catalog table (``db.t``) or Parquet path; ``cols`` projects at the scan
    (Parquet reads only those columns)."""
    if "/" in name_or_path or name_or_path.endswith(".parquet"):
        df = spark.read.parquet(name_or_path)
    else:
        df = spark.table(name_or_path)
    return df.select(*cols) if cols else df
