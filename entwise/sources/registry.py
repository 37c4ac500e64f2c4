"""Stored schemas of snapshot tables, and how a new snapshot differs from them.

The types of a table's CSV snapshots are inferred once, at its first load, and
stored. Later snapshots are read with the stored schema, after a check: the header
tells which columns came or went, and one aggregate over the text tells how many
values of each column its type no longer holds. A snapshot that differs is for a
person to look at; it is reported and not loaded.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from entwise.sources.csv import csv_snapshot
from entwise.sources.snapshots import list_folders

DRIFT = "column string, change string, n_values long"


class Registry:
    """Schemas under ``root``: a folder for each table, a version for each change."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _versions(self, table: str) -> list[str]:
        return sorted(n for n in list_folders(self.spark, f"{self.root}/{table}") if re.fullmatch(r"v[0-9]{8}", n))

    def schema(self, table: str) -> StructType | None:
        """The stored schema, None for a table that is not known."""
        for name in reversed(self._versions(table)):
            rows = self.spark.read.schema("value string").text(f"{self.root}/{table}/{name}").collect()  # one line
            if rows:
                return StructType.fromJson(json.loads(rows[0].value))
        return None

    def put(self, table: str, schema: StructType) -> None:
        """Store a schema as the table's next version."""
        at = max((int(n[1:]) for n in self._versions(table)), default=0) + 1
        self.spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.text(f"{self.root}/{table}/v{at:08d}")

    def read(self, table: str, path: str) -> tuple[DataFrame, DataFrame]:
        """(rows, drift) of a snapshot. The first snapshot of a table is inferred and
        its schema stored; of a drifted one the rows are not for loading."""
        stored = self.schema(table)
        if stored is None:
            found = csv_snapshot(self.spark, path).schema
            self.put(table, found)
            return csv_snapshot(self.spark, path, found), self.spark.createDataFrame([], DRIFT)
        text = csv_text(self.spark, path)  # by name: a header may list the columns in another order
        rows = text.select(*[(F.col(f"`{f.name}`") if f.name in text.columns else F.lit(None)).try_cast(f.dataType).alias(f.name)
                             for f in stored.fields])
        return rows, drift(text, stored)


def csv_text(spark: SparkSession, path: str) -> DataFrame:
    """A snapshot as text columns, named by its header."""
    return spark.read.option("header", True).csv(path)


def drift(text: DataFrame, stored: StructType) -> DataFrame:
    """(column, change, n_values): columns that are ``added`` or ``missing``, and those
    ``widened``, with the number of values that their stored type cannot hold."""
    known, found = set(stored.fieldNames()), set(text.columns)
    moved = [(c, "added", None) for c in text.columns if c not in known] + \
        [(c, "missing", None) for c in stored.fieldNames() if c not in found]
    moved = text.sparkSession.createDataFrame(moved, DRIFT)
    typed = [f for f in stored.fields if f.name in found and not isinstance(f.dataType, StringType)]
    if not typed:
        return moved
    wide = text.agg(*[F.count_if(F.col(f"`{f.name}`").isNotNull() & F.col(f"`{f.name}`").try_cast(f.dataType).isNull()).alias(f.name)
                      for f in typed])
    pairs = F.explode(F.array(*[F.struct(F.lit(f.name).alias("column"), F.col(f"`{f.name}`").alias("n_values")) for f in typed]))
    return moved.unionByName(wide.select(pairs.alias("x")).select(
        "x.column", F.lit("widened").alias("change"), "x.n_values").filter("n_values > 0"))
