"""CSV snapshot readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def csv_snapshot(spark: SparkSession, path: str, schema: StructType | None = None,
                 header: bool = True) -> DataFrame:
    """A snapshot folder of CSV files. Without ``schema`` the header names the
    columns and types are inferred (one extra pass over the data); with a
    schema nothing is inferred. ``header`` defaults to True in both cases."""
    reader = spark.read.option("header", header)
    if schema is None:
        reader = reader.option("inferSchema", True)
    else:
        reader = reader.schema(schema)
    return reader.csv(path)


CORRUPT = "_corrupt_record"


def csv_ragged(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Header CSV whose short rows are padded with NULLs. Rows with surplus or
    unreadable fields keep their whole line in the column ``_corrupt_record``
    (as do short rows), so nothing is cut silently; it is NULL for all others."""
    if schema is None:
        schema = spark.read.option("header", True).option("inferSchema", True).csv(path).schema
    schema = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    return (spark.read.option("header", True).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT).schema(schema).csv(path))


EXTRA = "_extra"
#: A field behind its comma: quoted, where a doubled quote stands for one, or up to the next comma.
FIELD = r',("(?:[^"]++|"")*+"|[^,]*+)'


def _field(raw: Column) -> Column:
    """A field without its quotes; NULL if it is empty and not quoted."""
    quoted = raw.startswith('"') & raw.endswith('"') & (F.length(raw) >= 2)
    inner = F.replace(F.substr(raw, F.lit(2), F.length(raw) - 2), F.lit('""'), F.lit('"'))
    return F.when(quoted, inner).otherwise(F.nullif(raw, F.lit("")))


def csv_lines(spark: SparkSession, path: str) -> DataFrame:
    """Ragged CSV read line by line: text columns named by the header, short rows
    padded with NULL, surplus fields of long rows kept in the array ``_extra``
    (NULL for all others). No line is dropped or marked but blank ones and headers.

    The header is the first line of each file; all files must have the same. Lines
    that repeat it are headers too. Fields are split by SQL functions: quoted
    fields may hold commas and doubled quotes, but no line ends. The driver reads
    the distinct headers, of which there is one.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("nth"))
    # the lines of a file's first block stand in one partition, in order
    heads = lines.filter("start = 0").groupBy("file").agg(F.min_by("value", "nth").alias("head")).select("head").distinct()
    found = [r["head"] for r in heads.limit(2).collect()]
    if len(found) != 1:
        raise ValueError(f"{path}: {'several headers' if found else 'no lines'}")
    head = spark.range(1).select(F.transform(F.regexp_extract_all(F.lit("," + found[0]), F.lit(FIELD), F.lit(1)), _field)).first()[0]
    names = [n or f"_c{i}" for i, n in enumerate(head)]
    if len({n.lower() for n in names}) < len(names) or EXTRA in names:
        raise ValueError(f"{path}: ambiguous column names {names}")
    fields = spark.read.text(path).filter((F.trim("value") != "") & (F.col("value") != F.lit(found[0]))).select(
        F.transform(F.regexp_extract_all(F.concat(F.lit(","), "value"), F.lit(FIELD), F.lit(1)), _field).alias("f"))
    extra = F.when(F.size("f") > len(names), F.slice("f", len(names) + 1, F.greatest(F.size("f") - len(names), F.lit(0))))
    return fields.select(*[F.get("f", F.lit(i)).alias(n) for i, n in enumerate(names)], extra.alias(EXTRA))
