"""Table views of the dashboard: column subsets, pages, samples, pivots, scatter sets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PIVOT_AGGS = {"count", "sum", "avg", "min", "max"}
MAX_PIVOT_VALUES = 10_000
#: Rows of a range that ``write_clustered`` sorts in one task, where a table has more
#: than that for each shuffle partition.
RANGE_ROWS = 1 << 22


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Run-time column subset; unknown names are an error, not silently dropped."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"unknown columns: {missing}")
    return df.select(*columns)


def _order(columns: Sequence[str], sort_col: str, ascending: bool) -> list[tuple[str, bool]]:
    return [(sort_col, ascending)] + [(c, True) for c in columns if c != sort_col]


def _sorted_by(order: Sequence[tuple[str, bool]]) -> list[Column]:
    return [F.col(c).asc_nulls_last() if up else F.col(c).desc_nulls_last() for c, up in order]


def _behind(order: Sequence[tuple[str, bool]], after: Mapping[str, object]) -> Column:
    """Whether a row sorts behind ``after``, which has a value for every column."""
    missing = [c for c, _ in order if c not in after]
    if missing:
        raise ValueError(f"after lacks {missing}")
    behind = F.lit(False)
    for c, up in reversed(order):
        col, last = F.col(c), F.lit(after[c])
        if after[c] is None:  # nothing of this column sorts behind a NULL
            behind = col.isNull() & behind
        else:
            beyond = col > last if up else col < last
            behind = col.isNull() | beyond | ((col == last) & behind)
    return behind


def page(df: DataFrame, sort_col: str, ascending: bool = True, size: int = 10,
         after: Mapping[str, object] | None = None) -> DataFrame:
    """One page of rows ordered by ``sort_col`` (NULLs last), ties broken by all
    other columns, so the page is deterministic.

    ``after`` is the last row of the page before (a value for every column): only
    rows behind it are sorted, and each partition hands on ``size`` rows at most,
    however deep the page is. NULLs in it sort last, as in the order.
    """
    order = _order(df.columns, sort_col, ascending)
    if after is not None:
        df = df.filter(_behind(order, after))
    return df.orderBy(*_sorted_by(order)).limit(size)


def write_clustered(df: DataFrame, path: str, sort_col: str, ascending: bool = True, rows_per_file: int = 1 << 20) -> None:
    """Store ``df`` in the page order: files hold ranges of the order, and an index
    has a row for each file with its number of rows and its last row.

    Rows are dealt by ranges of all columns, and equal rows by where they come
    from, so no file gets all rows of a common value. A range is sorted by one task
    and cut into its files there: the driver samples some rows for each range, so
    there are as many ranges as a shuffle has partitions, or one for RANGE_ROWS
    rows, not one for each file. A descending ``sort_col`` must be a number or a date.
    """
    order = _order(df.columns, sort_col, ascending)
    kind = df.schema[sort_col].dataType
    if not ascending and not isinstance(kind, (T.NumericType, T.DateType)):
        raise ValueError("descending pages need a number or a date to sort by")
    rows, width = df.count(), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(1, min(-(-rows // rows_per_file), max(width, -(-rows // RANGE_ROWS))))
    (df.repartitionByRange(ranges, *_sorted_by(order), F.monotonically_increasing_id())
     .sortWithinPartitions(*_sorted_by(order)).write.option("maxRecordsPerFile", rows_per_file).parquet(f"{path}/rows"))
    day = isinstance(kind, T.DateType)
    falling = -(F.unix_date(sort_col) if day else F.col(sort_col))
    keys = [F.struct(F.col(c).isNull(), (F.col(c) if up else falling).alias("v")).alias(c) for c, up in order]
    stored = df.sparkSession.read.schema(df.schema).parquet(f"{path}/rows")
    last = stored.groupBy(F.col("_metadata.file_path").alias("_file")).agg(
        F.count(F.lit(1)).alias("_rows"), F.max(F.struct(*keys)).alias("_last"))

    def value(c: str, up: bool) -> Column:
        v = F.col(f"_last.{c}.v")
        return (v if up else F.date_from_unix_date(-v) if day else -v).alias(c)
    last.select("_file", "_rows", *[value(c, up) for c, up in order]).coalesce(1).write.parquet(f"{path}/index")


def page_clustered(spark: SparkSession, path: str, sort_col: str, ascending: bool = True, size: int = 10,
                   after: Mapping[str, object] | None = None) -> DataFrame:
    """The page that ``page`` gives, from files that ``write_clustered`` stored.

    The index tells which files hold the first rows behind ``after``; only those
    are opened, the first of them and as many more as fill a page, wherever the
    page stands and however many files there are.
    """
    index = spark.read.parquet(f"{path}/index")
    columns = [c for c in index.columns if c not in ("_file", "_rows")]
    order = _order(columns, sort_col, ascending)
    if after is not None:  # a file matters if its last row sorts behind
        index = index.filter(_behind(order, after))
    found, rest = [], 0
    for r in index.orderBy(*_sorted_by(order), "_file").select("_file", "_rows").limit(size + 1).collect():
        if found:  # the first file may hold a single row behind; of the others all rows are
            rest += r["_rows"]
        found.append(r["_file"])
        if rest >= size:
            break
    rows = spark.read.schema(spark.read.parquet(f"{path}/rows").schema)
    rows = rows.parquet(*found) if found else rows.parquet(f"{path}/rows").limit(0)
    return page(rows, sort_col, ascending, size, after).select(*rows.columns)


def sample_rows(df: DataFrame, key: str, n: int = 1000, seed: str = "0") -> DataFrame:
    """Exactly ``min(n, rows)`` rows without replacement, in hash order of
    (key, seed). Hash order is reproducible (a retried task picks the same rows)
    and does not depend on partitioning; a top-n keeps n rows per partition."""
    h = F.md5(F.concat(F.col(key).cast("string"), F.lit("|"), F.lit(seed)))
    ties = [F.col(c).asc_nulls_last() for c in df.columns]
    return df.orderBy(h, *ties).limit(n)


def choices(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of ``column`` for a selector, sorted."""
    return df.select(column).distinct().orderBy(column)


def element_scatter(transactions: DataFrame, selected: str) -> DataFrame:
    """(transactionID, SUPPLIER_NB, color) for a log-log scatter: only positive
    coordinates; rows of the selected element are 'red', the rest 'grey'."""
    return (transactions
            .filter((F.col("transactionID") > 0) & (F.col("SUPPLIER_NB") > 0))
            .select("transactionID", "SUPPLIER_NB",
                    F.when(F.col("COLUMN_NM") == F.lit(selected), F.lit("red"))
                    .otherwise(F.lit("grey")).alias("color")))


def feature_scatter(analysis: DataFrame, feature: str) -> DataFrame:
    """(PBIN, feature, value) points for the chosen ratio column."""
    if feature not in ("pRatio", "tsoRatio"):
        raise ValueError("feature must be pRatio or tsoRatio")
    return analysis.select("PBIN", F.lit(feature).alias("feature"),
                           F.col(feature).alias("value"))


def pivot_long(df: DataFrame, rows: Sequence[str], column: str, agg: str = "count", measure: str | None = None) -> DataFrame:
    """The filled cells of a pivot table as rows: ``rows``, ``column`` (as text, NULL
    for rows without a value) and ``cell``. For any number of values: they stay in
    the rows and are never looked up, so nothing reaches the driver."""
    if agg not in PIVOT_AGGS:
        raise ValueError(f"agg must be one of {sorted(PIVOT_AGGS)}")
    if agg != "count" and measure is None:
        raise ValueError("measure is required for " + agg)
    cell = F.count(F.lit(1)) if agg == "count" else getattr(F, agg)(F.col(measure))
    return df.groupBy(*rows, F.col(column).cast("string").alias(column)).agg(cell.alias("cell"))


def pivot(df: DataFrame, rows: Sequence[str], column: str, values: Sequence[str] | None = None,
          agg: str = "count", measure: str | None = None, other: str = "other") -> DataFrame:
    """Pivot table: ``rows`` x ``values`` of ``column`` with count/sum/avg/min/max.

    Without ``values`` they are looked up first; a column with more than
    ``MAX_PIVOT_VALUES`` makes no table of columns, ``pivot_long`` takes it. Rows whose value
    is not listed, or NULL, go to the column ``other`` (with underscores added if
    a value has that name), so the cells of a line always cover all of its rows.
    Cells without rows are NULL (0 for count).
    """
    if agg not in PIVOT_AGGS:
        raise ValueError(f"agg must be one of {sorted(PIVOT_AGGS)}")
    if agg != "count" and measure is None:
        raise ValueError("measure is required for " + agg)
    if values is None:
        found = df.select(column).filter(F.col(column).isNotNull()).distinct().limit(MAX_PIVOT_VALUES + 1).collect()
        if len(found) > MAX_PIVOT_VALUES:
            raise ValueError(f"{column} has more than {MAX_PIVOT_VALUES} values: use pivot_long")
        values = sorted(str(r[0]) for r in found)
    while other.lower() in {v.lower() for v in values}:
        other += "_"
    cell = F.col(column).cast("string")
    cell = F.when(cell.isin(*values), cell).otherwise(F.lit(other)) if values else F.lit(other)
    cells = [*values, other]
    g = df.withColumn(column, cell).groupBy(*rows).pivot(column, cells)
    if agg == "count":
        return g.agg(F.count(F.lit(1))).fillna(0, subset=cells)
    return g.agg(getattr(F, agg)(F.col(measure)))
