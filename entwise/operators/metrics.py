"""Dashboard result sets: totals, ratios, top suppliers, distributions, histogram."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entwise import schemas as S


def top_suppliers(analysis: DataFrame, n: int = 5) -> DataFrame:
    """Suppliers by row count, top ``n`` with ties kept (rank <= n).

    A row's rank is 1 + the number of rows with a larger count, so the kept
    rows are those whose count is at least the n-th largest count. That value
    comes from a top-n (``limit`` after a sort keeps n rows per partition) as
    a scalar subquery; no global window funnels all suppliers into one task.
    """
    counts = analysis.groupBy("SUPPLIER_NM").agg(F.count(F.lit(1)).alias("name_count"))
    nth = counts.orderBy(F.col("name_count").desc()).limit(n).agg(F.min("name_count")).scalar()
    return counts.filter(F.col("name_count") >= nth)


def totals(transactions: DataFrame, analysis: DataFrame) -> DataFrame:
    """One row: transaction records, analysis records, structural changes."""
    analysis_rows = analysis.agg(F.count(F.lit(1))).scalar()
    return transactions.agg(
        F.count(F.lit(1)).alias("transaction_records"),
        F.sum(F.abs(F.col("strChange"))).alias("structural_changes"),
    ).withColumn("analysis_records", analysis_rows)


def structural_pct(transactions: DataFrame) -> DataFrame:
    """Share of structural changes in percent, and its label ('%2.0f%%' style,
    exact ties to the even number, as that format rounds)."""
    agg = transactions.agg((F.lit(100.0) * F.sum(F.abs(F.col("strChange")))
                            / F.count(F.lit(1))).alias("structural_pct"))
    rounded = F.bround(F.col("structural_pct"), 0).cast("bigint")
    return agg.withColumn("label", F.format_string("%2d%%", rounded))


def element_distribution(spark: SparkSession, analysis: DataFrame) -> DataFrame:
    """(element, label, n) for the eight dashboard elements, zero when absent.

    Counts are aggregated over the whole table first; the 8-row label
    dimension is a literal, so broadcasting it is safe.
    """
    labels = spark.createDataFrame(
        [(i, e, lbl) for i, (e, lbl) in enumerate(S.ELEMENT_LABELS)],
        "ord int, element string, label string")
    counts = (analysis.filter(F.col("COLUMN_NM").isin(*[e for e, _ in S.ELEMENT_LABELS]))
              .groupBy(F.col("COLUMN_NM").alias("element")).agg(F.count(F.lit(1)).alias("n")))
    return (counts.join(F.broadcast(labels), "element", "right")
            .select("ord", "element", "label", F.coalesce(F.col("n"), F.lit(0)).alias("n")))


def histogram(spark: SparkSession, df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Exactly ``bins`` equal-width bins over [min, max]; last bin closed.

    (bin, lower, upper, n) with empty bins included. min/max come from one
    global aggregate (map-side partials); the bin dimension has ``bins`` rows.
    """
    x = F.col(column).cast("double")
    # one scalar subquery (a single partial/final aggregate) for both bounds
    stats = df.agg(F.struct(F.min(x).alias("lo"), F.max(x).alias("hi"))).scalar()
    lo, hi = stats.getField("lo"), stats.getField("hi")
    width = (hi - lo) / F.lit(bins)
    b = F.when(hi == lo, F.lit(1)).otherwise(
        F.least(F.lit(bins), (F.floor((x - lo) / (hi - lo) * F.lit(bins)) + F.lit(1)).cast("int")))
    counts = (df.filter(x.isNotNull()).groupBy(b.cast("int").alias("bin"))
              .agg(F.count(F.lit(1)).alias("n")))
    dim = spark.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    return (counts.join(F.broadcast(dim), "bin", "right")
            .select("bin",
                    (lo + (F.col("bin") - F.lit(1)) * width).alias("lower"),
                    (lo + F.col("bin") * width).alias("upper"),
                    F.coalesce(F.col("n"), F.lit(0)).alias("n")))


def histogram_round(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """About ``bins`` bins between round breaks: (bin, lower, upper, n), empty bins
    included. ``bins`` is a hint; the breaks are whole multiples of a step of 1, 2
    or 5 times a power of ten.

    The step is the round number next to (max - min) / bins, where a mantissa up to
    1.4 counts as 1, up to 2.8 as 2, up to 7 as 5. Bins are open below and closed
    above, the first is closed on both sides; a value within a 10-millionth of a
    step above a break belongs to the bin under it. Equal values give one bin of
    width 1. NULL and NaN are left out; a column without values gives no bins.
    """
    x = F.col(column).cast("double")
    rows = df.select(x.alias("x")).filter("x IS NOT NULL AND NOT isnan(x)")
    # one row: bounds, then the step, then the first and last break in steps
    frame = (rows.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
             .selectExpr("lo", "hi", f"(hi - lo) / {int(bins)} AS raw")
             .selectExpr("lo", "hi", "raw", "CASE WHEN raw > 0 THEN pow(10D, floor(log10(raw))) ELSE 1D END AS unit")
             .selectExpr("lo", "hi", "CASE WHEN raw <= 0 OR raw / unit <= 1.4D THEN unit WHEN raw / unit <= 2.8D THEN 2 * unit "
                                     "WHEN raw / unit <= 7D THEN 5 * unit ELSE 10 * unit END AS step")
             .selectExpr("step", "CAST(floor(lo / step + 1e-7D) AS BIGINT) AS first",
                         "CAST(greatest(ceil(hi / step - 1e-7D), floor(lo / step + 1e-7D) + 1) AS BIGINT) AS last"))
    cut = frame.agg(F.struct(F.max("step").alias("step"), F.max("first").alias("first"), F.max("last").alias("last"))).scalar()
    step, first, last = (cut.getField(c) for c in ("step", "first", "last"))
    place = F.greatest(F.ceil(F.col("x") / step - F.lit(1e-7)).cast("long") - first, F.lit(1).cast("long"))
    counts = rows.groupBy(F.least(place, last - first).alias("at")).agg(F.count(F.lit(1)).alias("n"))
    # as many rows as there are bins: at most about one and a half times the hint
    dim = frame.filter("step IS NOT NULL").select(F.explode(F.sequence(F.lit(1).cast("long"), F.col("last") - F.col("first"))).alias("at"))
    return (dim.join(counts, "at", "left")
            .select(F.col("at").cast("int").alias("bin"), ((first + F.col("at") - 1) * step).alias("lower"),
                    ((first + F.col("at")) * step).alias("upper"), F.coalesce("n", F.lit(0)).alias("n")))
