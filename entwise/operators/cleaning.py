"""Cleaning of the transformed change log and of the supplement."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entwise import schemas as S
from entwise.functions.text import replace_values, strip_zeros_if_gt_one


def content_changes(changes: DataFrame) -> DataFrame:
    """Trimmed, renamed, non-structural change rows (before the dedupe)."""
    flagged = changes.withColumn("column_nm", F.trim(F.col("column_nm"))).withColumn(
        "structure", F.when(F.col("column_nm").isin(*S.STRUCTURAL_COLUMNS), F.lit("1"))
        .otherwise(F.lit("0")))
    return (flagged.withColumnsRenamed({"after": "after_value", "before": "before_value"})
            .filter(F.col("structure") == F.lit("0")))


def clean_changes(changes: DataFrame) -> DataFrame:
    """Content (non-structural) changes, deduplicated, with zero-padded numbers stripped.

    Output: the change columns with ``after``/``before`` renamed to
    ``after_value``/``before_value`` plus ``structure`` ('0' on every kept row).
    Dedupe runs before the stripping, so '0012' and '12' both survive.
    """
    content = content_changes(changes).dropDuplicates()
    return content.withColumns({
        "after_value": strip_zeros_if_gt_one("after_value"),
        "before_value": strip_zeros_if_gt_one("before_value"),
    })


def supplement_dates_mapped(supplement: DataFrame,
                            first_map: Mapping[str, str] = S.SENTINEL_ISO) -> DataFrame:
    """Report dates trimmed and the first sentinel map applied (before the dedupe)."""
    dates = ["dt_first_rpted", "dt_last_rpted"]
    return supplement.withColumns({d: replace_values(F.trim(F.col(d)), first_map) for d in dates})


def clean_supplement(supplement: DataFrame, first_map: Mapping[str, str] = S.SENTINEL_ISO,
                     second_map: Mapping[str, str] = S.SENTINEL_US) -> DataFrame:
    """Trim the report dates, replace sentinel dates, dedupe.

    Order is kept on purpose: the first map runs before the dedupe and the
    second after it, so two rows that only become equal in the second map stay
    two rows.
    """
    df = supplement_dates_mapped(supplement, first_map).dropDuplicates()
    dates = ["dt_first_rpted", "dt_last_rpted"]
    return df.withColumns({d: replace_values(F.col(d), second_map) for d in dates})


def attach_location(supplement: DataFrame, entity_locations: DataFrame,
                    prefix: str = "loc_") -> DataFrame:
    """Left join of supplement rows to location attributes on trimmed ``lvid``.

    The location columns are prefixed so both ``pbin`` columns survive with
    distinct names. Many location rows per ``lvid`` multiply supplement rows,
    as in any equi-join; both inputs are shuffle stages, so AQE can split a
    hot ``lvid``.
    """
    loc = entity_locations.select(
        F.trim(F.col("lvid")).alias("_lvid"),
        *[F.col(c).alias(prefix + c) for c in entity_locations.columns if c != "lvid"])
    left = supplement.withColumn("_lvid", F.trim(F.col("lvid")))
    return left.join(loc, "_lvid", "left").drop("_lvid")
