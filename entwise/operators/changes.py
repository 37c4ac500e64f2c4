"""Change-log normalisation (raw attribute changes -> transformed change rows)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entwise import schemas as S
from entwise.functions.text import code_map, day_of
from entwise.operators.skew import attach_group_aggregates, spread_join

GROUP_KEYS = ["pbin", "trn_ts", "column_nm"]


def map_codes(raw: DataFrame) -> DataFrame:
    """Trim and rename column codes, cut the time to its day.

    Output keeps the raw layout; ``trn_ts`` now holds 'yyyy-MM-dd' and
    ``column_nm`` an attribute name or '1' for unmapped codes.
    """
    return raw.withColumns({
        "trn_ts": day_of("trn_ts"),
        "column_nm": code_map(F.trim(F.col("column_nm")), S.CHANGE_CODE_MAP, S.UNMAPPED_CODE),
    })


def exclude(df: DataFrame, excluded_users: Sequence[str]) -> DataFrame:
    """Drop excluded users and unmapped codes. A NULL user fails ``!=`` and is
    dropped too, as in the original filter."""
    cond = F.col("column_nm") != F.lit(S.UNMAPPED_CODE)
    for u in excluded_users:
        cond = cond & (F.col("sbu_user_id") != F.lit(u))
    return df.filter(cond)


def max_per_key(df: DataFrame) -> DataFrame:
    """Each row plus the text maxima of after/before over (pbin, day, column).

    The two maxima are independent and compared as strings ('9' > '10'). Rows
    with a NULL pbin or day are dropped (they cannot join back to their group).
    """
    return attach_group_aggregates(df, GROUP_KEYS, {
        "after": F.max("after_value"),
        "before": F.max("before_value"),
    })


def drop_noops(df: DataFrame, null_safe: bool = False) -> DataFrame:
    """Keep rows whose trimmed before and after differ. By default a NULL on
    either side drops the row (inserts and deletes vanish); ``null_safe=True``
    keeps them."""
    b, a = F.trim(F.col("before")), F.trim(F.col("after"))
    return df.filter(~b.eqNullSafe(a) if null_safe else (b != a))


def normalize(raw: DataFrame, excluded_users: Sequence[str] = ()) -> DataFrame:
    """Full change-log normalisation in the ``CHANGES_LAYOUT`` order.

    Detail rows are kept, each with the maxima of its (pbin, day, column); so the
    result for a day depends on all raw rows of that day and on nothing else.
    """
    return drop_noops(max_per_key(exclude(map_codes(raw), excluded_users))).select(*S.CHANGES_LAYOUT)


def touched_days(batch: DataFrame, raw: DataFrame) -> DataFrame:
    """Raw rows of every day on which ``batch`` has a row. ``raw`` is the whole
    raw log, the batch included."""
    days = batch.select(day_of("trn_ts").alias("_day")).distinct()
    return spread_join(raw.withColumn("_day", day_of("trn_ts")), days, ["_day"], "left_semi").drop("_day")


def load_days(batch: DataFrame, raw: DataFrame, excluded_users: Sequence[str] = ()) -> DataFrame:
    """Normalised rows of the days that ``batch`` touches, to replace these days
    in the stored table.

    Normalising whole days makes the stored table independent of how the raw log
    is cut into loads: a late row changes the maxima of its group, and a load
    that runs twice replaces the days by the same rows.
    """
    return normalize(touched_days(batch, raw), excluded_users)


def replace_days(stored: DataFrame, recomputed: DataFrame, batch: DataFrame) -> DataFrame:
    """The stored table after a load: the days that ``batch`` touches as
    recomputed, all others as they were."""
    days = batch.select(day_of("trn_ts").alias("trn_ts")).distinct()
    return spread_join(stored, days, ["trn_ts"], "left_anti").unionByName(recomputed)


def changed_entities(changes: DataFrame) -> DataFrame:
    """Distinct entity ids that have changes."""
    return changes.select("pbin").distinct()
