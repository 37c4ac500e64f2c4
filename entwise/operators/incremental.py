"""Incremental loads: keep only source rows whose key is not in the target yet."""

from __future__ import annotations

from pyspark.sql import DataFrame


def not_yet_loaded(new: DataFrame, loaded: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new`` with no row of ``loaded`` on ``keys`` (a left-anti join).

    Rows with a NULL key part never match and are kept, like the ``LEFT JOIN ...
    WHERE t.k IS NULL`` form. The target is not deduplicated: that would not
    change the result, and with two bare shuffles AQE splits a key that many new
    rows share. Each side is read once.
    """
    return new.join(loaded.select(*keys), keys, "left_anti").select(*new.columns)
