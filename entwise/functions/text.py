"""Scalar string rules used by the change-log and supplement pipelines."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def code_map(c: str | Column, mapping: Mapping[str, str], default: str | None) -> Column:
    """``mapping[c]`` when listed, else ``default`` (NULL input -> default).

    A lookup in a literal map rather than a CASE chain: the input expression
    appears once, so plans stay small when it is itself a long expression and
    is inlined into filters, joins and aggregates.
    """
    if not mapping:
        return F.lit(default)
    lookup = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.try_element_at(lookup, _c(c)), F.lit(default))


def replace_values(c: str | Column, mapping: Mapping[str, str]) -> Column:
    """Replace exact values listed in ``mapping``; everything else (and NULL) unchanged."""
    col = _c(c)
    out = None
    for k, v in mapping.items():
        out = F.when(col == F.lit(k), F.lit(v)) if out is None else out.when(col == F.lit(k), F.lit(v))
    return col if out is None else out.otherwise(col)


def day_of(c: str | Column) -> Column:
    """First 10 characters of a timestamp-like string ('yyyy-MM-dd')."""
    return F.substring(_c(c), 1, 10)


def leading_digits(c: str | Column) -> Column:
    """Keep the leading run of digits: '1200.50' -> '1200', 'N/A' -> '' (NULL stays NULL)."""
    return F.regexp_extract(_c(c), r"^[0-9]*", 0)


def strip_leading_zeros(c: str | Column) -> Column:
    """'0012.5' -> '12.5'; '000' -> ''."""
    return F.regexp_replace(_c(c), r"^0+", "")


def lenient_gt(c: str | Column, n: int) -> Column:
    """``c > n`` with the lenient string-to-int semantics of non-ANSI Spark.

    The string is read as a number, its integer part taken (so '01.5' counts as
    1) and values outside the int range or not numeric give NULL instead of an
    error. NULL means "not greater".
    """
    as_int = F.floor(_c(c).try_cast("decimal(38,6)")).try_cast("int")
    return as_int > F.lit(n)


def strip_zeros_if_gt_one(c: str | Column) -> Column:
    """Strip leading zeros from values that read as a number greater than 1."""
    col = _c(c)
    return F.when(lenient_gt(col, 1), strip_leading_zeros(col)).otherwise(col)


def blank_to_empty(c: str | Column) -> Column:
    """NULL -> '' (used when building pipe-separated keys)."""
    return F.coalesce(_c(c), F.lit(""))
