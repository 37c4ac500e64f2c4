"""Address classification and the government-location key set."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entwise import schemas as S
from entwise.functions.address import GOVT_SQL, address_key_sql, base_flag_sql, derived_flag_sql
from entwise.operators.skew import spread_join

GOVT_KEY = "no_dir_strtnm_ste_zip"


def government_source_rows(naics_source: DataFrame, excluded_supplier: int = S.GOVT_EXCLUDED_SUPPLIER,
                           years: Sequence[str] = S.GOVT_YEARS) -> DataFrame:
    """Government-classified (location, supplier) reports.

    ``startswith`` and ``!=`` are written on raw columns so a Parquet scan can
    take them as pushed filters; the year test reads characters 7-10 of an
    'MM/dd/yyyy' date.
    """
    return naics_source.filter(
        F.col("naics_std_cd").startswith(S.GOVT_NAICS_PREFIX)
        & (F.col("supplier_nb") != F.lit(excluded_supplier))
        & F.substring("dt_last_rpted", 7, 4).isin(*years)).select("lvid")


def government_keys(address: DataFrame, location_addresses: DataFrame, naics_source: DataFrame,
                    entity_location_assoc: DataFrame, operating_locations: DataFrame,
                    excluded_supplier: int = S.GOVT_EXCLUDED_SUPPLIER,
                    years: Sequence[str] = S.GOVT_YEARS,
                    activity: Sequence[str] = S.GOVT_ACTIVITY) -> DataFrame:
    """Distinct trimmed 6-part address keys of active government locations, govt='1'.

    address -(ain)- location -(lvid)- government report, location -(lvid)-
    entity -(pbin)- operating location with activity A/B/C. The output is a key
    set, so only existence matters: every step is a plain semi-join, which never
    multiplies rows, and whose inputs are bare shuffles, so AQE splits a hot
    location, entity or address. Only the final keys are made distinct.
    """
    govt = government_source_rows(naics_source, excluded_supplier, years)
    active = operating_locations.filter(F.substring("ol_activity_ind", 1, 1).isin(*activity)).select("pbin")
    active_lvids = entity_location_assoc.select("lvid", "pbin").join(active, "pbin", "left_semi").select("lvid")
    ains = (location_addresses.select("ain", "lvid").join(govt, "lvid", "left_semi")
            .join(active_lvids, "lvid", "left_semi").select("ain"))
    keys = (address.join(ains, "ain", "left_semi")
            .selectExpr(f"trim({address_key_sql(with_unit=True)}) AS {GOVT_KEY}")
            .distinct())
    return keys.withColumn("govt", F.lit("1"))


def base_flags(address: DataFrame) -> DataFrame:
    """Raw address columns plus the base flags and keys (one projection)."""
    return address.selectExpr("*", *[f"{e} AS {n}" for n, e in base_flag_sql().items()])


def derived_flags(address_with_base: DataFrame) -> DataFrame:
    """Trims then residential / commercial / non-physical / complete flags."""
    trimmed = address_with_base.selectExpr(
        *[f"trim({c}) AS {c}" if c in S.TRIMMED_AFTER_BASE else c for c in address_with_base.columns])
    return trimmed.selectExpr("*", *[f"{e} AS {n}" for n, e in derived_flag_sql().items()])


def classify(address: DataFrame, govt_keys: DataFrame) -> DataFrame:
    """All 91 columns of the classified address table, in ``ADDRESS_LAYOUT`` order.

    The government marker is attached with a left join on the 6-part key.
    ``govt_keys`` holds each trimmed key once, as ``government_keys`` makes it
    (``plans.jobs`` checks the written table). An empty address ('|||||') can be
    a very common key, so the join spreads keys by a fixed factor. The repeated
    keys are sorted and merged: their size is measured before they are repeated, so
    a broadcast chosen by it would hold as many times that in every task.
    """
    flagged = derived_flags(base_flags(address))
    marker = govt_keys.select(GOVT_KEY, F.col("govt").alias("govt_flag"))
    joined = spread_join(flagged, marker.hint("merge"), [GOVT_KEY], "left")
    return joined.selectExpr(*[f"{GOVT_SQL} AS govt" if c == "govt" else c for c in S.ADDRESS_LAYOUT])
