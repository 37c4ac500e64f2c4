"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame built
from the driver tables through ``sources.adapters``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from entwise.operators import (address as addr, changes as chg, cleaning, metrics, quality,
                               supplement as sup, survey, views)
from entwise.operators.incremental import not_yet_loaded
from entwise.sources import adapters as A
from entwise.sources import snapshots as snap

Query = Callable[[SparkSession, str], DataFrame]

STRUCTURAL_SHOW_VARS = ["pbin", "transactionID", "trn_day"]
PIVOT_ELEMENTS = ["Name", "SIC", "Sls_Size"]
# the last row of a page some way into the table
PAGE_AFTER = {"pRatio": 0.05, "PBIN": 100, "SUPPLIER_NM": "", "COLUMN_NM": "", "tsoRatio": 0.0}


def _normalized(spark, d):
    return chg.normalize(A.raw_changes(spark, d), A.EXCLUDED_USERS)


def _supplement(spark, d, parts):
    """``parts``: (source adapter, specs). The loaded target holds the same elements."""
    sources = [(fn(spark, d), specs) for fn, specs in parts]
    return sup.build(_normalized(spark, d), A.entity_locations(spark, d), A.suppliers(spark, d),
                     sources, loaded=A.loaded_supplement(spark, d, parts))


ALL_PARTS = [(A.sic_source, [sup.SIC]), (A.phone_source, [sup.PHONE_AREA, sup.PHONE_PFX]),
             (A.size_source, [sup.SLS_SIZE, sup.EMP_SIZE])]


def _government_keys(spark, d):
    return addr.government_keys(A.address(spark, d), A.location_addresses(spark, d),
                                A.sic_source(spark, d), A.entity_location_assoc(spark, d),
                                A.operating_locations(spark, d), years=A.FIXTURE_GOVT_YEARS)


def _classified(spark, d):
    return addr.classify(A.address(spark, d), _government_keys(spark, d))


def _changes_incremental(spark, d):
    raw = A.raw_changes(spark, d)
    return chg.load_days(raw.filter(raw.trn_ts >= A.LOADED_BEFORE_DAY), raw, A.EXCLUDED_USERS)


def _changes_split_day(spark, d):
    """The stored table after two loads, cut inside a day."""
    raw = A.raw_changes(spark, d)
    early, late = raw.filter(raw.trn_ts < A.LOADED_BEFORE_TIME), raw.filter(raw.trn_ts >= A.LOADED_BEFORE_TIME)
    return chg.replace_days(chg.normalize(early, A.EXCLUDED_USERS), chg.load_days(late, raw, A.EXCLUDED_USERS), late)


def _pivoted(spark, d, agg):
    """All values of the column, looked up at run time."""
    return views.pivot(A.transactions(spark, d), ["SUPPLIER_NB"], "COLUMN_NM", None, agg, "transactionID")


def _refresh_plan(spark, d):
    return snap.refresh_plan(A.control_rows(spark, d), snap.latest(A.snapshot_names(spark, d)), A.AS_OF)


QUERIES: dict[str, Query] = {
    # supplements (one operator, several specs)
    "supplement_sic": lambda s, d: _supplement(s, d, [(A.sic_source, [sup.SIC])]),
    "supplement_phone_area": lambda s, d: _supplement(s, d, [(A.phone_source, [sup.PHONE_AREA])]),
    "supplement_phone_prefix": lambda s, d: _supplement(s, d, [(A.phone_source, [sup.PHONE_PFX])]),
    "supplement_sizes": lambda s, d: _supplement(s, d, [(A.size_source, [sup.SLS_SIZE, sup.EMP_SIZE])]),
    "supplement_all": lambda s, d: _supplement(s, d, ALL_PARTS),
    # change log
    "changed_entities": lambda s, d: chg.changed_entities(_normalized(s, d)),
    "not_yet_loaded": lambda s, d: not_yet_loaded(
        sup.unpivot_elements(A.sic_source(s, d), [sup.SIC]),
        A.loaded_supplement(s, d, [(A.sic_source, [sup.SIC])]), sup.LOAD_KEYS),
    "change_code_map": lambda s, d: chg.map_codes(A.raw_changes(s, d)),
    "changes_max_per_key": lambda s, d: chg.max_per_key(
        chg.exclude(chg.map_codes(A.raw_changes(s, d)), A.EXCLUDED_USERS)),
    "changes_normalized": _normalized,
    "changes_incremental": _changes_incremental,
    "changes_incremental_split_day": _changes_split_day,
    "clean_changes": lambda s, d: cleaning.clean_changes(_normalized(s, d)),
    "clean_supplement": lambda s, d: cleaning.clean_supplement(_supplement(s, d, ALL_PARTS)),
    "location_attach": lambda s, d: cleaning.attach_location(
        cleaning.clean_supplement(_supplement(s, d, [(A.sic_source, [sup.SIC])])),
        A.entity_locations(s, d)),
    # addresses
    "address_keys": lambda s, d: addr.base_flags(A.address(s, d)).select(
        "ain", "no_dir_strtnm_zip", "no_dir_strtnm_ste_zip"),
    "address_base_flags": lambda s, d: addr.base_flags(A.address(s, d)).select(
        "ain", "std_addr", "verified_addr", "miss_ste_addr", "innac_ste_addr",
        "ste_for_single_loc_addr", "cmra", "multiunit_addr", "single_loc_addr"),
    "address_derived_flags": lambda s, d: addr.derived_flags(addr.base_flags(A.address(s, d))).select(
        "ain", "rsdl", "comml", "non_phys", "comp_addr"),
    "government_keys": _government_keys,
    "address_classified": _classified,
    "flag_audit": lambda s, d: quality.flag_audit(_classified(s, d)),
    "value_counts": lambda s, d: quality.value_counts(chg.map_codes(A.raw_changes(s, d)), "column_nm"),
    "value_counts_raw": lambda s, d: quality.value_counts(A.raw_changes(s, d), "column_nm"),
    "change_dedupe_counts": lambda s, d: quality.dedupe_counts(cleaning.content_changes(_normalized(s, d))),
    "supplement_dedupe_counts": lambda s, d: quality.dedupe_counts(
        cleaning.supplement_dates_mapped(_supplement(s, d, ALL_PARTS))),
    # dashboard
    "top_suppliers": lambda s, d: metrics.top_suppliers(A.analysis(s, d)),
    "totals": lambda s, d: metrics.totals(A.transactions(s, d), A.analysis(s, d)),
    "structural_pct": lambda s, d: metrics.structural_pct(A.transactions(s, d)),
    "element_distribution": lambda s, d: metrics.element_distribution(s, A.analysis(s, d)),
    "histogram": lambda s, d: metrics.histogram(s, A.structural(s, d), "pbin", 50),
    "element_scatter": lambda s, d: views.element_scatter(A.transactions(s, d), "Name"),
    "feature_scatter": lambda s, d: views.feature_scatter(A.analysis(s, d), "pRatio"),
    "pivot_view": lambda s, d: views.pivot(A.transactions(s, d), ["SUPPLIER_NB"], "COLUMN_NM",
                                           PIVOT_ELEMENTS, "count"),
    "pivot_sum": lambda s, d: _pivoted(s, d, "sum"),
    "pivot_avg": lambda s, d: _pivoted(s, d, "avg"),
    "pivot_min": lambda s, d: _pivoted(s, d, "min"),
    "pivot_max": lambda s, d: _pivoted(s, d, "max"),
    "pivot_long": lambda s, d: views.pivot_long(A.analysis(s, d), ["SUPPLIER_NM"], "PBIN", "max", "pRatio"),
    "choices": lambda s, d: views.choices(A.transactions(s, d), "COLUMN_NM"),
    "page_view": lambda s, d: views.page(A.analysis(s, d), "pRatio", ascending=False, size=25),
    "page_view_next": lambda s, d: views.page(A.analysis(s, d), "pRatio", ascending=False, size=25,
                                              after=PAGE_AFTER),
    "sample_rows": lambda s, d: views.project(
        views.sample_rows(A.structural(s, d), "transactionID", 1000, "42"), STRUCTURAL_SHOW_VARS),
    # refresh decision
    "snapshot_latest": lambda s, d: snap.latest(A.snapshot_names(s, d)),
    "refresh_plan": _refresh_plan,
    "control_advanced": lambda s, d: snap.advance_control(
        A.control_rows(s, d), _refresh_plan(s, d).filter("status = 'update'")),
    "survey_invalid": lambda s, d: survey.invalid_responses(s, A.survey_responses(s, d)),
}


def queries() -> dict[str, Query]:
    from entwise.plans import written
    return QUERIES | written.QUERIES


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["supplement_sic"](spark, sf_dir)
