"""The registered queries must return rows that each rule changed; otherwise a
comparison with the oracle says nothing about the rule."""

import pytest
from pyspark.sql import functions as F

from entwise.plans import catalog
from entwise.sources import adapters as A

SF = "/root/testdata/sf0.01"


def query(spark, name):
    return catalog.queries()[name](spark, SF)


def test_raw_log_reaches_the_value_rules(spark):
    raw = A.raw_changes(spark, SF)
    for rule in ("after_value IS NULL", "before_value IS NULL", "after_value RLIKE '^0[0-9]'", "after_value = 'N/A'",
                 "after_value LIKE '%.5'", "before_value LIKE ' %'"):
        assert raw.filter(rule).count() > 0, rule


def test_h7_h12_zero_stripping(spark):
    before = query(spark, "changes_normalized").filter("after RLIKE '^0+[1-9]' OR before RLIKE '^0+[1-9]'")
    assert before.count() > 0
    cleaned = query(spark, "clean_changes")
    assert cleaned.filter("try_cast(after_value AS decimal(38,6)) >= 2 AND after_value LIKE '0%'").count() == 0
    assert cleaned.filter("after_value = 'N/A'").count() > 0     # not a number: kept


def test_b11_noops_and_nulls_are_dropped(spark):
    every, kept = query(spark, "changes_max_per_key"), query(spark, "changes_normalized")
    assert every.filter("after IS NULL OR before IS NULL").count() > 0
    assert every.filter("trim(after) = trim(before) AND after <> before").count() > 0
    assert kept.count() < every.count()


def test_h13_sentinels(spark):
    raw = query(spark, "supplement_all")
    for c in ("dt_first_rpted", "dt_last_rpted"):
        for sentinel in ("0401-01-01", "01/01/0401"):
            assert raw.filter(F.trim(c) == sentinel).count() > 0
    out = query(spark, "clean_supplement")
    assert out.filter("dt_last_rpted IN ('1970-01-01', '01-01-1800')").count() > 0
    assert out.filter("dt_last_rpted LIKE '%0401%' OR dt_first_rpted LIKE '%0401%'").count() == 0


def test_h8_leading_digits_and_c3_missing_names(spark):
    sizes = query(spark, "supplement_sizes")
    assert sizes.filter("element = 'Sls_Size' AND value = ''").count() > 0
    assert sizes.filter("supplier_nm IS NULL").count() > 0 and sizes.filter("supplier_nm IS NOT NULL").count() > 0


def test_c4_padded_locations_attach_and_j8_removes_copies(spark):
    attached = query(spark, "location_attach").count()
    plain = query(spark, "supplement_sic")
    assert attached > plain.select(*plain.columns).distinct().count() / 2
    assert A.entity_locations(spark, SF).filter("lvid LIKE ' %'").count() > 0
    assert A.entity_locations(spark, SF).filter("lvid IS NULL").count() > 0
    r = query(spark, "supplement_dedupe_counts").first()
    assert r.rows > r.distinct_rows


@pytest.mark.parametrize("status", ["not_needed", "update", "failed"])
def test_refresh_decisions_all_occur(spark, status):
    assert query(spark, "refresh_plan").filter(F.col("status") == status).count() > 0


def test_split_day_really_is_split(spark):
    raw = A.raw_changes(spark, SF)
    day = A.LOADED_BEFORE_TIME[:10]
    same_day = raw.filter(F.col("trn_ts").startswith(day))
    assert same_day.filter(F.col("trn_ts") < A.LOADED_BEFORE_TIME).count() > 0
    assert same_day.filter(F.col("trn_ts") >= A.LOADED_BEFORE_TIME).count() > 0


def test_reports_without_supplier_give_no_government_key(spark):
    reports = A.sic_source(spark, SF).filter("supplier_nb IS NULL AND naics_std_cd LIKE '92%'")
    assert reports.count() > 0                     # unknown, so not known to be another than the excluded one
    assert query(spark, "supplement_sic").filter("supplier_nb IS NULL AND supplier_nm IS NULL").count() > 0
