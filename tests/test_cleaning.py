from entwise import schemas as S
from entwise.operators import cleaning

from .conftest import rows


def test_clean_changes(spark):
    df = spark.createDataFrame([
        ("2024-01-01", "1", " SIC ", "T", "0012", "0001", "U", 1),
        ("2024-01-01", "1", "SIC", "T", "0012", "0001", "U", 1),       # duplicate after trim
        ("2024-01-01", "2", "PBIN", "T", "5", "6", "U", 1),            # structural -> dropped
        ("2024-01-01", "3", "Name", "T", "00ABC", "0012.5", "U", 1),
    ], S.CHANGES_SCHEMA)
    out = cleaning.clean_changes(df)
    assert rows(out, "pbin", "column_nm", "after_value", "before_value", "structure") == [
        ("1", "SIC", "12", "0001", "0"),
        ("3", "Name", "00ABC", "12.5", "0"),
    ]


def test_clean_supplement_order_of_maps(spark):
    base = ("P", "B", "L", "v", "SIC", "t", 1)
    df = spark.createDataFrame([
        base + (" 0401-01-01 ", "02/01/2020", "n"),
        base + ("1970-01-01", "02/01/2020", "n"),        # equal after first map -> deduped
        base + ("01/01/0401", "x", "n"),
        base + ("01-01-1800", "x", "n"),                 # equal only after second map -> both kept
    ], S.SUPPLEMENT_SCHEMA)
    out = cleaning.clean_supplement(df)
    assert rows(out, "dt_first_rpted", "dt_last_rpted") == [
        ("01-01-1800", "x"), ("01-01-1800", "x"), ("1970-01-01", "02/01/2020")]


def test_attach_location_trims_and_prefixes(spark):
    sup = spark.createDataFrame([("P", "B", " L1", "v", "SIC", "t", 1, "a", "b", "n"),
                                 ("P", "B", "L9", "v", "SIC", "t", 1, "a", "b", "n")],
                                S.SUPPLEMENT_SCHEMA)
    loc = spark.createDataFrame([("E1", "C1", "L1 ") + ("x",) * 7, ("E2", "C2", "L1") + ("y",) * 7],
                                S.ENTITY_LOCATIONS_SCHEMA)
    out = cleaning.attach_location(sup, loc)
    assert "loc_pbin" in out.columns and "pbin" in out.columns and "loc_lvid" not in out.columns
    assert rows(out, "lvid", "loc_pbin") == [(" L1", "E1"), (" L1", "E2"), ("L9", None)]
