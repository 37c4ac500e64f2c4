import itertools

import duckdb
import pandas as pd
from pyspark.sql import functions as F

from entwise import schemas as S
from entwise.operators import address as addr
from entwise.plans.oracle import CTES

from .conftest import rows

FLAGS = ["std_addr", "verified_addr", "miss_ste_addr", "innac_ste_addr", "ste_for_single_loc_addr",
         "cmra", "multiunit_addr", "single_loc_addr", "rsdl", "comml", "non_phys", "comp_addr"]


def grid():
    combos = itertools.product(["F", "G", "H", "P", "R", "S", "X"], ["A", "C", "Z"], [None, "R"],
                               [None, "5"], ["0", "1", None], ["Y", "N", None], ["Y", "N", None])
    out = []
    for i, (t, z, rtn, unit, code, cmra, res) in enumerate(combos):
        rec = {c: None for c in S.ADDRESS_INPUT_COLUMNS}
        rec.update(ain=str(i), std_usps_rc_ty_cd=t, std_zip_cd_stat_cd=z, std_rtn_cd=rtn,
                   std_unit_nb=unit, std_ovall_prbl_cor=code, hyg_cmra_in=cmra,
                   hyg_residential_in=res, std_hse_nb=str(i % 13), std_zip5_cd="00001")
        out.append(rec)
    return out


def test_truth_table_matches_sql_text(spark):
    g = grid()
    assert len(g) == 2268
    sdf = spark.createDataFrame([tuple(r[c] for c in S.ADDRESS_INPUT_COLUMNS) for r in g],
                                S.ADDRESS_SCHEMA)
    got = addr.derived_flags(addr.base_flags(sdf)).select("ain", *FLAGS)
    con = duckdb.connect()
    grid_pdf = pd.DataFrame(g, columns=S.ADDRESS_INPUT_COLUMNS).astype(object)
    con.register("grid_pdf", grid_pdf)
    con.sql("CREATE VIEW address AS SELECT " + ", ".join(
        f"CAST({c} AS VARCHAR) AS {c}" for c in S.ADDRESS_INPUT_COLUMNS) + " FROM grid_pdf")
    body = "WITH " + ", ".join(f"{n} AS ({CTES[n][0]})" for n in
                              ("address_base", "address_trimmed", "address_derived"))
    expected = con.sql(body + " SELECT ain, " + ", ".join(FLAGS) + " FROM address_derived").fetchall()
    assert sorted(tuple(r) for r in got.collect()) == sorted(expected)


def test_prose_rules_on_selected_rows(spark):
    base = {c: None for c in S.ADDRESS_INPUT_COLUMNS}

    def rec(**kw):
        r = dict(base)
        r.update(kw)
        return tuple(r[c] for c in S.ADDRESS_INPUT_COLUMNS)
    df = spark.createDataFrame([
        rec(ain="1", std_usps_rc_ty_cd="H", std_zip_cd_stat_cd="A", std_unit_nb=None,
            std_ovall_prbl_cor="1", hyg_residential_in="N"),
        rec(ain="2", std_usps_rc_ty_cd="S", std_zip_cd_stat_cd="C", std_unit_nb="7",
            std_ovall_prbl_cor="2", hyg_cmra_in=" N", hyg_residential_in="Y"),
        rec(ain="3", std_usps_rc_ty_cd="G", std_zip_cd_stat_cd="A"),
    ], S.ADDRESS_SCHEMA)
    out = addr.derived_flags(addr.base_flags(df))
    got = {r.ain: r for r in out.collect()}
    # multi-unit without suite: missing suite, innac not applicable (NULL), not complete
    assert (got["1"].miss_ste_addr, got["1"].innac_ste_addr, got["1"].comp_addr) == ("1", None, "0")
    assert got["1"].comml == "1"
    # single location with a suite and a problem code: flagged; cmra from untrimmed ' N' is '0',
    # but rsdl reads the trimmed value 'N'
    assert (got["2"].ste_for_single_loc_addr, got["2"].cmra, got["2"].rsdl) == ("1", "0", "1")
    # standard but not verified type -> non-physical, flags of verified-only rules
    assert (got["3"].std_addr, got["3"].verified_addr, got["3"].non_phys, got["3"].comp_addr) == \
        ("1", "0", "1", None)


def small_world(spark):
    def a(ain, hse, unit, zip5):
        r = {c: None for c in S.ADDRESS_INPUT_COLUMNS}
        r.update(ain=ain, std_hse_nb=hse, std_unit_nb=unit, std_zip5_cd=zip5, std_str_addr="MAIN",
                 std_usps_rc_ty_cd="F", std_zip_cd_stat_cd="A", hyg_residential_in="N")
        return tuple(r[c] for c in S.ADDRESS_INPUT_COLUMNS)
    address = spark.createDataFrame([a("A1", "1", None, "11111"), a("A2", "2", "3", "22222"),
                                     a("A3", "3", None, "33333")], S.ADDRESS_SCHEMA)
    loc_addr = spark.createDataFrame([("A1", "L1"), ("A2", "L2"), ("A3", "L3")], "ain string, lvid string")
    naics = spark.createDataFrame([
        (1, "L1", "x", "05/01/2018", "t", "c", "921100"),
        (1, "L1", "x", "05/01/2018", "t", "c", "921100"),        # duplicate report
        (508673, "L2", "x", "05/01/2018", "t", "c", "921100"),   # excluded supplier
        (1, "L3", "x", "05/01/2016", "t", "c", "921100"),        # year outside
    ], "supplier_nb int, lvid string, dt_first_rpted string, dt_last_rpted string, "
       "sic_ty_cd string, sic_cd string, naics_std_cd string")
    assoc = spark.createDataFrame([("L1", "P1"), ("L2", "P2"), ("L3", "P3")], "lvid string, pbin string")
    oper = spark.createDataFrame([("P1", "Active"), ("P2", "A"), ("P3", "B")],
                                 "pbin string, ol_activity_ind string")
    return address, loc_addr, naics, assoc, oper


def test_government_keys(spark):
    address, loc_addr, naics, assoc, oper = small_world(spark)
    keys = addr.government_keys(address, loc_addr, naics, assoc, oper)
    assert rows(keys) == [("1||MAIN|||11111", "1")]


def test_classify_layout_and_govt(spark):
    address, loc_addr, naics, assoc, oper = small_world(spark)
    keys = addr.government_keys(address, loc_addr, naics, assoc, oper)
    out = addr.classify(address, keys)
    assert out.columns == S.ADDRESS_LAYOUT and len(out.columns) == 91
    assert rows(out, "ain", "govt") == [("A1", "1"), ("A2", "0"), ("A3", "0")]


def test_classify_scan_prunes_nothing_needed(spark, tmpdir_path):
    address, *_ = small_world(spark)
    address.write.parquet(f"{tmpdir_path}/addr")
    src = spark.read.parquet(f"{tmpdir_path}/addr")
    out = addr.base_flags(src).select("ain", "std_addr")
    plan = out._jdf.queryExecution().executedPlan().toString()
    # only the columns the flag needs reach the scan
    assert "hyg_lacs_dt" not in plan and "std_usps_rc_ty_cd" in plan
    assert out.filter(F.col("std_addr") == "1").count() == 3


def test_repeated_government_keys_are_never_broadcast(spark):
    """Their size is known before they are repeated for the salts, so a broadcast
    chosen by it would be many times as large in every task."""
    from pyspark.sql import functions as F

    from entwise.operators import address as addr
    from entwise.sources import adapters as A
    rows = A.address(spark, "/root/testdata/sf0.001")
    keys = addr.base_flags(rows).selectExpr(f"trim({addr.GOVT_KEY}) AS {addr.GOVT_KEY}").distinct().withColumn("govt", F.lit("1"))
    out = addr.classify(rows, keys)
    assert len(out.collect()) == rows.count()
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
