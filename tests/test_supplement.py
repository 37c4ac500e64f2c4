from pyspark.sql import functions as F

from entwise import schemas as S
from entwise.operators import supplement as sup

from .conftest import rows


def fixtures(spark):
    changes = spark.createDataFrame(
        [("2024-01-01", "P1", "SIC", "T", "a", "b", "U", 1),
         ("2024-01-02", "P1", "Name", "T", "a", "b", "U", 1),
         ("2024-01-01", "P2", "SIC", "T", "a", "b", "U", 1),
         ("2024-01-01", "P9", "SIC", "T", "a", "b", "U", 1)], S.CHANGES_SCHEMA)   # P9: no location
    locs = spark.createDataFrame(
        [("P1", "C1", "L1") + (None,) * 7, ("P2", "C2", "L2") + (None,) * 7,
         ("P3", "C3", "L3") + (None,) * 7], S.ENTITY_LOCATIONS_SCHEMA)            # P3 unchanged
    suppliers = spark.createDataFrame([(10, "Acme")], S.SUPPLIERS_SCHEMA)         # 20 missing
    phone = spark.createDataFrame(
        [("L1", 10, "01/01/2020", "02/01/2020", "212", "212"),   # same digits as area and prefix
         ("L1", 10, "01/01/2020", "02/01/2020", "212", "555"),   # two rows on one 4-key
         ("L2", 20, "01/01/2020", "02/01/2020", "305", "777"),
         ("L3", 10, "01/01/2020", "02/01/2020", "999", "999")],
        "lvid string, supplier_nb int, dt_first_rpted string, dt_last_rpted string, "
        "ph_area_cd string, ph_nb_pfx string")
    sizes = spark.createDataFrame(
        [("L1", 10, "02/01/2020", "01/01/2020", "1200.50", "E", "15", "S"),
         ("L2", 20, "02/01/2020", "01/01/2020", "N/A", "E", "7", "S")],
        "lvid string, supplier_nb int, dt_last_rpted string, dt_first_rpted string, "
        "act_sls_sz string, emp_sls_sz_ty_cd string, act_emp_sz string, sls_sz_cd string")
    return changes, locs, suppliers, phone, sizes


def test_phone_area_rows(spark):
    changes, locs, suppliers, phone, _ = fixtures(spark)
    out = sup.build(changes, locs, suppliers, [(phone, [sup.PHONE_AREA])])
    assert out.columns == S.SUPPLEMENT_LAYOUT
    assert rows(out, "pbin", "bin", "lvid", "value", "element", "ty_cd", "supplier_nm") == [
        ("P1", "C1", "L1", "212", "Phone_AREA", None, "Acme"),
        ("P1", "C1", "L1", "212", "Phone_AREA", None, "Acme"),
        ("P2", "C2", "L2", "305", "Phone_AREA", None, None),
    ]


def test_element_is_part_of_load_key(spark):
    changes, locs, suppliers, phone, _ = fixtures(spark)
    loaded = sup.build(changes, locs, suppliers, [(phone, [sup.PHONE_AREA])])
    pfx = sup.build(changes, locs, suppliers, [(phone, [sup.PHONE_PFX])], loaded=loaded)
    # prefix '212' equals a loaded area code on the same location/supplier/date but is kept
    assert ("L1", "212") in [(r.lvid, r.value) for r in pfx.collect()]


def test_reload_adds_nothing(spark):
    changes, locs, suppliers, phone, sizes = fixtures(spark)
    srcs = [(phone, [sup.PHONE_AREA, sup.PHONE_PFX]), (sizes, [sup.SLS_SIZE, sup.EMP_SIZE])]
    first = sup.build(changes, locs, suppliers, srcs)
    assert sup.build(changes, locs, suppliers, srcs, loaded=first).count() == 0


def test_sizes_clean_and_by_name(spark):
    changes, locs, suppliers, _, sizes = fixtures(spark)
    out = sup.build(changes, locs, suppliers, [(sizes, [sup.SLS_SIZE, sup.EMP_SIZE])])
    assert rows(out, "lvid", "element", "value", "ty_cd") == [
        ("L1", "Emp_Size", "15", "E"), ("L1", "Sls_Size", "1200", "S"),
        ("L2", "Emp_Size", "7", "E"), ("L2", "Sls_Size", "", "S"),
    ]


def test_single_scan_equals_separate_builds(spark):
    changes, locs, suppliers, phone, sizes = fixtures(spark)
    together = sup.build(changes, locs, suppliers,
                         [(phone, [sup.PHONE_AREA, sup.PHONE_PFX]), (sizes, [sup.SLS_SIZE, sup.EMP_SIZE])])
    parts = None
    for src, spec in [(phone, sup.PHONE_AREA), (phone, sup.PHONE_PFX), (sizes, sup.SLS_SIZE),
                      (sizes, sup.EMP_SIZE)]:
        p = sup.build(changes, locs, suppliers, [(src, [spec])])
        parts = p if parts is None else parts.unionByName(p)
    assert together.exceptAll(parts).count() == 0 and parts.exceptAll(together).count() == 0


def test_plan_has_no_python_and_scans_source_once(spark, tmpdir_path):
    changes, locs, suppliers, phone, _ = fixtures(spark)
    phone.write.parquet(f"{tmpdir_path}/phone")
    src = spark.read.parquet(f"{tmpdir_path}/phone")
    out = sup.build(changes, locs, suppliers, [(src, [sup.PHONE_AREA, sup.PHONE_PFX])])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "EvalPython" not in plan
    assert plan.count("FileScan parquet") == 1
    assert out.filter(F.col("element") == "Phone_PFX").count() == 3
