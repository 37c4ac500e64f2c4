import pytest
from pyspark.sql import functions as F

from entwise.operators import metrics, quality, views

from .conftest import rows


def analysis(spark):
    counts = {"S1": 9, "S2": 7, "S3": 7, "S4": 5, "S5": 3, "S6": 3, "S7": 1}   # tie at rank 5
    data, pb = [], 0
    for s, n in counts.items():
        for i in range(n):
            pb += 1
            data.append((pb, s, ["Name", "SIC", "Sls_Size", "Other"][pb % 4], 0.1 * (pb % 5), 0.2))
    return spark.createDataFrame(data, "PBIN long, SUPPLIER_NM string, COLUMN_NM string, "
                                       "pRatio double, tsoRatio double")


def test_top_suppliers_keeps_ties(spark):
    out = metrics.top_suppliers(analysis(spark))
    assert rows(out) == [("S1", 9), ("S2", 7), ("S3", 7), ("S4", 5), ("S5", 3), ("S6", 3)]


def test_top_suppliers_fewer_rows_than_n(spark):
    df = analysis(spark).filter(F.col("SUPPLIER_NM").isin("S1", "S2"))
    assert metrics.top_suppliers(df).count() == 2


def test_element_distribution_zero_for_absent(spark):
    out = {r.element: (r.label, r.n) for r in metrics.element_distribution(spark, analysis(spark)).collect()}
    assert len(out) == 8 and out["Phone_SFX"] == ("Phone SFX", 0) and out["Sls_Size"][0] == "Sales Size"
    assert sum(n for _, n in out.values()) == sum(1 for r in analysis(spark).collect()
                                                  if r.COLUMN_NM in ("Name", "SIC", "Sls_Size"))


def test_histogram_bins(spark):
    df = spark.createDataFrame([(None if x is None else float(x),) for x in [0, 1, 2, 3, 10, 10, None]], "x double")
    out = metrics.histogram(spark, df, "x", 5)
    assert [(r.bin, r.n) for r in out.orderBy("bin").collect()] == [(1, 2), (2, 2), (3, 0), (4, 0), (5, 2)]
    const = spark.createDataFrame([(4.0,), (4.0,)], "x double")
    assert [r.n for r in metrics.histogram(spark, const, "x", 3).orderBy("bin").collect()] == [2, 0, 0]


def test_totals_and_pct(spark):
    tx = spark.createDataFrame([(1, "Name", 3, 0.0), (2, "PBIN", 4, 1.0), (3, "PBIN", 4, -1.0)],
                               "transactionID long, COLUMN_NM string, SUPPLIER_NB long, strChange double")
    t = metrics.totals(tx, analysis(spark)).collect()[0]
    assert (t.transaction_records, t.structural_changes, t.analysis_records) == (3, 2.0, 35)
    p = metrics.structural_pct(tx).collect()[0]
    assert round(p.structural_pct, 3) == 66.667 and p.label == "67%"
    for ones, label in ((1, "12%"), (3, "38%")):   # 12.5 and 37.5: ties go to the even number
        tie = spark.createDataFrame([(1.0 if i < ones else 0.0,) for i in range(8)], "strChange double")
        assert metrics.structural_pct(tie).first().label == label


def test_views(spark):
    df = analysis(spark)
    everything = [tuple(r) for r in views.page(df, "pRatio", ascending=False, size=1000).collect()]
    paged, after = [], None
    while True:   # page by page, each from the last row of the one before
        page = views.page(df, "pRatio", ascending=False, size=3, after=after).collect()
        paged += [tuple(r) for r in page]
        if len(page) < 3:
            break
        after = page[-1].asDict()
    assert paged == everything and len(paged) == 35
    assert "Offset" not in views.page(df, "pRatio", after=after)._jdf.queryExecution().optimizedPlan().toString()
    with pytest.raises(ValueError):
        views.page(df, "pRatio", after={"pRatio": 0.1})
    s1 = rows(views.sample_rows(df, "PBIN", 10, "7"))
    assert len(s1) == 10 and s1 == rows(views.sample_rows(df.repartition(5), "PBIN", 10, "7"))
    assert views.sample_rows(df, "PBIN", 1000).count() == 35
    with pytest.raises(ValueError):
        views.project(df, ["PBIN", "nope"])
    assert [r[0] for r in views.choices(df, "COLUMN_NM").collect()] == ["Name", "Other", "SIC", "Sls_Size"]
    piv = views.pivot(df, ["SUPPLIER_NM"], "COLUMN_NM", ["Name", "SIC", "Phone_SFX"], "count")
    r = {x.SUPPLIER_NM: x for x in piv.collect()}
    assert r["S7"].Phone_SFX == 0 and sum(x.Name for x in r.values()) == 8
    assert sum(x.Name + x.SIC + x.Phone_SFX + x.other for x in r.values()) == 35   # the cells cover all rows
    found = views.pivot(df, ["SUPPLIER_NM"], "COLUMN_NM")
    assert found.columns == ["SUPPLIER_NM", "Name", "Other", "SIC", "Sls_Size", "other_"]
    assert found.agg({"other_": "sum"}).first()[0] == 0
    mx = views.pivot(df, ["SUPPLIER_NM"], "COLUMN_NM", ["Name"], "max", "pRatio")
    assert mx.count() == 7
    sc = views.element_scatter(spark.createDataFrame(
        [(1, "Name", 3), (0, "Name", 3), (2, "SIC", 5)], "transactionID long, COLUMN_NM string, SUPPLIER_NB long"),
        "Name")
    assert rows(sc) == [(1, 3, "red"), (2, 5, "grey")]
    fs = views.feature_scatter(df, "tsoRatio")
    assert fs.columns == ["PBIN", "feature", "value"]


def test_flag_audit_and_value_counts(spark):
    df = spark.createDataFrame([("1", "0", None, "1"), ("0", "0", "1", "1"), (None, "1", "0", "0")],
                               "rsdl string, comml string, comp_addr string, non_phys string")
    out = {r.flag: (r.ones, r.zeros, r.nulls) for r in quality.flag_audit(df).collect()}
    assert out == {"rsdl": (1, 1, 1), "comml": (1, 2, 0), "comp_addr": (1, 1, 1), "non_phys": (2, 1, 0)}
    vc = quality.value_counts(df, "rsdl")
    assert rows(vc) == [(None, 1), ("0", 1), ("1", 1)]
    counted, obs = quality.row_metrics(df, "audit")
    counted.collect()
    assert obs.get["rows"] == 3


def test_dedupe_counts(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 1)], "x string, y int")
    r = quality.dedupe_counts(df).collect()[0]
    assert (r.rows, r.distinct_rows) == (3, 2)   # NULLs count as equal, unlike count(DISTINCT ...)


def test_pivot_long_takes_any_number_of_values(spark):
    df = spark.range(25_000).selectExpr("id % 2 AS r", "CASE WHEN id < 24990 THEN id END AS v", "CAST(id AS DOUBLE) AS m")
    with pytest.raises(ValueError, match="pivot_long"):
        views.pivot(df, ["r"], "v")
    got = views.pivot_long(df, ["r"], "v")
    assert got.count() == 24_992 and {r.cell for r in got.filter("v IS NULL").collect()} == {5}
    assert views.pivot_long(df, ["r"], "v", "max", "m").agg({"cell": "max"}).first()[0] == 24_999.0
    with pytest.raises(ValueError):
        views.pivot_long(df, ["r"], "v", "sum")
