from pyspark.sql import functions as F

from entwise import schemas as S
from entwise.functions.text import (code_map, day_of, leading_digits, lenient_gt, replace_values,
                                    strip_zeros_if_gt_one)


def one_col(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v string")


def test_code_map_unmapped_and_null(spark):
    df = one_col(spark, ["LGL_NM", "PRI_PH_AREA", "CHILD_PBIN", "XYZ", None])
    out = [r[0] for r in df.select(code_map("v", S.CHANGE_CODE_MAP, "1")).collect()]
    assert out == ["Name", "Phone_AREA", "CHILD_PBIN", "1", "1"]


def test_day_of_cuts_to_ten_chars(spark):
    df = one_col(spark, ["2024-01-05 10:11:12", "2024-01-05", None])
    assert [r[0] for r in df.select(day_of("v")).collect()] == ["2024-01-05", "2024-01-05", None]


def test_leading_digits(spark):
    df = one_col(spark, ["1200", "1200.50", "N/A", "", None])
    assert [r[0] for r in df.select(leading_digits("v")).collect()] == ["1200", "1200", "", "", None]


def test_strip_zeros_only_when_number_gt_one(spark):
    vals = ["0005", "00ABC", "0001", "000", "1.5", "0012.5", "9999999999", "", None, "01.5",
            "0009999999999"]
    df = one_col(spark, vals)
    out = [r[0] for r in df.select(strip_zeros_if_gt_one("v")).collect()]
    # '00ABC' is not a number, '0001'/'000' are not > 1, '01.5' has integer part 1,
    # '0009999999999' is beyond the int range -> all untouched
    assert out == ["5", "00ABC", "0001", "000", "1.5", "12.5", "9999999999", "", None, "01.5",
                   "0009999999999"]


def test_lenient_gt_never_raises_under_ansi(spark):
    df = one_col(spark, ["abc", "2", " 3 ", None])
    out = [r[0] for r in df.select(lenient_gt("v", 1)).collect()]
    assert out == [None, True, True, None]


def test_replace_values_keeps_others(spark):
    df = one_col(spark, ["0401-01-01", "2020-01-01", None])
    out = [r[0] for r in df.select(replace_values("v", S.SENTINEL_ISO)).collect()]
    assert out == ["1970-01-01", "2020-01-01", None]


def test_expressions_stay_in_codegen(spark):
    df = one_col(spark, ["0012"]).select(strip_zeros_if_gt_one("v").alias("x"),
                                         code_map(F.trim("v"), S.CHANGE_CODE_MAP, "1").alias("y"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
