from pyspark.sql import Window
from pyspark.sql import functions as F

from entwise import schemas as S
from entwise.operators import changes as chg

from .conftest import rows

RAW = [
    # pbin, trn_ts, table_nm, column_nm, after, before, user, supplier
    ("1", "2024-01-01 10:00:00", "T", "LGL_NM", "9", "1", "U1", 5),
    ("1", "2024-01-01 11:00:00", "T", " LGL_NM ", "10", "2", "U2", 5),   # same key, text max '9'
    ("1", "2024-01-01 12:00:00", "T", "XX", "a", "b", "U1", 5),          # unmapped -> dropped
    ("2", "2024-01-02 09:00:00", "T", "SIC_CD_PRI", "0100", "0100 ", "U1", 6),  # equal after trim
    ("3", "2024-01-02 09:00:00", "T", "PRI_AIN", "x", "y", "JB", 7),     # excluded user
    ("4", "2024-01-03 09:00:00", "T", "PRI_AIN", "x", "y", None, 7),     # NULL user -> dropped
    ("5", "2024-01-03 09:00:00", "T", "PRI_AIN", None, "y", "U3", 7),    # NULL after -> dropped
    ("6", "2024-01-04 09:00:00", "T", "CHILD_PBIN", "60", "61", "U3", 8),
    (None, "2024-01-04 09:00:00", "T", "CHILD_PBIN", "1", "2", "U3", 8),  # NULL key -> dropped
]


def raw_df(spark):
    return spark.createDataFrame(RAW, S.RAW_CHANGES_SCHEMA)


def test_normalize_expected_rows(spark):
    out = chg.normalize(raw_df(spark), ["JB"])
    assert out.columns == S.CHANGES_LAYOUT
    assert rows(out) == [
        ("2024-01-01", "1", "Name", "T", "9", "2", "U1", 5),
        ("2024-01-01", "1", "Name", "T", "9", "2", "U2", 5),
        ("2024-01-04", "6", "CHILD_PBIN", "T", "60", "61", "U3", 8),
    ]


def test_null_safe_option_keeps_inserts(spark):
    df = raw_df(spark)
    kept = chg.drop_noops(chg.max_per_key(chg.exclude(chg.map_codes(df), ["JB"])), null_safe=True)
    assert ("5", "y") in [(r.pbin, r.before) for r in kept.collect()]


def test_load_days_returns_the_touched_days_only(spark):
    df = raw_df(spark)
    late = df.filter(F.col("trn_ts") >= "2024-01-02")
    assert [r.pbin for r in chg.load_days(late, df, ["JB"]).collect()] == ["6"]
    stored = chg.normalize(df.filter(F.col("trn_ts") < "2024-01-02"), ["JB"])
    after = chg.replace_days(stored, chg.load_days(late, df, ["JB"]), late)
    assert rows(after) == rows(chg.normalize(df, ["JB"]))


def test_max_per_key_equals_window_form_and_salted_path(spark):
    # many rows per key, including one hot key
    data = [(str(i % 3), f"2024-01-0{1 + i % 2} 00:00:00", "T", "LGL_NM", str(i), str(100 - i), "U1", 1)
            for i in range(60)] + [("9", "2024-01-01 00:00:00", "T", "LGL_NM", str(i), "x", "U1", 1)
                                   for i in range(40)]
    df = chg.exclude(chg.map_codes(spark.createDataFrame(data, S.RAW_CHANGES_SCHEMA)), [])
    w = Window.partitionBy(*chg.GROUP_KEYS)
    expected = df.withColumns({"after": F.max("after_value").over(w),
                               "before": F.max("before_value").over(w)})
    got = chg.max_per_key(df).select(*expected.columns)
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0


def test_changed_entities_distinct(spark):
    out = chg.changed_entities(chg.normalize(raw_df(spark), ["JB"]))
    assert rows(out) == [("1",), ("6",)]
