import random

from entwise import schemas as S
from entwise.operators.changes import load_days, normalize, replace_days
from entwise.plans.jobs import normalize_changes
from entwise.streaming.change_stream import start_change_stream

TABLE = ("CREATE TABLE {} (pbin STRING, column_nm STRING, table_nm STRING, after STRING, before STRING, "
         "sbu_user_id STRING, sbu_supplier_nb INT, trn_ts STRING) USING parquet PARTITIONED BY (trn_ts)")


def log(n, seed=1):
    r = random.Random(seed)
    return [(str(r.randrange(5)), f"2024-01-0{r.randrange(1, 4)} 0{r.randrange(10)}:00:00", "T",
             r.choice(["LGL_NM", "PRI_AIN", "XX"]), r.choice(["a", "b", "c", None]), r.choice(["a", "b", "c"]),
             "U1", 1) for _ in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, S.RAW_CHANGES_SCHEMA)


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_late_row_of_a_day_changes_its_group(spark):
    early = frame(spark, [("1", "2024-01-01 08:00:00", "T", "LGL_NM", "a", "b", "U1", 1)])
    late = frame(spark, [("1", "2024-01-01 09:00:00", "T", "LGL_NM", "z", "c", "U1", 1)])
    both = early.union(late)
    table = replace_days(normalize(early), load_days(late, both), late)
    assert table.count() == 2 and same(table, normalize(both))
    assert {r.after for r in table.collect()} == {"z"}


def test_any_split_into_loads_gives_the_one_load_table(spark):
    for case in range(3):
        rows = log(60, case)
        r = random.Random(case)
        r.shuffle(rows)
        cuts = [0, *sorted(r.sample(range(1, 60), 2)), 60]
        name = f"split_changes_{case}"
        spark.sql(TABLE.format(name))
        for a, b in zip(cuts, cuts[1:]):
            normalize_changes(spark, frame(spark, rows[a:b]), frame(spark, rows[:b]), name, [])
        assert same(spark.table(name), normalize(frame(spark, rows)))
        # a load that runs again changes nothing
        normalize_changes(spark, frame(spark, rows[cuts[1]:]), frame(spark, rows), name, [])
        assert same(spark.table(name), normalize(frame(spark, rows)))


def test_a_day_that_becomes_empty_is_emptied(spark):
    spark.sql(TABLE.format("emptied_changes"))
    one = [("1", "2024-01-01 08:00:00", "T", "LGL_NM", "a", "b", "U1", 1)]
    more = one + [("1", "2024-01-01 09:00:00", "T", "LGL_NM", "b", "a", "U1", 1)]   # maxima are now equal
    normalize_changes(spark, frame(spark, one), frame(spark, one), "emptied_changes", [])
    assert spark.table("emptied_changes").count() == 1
    normalize_changes(spark, frame(spark, more[1:]), frame(spark, more), "emptied_changes", [])
    assert spark.table("emptied_changes").count() == 0


def test_stream_equals_batch_however_files_arrive(spark, tmpdir_path):
    raw = f"{tmpdir_path}/raw"
    spark.sql(TABLE.format("stream_changes"))
    rows = log(80)
    for k, part in enumerate((rows[:30], rows[30:50], rows[50:])):   # days are cut across files
        frame(spark, part).coalesce(1).write.mode("append").parquet(raw)
        if k != 1:
            q = start_change_stream(spark, raw, "stream_changes", f"{tmpdir_path}/ckpt", [], files_per_batch=1)
            q.awaitTermination()
    expected = normalize(spark.read.parquet(raw), [])
    spark.catalog.refreshTable("stream_changes")    # the stream wrote in a session of its own
    assert expected.count() and same(spark.table("stream_changes"), expected)
    # a fresh checkpoint replays every file
    start_change_stream(spark, raw, "stream_changes", f"{tmpdir_path}/ckpt2", []).awaitTermination()
    spark.catalog.refreshTable("stream_changes")
    assert same(spark.table("stream_changes"), expected)
