import json
import os

import pytest
from pyspark.sql import functions as F

from entwise import schemas as S
from entwise import sinks
from entwise.plans import jobs
from entwise.sources import snapshots as snap
from entwise.sources.csv import csv_ragged, csv_snapshot

from .conftest import rows


def write_csv_folder(path, header, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-0.csv"), "w") as f:
        f.write(header + "\n" + "\n".join(lines) + "\n")


def test_latest_snapshot_ignores_non_dates(spark, tmpdir_path):
    root = f"{tmpdir_path}/src"
    for d in ["20240101", "20240301", "20240215", "latest_x", "2024031"]:
        write_csv_folder(f"{root}/{d}", "a", ["1"])
    folders = snap.snapshot_folders(spark, [root])
    assert rows(snap.latest(folders)) == [(root, "20240301")]


def control_rows(spark, root):
    return spark.createDataFrame([
        ("t_zero", root, "db_t0", "20240101", 0),        # never updated
        ("t_today", root, "db_t1", "20240301", 1),       # due exactly on as_of -> not needed
        ("t_newer", root, "db_t2", "20240201", 7),       # overdue, newer folder -> update
        ("t_same", root, "db_t3", "20240310", 1),        # overdue, latest == last -> failed
        ("t_older", root, "db_t4", "20240315", 1),       # overdue, latest older -> failed
        ("t_stale", root, "db_t5", "20240120", 60),      # due 2024-03-20 > as_of? not due
        ("t_nosrc", f"{root}_missing", "db_t6", "20240101", 1),
    ], S.CONTROL_SCHEMA)


def test_refresh_plan_cases(spark, tmpdir_path):
    root = f"{tmpdir_path}/src"
    for d in ["20240201", "20240310"]:
        write_csv_folder(f"{root}/{d}", "a", ["1"])
    control = control_rows(spark, root)
    latest = snap.latest(snap.snapshot_folders(spark, [root, f"{root}_missing"]))
    plan = snap.refresh_plan(control, latest, "2024-03-02")
    got = {r.table: (r.status, r.note) for r in plan.collect()}
    assert got["t_zero"] == ("not_needed", None)
    assert got["t_today"] == ("not_needed", None)
    assert got["t_newer"] == ("update", None)
    assert got["t_same"][0] == "not_needed"   # due 2024-03-11, not yet
    plan2 = {r.table: (r.status, r.note) for r in
             snap.refresh_plan(control, latest, "2024-04-30").collect()}
    assert plan2["t_same"] == ("failed", "no newer source")
    assert plan2["t_older"] == ("failed", "no newer source")
    assert plan2["t_stale"] == ("update", "older_than_expected")
    assert plan2["t_nosrc"] == ("failed", "no source folder")
    rep = {r.status: r.tables for r in snap.report(plan).collect()}
    assert "t_newer" in rep["update"]


def test_control_roundtrip(spark, tmpdir_path):
    path = f"{tmpdir_path}/control.json"
    with open(path, "w") as f:
        json.dump({"b": {"source": "/s/b", "destination": "db.b", "last_update": "20240101",
                         "update_freq": 7},
                   "a": {"source": "/s/a", "destination": "db.a", "last_update": "20240102",
                         "update_freq": 0}}, f)
    control = snap.read_control(spark, path)
    assert rows(control) == [("a", "/s/a", "db.a", "20240102", 0), ("b", "/s/b", "db.b", "20240101", 7)]
    done = spark.createDataFrame([("b", "20240301")], "table string, snapshot string")
    snap.write_control(snap.advance_control(control, done), f"{tmpdir_path}/control2")
    back = snap.read_control(spark, f"{tmpdir_path}/control2")
    assert rows(back, "table", "last_update") == [("a", "20240102"), ("b", "20240301")]
    # a version whose job did not finish is not read
    os.makedirs(f"{tmpdir_path}/control2/v00000002")
    assert rows(snap.read_control(spark, f"{tmpdir_path}/control2"), "table", "last_update") == rows(
        back, "table", "last_update")
    done = spark.createDataFrame([("a", "20240401")], "table string, snapshot string")
    assert snap.write_control(snap.advance_control(back, done), f"{tmpdir_path}/control2").endswith("v00000003")
    again = snap.read_control(spark, f"{tmpdir_path}/control2")
    assert rows(again, "table", "last_update") == [("a", "20240401"), ("b", "20240301")]


def test_refresh_job_end_to_end(spark, tmpdir_path):
    root = f"{tmpdir_path}/src"
    write_csv_folder(f"{root}/20240101", "id,name", ["1,a"])
    write_csv_folder(f"{root}/20240301", "id,name", ["1,a", "2,b"])
    path = f"{tmpdir_path}/control.json"
    with open(path, "w") as f:
        json.dump({"people": {"source": root, "destination": "people_snap", "last_update": "20240101",
                              "update_freq": 7}}, f)
    plan, report = jobs.refresh_snapshots(spark, path, f"{tmpdir_path}/control_next", as_of="2024-03-05")
    assert [r.status for r in plan.collect()] == ["update"]
    assert [(r.status, r.tables) for r in report.collect()] == [("update", ["people"])]
    assert spark.table("people_snap").count() == 2
    assert rows(snap.read_control(spark, f"{tmpdir_path}/control_next"), "last_update") == [("20240301",)]


def test_csv_readers(spark, tmpdir_path):
    write_csv_folder(f"{tmpdir_path}/c", "a,b,c", ["1,x,2.5", "2,y", "3,z,4.5,surplus"])
    df = csv_ragged(spark, f"{tmpdir_path}/c")
    got = {r.a: r for r in df.collect()}
    assert (got[1].b, got[1].c, got[1]._corrupt_record) == ("x", 2.5, None)
    assert (got[2].b, got[2].c) == ("y", None)
    assert got[3]._corrupt_record == "3,z,4.5,surplus"
    typed = csv_snapshot(spark, f"{tmpdir_path}/c", schema=S.T.StructType(
        [S.T.StructField("a", S.T.StringType()), S.T.StructField("b", S.T.StringType()),
         S.T.StructField("c", S.T.StringType())]))
    assert typed.count() == 3


def test_sinks(spark, tmpdir_path):
    spark.sql("CREATE TABLE sink_t (a STRING, b STRING, n INT) USING parquet")
    df = spark.createDataFrame([(1, "B", "A")], "n int, b string, a string")
    sinks.append_by_name(df, "sink_t")
    assert rows(spark.table("sink_t")) == [("A", "B", 1)]
    sinks.replace_rows(spark.createDataFrame([("X", "Y", 2)], "a string, b string, n int"), "sink_t")
    assert rows(spark.table("sink_t")) == [("X", "Y", 2)]
    more = df.withColumn("unknown", F.lit(1))
    for write in (sinks.append_by_name, sinks.replace_rows):
        with pytest.raises(ValueError):
            write(more, "sink_t")
        with pytest.raises(ValueError):
            write(df.drop("n"), "sink_t")
    sinks.append_or_create(df, "sink_new")
    sinks.append_or_create(df, "sink_new")
    assert spark.table("sink_new").count() == 2
    sinks.overwrite(df, "sink_over")
    assert spark.table("sink_over").count() == 1
    sinks.export_csv(df, f"{tmpdir_path}/out_csv")
    back = spark.read.option("header", True).csv(f"{tmpdir_path}/out_csv")
    assert back.columns == ["n", "b", "a"] and back.count() == 1


@pytest.mark.parametrize("session_zone", ["UTC", "America/Chicago", "Asia/Tokyo"])
def test_day_in_zone_does_not_depend_on_the_session(spark, session_zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        for moment, day in (("2024-01-10 06:30:00", "2024-01-10"), ("2024-01-10 05:30:00", "2024-01-09")):
            instant = F.lit(f"{moment}+00:00").cast("timestamp")
            assert spark.range(1).select(snap.day_in(instant, "America/Chicago").cast("string")).first()[0] == day
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
