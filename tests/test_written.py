"""Loads, CSV lines, schema registry, refresh, layouts and clustered pages."""

import os
import random

import pytest

from entwise import schemas as S
from entwise.operators import change_state, metrics, survey, views
from entwise.operators.changes import normalize
from entwise.plans import catalog, jobs, layout, written
from entwise.sinks.store import Store
from entwise.sources import adapters as A
from entwise.sources import snapshots as snap
from entwise.sources.csv import csv_lines
from entwise.sources.registry import Registry
from entwise.sources.scratch import scratch
from entwise.streaming.change_stream import start_change_stream_into

from .test_runtime_filter import nodes, shuffles  # noqa: F401
from .test_store import Crash, crash_at
from .test_streaming import frame, log, same

SF = "/root/testdata/sf0.001"


def put_text(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


# --- CSV lines -------------------------------------------------------------------

def test_csv_lines_pad_short_rows_and_keep_long_ones(spark, tmpdir_path):
    put_text(f"{tmpdir_path}/r/a.csv", 'a,b,"c x"\n1,"x, ""y""",2.5\n2\n\n3,z,4.5,s,"t,u"\n,"",\n')
    put_text(f"{tmpdir_path}/r/b.csv", 'a,b,"c x"\n9,q,\n5,"open,7\na,b,"c x"\n')
    df = csv_lines(spark, f"{tmpdir_path}/r")
    assert df.columns == ["a", "b", "c x", "_extra"]
    assert sorted(map(tuple, df.collect()), key=str) == sorted([
        ("1", 'x, "y"', "2.5", None), ("2", None, None, None), ("3", "z", "4.5", ["s", "t,u"]), (None, "", None, None),
        ("9", "q", None, None), ("5", '"open', "7", None)], key=str)


def test_csv_lines_of_long_fields_and_bad_headers(spark, tmpdir_path):
    put_text(f"{tmpdir_path}/long/a.csv", 'a,b\n"' + "x" * 200_000 + '",1\n')
    assert [(len(r.a), r.b) for r in csv_lines(spark, f"{tmpdir_path}/long").collect()] == [(200_000, "1")]
    for name, files in {"two": ["a,b\n1,2\n", "a,c\n1,2\n"], "same": ["a,A\n1,2\n"], "own": ["a,_extra\n1,2\n"], "none": [""]}.items():
        for k, text in enumerate(files):
            put_text(f"{tmpdir_path}/{name}/{k}.csv", text)
        with pytest.raises(ValueError, match="header|ambiguous|no lines"):
            csv_lines(spark, f"{tmpdir_path}/{name}")


# --- schema registry and refresh ----------------------------------------------------

def test_types_are_inferred_once(spark, tmpdir_path, monkeypatch):
    put_text(f"{tmpdir_path}/1/a.csv", "id,name,v\n1,a,2\n")
    put_text(f"{tmpdir_path}/2/a.csv", "v,id,name\n7,2,b\n,3,c\n")          # other order, no other columns
    put_text(f"{tmpdir_path}/3/a.csv", "id,v,new\n1,2.5,x\n2,,y\n9999999999,1,z\n")
    registry = Registry(spark, f"{tmpdir_path}/schemas")
    assert registry.schema("t") is None
    assert registry.read("t", f"{tmpdir_path}/1")[0].dtypes == [("id", "int"), ("name", "string"), ("v", "int")]
    monkeypatch.setattr("entwise.sources.registry.csv_snapshot", None)     # would infer again
    rows, drift = registry.read("t", f"{tmpdir_path}/2")
    assert drift.count() == 0 and sorted(map(tuple, rows.collect())) == [(2, "b", 7), (3, "c", None)]
    drift = registry.read("t", f"{tmpdir_path}/3")[1]
    assert sorted(map(tuple, drift.collect()), key=str) == sorted([
        ("name", "missing", None), ("new", "added", None), ("id", "widened", 1), ("v", "widened", 1)], key=str)
    registry.put("t", S.CONTROL_SCHEMA)
    assert registry.schema("t") == S.CONTROL_SCHEMA


def test_a_failing_load_does_not_stop_the_others(spark, tmpdir_path):
    root = f"{tmpdir_path}/src"
    for t in ("one", "two", "three"):
        put_text(f"{root}/{t}/20240101/a.csv", "id\n1\n")
        put_text(f"{root}/{t}/20240301/a.csv", "id\n1\n2\n")
    os.makedirs(f"{root}/bad/20240301")                                       # a folder without files
    names = ["bad", "one", "two", "three"]
    control = spark.createDataFrame([(t, f"{root}/{t}", f"apart_{t}", "20240101", 7) for t in names], S.CONTROL_SCHEMA)
    snap.write_control(control, f"{tmpdir_path}/control")
    plan, report = jobs.refresh_snapshots(spark, f"{tmpdir_path}/control", f"{tmpdir_path}/control", "2024-03-05",
                                          report_path=f"{tmpdir_path}/report")
    assert {r["table"]: r["status"] for r in plan.collect()} == {
        "bad": "failed", "one": "update", "two": "update", "three": "update"}
    assert [r.note for r in plan.filter("status = 'failed'").collect()] == ["load failed: AnalysisException"]
    lists = {r.status: r.tables for r in spark.read.json(f"{tmpdir_path}/report").collect()}
    assert lists == {"failed": ["bad"], "update": ["one", "three", "two"]} == {r.status: r.tables for r in report.collect()}
    assert all(spark.table(f"apart_{t}").count() == 2 for t in ("one", "two", "three"))
    done = {r["table"]: r.last_update for r in snap.read_control(spark, f"{tmpdir_path}/control").collect()}
    assert done == {"bad": "20240101", "one": "20240301", "two": "20240301", "three": "20240301"}


def test_a_drifted_snapshot_is_reported_not_loaded(spark, tmpdir_path):
    root = f"{tmpdir_path}/src/t"
    put_text(f"{root}/20240101/a.csv", "id\n1\n")
    put_text(f"{root}/20240301/a.csv", "id,more\n1,x\n")
    snap.write_control(spark.createDataFrame([("t", root, "drifted_t", "20230101", 7)], S.CONTROL_SCHEMA), f"{tmpdir_path}/c")
    registry = Registry(spark, f"{tmpdir_path}/schemas")
    registry.read("t", f"{root}/20240101")
    plan, _ = jobs.refresh_snapshots(spark, f"{tmpdir_path}/c", f"{tmpdir_path}/c", "2024-03-05", registry=registry)
    assert [(r.status, r.note) for r in plan.collect()] == [("failed", "drifted: more added")]
    assert not spark.catalog.tableExists("drifted_t")


# --- loads that run again ---------------------------------------------------------

@pytest.mark.parametrize("when", [1, -1, 2, -2])
def test_a_survey_load_that_crashes_and_runs_again_is_there_once(spark, tmpdir_path, monkeypatch, when):
    answers = A.survey_responses(spark, SF).filter("respondent_id < 40")
    accepted, invalid = survey.load_responses(spark, answers)
    s = Store(spark, f"{tmpdir_path}/s")
    with monkeypatch.context() as m:
        crash_at(m, Store, "stage", when)
        with pytest.raises(Crash):
            jobs.load_survey_once(s, answers, "monday")
    assert s.read("accepted", accepted.schema).count() == s.read("invalid", invalid.schema).count() == 0
    for _ in range(2):
        jobs.load_survey_once(s, answers, "monday")
        assert same(s.read("accepted", accepted.schema), accepted) and same(s.read("invalid", invalid.schema), invalid)


def test_stream_into_a_store_however_files_arrive(spark, tmpdir_path):
    raw, rows = f"{tmpdir_path}/raw", log(80)
    for k, part in enumerate((rows[:30], rows[30:50], rows[50:])):            # days are cut across files
        frame(spark, part).coalesce(1).write.mode("append").parquet(raw)
        if k != 1:
            start_change_stream_into(spark, raw, f"{tmpdir_path}/store", f"{tmpdir_path}/ckpt", ["U0"],
                                     files_per_batch=1).awaitTermination()
    want = normalize(spark.read.parquet(raw), ["U0"])
    store = Store(spark, f"{tmpdir_path}/store")
    assert want.count() and same(change_state.changes(store), want)
    # another checkpoint replays every file, all in one batch
    start_change_stream_into(spark, raw, f"{tmpdir_path}/store", f"{tmpdir_path}/ckpt2", ["U0"]).awaitTermination()
    assert same(change_state.changes(store), want)


# --- layouts --------------------------------------------------------------------------

def test_bucketed_address_jobs_shuffle_no_location_or_address(spark, shuffles):  # noqa: F811
    made = layout.Layout(spark, "ew_test_", scratch(spark, "layout"), 8)
    layout.store(made, A.address(spark, SF), A.location_addresses(spark, SF), A.sic_source(spark, SF),
                 A.entity_location_assoc(spark, SF), A.operating_locations(spark, SF), years=A.FIXTURE_GOVT_YEARS)
    places = made.table("places").join(made.table("govt_locations"), ["lvid", layout.SALT], "left_semi")
    keys = layout.government_keys(made)
    classified = layout.classify(made, keys)
    assert same(keys, catalog._government_keys(spark, SF)) and same(classified, catalog._classified(spark, SF))
    for df, exchanges in ((places, 0), (keys, 1), (classified, 0)):
        df.collect()
        found = [n.toString().split("\n")[0] for n in nodes(df._jdf.queryExecution().executedPlan())
                 if n.getClass().getSimpleName() == "ShuffleExchangeExec"]
        assert len(found) == exchanges and not any("(ain#" in x or "(lvid#" in x for x in found), found
    # one key with all rows lies in several buckets
    hot = spark.range(4000).selectExpr("'same' AS k", "id % 3 AS v")
    made.put_rows(hot, "hot", "k")
    files = made.table("hot").groupBy("_metadata.file_path").count().collect()
    assert len(files) > 2 and sum(r["count"] for r in files) == 4000
    made.drop()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("ew_test_")]


def grown(spark, n):
    return spark.range(n).selectExpr("CASE WHEN id % 50 = 0 THEN NULL ELSE CAST(id % 7 AS DOUBLE) END AS k", "id AS j",
                                     "concat('s', id % 3) AS s")


@pytest.mark.parametrize("ascending", [True, False])
def test_files_read_for_a_page_do_not_grow_with_the_table(spark, ascending):
    opened = {}
    for n in (3000, 12_000):
        df, path, after = grown(spark, n), scratch(spark, "pages"), None
        views.write_clustered(df, path, "k", ascending, 400)
        for page in range(4):
            want = [tuple(r) for r in views.page(df, "k", ascending, 60, after).collect()]
            found = views.page_clustered(spark, path, "k", ascending, 60, after)
            assert [tuple(r) for r in found.collect()] == want
            opened[n, page] = len(found.inputFiles())
            after = dict(zip(df.columns, want[-1])) if want else after
            if page == 1:                                                        # then deep in the table, at a NULL
                after = {"k": None, "j": n // 2, "s": "s0"}
        assert len(found.inputFiles()) < n // 400
    assert max(opened.values()) <= 3
    beyond = {"k": None, "j": 10 ** 9, "s": None}
    assert views.page_clustered(spark, path, "k", ascending, 60, beyond).count() == 0


def test_clustered_copies_of_one_row_and_unfit_columns(spark):
    path = scratch(spark, "pages")
    views.write_clustered(spark.range(3000).selectExpr("1 AS k", "'x' AS s"), path, "k", False, 300)
    sizes = [r["_rows"] for r in spark.read.parquet(f"{path}/index").collect()]
    assert len(sizes) > 5 and max(sizes) < 1500
    assert views.page_clustered(spark, path, "k", False, 25).count() == 25
    with pytest.raises(ValueError, match="number or a date"):
        views.write_clustered(spark.range(3).selectExpr("'a' AS k"), scratch(spark, "pages"), "k", False)


def test_clustered_ranges_do_not_grow_with_the_files(spark):
    """The driver samples rows for each range of the shuffle; files are cut from a range."""
    jobs, df = [], spark.range(20_000).selectExpr("id % 977 AS k", "id AS j")
    path, width = scratch(spark, "pages"), int(spark.conf.get("spark.sql.shuffle.partitions"))
    group = f"pages-{path}"
    spark.sparkContext.setJobGroup(group, group)
    views.write_clustered(df, path, "k", False, 50)
    tracker = spark.sparkContext.statusTracker()
    for job in tracker.getJobIdsForGroup(group):
        jobs += [tracker.getStageInfo(i).numTasks for i in tracker.getJobInfo(job).stageIds if tracker.getStageInfo(i)]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    index = spark.read.parquet(f"{path}/index").collect()
    assert len(index) >= 400 and max(r["_rows"] for r in index) <= 50 and sum(r["_rows"] for r in index) == 20_000
    assert max(jobs) < 200 and width < 200
    after = {"k": 500, "j": 3000}
    assert views.page_clustered(spark, path, "k", False, 70, after).collect() == views.page(df, "k", False, 70, after).collect()


# --- histogram -------------------------------------------------------------------------

def test_round_histogram(spark):
    rnd = random.Random(2)
    for lo, hi, bins in ((0, 99, 10), (0, 1500, 50), (-3700, 0, 10), (0.001, 0.0094, 7), (12.5, 13, 4), (1e6, 9e7, 20)):
        xs = [float(lo), float(hi)] + [rnd.uniform(lo, hi) for _ in range(300)]
        df = spark.createDataFrame([(x,) for x in xs] + [(None,), (float("nan"),)], "x double")
        got = metrics.histogram_round(df, "x", bins).orderBy("bin").collect()
        step = got[0].upper - got[0].lower
        mantissa = float(f"{step:.6e}".split("e")[0])
        assert round(mantissa, 3) in (1, 2, 5) and bins / 1.8 <= (hi - lo) / step <= bins * 1.45
        assert [r.bin for r in got] == list(range(1, len(got) + 1)) and sum(r.n for r in got) == len(xs)
        assert got[0].lower <= lo + 1e-9 * step and hi <= got[-1].upper + 1e-7 * step
        for r in got:
            inside = sum(r.lower < x <= r.upper or (r.bin == 1 and x == r.lower) for x in xs)
            assert abs(inside - r.n) <= 1                                        # a value on a break, up to rounding
    assert [tuple(r) for r in metrics.histogram_round(spark.createDataFrame([(5.0,)] * 3, "x double"), "x").collect()] == [
        (1, 5.0, 6.0, 3)]
    assert metrics.histogram_round(spark.createDataFrame([(None,)], "x double"), "x").count() == 0


def test_every_written_query_has_an_oracle():
    from entwise.plans import oracle
    assert set(written.QUERIES) <= set(oracle.oracle_sql())
