import random

import pytest

from entwise import schemas as S
from entwise.operators import change_state as cs
from entwise.operators import changes as chg
from entwise.sinks import store as st
from entwise.sinks.store import Conflict, Store

from .test_streaming import frame, log, same

ROWS = "d string, v int"


def put(spark, *rows):
    return spark.createDataFrame(list(rows), ROWS)


def values(store, table="t", **options):
    return sorted(r.v for r in store.read(table, ROWS, **options).collect())


class Crash(Exception):
    pass


def crash_at(monkeypatch, owner, name, when):
    """``owner.name`` raises at its ``when``th call, before or after its work."""
    real, calls = getattr(owner, name), [0]

    def stub(*args, **kwargs):
        calls[0] += 1
        if calls[0] == abs(when):
            if when < 0:
                real(*args, **kwargs)
            raise Crash(name)
        return real(*args, **kwargs)
    monkeypatch.setattr(owner, name, stub)


def test_whole_operations(spark, tmpdir_path):
    s = Store(spark, f"{tmpdir_path}/s")
    assert s.version() == 0 and values(s) == []
    s.overwrite(put(spark, ("x", 1), ("y", 2)), "t")
    s.overwrite(s.read("t", ROWS).selectExpr("d", "v + 10 AS v"), "t")          # reads the table it replaces
    assert values(s) == [11, 12] and values(s, version=1) == [1, 2]             # the old version still reads
    s.append(put(spark, ("x", 3)), "t", "monday")
    s.append(put(spark, ("x", 3)), "t", "monday")                               # the same load again
    assert values(s) == [3, 11, 12]
    s.overwrite(put(spark, ("x", 5)), "t")                                      # appended loads go too
    assert values(s) == [5]
    s.replace_parts(put(spark, ("a", 1), ("b", 2), ("b", 3)), "days", "d", ["a", "b"])
    s.replace_parts(put(spark, ("b", 9)), "days", "d", ["b", "c"])
    assert values(s, "days") == [1, 9] and values(s, "days", parts=["a"]) == [1] and values(s) == [5]
    s.replace_parts(put(spark), "days", "d", ["a"])
    assert values(s, "days") == [9]
    with pytest.raises(ValueError, match="other parts"):
        s.replace_parts(put(spark, ("z", 1)), "days", "d", ["a"])
    assert s.stage(put(spark, (None, 1), ("", 2)), by="d") == {}


def test_a_part_name_may_hold_any_characters(spark, tmpdir_path):
    s = Store(spark, f"{tmpdir_path}/s")
    names = ["a/b", "c=d", "50%", "é x", "2024-01-01|load 1:2"]
    s.replace_parts(put(spark, *[(n, i) for i, n in enumerate(names)]), "t", "d", names)
    assert {n: values(s, parts=[n]) for n in names} == {n: [i] for i, n in enumerate(names)}


@pytest.mark.parametrize("owner,name,when", [(Store, "stage", 1), (Store, "stage", -1),
                                             (Store, "stage", 2), (Store, "stage", -2), (Store, "commit", 1),
                                             (Store, "commit", -1)])
def test_a_crash_leaves_the_old_or_the_new_tables(spark, tmpdir_path, monkeypatch, owner, name, when):
    s = Store(spark, f"{tmpdir_path}/s")
    s.append_all({"t": put(spark, ("x", 1)), "u": put(spark, ("x", 2))}, "first")
    old = values(s), values(s, "u")
    new = [1, 3], [2, 4]
    load = {"t": put(spark, ("x", 3)), "u": put(spark, ("x", 4))}
    with monkeypatch.context() as m:
        crash_at(m, owner, name, when)
        with pytest.raises(Crash):
            s.append_all(load, "second")
    assert (values(s), values(s, "u")) == (new if (name, when) == ("commit", -1) else old)
    s.append_all(load, "second")                                                # made again
    assert (values(s), values(s, "u")) == new


def test_a_manifest_that_broke_off_is_not_read(spark, tmpdir_path):
    s = Store(spark, f"{tmpdir_path}/s")
    s.overwrite(put(spark, ("x", 1)), "t")
    spark.createDataFrame([("t", "", "data/none")], st.MANIFEST).write \
        .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").json(f"{tmpdir_path}/s/manifests/v00000002")
    assert values(s) == [1] and s.version() == 1
    assert s.overwrite(put(spark, ("x", 2)), "t") == 3 and values(s) == [2]


def test_two_changes_from_one_version(spark, tmpdir_path):
    s = Store(spark, f"{tmpdir_path}/s")
    since = s.version()
    s.overwrite(put(spark, ("x", 1)), "t")
    with pytest.raises(Conflict):
        s.commit({"t": s.stage(put(spark, ("x", 2)))}, since=since)
    assert values(s) == [1]


# --- the change log -----------------------------------------------------------

def test_any_cut_order_and_repetition_gives_the_one_load_table(spark, tmpdir_path):
    for case in range(2):
        rows, r = log(60, case), random.Random(case)
        r.shuffle(rows)
        cuts = [0, *sorted(r.sample(range(1, 60), 2)), 60]
        loads = [(f"load {k}", rows[a:b]) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
        s = Store(spark, f"{tmpdir_path}/{case}")
        for name, part in [*loads[::-1], loads[1]]:                             # out of order, one twice
            cs.load_changes(s, frame(spark, part), name, ["U0"])
        assert same(cs.changes(s), chg.normalize(frame(spark, rows), ["U0"])) and cs.changes(s).count()


def test_a_load_reads_its_batch_and_the_touched_days_only(spark, tmpdir_path):
    s = Store(spark, f"{tmpdir_path}/s")
    day = lambda d, after: ("1", f"2024-01-0{d} 08:00:00", "T", "LGL_NM", after, "b", "U1", 1)
    cs.load_changes(s, frame(spark, [day(d, "a") for d in range(1, 7)]), "one")
    for (table, part), folder in s.manifest().items():                          # other days can't be read any more
        if not part.startswith("2024-01-03"):
            spark.createDataFrame([("no parquet",)], "x string").write.mode("append").text(f"{s.root}/{folder}")
    assert cs.load_changes(s, frame(spark, [day(3, "z")]), "two") == ["2024-01-03"]
    assert {(r.trn_ts, r.after) for r in cs.changes(s, ["2024-01-03"]).collect()} == {("2024-01-03", "z")}
    assert cs.changes(s, ["2024-01-03"]).count() == 2
    assert {p for (t, p) in s.manifest() if t == cs.DETAIL and p.startswith("2024-01-03")} == {
        "2024-01-03|one", "2024-01-03|two"}
    with pytest.raises(Exception):  # noqa: B017, PT011 - the marked files are read when asked for
        cs.changes(s).collect()


def test_rows_without_a_day_or_of_excluded_users_touch_nothing(spark, tmpdir_path):
    s = Store(spark, f"{tmpdir_path}/s")
    rows = [("1", None, "T", "LGL_NM", "a", "b", "U1", 1), ("1", "2024-01-01 08:00:00", "T", "LGL_NM", "a", "b", "U0", 1)]
    assert cs.load_changes(s, frame(spark, rows), "one", ["U0"]) == [] and s.version() == 0
    assert cs.changes(s).columns == S.CHANGES_LAYOUT and cs.changes(s).count() == 0


@pytest.mark.parametrize("when", [1, -1, 2, -2, 3, -3])
def test_a_crashed_load_leaves_the_table_and_may_run_again(spark, tmpdir_path, monkeypatch, when):
    rows = log(40, 9)
    s = Store(spark, f"{tmpdir_path}/s")
    cs.load_changes(s, frame(spark, rows[:20]), "one")
    with monkeypatch.context() as m:
        crash_at(m, Store, "stage", when)
        with pytest.raises(Crash):
            cs.load_changes(s, frame(spark, rows[20:]), "two")
    assert same(cs.changes(s), chg.normalize(frame(spark, rows[:20])))
    cs.load_changes(s, frame(spark, rows[20:]), "two")
    assert same(cs.changes(s), chg.normalize(frame(spark, rows)))
