import random

import pytest

from entwise import schemas as S
from entwise.operators import supplement as sup
from entwise.operators.runtime_filter import KeyFilter, bits_for
from entwise.plans import catalog

SF = "/root/testdata/sf0.001"


def nodes(plan):
    """All nodes of an executed plan, those of finished query stages and subqueries too."""
    out = [plan]
    for inner in ("executedPlan", "plan"):
        if plan.getClass().getSimpleName() in ("AdaptiveSparkPlanExec", "ShuffleQueryStageExec", "BroadcastQueryStageExec",
                                               "ResultQueryStageExec") and hasattr(plan, inner):
            try:
                out += nodes(getattr(plan, inner)())
                break
            except Exception:  # not a method of this node
                continue
    children = plan.children()
    for i in range(children.size()):
        out += nodes(children.apply(i))
    return out


def shuffled(df, column):
    """Rows that the executed plan wrote into exchanges on ``column`` above a source scan."""
    rows = 0
    for n in nodes(df._jdf.queryExecution().executedPlan()):
        if n.getClass().getSimpleName() == "ShuffleExchangeExec" and f"hashpartitioning({column}#" in n.toString().split("\n")[0]:
            rows += n.metrics().apply("shuffleRecordsWritten").value()
    return rows


@pytest.fixture()
def shuffles(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


class Width:
    """A session's setting alone."""

    def __init__(self, partitions):
        self.conf = {"spark.sql.shuffle.partitions": str(partitions)}


def test_keys_pass_and_few_others(spark):
    keys = spark.range(2000).selectExpr("CAST(id * 7 AS STRING) AS k").unionAll(spark.sql("SELECT CAST(NULL AS STRING)"))
    rows = spark.range(140_000).selectExpr("id AS k")       # a number here, text there
    passed = {r.k for r in rows.filter(KeyFilter(keys, "k", 1 << 16).holds("k")).collect()}
    want = {7 * i for i in range(2000)}
    assert want <= passed and len(passed - want) < 2000
    tight = rows.filter(KeyFilter(keys, "k", 64).holds("k"))   # a full array lets all pass
    assert tight.count() == 140_000
    assert rows.filter(KeyFilter(keys.limit(0), "k").holds("k")).count() == 0
    assert [bits_for(spark) for spark in (Width(1), Width(16), Width(200), Width(10 ** 5))] == [1 << 20, 1 << 21, 1 << 25, 1 << 26]
    for bits in (0, 96, 1 << 27):
        with pytest.raises(ValueError):
            KeyFilter(keys, "k", bits)


def tables(spark, changed, locations=400, reports=20_000):
    rnd = random.Random(changed)
    changes = spark.createDataFrame([(str(i % changed),) for i in range(3 * changed)], "pbin string")
    places = spark.createDataFrame([(str(i % 100), f"c{i}", f"L{i}") for i in range(locations)],
                                   "pbin string, child_pbin string, lvid string")
    source = spark.createDataFrame(
        [(f"L{rnd.randrange(locations)}", i % 9, "01/01/2000", "01/02/2000", f"{i % 50:04d}", "T") for i in range(reports)],
        "lvid string, supplier_nb int, dt_first_rpted string, dt_last_rpted string, sic_cd string, sic_ty_cd string")
    named = spark.createDataFrame([(i, f"S{i}") for i in range(5)], "supplier_nb int, supplier_nm string")
    loaded = sup.unpivot_elements(source, [sup.SIC]).filter("supplier_nb < 3")
    return changes, places, named, source, loaded


def build(parts, **options):
    changes, places, named, source, loaded = parts
    return sup.build(changes, places, named, [(source, [sup.SIC])], loaded=loaded, **options)


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_source_rows_shuffled_fall_with_the_share_of_changed_locations(spark, shuffles):
    moved = {}
    for changed in (2, 20, 100):
        parts = tables(spark, changed)
        for bits in (None, 1 << 16):
            df = build(parts, prefilter=bits is not None, filter_bits=bits)
            df.collect()
            moved[changed, bits] = shuffled(df, "lvid")
        assert same(build(parts, filter_bits=1 << 16), build(parts, prefilter=False))
    assert moved[2, None] >= 20_000
    assert moved[2, 1 << 16] < 0.2 * moved[2, None]
    assert moved[2, 1 << 16] < moved[20, 1 << 16] < moved[100, 1 << 16] <= moved[100, None]


def test_filter_stands_between_scan_and_exchange(spark, shuffles):
    df = catalog.QUERIES["supplement_sic"](spark, SF)
    df.collect()
    tests = [n for n in nodes(df._jdf.queryExecution().executedPlan())
             if n.getClass().getSimpleName() == "FilterExec" and "getbit(" in n.condition().toString()]
    assert len(tests) >= 2                       # the source, and the rows loaded before
    assert all("Scan" in n.toString() and "Exchange" not in n.child().toString() for n in tests)
    assert df.columns == S.SUPPLEMENT_LAYOUT


def test_a_row_is_tested_by_one_word_that_is_mentioned_twice(spark):
    """Each mention of the array is a copy in every closure that the driver serializes."""
    keys = spark.range(3000).selectExpr("id * 7 AS k")
    found = KeyFilter(keys, "k", 1 << 16)
    assert found.words is not None and str(found.holds("k")).count("element_at") == 2
    rows = spark.range(-5000, 21_000).selectExpr("id AS k").unionAll(spark.sql("SELECT CAST(NULL AS LONG)"))
    passed = {r.k for r in rows.filter(found.holds("k")).collect()}
    assert {7 * i for i in range(3000)} <= passed and len(passed) < 3000 + 1500
    held = spark.range(1).select(found.words.alias("w")).first().w
    assert len(held) == (1 << 16) // 64 and 0 < sum(bin(w & (2 ** 64 - 1)).count("1") for w in held) <= 3 * 3000
