import pytest
from pyspark.sql import functions as F

from entwise.operators.incremental import not_yet_loaded
from entwise.operators.skew import attach_group_aggregates, spread_join


def skewed(spark, n=3000):
    # key 'hot' holds a third of the rows, including exact copies; some NULL keys
    data = [("hot", i % 7) for i in range(n // 3)] + [(f"k{i % 50}", i) for i in range(n // 2)] \
        + [(None, i) for i in range(n - n // 3 - n // 2)]
    return spark.createDataFrame(data, "k string, v int")


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.fixture()
def plain_plans(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_equals_plain_join(spark, how):
    left = skewed(spark)
    right = spark.createDataFrame([("hot", "H")] + [(f"k{i}", f"K{i}") for i in range(0, 50, 2)], "k string, r string")
    got = spread_join(left, right, ["k"], how)
    assert same(got, left.join(right, "k", how).select(*got.columns))


def test_attach_group_aggregates_matches_groupby_join(spark):
    df = skewed(spark)
    agg = df.groupBy("k").agg(F.max("v").alias("mx"), F.sum("v").alias("sm"))
    expected = df.join(agg, "k")
    got = attach_group_aggregates(df, ["k"], {"mx": F.max("v"), "sm": F.sum("v")})
    assert same(got.select(*expected.columns), expected)
    assert attach_group_aggregates(df.limit(0), ["k"], {"mx": F.max("v")}).count() == 0


def test_hot_key_leaves_from_several_reducers(spark, plain_plans):
    left = skewed(spark, 6000)
    right = spark.createDataFrame([("hot", "H")] + [(f"k{i}", f"K{i}") for i in range(50)], "k string, r string")

    def reducers(df):
        return df.filter("k = 'hot'").select(F.spark_partition_id().alias("p")).distinct().count()
    assert reducers(left.join(right, "k", "inner")) == 1
    assert reducers(spread_join(left, right, ["k"], "inner")) >= 4
    assert reducers(attach_group_aggregates(left, ["k"], {"mx": F.max("v")})) >= 2


def test_salt_reaches_the_shuffle_partitioning(spark, plain_plans):
    df = attach_group_aggregates(skewed(spark), ["k"], {"mx": F.max("v")})
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert len([x for x in plan.splitlines() if "hashpartitioning(" in x and "_ew_salt" in x]) == 2, plan


def test_no_more_hot_keys_than_partitions(spark):
    # a key is hot if it has more than an even share of a partition's rows
    many = spark.range(4000).selectExpr("cast(id % 1000 AS string) AS k", "cast(id AS int) AS v")
    plan = attach_group_aggregates(many, ["k"], {"mx": F.max("v")})
    assert plan.count() == 4000
    assert "CartesianProduct" not in plan._jdf.queryExecution().executedPlan().toString()


def test_aqe_splits_a_hot_probe_key_of_the_anti_join(spark, tmpdir_path):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        spark.range(200_000).selectExpr("CASE WHEN id % 3 = 0 THEN -1 ELSE id END AS k", "id AS v") \
            .repartition(8).write.parquet(f"{tmpdir_path}/new")
        spark.range(5000).selectExpr("id AS k").union(spark.range(5000).selectExpr("id AS k")) \
            .write.parquet(f"{tmpdir_path}/old")
        out = not_yet_loaded(spark.read.parquet(f"{tmpdir_path}/new"), spark.read.parquet(f"{tmpdir_path}/old"), ["k"])
        n = len(out.collect())
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
        assert n == out.count() == 200_000 - spark.range(5000).filter("id % 3 <> 0").count()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_not_yet_loaded_keeps_rows_with_null_keys(spark):
    new = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (2, "d")], "k int, v string")
    old = spark.createDataFrame([(2,), (2,), (None,)], "k int")
    assert sorted(r.v for r in not_yet_loaded(new, old, ["k"]).collect()) == ["a", "b", "c"]


def scans(df, table):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return sum(1 for x in plan.splitlines() if "Relation [" in x and f"{table}" in x)


@pytest.mark.parametrize("name,most", [("supplement_sic", 2), ("supplement_all", 6), ("not_yet_loaded", 2)])
def test_each_side_is_scanned_once(spark, name, most):
    from entwise.plans import catalog
    df = catalog.queries()[name](spark, "/root/testdata/sf0.001")
    assert 0 < scans(df, "l_orderkey") <= most
