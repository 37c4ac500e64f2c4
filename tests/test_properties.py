"""Property tests: the spread join equals the plain join for any data and salt factor."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from entwise.operators.skew import spread_join

keys = st.one_of(st.none(), st.sampled_from(["a", "b", "c", "d"]))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(left=st.lists(st.tuples(keys, st.integers(0, 5)), min_size=0, max_size=40),
       right_keys=st.sets(st.sampled_from(["a", "b", "c", "e"])),
       salts=st.integers(1, 10),
       how=st.sampled_from(["inner", "left", "left_semi", "left_anti"]))
def test_spread_equals_plain(spark, left, right_keys, salts, how):
    ldf = spark.createDataFrame(left, "k string, v int")
    rdf = spark.createDataFrame([(k, k.upper()) for k in sorted(right_keys)], "k string, r string")
    if how in ("left_semi", "left_anti"):
        rdf = rdf.select("k")
    plain = ldf.join(rdf, "k", how)
    salted = spread_join(ldf, rdf, ["k"], how, salts)
    assert sorted(map(tuple, salted.select(*plain.columns).collect()), key=repr) == \
        sorted(map(tuple, plain.collect()), key=repr)
