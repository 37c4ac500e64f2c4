import duckdb
import pytest

import __spark_entry__ as E
from entwise import schemas as S
from entwise.plans import catalog, oracle
from tests.oracle_compare import TABLES, canon

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == S.SUPPLEMENT_LAYOUT


def test_every_query_has_oracle():
    assert set(catalog.queries()) == set(oracle.oracle_sql())
    assert set(catalog.queries()) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    res = duck.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(res.columns)

    def norm(cols, recs):
        order = sorted(range(len(cols)), key=lambda i: cols[i])
        return sorted(tuple(canon(r[i]) for i in order) for r in recs)
    assert norm(df.columns, df.collect()) == norm(res.columns, res.fetchall())


def test_sf_dir_with_trailing_slash(spark):
    q = E.queries()["supplement_sic"]
    assert q(spark, SF + "/").count() == q(spark, SF).count() > 0
