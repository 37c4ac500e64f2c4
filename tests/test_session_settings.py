"""The registered queries must not depend on the session time zone or on
ANSI mode: the driver runs them in a session of its own."""

import duckdb
import pytest

from entwise.plans import catalog, oracle
from tests.oracle_compare import TABLES, canon

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("conf", [{"spark.sql.session.timeZone": "America/Sao_Paulo"},
                                  {"spark.sql.ansi.enabled": "false"}])
def test_queries_independent_of_session_settings(spark, duck, conf):
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        bad = []
        for name, q in catalog.queries().items():
            df = q(spark, SF)
            res = duck.sql(oracle.oracle_sql()[name])

            def norm(cols, recs):
                order = sorted(range(len(cols)), key=lambda i: cols[i])
                return sorted(tuple(canon(r[i]) for i in order) for r in recs)
            if norm(df.columns, df.collect()) != norm(res.columns, res.fetchall()):
                bad.append(name)
        assert bad == []
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
