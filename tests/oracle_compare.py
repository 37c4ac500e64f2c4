"""Run registered queries in Spark and their oracle SQL in DuckDB, compare.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
Prints one line per query: rows, column names and an order-insensitive match.
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

sys.path.insert(0, ".")

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def canon(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{v:.9g}"
    if hasattr(v, "is_integer") and not isinstance(v, bool):  # Decimal
        try:
            return f"{float(v):.9g}"
        except Exception:
            return str(v)
    if isinstance(v, bool):
        return str(v).lower()
    return str(v)


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(canon(r[i]) for i in order) for r in records)


def compare(spark, con, sf_dir, name, q, sql):
    t0 = time.time()
    df = q(spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    res = con.sql(sql)
    dcols, drows = res.columns, res.fetchall()
    t2 = time.time()
    scols = df.columns
    ok_cols = sorted(scols) == sorted(dcols)
    ok_n = len(srows) == len(drows)
    ok_v = ok_cols and rows_of(scols, srows) == rows_of(dcols, drows)
    spark_t = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    duck_t = dict(zip(dcols, [str(t) for t in res.types]))
    same = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
            "boolean": "BOOLEAN", "float": "FLOAT", "date": "DATE"}
    tdiff = {c: (spark_t[c], duck_t.get(c)) for c in spark_t
             if same.get(spark_t[c], spark_t[c]) != duck_t.get(c)}
    if tdiff:
        print(f"   TYPES {name}: {tdiff}")
    status = "OK" if (ok_cols and ok_n and ok_v) else "MISMATCH"
    print(f"{status:8s} {name:26s} spark={len(srows):6d} duck={len(drows):6d} "
          f"cols={'ok' if ok_cols else (sorted(scols), sorted(dcols))} vals={'ok' if ok_v else 'DIFF'} "
          f"t_spark={t1 - t0:.1f}s t_duck={t2 - t1:.1f}s", flush=True)
    if not ok_v and ok_cols:
        a, b = rows_of(scols, srows), rows_of(dcols, drows)
        sa, sb = set(a), set(b)
        print("   only spark:", sorted(sa - sb)[:3])
        print("   only duck :", sorted(sb - sa)[:3])
    return status == "OK"


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    from entwise.session import local_session
    import __spark_entry__ as E
    spark = local_session(8, 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    qs, sqls = E.queries(), E.oracle_sql()
    bad = []
    for name in (names or list(qs)):
        if name not in sqls:
            print(f"NO-ORACLE {name}")
            continue
        try:
            if not compare(spark, con, sf_dir, name, qs[name], sqls[name]):
                bad.append(name)
        except Exception as e:  # report and continue
            print(f"ERROR    {name}: {type(e).__name__}: {str(e)[:600]}")
            bad.append(name)
    print("FAILED:", bad)


if __name__ == "__main__":
    main()
