import random
import re

from entwise.llm import secrets

from .conftest import sha, with_clashes

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS, HEX = re.compile("AKIA[A-Z0-9]+"), re.compile("[0-9a-f]+")


def base(text):
    t = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(t) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(t) if len(m[0]) >= 24]
    said = [f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(found)]
    return (*[sum(x[1] == k for x in found) for k in range(3)], sha(",".join(said))), said


def check(spark, rows):
    df = with_clashes(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r.doc_id: r for r in secrets.report(df).collect()}
    for i, t in rows:
        want, said = base(t)
        assert tuple(got[i])[1:5] == want
        assert set(said) <= set(got[i].spans.split(","))
    return got


def test_base_spans_equal_brute_force(spark, documents):
    check(spark, [(r.doc_id, r.text) for r in documents.collect()])
    rnd = random.Random(4)
    parts = ["token", "PassWord", "secret", "api_key", "apikey", "=", ":", " ", "  ", '"', "'", "abc", "abcdef", "x1.y=",
             "AKIA", "ABCDEFGH01234567", "Z9", "é", "\U0001F600", "\n", "0123456789abcdef", "deadbeef", ".", "-", "ſecret=abcdefg"]
    rows = [(i, "".join(rnd.choices(parts, k=rnd.randint(0, 30)))) for i in range(1500)]
    check(spark, rows + [(9000, None), (9001, ""), (9002, "a" * 30000 + " token=abcdefg " * 300)])


def test_entropy_spans_and_allow_list(spark):
    key = "wJalrXUtnFEMI/K7MDENG/bPxRfiCYzzq8"
    rows = [(1, f"key {key} end"), (2, "internationalizationally aaaaaaaaaaaaaaaaaaaa1"), (3, f"{key}EXAMPLE"),
            (4, "123e4567-e89b-12d3-a456-426614174000"), (5, "0123 9F86D081884C7D659A2F zz")]
    got = check(spark, rows)
    kind, a, b = got[1].spans.split(":")
    assert kind == "entropy_base64" and rows[0][1][int(a):int(b)] in key and int(b) - int(a) >= secrets.WINDOW
    assert got[2].spans == got[3].spans == got[4].spans == ""
    assert got[5].spans.startswith("entropy_hex:5:")


def test_incremental_entropy_equals_plain(spark):
    from math import log2

    from pyspark.sql import functions as F
    rnd = random.Random(2)
    alphabet = secrets.CLASSES["entropy_hex"][1]
    values = ["".join(rnd.choices(alphabet[:rnd.choice([2, 6, 16])], k=rnd.randint(1, 60))) for _ in range(60)]

    def plain(v):
        hot = []
        for i in range(len(v) - secrets.WINDOW + 1):
            w = v[i:i + secrets.WINDOW]
            if -sum(w.count(c) / len(w) * log2(w.count(c) / len(w)) for c in set(w)) >= 2.7:
                hot.append(i)
        return (hot[0], hot[-1]) if hot else (-1, -1)
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = df.select("v", secrets._hot_run(F.col("v"), alphabet, 2.7).alias("r")).collect()
    assert {r.v: tuple(r.r) for r in got} == {v: plain(v) for v in values}


def test_redact(spark):
    rows = [(1, 'a token = "abcdef123456" b'), (2, "token=0123456789abcdef01234567"), (3, None), (4, "clean"), (5, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in secrets.redact(df).collect()}
    assert got == {1: 'a [SECRET]" b', 2: "[SECRET]", 3: None, 4: "clean", 5: ""}
    assert secrets.report(df.limit(0)).count() == 0


def test_columns_with_names_of_our_own_and_rows_that_repeat(spark):
    text = 'of the token = "0123456789abcdef0123" and that is'
    rows = [(1, text, "b", "s", "a", "h"), (1, text, "b", "s", "a", "h"), (None, text, "x", "y", "z", "w"), (2, None, "b", "s", "a", "h")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, base string, secrets string, _added string, _entropy_hex string")
    out = secrets.redact(docs)
    assert out.columns == docs.columns
    assert sorted(((r.doc_id, r.base, r.secrets, r["_added"], r["_entropy_hex"], r.text and "[SECRET]" in r.text)
                   for r in out.collect()), key=str) == sorted(
        [(1, "b", "s", "a", "h", True)] * 2 + [(None, "x", "y", "z", "w", True), (2, "b", "s", "a", "h", None)], key=str)
    found = secrets.find_secrets(docs)
    assert found.columns == ["doc_id", "text", "_added", "_entropy_hex", "base", "secrets"]
    assert [(r.n_assign, r.n_hex) for r in secrets.report(docs).filter("doc_id = 1").collect()] == [(1, 0)] * 2
    assert secrets.report(docs).filter("doc_id IS NULL").count() == 1
