import math
import random

import duckdb
import pytest

from entwise.llm import decontaminate, licenses, queries, topk

from .conftest import TABLES, sha, with_clashes, words

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def hits(docs, bench):
    patterns, out = {}, {}
    for i, t in bench:
        w = words(WORD, t)
        m = min(13, len(w))
        for k in range(len(w) - m + 1 if m and i is not None else 0):
            patterns.setdefault(tuple(w[k:k + m]), set()).add(str(i))
    for d, t in docs:
        w = words(WORD, t)
        hit, items = [0] * len(w), set()
        for m in {len(p) for p in patterns}:
            for k in range(len(w) - m + 1):
                if owners := patterns.get(tuple(w[k:k + m])):
                    items |= owners
                    hit[k:k + m] = [1] * m
        n = sum(hit)
        out[d] = (len(w), n, len(items), sha(",".join(sorted(items))), n > 0 and 20 * n >= len(w))
    return out


def check_contamination(spark, docs, bench, **options):
    a = with_clashes(spark.createDataFrame(docs, "doc_id long, text string"))
    b = with_clashes(spark.createDataFrame(bench, "item_id long, text string"))
    got = {r.doc_id: tuple(r)[1:6] for r in decontaminate.contamination(a, b, **options).collect()}
    assert got == hits(docs, bench)
    return got


def test_contamination_equals_brute_force(spark, documents):
    docs = [(r.doc_id, r.text) for r in documents.collect()]
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{TABLES}/benchmark.parquet").collect()]
    got = check_contamination(spark, docs, bench)
    assert any(g[4] for g in got.values())
    check_contamination(spark, docs, bench, pass_bytes=2000)      # several passes
    rnd = random.Random(2)
    few = ["a", "b", "c", "dé", "E", "f1"]
    docs = [(i, " ".join(rnd.choices(few, k=rnd.randint(0, 60)))) for i in range(200)] + [(900, None), (901, ""), (902, "..")]
    bench = [(i, " ".join(rnd.choices(few, k=rnd.choice([1, 2, 3, 5, 8, 12, 13, 14, 20])))) for i in range(12)]
    check_contamination(spark, docs, bench + [(50, None), (51, ""), (52, "b"), (53, " a b a b")])
    check_contamination(spark, docs, [x for x in bench if len(x[1].split()) >= 8])
    check_contamination(spark, [], [])
    check_contamination(spark, docs, [])


def test_contamination_of_repeated_ids_in_one_or_several_passes(spark):
    passage = [" ".join(f"{c}{i}" for i in range(300)) for c in "pqr"]
    rows = [(1, passage[0]), (1, "clean words"), (1, passage[1]), (1, passage[1]), (2, passage[2]), (2, None), (None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(passage)], "item_id long, text string")
    one, many = (sorted(map(tuple, decontaminate.contamination(docs, bench, pass_bytes=n).collect())) for n in (1 << 20, 500))
    assert one == many and [(r[0], r[2], r[3]) for r in one] == [
        (1, 0, 0), (1, 300, 1), (1, 300, 1), (1, 300, 1), (2, 0, 0), (2, 300, 1)]


def test_shift_table_skips_only_impossible_places():
    p = decontaminate.build_patterns([("x", "a b c d e")], 5)[0]
    assert p.default == 4 and sorted(p.shift.tolist()) == [0, 1, 2, 3]


def products(rows, k, every):
    v = {i: [math.floor(64 * x) for x in e] for i, e in rows
         if e is not None and i is not None and all(x is not None and math.isfinite(x) for x in e)}
    out = []
    for q in v:
        if q % every == 0:
            best = sorted((-sum(a * b for a, b in zip(v[q], v[c])), c) for c in v if c != q)[:k]
            out += [(q, r + 1, c, -s) for r, (s, c) in enumerate(best)]
    return sorted(out)


def test_topk_equals_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{TABLES}/embeddings.parquet'")
    got = sorted(map(tuple, queries.QUERIES["op7_topk"](spark, TABLES).collect()))
    assert got == sorted(con.sql(queries.ORACLE["op7_topk"]).fetchall())


def test_topk_ties_blocks_and_bad_vectors(spark, monkeypatch):
    for name, value in (("BLOCK", 64), ("SLICE", 16), ("QUERY_BLOCK", 7)):
        monkeypatch.setattr(topk, name, value)
    rnd = random.Random(1)
    rows = [(i, [rnd.choice([0.0, .5, -1.0, 2.0]) for _ in range(5)]) for i in range(300)]
    rows += [(1000, None), (1020, []), (1040, [1.0, None, 2.0, 1.0, 1.0]), (1060, [float("nan")] * 5),
             (1080, [float("inf")] * 5), (1100, [1.0, 1.0]), (None, [1.0] * 5), (-20, [3.0] * 5)]
    df = with_clashes(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    assert sorted(map(tuple, topk.top_products(df, 20, 20).collect())) == products(rows, 20, 20)
    assert topk.top_products(df.limit(0)).count() == 0
    few = spark.createDataFrame(rows[:4], "vec_id long, embedding array<float>")
    assert topk.top_products(few, 20, 20).count() == 3


def notices(text):
    shingles = lambda w: [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    w, out = words(WORD, text), {}
    for name, template in licenses.TEMPLATES:
        t = words(WORD, template)
        m = 4
        while m < len(t):
            m = max(m + 1, m * 5 // 4)
        half = -(-m // 2)
        for k in range(0, max(1, len(w)), half):
            window = set(shingles(w[k:k + m + half]))
            share = len(set(shingles(t)) & window) / len(set(shingles(t)))
            if share >= licenses.CONTAINMENT and (-share, k) < out.get(name, (1, 0)):
                out[name] = (-share, k)
    return [(n, -c, k) for n, (c, k) in sorted(out.items())]


def test_licenses_equal_brute_force(spark, documents):
    assert licenses.collision_chance() > 1 - 1e-5
    rnd = random.Random(3)
    few = ["foo", "bar", "baz", "qux", "the", "license", "under", "is"]
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    for i in range(200):
        w = rnd.choice(licenses.TEMPLATES)[1].split()
        for _ in range(rnd.randint(0, max(1, len(w) // 12))):
            w[rnd.randrange(len(w))] = rnd.choice(few)
        rows.append((10_000 + i, " ".join(rnd.choices(few, k=rnd.randint(0, 60)) + w + rnd.choices(few, k=rnd.randint(0, 60)))))
    rows += [(90_001, None), (90_002, ""), (90_003, "..."), (90_004, "MIT License")]
    df = with_clashes(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r.doc_id: [tuple(x) for x in r.found] for r in licenses.scan_licenses(df).collect()}
    assert got == {i: notices(t) for i, t in rows}
    assert licenses.scan_licenses(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        licenses.Library([("short", "two words")])


def test_licenses_of_one_family_are_told_apart(spark):
    library = "you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software " \
        "Foundation, either version {} of the License, or (at your option) any later version."
    cases = [(t, {n}) for n, t in licenses.TEMPLATES]
    cases += [("This program is free software: " + library.format(f"{k}General Public License", v), {n}) for k, v, n in [
        ("", "2", "GPL-2.0"), ("", "3", "GPL-3.0"), ("Affero ", "3", "AGPL-3.0"), ("Lesser ", "2.1", "LGPL-2.1"),
        ("Lesser ", "3", "LGPL-3.0"), ("Library ", "2", "LGPL-2.0")]]
    cases += [("It is licensed under the GNU General Public License, version 2.", {"GPL-2.0"}),
              ("This program is free software: " + library.format("General Public License", "1"), set()),
              ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", {"CC-BY-SA-4.0"}),
              ("This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
               {"CC-BY-NC-ND-4.0"}),
              ("This work is licensed under a Creative Commons Attribution 3.0 Unported License.", set()),
              # notices of siblings side by side are all found
              (" ".join(t for n, t in licenses.TEMPLATES if "GPL" in n), {n for n, _ in licenses.TEMPLATES if "GPL" in n}),
              ("Licensed under CC BY 4.0. Licensed under CC BY-SA 4.0.", {"CC-BY-4.0", "CC-BY-SA-4.0"})]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id long, text string")
    got = {r.doc_id: {x.license for x in r.found} for r in licenses.scan_licenses(df, telling=licenses.TELLING).collect()}
    assert got == {i: want for i, (_, want) in enumerate(cases)}
