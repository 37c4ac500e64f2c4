import math
import random
from collections import Counter

import duckdb
import numpy as np

from entwise.llm import lexical, queries

from .conftest import TABLES, with_clashes, words

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def brute(docs, items, k):
    counts = [(d, Counter(words(TERM, t))) for d, t in docs if d is not None]
    counts = [(d, c) for d, c in counts if c]
    n_docs, length = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    asked = {}
    for i, t in items:
        if i is not None:
            asked.setdefault(i, Counter()).update(words(TERM, t))
    out = []
    for i, terms in asked.items():
        scored = []
        for d, c in counts:
            m = 100 - 75 + (75 * sum(c.values()) * n_docs) // length
            s = sum(r * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    * ((10 ** 9 * c[t]) // (1000 * c[t] + 8 * m)) for t, r in terms.items() if t in c)
            if s > 0:
                scored.append((-s, d))
        out += [(i, r + 1, d, -s) for r, (s, d) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def got(spark, docs, items, k=10, **options):
    a = with_clashes(spark.createDataFrame(docs, "doc_id long, text string"))
    b = with_clashes(spark.createDataFrame(items, "item_id string, text string"))
    out = lexical.rank_documents(a, b, k, **options)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, out.collect()))


def test_ranks_equal_brute_force(spark):
    rnd = random.Random(5)
    few = ["a", "B", "été", "x1", "Ǆ", "..", "c_d", "rare"]
    docs = [(i, " ".join(rnd.choices(few, k=rnd.randint(0, 25)))) for i in range(300)]
    docs += [(i + 1000, "same words here") for i in range(40)] + [(7, "a rare"), (7, "a rare"), (None, "rare"), (500, None), (501, "")]
    docs.append((600, "long " * 60_000 + "rare"))
    items = [(str(i), " ".join(rnd.choices(few, k=rnd.randint(1, 9)))) for i in range(12)]
    items += [("same", "same words"), ("twice", "a a a"), ("twice", "rare"), ("none", None), ("empty", ".."), (None, "a"),
              ("unknown", "nowhere"), ("long", "long")]
    want = brute(docs, items, 10)
    assert [r[2] for r in want if r[0] == "same"] == list(range(1000, 1010))
    assert got(spark, docs, items) == want
    assert got(spark, docs, items, pass_bytes=30) == want
    assert got(spark, docs, items, k=3) == brute(docs, items, 3)


def test_empty_tables(spark):
    assert got(spark, [], [("1", "a")]) == got(spark, [(1, "a")], []) == got(spark, [(1, None)], [("1", "a")]) == []


def test_small_tiles_give_the_same_rows(spark, monkeypatch):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    items = spark.read.parquet(f"{TABLES}/benchmark.parquet")
    monkeypatch.setattr(lexical, "ITEM_TILE", 7)
    monkeypatch.setattr(lexical, "DOC_TILE", 16)
    monkeypatch.setattr(lexical, "TILE_CELLS", 64)
    out = sorted(map(tuple, lexical.rank_documents(docs, items).collect()))
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{TABLES}/{name}.parquet'")
    assert out == sorted(con.sql(queries.ORACLE["op11_ranked_search"]).fetchall())


def test_products_beyond_two_to_the_53_are_exact():
    rng = np.random.default_rng(1)
    weights = rng.integers(0, 40_000, (6, 50))
    weights[0, 3] = 10 ** 12 + 7      # times a million, more than one tile may hold
    weights[1, 4] = 9_007_199_253
    impacts = rng.integers(0, 1_000_001, (9, 50))
    impacts[2, 3] = impacts[2, 4] = 1_000_000
    exact = [[sum(int(a) * int(b) for a, b in zip(w, x)) for x in impacts] for w in weights]
    assert lexical.multiply(weights, impacts).tolist() == exact and max(map(max, exact)) > 1 << 53
    for column, nth, parts in lexical.column_tiles(weights.max(axis=0), 1000):
        assert (-(-weights.max(axis=0)[column] // parts)).sum() * 10 ** 6 < 1 << 53
