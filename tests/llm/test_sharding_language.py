import zlib
from collections import defaultdict

import pytest

from entwise.llm import language, queries, sharding

from .conftest import TABLES, with_clashes


def check_shards(spark, rows, n=24):
    df = with_clashes(spark.createDataFrame(rows, "doc_id long, text string"))
    got = sharding.shard_documents(df, n).collect()
    slots, groups = defaultdict(list), defaultdict(set)
    for r in got:
        slots[r.shard].append(r.slot)
    counts = [len(slots[s]) for s in range(n)]
    assert max(counts) - min(counts) <= 1 and sum(counts) == len(rows) and set(slots) <= set(range(n))
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    texts = dict(rows)
    if len(texts) == len(rows):
        for r in got:
            data = (texts[r.doc_id] or "").encode()
            assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 8, zlib.crc32(data), "rows", None)
            if texts[r.doc_id] is not None:
                groups[texts[r.doc_id]].add((r.shard, r.doc_id))
    return {t: ({s for s, _ in g}, len(g)) for t, g in groups.items() if len(g) > 1}


def test_shards(spark):
    # pairs and one group larger than a shard, among documents without neighbours
    rows = [(i, f"pair {i // 2}") for i in range(100)] + [(1000 + i, "many") for i in range(90)] \
        + [(5000 + i, f"alone {i}") for i in range(900)]
    groups = check_shards(spark, rows, 24)
    assert sum(len(s) > 1 for t, (s, _) in groups.items() if t != "many") <= 2
    assert len(groups["many"][0]) <= 4     # a shard holds 45
    check_shards(spark, [(i, "same") for i in range(50)], 7)
    check_shards(spark, [(1, None), (1, None), (None, "a"), (None, "a"), (3, ""), (4, "")], 3)
    check_shards(spark, [], 5)


@pytest.mark.parametrize("percent", [50, 80, 100])
def test_linked_rows_stay_together(spark, percent):
    linked = 24 * percent
    alone = [(10_000 + i, f"alone {i}") for i in range(2400 - linked)]
    # a shard holds 100 rows: with groups of 3 alone, one row of each is left over
    groups = check_shards(spark, [(i, f"three {i // 3}") for i in range(linked)] + alone)
    assert sum(len(s) > 1 for s, _ in groups.values()) <= (8 if percent == 100 else 0)
    # a third of all rows are one group
    groups = check_shards(spark, [(i, "many" if i < 800 else f"three {i // 3}") for i in range(linked)] + alone)
    assert len(groups.pop("many")[0]) == 8
    assert sum(len(s) > 1 for s, _ in groups.values()) <= (6 if percent == 100 else 0)


def test_a_group_of_a_third_over_many_shards(spark):
    groups = check_shards(spark, [(i, "many" if i < 800 else f"alone {i}") for i in range(2400)], 48)
    assert len(groups["many"][0]) == 16


def test_shards_of_the_whole_table(spark, documents):
    check_shards(spark, [(r.doc_id, r.text) for r in documents.collect()])


def test_language_on_held_out_documents(spark):
    sf = TABLES.replace("sf0.001", "sf0.01")
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.QUERIES["op10_language"](spark, sf).collect()
    assert {r.doc_id for r in got} == set(truth)
    held = [r for r in got if r.held_out]
    assert all((zlib.crc32(str(r.doc_id).encode()) % 4 == 2) == r.held_out and 0 <= r.score <= 1 for r in got)
    assert sum(truth[r.doc_id] == r.lang_pred for r in held) >= 0.98 * len(held)


def test_language_edge_cases(spark):
    rows = [(i, t, lang, s) for i, (t, lang, s) in enumerate([
        ("the cat and that hat", "en", "a"), ("der hund und die katze", "de", "b")] * 8)]
    rows += [(100, None, "en", "c"), (101, "", "en", None), (102, "123 !!", "de", "d"), (103, "und der", None, "e"),
             (104, "the that and", "xx" if False else None, "f")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(with_clashes(df), "true").collect()}
    assert got[100] == got[101] == got[102] == ("und", 0.0)
    assert got[103][0] == "de" and got[104][0] == "en"
    assert language.identify(df).columns == [*df.columns, "lang_pred", "score"]
    assert language.identify(df.limit(0)).count() == 0
    nothing = language.identify(df, "false").collect()
    assert {r.lang_pred for r in nothing} == {"und"}


def test_prediction_uses_the_text_alone(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the cat and that hat", "en"), ("der hund und die katze", "de")] * 8)]
    train = "doc_id < 16"
    asked = [(50, "das und der", "en"), (51, "das und der", "de"), (52, "das und der", None)]
    df = spark.createDataFrame(rows + asked, "doc_id long, text string, lang string")
    got = [(r.lang_pred, r.score) for r in language.identify(df, train).filter("doc_id >= 50").collect()]
    assert len(set(got)) == 1


@pytest.mark.parametrize("value", ["lang_pred", "score"])
def test_columns_of_the_same_name_are_replaced(spark, value):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(1, "the cat", "en")], "doc_id long, text string, lang string").withColumn(value, F.lit("old"))
    out = language.identify(df, "true")
    assert out.columns.count(value) == 1 and out.first()["lang_pred"] == "en"


def test_many_languages_and_ids_that_repeat_or_lack(spark, monkeypatch):
    words = {"en": "the cat and that hat", "de": "der hund und die katze", "fr": "le chat est sur la table"}
    rows = [(i % 3 if i % 4 else None, t, lang) for lang, t in words.items() for i in range(12)]
    rows += [(1, "der hund und the cat", "en"), (1, "ein hund und der", "de")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    first, again = (sorted(map(tuple, language.identify(d, "true").collect()), key=str) for d in (df, df.repartition(5)))
    assert first == again and sum(r[2] == r[3] for r in first) >= 36
    monkeypatch.setattr(language, "MOST_LANGUAGES", 2)     # the two with the most rows are learned
    more = df.unionAll(spark.createDataFrame([(9, "le chat est", "fr")], df.schema)).filter("lang <> 'en' OR text LIKE '%cat%'")
    assert {r.lang_pred for r in language.identify(more, "true").collect()} <= {"en", "de", "fr"}
    assert len({r.lang_pred for r in language.identify(more, "true").collect()}) == 2
    monkeypatch.undo()
    labels = spark.createDataFrame([(i, "the cat and that hat", f"l{i:03d}") for i in range(420)], df.schema)
    assert language.identify(labels, "true").count() == 420
