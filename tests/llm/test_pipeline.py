import re

import pyarrow as pa

import corpus_pipeline
from entwise.llm import common, decontaminate, packing, secrets

from .conftest import TABLES, words
from .test_near_dedup import brute as components
from .test_search import hits
from .test_secrets import base

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{TABLES}/benchmark.parquet").collect()]
    odd = spark.createDataFrame([(9000, "12 34", "en", "x", 5), (9001, None, "en", "x", None), (9002, "", "en", "x", 0),
                                 (9003, 'of the token = "0123456789abcdef0123" and that is', "en", "x", 49)], docs.schema)
    docs, before = docs.unionAll(odd), None
    for name, stage in corpus_pipeline.STAGES:
        rows = {r.doc_id: r for r in docs.collect()}
        out = stage(spark, docs, TABLES)
        out.write.parquet(f"{tmp_path}/{name}")
        out = spark.read.parquet(f"{tmp_path}/{name}")
        if name == "packing":
            assert sum(r.length for r in out.collect()) > len(rows) and max(r.offset for r in out.collect()) < packing.CAPACITY
            assert {r.doc_id for r in out.collect()} == set(rows)
            continue
        assert out.columns == COLUMNS
        kept = {r.doc_id: r for r in out.collect()}
        texts = [(i, r.text) for i, r in rows.items()]
        if name == "language":
            assert set(kept) == {i for i, t in texts if t and re.search(r"[^\W\d_]", t)}
        elif name == "near_dedup":
            assert set(kept) == {i for i, (_, _, k) in components(texts, 5, 80).items() if k}
        elif name == "decontaminate":
            assert set(kept) == {i for i, h in hits(texts, bench).items() if not h[4]} != set(rows)
        elif name == "secrets":
            assert set(kept) == set(rows)
            found = {i for i, t in texts if base(t)[1]}
            assert found and all(not base(kept[i].text)[1] and "[SECRET]" in kept[i].text for i in found)
            assert all(kept[i].n_chars == len(kept[i].text) for i in kept)
            assert all(kept[i].text == rows[i].text for i in rows if i not in found and "[SECRET]" not in kept[i].text)
        docs, before = out, name
    assert before == "secrets" and secrets.KINDS and words(r"\w+", "A b") == ["a", "b"]


def test_run_over_the_table_and_an_empty_one(spark, tmp_path):
    got = corpus_pipeline.run(spark, TABLES)
    assert got.count() > 0
    for t in ("documents", "benchmark"):
        spark.read.parquet(f"{TABLES}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/none/{t}.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def test_stages_decide_by_row(spark, tmp_path):
    text, other = (" ".join(f"{w}{i}" for i in range(60)) for w in ("one", "two"))
    rows = [(5, text), (5, text), (6, other), (1, "quite another text of its own"), (1, other), (None, other),
            (None, "clean words without an id"), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "x", None) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([("b", other)], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    key = lambda x: [(i is None, i or 0, t is None, t or "") for i, t in x]
    after = {name: sorted(key((r.doc_id, r.text) for r in stage(spark, docs, str(tmp_path)).collect()))
             for name, stage in corpus_pipeline.STAGES[1:3]}
    assert after["near_dedup"] == sorted(key([rows[0], rows[3], rows[4], rows[6], rows[7]]))
    assert after["decontaminate"] == sorted(key([rows[0], rows[1], rows[3], rows[6], rows[7]]))
    packed = corpus_pipeline.pack(spark, docs, str(tmp_path))
    assert packed.columns == corpus_pipeline.pack(spark, docs.filter("doc_id IS NOT NULL"), str(tmp_path)).columns
    assert packed.filter("doc_id IS NULL AND start = 0").count() == 3 and packed.filter("start = 0").count() == len(rows)


def test_an_unlabelled_corpus_is_kept_and_null_labels_are_filled(spark):
    rows = [(i, t, lang, "x", 1) for i, (t, lang) in enumerate(
        [("the cat and that hat", "en"), ("der hund und die katze", "de")] * 8 + [("der die und", None), ("12 34", "en"), (None, "en")])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id: r.lang for r in corpus_pipeline.language_id(spark, docs, "").collect()}
    assert set(kept) == set(range(17)) and kept[16] == "de"
    bare = docs.selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang", "source", "n_chars")
    kept = {r.doc_id: r.lang for r in corpus_pipeline.language_id(spark, bare, "").collect()}
    assert kept == dict.fromkeys(range(17))


def test_columns_with_the_names_of_helpers_stay(spark, tmp_path):
    rows = [(1, "some words of a text", "en", "x", 5, "a"), (1, "some words of a text", "en", "x", 5, "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, _row string")
    spark.createDataFrame([("b", "other")], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert [r["_row"] for r in corpus_pipeline.near_dedup_stage(spark, docs, "").collect()] in (["a"], ["b"])
    assert sorted(r["_row"] for r in corpus_pipeline.decontaminate_stage(spark, docs, str(tmp_path)).collect()) == ["a", "b"]


def test_a_task_of_the_pipeline_needs_one_python_worker(spark):
    """Two Python operators in a stage take two workers for each task, and Python rows
    of the driver others beside them; they stay and hold memory in later stages."""
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    plan = decontaminate.contamination(docs, spark.read.parquet(f"{TABLES}/benchmark.parquet"))._jdf.queryExecution()
    assert plan.executedPlan().toString().count("MapInArrow") == 1
    rows = common.local_rows(spark, {"a": pa.int32(), "b": pa.string()}, [(1, "x"), (2, None)])
    assert rows.dtypes == [("a", "int"), ("b", "string")] and [tuple(r) for r in rows.collect()] == [(1, "x"), (2, None)]
    assert "ExistingRDD" not in rows._jdf.queryExecution().executedPlan().toString()
    assert common.local_rows(spark, {"a": pa.int64()}, []).count() == 0
