import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from entwise.llm import packing, token_files
from entwise.llm import tokens as T
from entwise.llm.common import Work

from .conftest import with_clashes

FILES = [("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)]
PARTS = ["a", "B", "'s", " ", " ", "  ", "\n", "\t", ".", "1", "é", "́", " ", "\x1c", "ß", "日", "Σ", "!", "word",
         "the", " the", "<|endoftext|>", "<|", "’", " ", "　", "​", "\x85", "\U0001F600", "İ", "ﬁ"]


def library(name, plain=False):
    tok = Tokenizer.from_file(public_tokenizers.path(name))
    if plain:
        tok.encode_special_tokens = True
    return lambda texts: [e.ids for e in tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.mark.parametrize("name,by_words", FILES)
@pytest.mark.parametrize("slots,plain", [(1 << 22, False), (1 << 6, True)])
def test_encoder_equals_the_library(monkeypatch, documents, name, by_words, slots, plain):
    monkeypatch.setattr(T, "SLOTS", slots)
    rnd = random.Random(7)
    texts = ["".join(rnd.choices(PARTS, k=rnd.randint(0, 14))) for _ in range(4000)] + [None, ""]
    texts += [r.text for r in documents.collect()]
    got = T.Encoder(public_tokenizers.path(name), by_words, plain).batch(pa.array(texts))
    assert [g.tolist() for g in got] == library(name, plain)(texts)


def thue_morse(n):
    word = "a"
    while len(word) < n:
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("name,by_words", FILES)
def test_words_of_one_hash_are_told_apart(name, by_words):
    a, b = thue_morse(2048)
    texts = [f"{a} {b}", f"{b} {a} {b}", a, b, "one <|endoftext|> two <|startoftext|>"]
    encoder = T.Encoder(public_tokenizers.path(name), by_words)
    for _ in range(2):
        assert [g.tolist() for g in encoder.batch(pa.array(texts))] == library(name)(texts)


def test_token_files_round_trip(spark, documents, tmp_path):
    extra = spark.createDataFrame([(100_001, None), (100_002, ""), (100_003, "x" * 5000), (None, "gone"),
                                   (100_004, "twice"), (100_004, "twice"),
                                   (100_005, "one <|endoftext|> two")], "doc_id long, text string")
    docs = documents.select("doc_id", "text").unionAll(extra)
    out = f"{tmp_path}/tokens"
    path = public_tokenizers.path("byte_bpe_50k.json")
    token_files.write_token_files(with_clashes(docs), out, path, end_id=0, partitions=3)
    got = sorted((r.doc_id, r.start, r.n_tokens, bytes(r.ids)) for r in token_files.read_token_files(spark, out).collect())
    rows = sorted(((r.doc_id, r.text) for r in docs.collect() if r.doc_id is not None), key=lambda x: x[0])
    start = 0
    for (doc, text), ids, g in zip(rows, library("byte_bpe_50k.json")([t for _, t in rows]), got, strict=True):
        want = np.array([*ids, 0], "<u4").tobytes()
        assert g == (doc, start, len(ids) + 1, want)
        start += len(ids) + 1
    one = token_files.read_token_files(spark, out, doc_id=7).collect()
    assert len(one) == 1 and bytes(one[0].ids) == got[7][3]
    assert spark.read.parquet(f"{out}/dictionary").count() == 1


def test_empty_token_files(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id long, text string")
    token_files.write_token_files(empty, f"{tmp_path}/none", public_tokenizers.path("byte_bpe_50k.json"), 0)
    assert token_files.read_token_files(spark, f"{tmp_path}/none").count() == 0


def check_packed(spark, rows, share=None):
    path = public_tokenizers.path("word_bpe_49k.json")
    df = with_clashes(spark.createDataFrame(rows, "doc_id long, text string"))
    got = packing.pack(df, path, 2, keep_ids=True).collect()
    rows = [r for r in rows if r[0] is not None]
    want = sorted((d, len(ids) + 1) for (d, _), ids in zip(rows, library("word_bpe_49k.json")([t for _, t in rows])))
    sequences = {}
    for r in got:
        assert 0 < r.length <= packing.CAPACITY and len(r.ids) == 4 * r.length and zlib.crc32(bytes(r.ids)) == r.ids_crc32
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():      # gapless, within the capacity
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    assert sum(r.length for r in got) == sum(n for _, n in want)
    if len({d for d, _ in rows}) == len(rows):
        per = {}
        for r in got:
            per.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, r.length, bytes(r.ids)))
        assert sorted(per) == want
        for (doc, n), parts in per.items():   # pieces of a document follow each other
            at = 0
            for start, length, _ in sorted(parts):
                assert start == at
                at += length
            assert at == n
    filled = [sum(x for _, x in p) for p in sequences.values()]
    padding = sum(packing.CAPACITY - x for x in filled if x & (x - 1))
    if share is not None:
        assert padding <= share * (padding + sum(filled))
    return got


def test_packing_whole_table(spark, documents):
    check_packed(spark, [(r.doc_id, r.text) for r in documents.collect()], 0.01)


def test_packing_edge_cases(spark):
    assert check_packed(spark, []) == []
    check_packed(spark, [(1, None), (2, ""), (3, "a b c"), (None, "gone")])
    check_packed(spark, [(i, "one two three") for i in range(3000)], 0.06)     # one length holds all rows
    check_packed(spark, [(5, "a " * 4095), (6, "a " * 4096), (7, "a " * 9000)])
    check_packed(spark, [(i % 30, f"text {i % 30} " * (i % 30)) for i in range(60)] + [(7, "other")])


def test_plan_is_close_to_the_bound():
    rnd = np.random.default_rng(0)
    rest = (rnd.lognormal(6.5, 1.2, 100_000)).astype(int) % packing.CAPACITY
    lengths = {int(n): int(c) for n, c in zip(*np.unique(rest[rest > 0], return_counts=True))}
    intervals, sequences = packing.plan(lengths)
    dealt = sum(high - low for _, low, high, *_ in intervals)
    assert dealt > 0.97 * sum(lengths.values())
    assert sequences * packing.CAPACITY < 1.01 * sum(n * c for n, c in lengths.items())


def test_knapsack_finds_the_best():
    size, price = np.array([3, 5, 7]), np.array([3.0, 5.5, 8.0])
    best, pattern = packing.knapsack(price, size, 17)
    brute = max(3.0 * a + 5.5 * b + 8 * c for a in range(6) for b in range(4) for c in range(3) if 3 * a + 5 * b + 7 * c <= 17)
    assert best == brute == float(price @ pattern) and size @ pattern <= 17


def test_work_needs_a_shared_folder_on_a_cluster(spark):
    assert Work(spark, "x").path.startswith(spark.conf.get("spark.checkpoint.dir"))
