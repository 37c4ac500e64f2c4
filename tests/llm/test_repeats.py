import random

import numpy as np
import pytest

from entwise.llm import repeats

from .conftest import sha, with_clashes


def brute(rows, length):
    seen, out = {}, {}
    texts = [(i, (t or "").encode()) for i, t in rows]
    for _, b in texts:
        for s in range(len(b) - length + 1):
            seen[b[s:s + length]] = seen.get(b[s:s + length], 0) + 1
    for i, b in texts:
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - length + 1):
            if seen[b[s:s + length]] > 1:
                gone[s:s + length] = True
        runs = np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])) == 1
        out[i] = (len(b), int(gone.sum()), int(runs.sum()), sha(bytes(np.frombuffer(b, np.uint8)[~gone])))
    return out


def ours(df, length):
    return {r.doc_id: tuple(r)[1:5] for r in repeats.remove_repeats(df, length).collect()}


def test_leftmost_minima():
    rnd = np.random.default_rng(1)
    for n, width in ((1, 1), (5, 7), (40, 7), (41, 8), (64, 8)):
        h = rnd.integers(0, 6, n).astype(np.uint64)     # many ties
        want = [i + int(np.argmin(h[i:i + width])) for i in range(n - width + 1)]
        assert repeats._leftmost_minima(h, width).tolist() == want


@pytest.mark.parametrize("length", [400, 128])
def test_equals_brute_force(spark, length):
    rnd = random.Random(3)
    base = ["".join(rnd.choices("abcdef ", k=rnd.randint(300, 1200))) for _ in range(5)]
    rows = []
    for i in range(40):
        x, y = rnd.choice(base), rnd.choice(base)
        rows.append((i, x[:rnd.randint(0, len(x))] + rnd.choice(["", "xyzzy"]) + y[rnd.randint(0, len(y)):]))
    rows += [(100, "a" * 1000), (101, "ab" * 600), (102, None), (103, ""), (104, "a" * 400), (105, "x" * 399),
             (106, "x" * 399), (107, "é" * 250), (108, "b" + "é" * 230), (110, base[0][:400]), (111, base[0][1:401])]
    passage = "".join(rnd.choices("ghij ", k=420))        # one passage that many documents share
    rows += [(200 + i, f"{i} " * rnd.randint(0, 90) + passage + f" {i}" * rnd.randint(0, 90)) for i in range(40)]
    df = with_clashes(spark.createDataFrame(rows, "doc_id long, text string"))
    assert ours(df, length) == brute(rows, length)


def test_whole_table(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    want = brute(rows, 400)
    assert sum(w[1] for w in want.values()) > 0
    assert ours(documents, 400) == want


def test_edge_cases(spark):
    assert ours(spark.createDataFrame([], "doc_id long, text string"), 400) == {}
    x = "".join(random.Random(1).choices("abcdefgh ", k=900))
    df = spark.createDataFrame([(1, x), (1, x), (2, x[:450] + "Q" + x[450:]), (2, "short"), (None, x), (3, None)],
                               "doc_id long, text string")
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, [tuple(s) for s in r.spans]) for r in repeats.remove_repeats(df).collect())
    assert got == [(1, 900, 900, [(0, 900)]), (1, 900, 900, [(0, 900)]), (2, 5, 0, []),
                   (2, 901, 900, [(0, 450), (451, 901)]), (3, 0, 0, [])]


def test_spans_and_text_that_is_left(spark):
    passage = "".join(chr(0xC0 + i % 60) for i in range(90))      # two bytes a character
    rows = [(1, "abc " + passage + " xyz"), (2, passage), (3, "clean")]
    got = {r.doc_id: (r.text, [tuple(x) for x in r.spans]) for r in repeats.remove_repeats(
        spark.createDataFrame(rows, "doc_id long, text string"), 180).collect()}
    assert got == {1: ("abc  xyz", [(4, 184)]), 2: ("", [(0, 180)]), 3: ("clean", [])}


def test_strings_of_equal_structure_are_told_apart(spark):
    word = "a"
    while len(word) < 1024:
        word += word.translate(str.maketrans("ab", "ba"))
    rows = [(1, word), (2, word.translate(str.maketrans("ab", "ba")))]
    got = repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), 1024)
    assert [r.n_removed for r in got.collect()] == [0, 0]
