import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from entwise.llm import alignment, queries

from .conftest import TABLES, sha, with_clashes

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def sides():
    tok = Tokenizer.from_file(A)
    tok.encode_special_tokens = True
    return tok, sentencepiece.SentencePieceProcessor(model_file=B)


def tokens(sides, text):
    """[(id, bytes)] of both sides, or none."""
    tok, sp = sides
    if not text:
        return [], []
    alphabet = alignment.byte_alphabet()
    a = [(i, bytes(alphabet[c] for c in tok.id_to_token(i))) for i in tok.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in sp.encode(text):
        p = sp.id_to_piece(i)
        b.append((i, bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    return (a, b) if b"".join(x for _, x in a) == whole == b"".join(x for _, x in b) else ([], [])


def groups(side_a, side_b):
    ends = []
    for side in (side_a, side_b):
        at, out = 0, []
        for i, t in side:
            at += len(t)
            out.append((at, i))
        ends.append(out)
    shared = sorted({e for e, _ in ends[0]} & {e for e, _ in ends[1]})
    out, low = [], 0
    for cut in shared:
        out.append(tuple([i for e, i in side if low < e <= cut] for side in ends))
        low = cut
    return out


def brute(sides, texts):
    cut = [groups(*tokens(sides, t)) for t in texts]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for g in cut]
    held = Counter(p for c in links for p in c)
    best = defaultdict(int)
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    return [(sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(c.values()),
             sum(n for p, n in c.items() if held[p] == best[p[0]]), sum(n * held[p] for p, n in c.items()),
             sha(";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)) if g else "")
            for g, c in zip(cut, links)]


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_query_equals_brute_force(spark, documents, sides):
    rows = documents.collect()
    got = queries.QUERIES["op13_alignment"](spark, TABLES)
    assert got.columns == COLUMNS
    want = brute(sides, [r.text for r in rows])
    assert sorted(map(tuple, got.collect())) == sorted((r.doc_id, *w) for r, w in zip(rows, want))


def test_odd_texts_in_many_chunks(spark, sides, monkeypatch):
    rnd = random.Random(3)
    some = list("ab \n\té☃𐍈<s>x0'") + ["▁", "  ", "<|endoftext|>", "</s>", "日本", "​", "the", " and", "\x00", "don't"]
    texts = ["".join(rnd.choices(some, k=rnd.randint(0, 20))) for _ in range(300)]
    texts += [None, "", " ", "▁", "same text", "same text", "same text", "☃" * 300, "a" * 4000, "-" * 3000, "\n" * 500]
    rows = [(i if i % 7 else None, t) for i, t in enumerate(texts)]
    want = sorted(((d is None, d or 0, *w) for (d, _), w in zip(rows, brute(sides, texts))))
    docs = with_clashes(spark.createDataFrame(rows, "doc_id long, text string"))
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(key(tuple(r)) for r in alignment.align(docs, A, B).collect()) == want
    monkeypatch.setattr(alignment, "SLICE_BYTES", 300)
    monkeypatch.setattr(alignment, "LARGE", 1)
    assert sorted(key(tuple(r)) for r in alignment.align(docs, A, B, chunk_bytes=500).collect()) == want


def test_empty_tables_and_texts_without_tokens(spark):
    schema = "doc_id long, text string"
    assert alignment.align(spark.createDataFrame([], schema), A, B).collect() == []
    out = alignment.align(spark.createDataFrame([(1, None), (2, ""), (2, "▁")], schema), A, B).collect()
    assert sorted(map(tuple, out)) == [(1, *[0] * 6, ""), (2, *[0] * 6, ""), (2, *[0] * 6, "")]
