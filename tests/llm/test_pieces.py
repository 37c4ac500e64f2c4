import random
import struct

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from entwise.llm import pieces, queries
from entwise.llm.common import string_buffers

from .conftest import TABLES, sha, with_clashes

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = list("ab \n\té▁☃𐍈<s>x0١़'") + ["  ", "<0x41>", "</s>", "\x00", "日本", "ﬁ", " ", "​", "the", " and"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def odd_texts(n, seed=1):
    rnd = random.Random(seed)
    return ["".join(rnd.choices(ODD, k=rnd.randint(0, 40))) for _ in range(n)] + [
        "", " ", "▁", "x" * 5000, "é" * 3000, " " * 999, "\n" * 50, "a\n" * 40_000]


def test_query_equals_the_library(spark, documents, library):
    got = {r.doc_id: r for r in queries.QUERIES["op12_sentencepiece"](spark, TABLES).collect()}
    rows = documents.collect()
    assert len(got) == len(rows)
    for r in rows:
        ids = library.encode(r.text or "", add_bos=True, add_eos=True)
        g = got[r.doc_id]
        assert (g.n_tokens, g.ids_sha256) == (len(ids), sha(struct.pack(f"<{len(ids)}I", *ids)))
        assert g.decoded_sha256 == sha(library.decode(ids)) and g.n_bytes == g.n_covered == len((r.text or "").encode())


def test_ids_spans_and_texts_of_odd_texts(spark, library):
    texts = odd_texts(400)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(None, "a"), (3, None), (3, "b"), (3, "b")],
                                 "doc_id long, text string")
    out = pieces.encode_documents(with_clashes(docs), MODEL, bos=True, eos=True)
    found = out.collect()
    assert len(found) == len(texts) + 4
    for r in [r for r in found if r.doc_id is not None and r.doc_id != 3]:
        t = texts[r.doc_id]
        want = library.encode(t, return_type="proto")
        assert list(r.ids) == [1, *[p.id for p in want.pieces], 2]
        spans = [(p.begin, p.end) for p in want.pieces]
        assert list(zip(r.begins, r.ends))[1:-1] == spans
        raw = t.encode()
        assert b"".join(raw[a:b] for a, b in zip(r.begins, r.ends)) == raw
    back = {r.doc_id: r.text for r in pieces.decode_documents(out, MODEL).filter("doc_id <> 3").collect()}
    assert back == {i: library.decode(library.encode(t)) for i, t in enumerate(texts) if i != 3}
    assert sorted(len(r.ids) for r in found if r.doc_id == 3)[0] == 2
    assert pieces.encode_documents(docs.limit(0), MODEL).count() == 0


def test_decoding_any_ids(spark, library):
    rnd = random.Random(4)
    lists = [[rnd.choice([rnd.randrange(300), rnd.randrange(32000), 259, 28705]) for _ in range(rnd.randint(0, 12))]
             for _ in range(3000)]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(lists)] + [(9999, None)], "doc_id long, ids array<int>")
    got = {r.doc_id: r.text for r in pieces.decode_documents(rows, MODEL).collect()}
    assert got == {i: library.decode(x) for i, x in enumerate(lists)} | {9999: ""}
    with pytest.raises(Exception, match="vocabulary"):
        pieces.decode_documents(spark.createDataFrame([(1, [40_000])], "doc_id long, ids array<int>"), MODEL).collect()


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nfkc_cf"])
def test_normaliser_and_its_alignment_equal_the_library(rule):
    """The given model's map is empty, so the library's own maps are tried."""
    chars = ["ﬁ", "Ⅳ", "　", "é", "é", "e", "́", "̧", " ", "  ", "A", "ß", "\x01", "´", "½",
             "ｶﾞ", "가", "ᄀ", "ᅡ", "​", "▁", "x", "日", "㍿", "힣", "\n"]
    rnd = random.Random(rule)
    texts = ["".join(rnd.choices(chars, k=rnd.randint(0, 12))) for _ in range(2000)]
    raw, off = string_buffers(pa.array(texts, pa.string()))
    c = pieces.Codec(MODEL)
    for prefix in (True, False):
        for squeeze in (True, False):
            lib = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=prefix,
                                                        remove_extra_whitespaces=squeeze, escape_whitespaces=True)
            c.map = pieces.CharsMap(dict(pieces.fields(dict(pieces.fields(lib.serialized_model_proto()))[3]))[pieces.CHARSMAP])
            c.prefix, c.squeeze = prefix, squeeze
            out, cut, src = c.normalize(raw, off)
            for k, t in enumerate(texts):
                text = out[cut[k]:cut[k + 1]].tobytes().decode()
                place = np.cumsum([0] + [len(x.encode()) for x in t]).tolist()
                starts = np.cumsum([0] + [len(x.encode()) for x in text])
                sources = [place.index(x) for x in src[cut[k] + k:cut[k + 1] + k + 1][starts].tolist()]
                assert (text, sources) == lib.normalize(t, with_offsets=True)


def test_other_models_are_refused(tmp_path):
    with open(MODEL, "rb") as f:
        model = f.read()
    (tmp_path / "unigram.model").write_bytes(model + bytes([pieces.TRAINER << 3 | 2, 2, pieces.MODEL_TYPE << 3, 1]))
    with pytest.raises(ValueError, match="byte fallback"):
        pieces.Codec(str(tmp_path / "unigram.model"))
