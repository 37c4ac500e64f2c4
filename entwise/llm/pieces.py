"""SentencePiece encoding and decoding with the place of every piece in its text.

The model file gives the pieces, the normaliser's settings and its compiled
character map: a double-array trie of byte strings, each with what replaces it.
Texts are normalised here, all characters of a slice at once: every character
walks the trie as far as it leads, the longest rule wins, and the replacements
are laid out with, for each normalised byte, the byte of the text it comes from.
Blanks are collapsed (if the model asks so), the leading blank is added and
blanks become U+2581, all with their places.

A piece never covers two neighbouring bytes that no piece of the vocabulary
holds side by side, so a normalised text falls into independent strings at such
places (before a word, around a line end). Arrow's dictionary encoding, which
compares bytes, leaves each distinct string of a slice once; the library's
merges, with the normaliser switched off, cut those into pieces, and cumulative
piece lengths give every piece's normalised bytes, which the alignment turns
into a byte span of the text as it was.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entwise.llm.common import held, prepare, slices, string_buffers

SLICE_BYTES = 1 << 20
SPACE = "▁".encode()  # what stands for a blank in pieces
REPLACEMENT = "�".encode()

# Field numbers and piece types of the model file format.
PIECE, TRAINER, NORMALIZER = 1, 2, 3
PIECE_TEXT, PIECE_TYPE = 1, 3
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
MODEL_TYPE, SUFFIX_BLANKS, BYTE_FALLBACK, UNK_SURFACE = 3, 24, 35, 44
CHARSMAP, DUMMY_PREFIX, REMOVE_EXTRA, ESCAPE = 2, 3, 4, 5
BPE = 2


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        value |= (data[at] & 127) << shift
        at, shift = at + 1, shift + 7
        if data[at - 1] < 128:
            return value, at


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a message in the model file."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        if key & 7 == 0:
            value, at = _varint(data, at)
        else:
            if key & 7 == 2:
                n, at = _varint(data, at)
            else:
                n = 8 if key & 7 == 1 else 4
            value, at = data[at:at + n], at + n
        yield key >> 3, value


def ragged(pool: np.ndarray, start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The stretches of ``pool`` from ``start``, ``n`` long each, end to end."""
    end = np.cumsum(n)
    return pool[np.repeat(start - (end - n), n) + np.arange(end[-1] if len(end) else 0)]


class CharsMap:
    """Longest-prefix replacement by a compiled character map."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little")
        self.units = np.frombuffer(blob[4:4 + size], "<u4")
        self.texts = np.frombuffer(blob[4 + size:], np.uint8)
        self.ends = np.flatnonzero(self.texts == 0)  # a replacement ends at a zero byte
        self.root = int(self._offset(self.units[:1])[0])

    @staticmethod
    def _offset(units: np.ndarray) -> np.ndarray:
        return (units >> np.uint32(10)) << ((units & np.uint32(1 << 9)) >> np.uint32(6))

    def longest(self, raw: np.ndarray, at: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each place the length of the longest rule that begins there and
        ends before ``stop`` (0: none), and the place of its replacement."""
        n, value = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        live, node, step = np.arange(len(at)), np.full(len(at), self.root, np.int64), 0
        while len(live):
            byte = raw[at[live] + step]
            node = node ^ byte
            unit = self.units[np.minimum(node, len(self.units) - 1)]
            ok = (node < len(self.units)) & ((unit & np.uint32(0x800000FF)) == byte)
            live, unit = live[ok], unit[ok]
            node, step = node[ok] ^ self._offset(unit).astype(np.int64), step + 1
            leaf = ((unit >> np.uint32(8)) & np.uint32(1)) == 1
            n[live[leaf]] = step
            value[live[leaf]] = self.units[node[leaf]] & np.uint32(0x7FFFFFFF)
            on = at[live] + step < stop[live]
            live, node = live[on], node[on]
        return n, value

    def replace(self, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, ...]:
        """Chunks of all texts, each a rule or one character: (place, bytes taken,
        bytes given, the bytes given end to end)."""
        at = np.flatnonzero((raw & 0xC0) != 0x80)
        taken = np.diff(np.append(at, len(raw)))
        stop = off[np.searchsorted(off, at, side="right")]
        n, value = self.longest(raw, at, stop)
        kept = np.ones(len(at), bool)
        free = 0  # rules over several characters: the leftmost goes first
        for i in np.flatnonzero(n > taken).tolist():
            if at[i] >= free:
                free = int(at[i] + n[i])
                kept[i + 1:np.searchsorted(at, free)] = False
        at, taken, n, value = at[kept], taken[kept], n[kept], value[kept]
        ruled = n > 0
        given = np.where(ruled, self.ends[np.searchsorted(self.ends, value)] - value, taken)
        start = np.where(ruled, value + len(raw), at)
        return at, np.where(ruled, n, taken), given, ragged(np.concatenate([raw, self.texts]), start, given)


class Encoded:
    """Pieces of several texts: ``ids``, ``cut`` (the first piece of each text),
    ``begin`` and ``end`` (bytes of the text that each piece stands for), and
    the normalised bytes with their offsets."""

    def __init__(self, ids, cut, begin, end, data, data_off, ends):
        self.ids, self.cut, self.begin, self.end = ids, cut, begin, end
        self.data, self.data_off, self.ends = data, data_off, ends


class Codec:
    """Encoder and decoder of one model file.

    Models of the merging kind with byte fallback, whose blanks stand before a
    word and which have no user-defined pieces; others raise ValueError.
    """

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        with open(path, "rb") as f:
            model = f.read()
        # The file format's defaults
        trainer, rules = {MODEL_TYPE: 1, SUFFIX_BLANKS: 0, BYTE_FALLBACK: 0, UNK_SURFACE: " ⁇ ".encode()}, {
            CHARSMAP: b"", DUMMY_PREFIX: 1, REMOVE_EXTRA: 1, ESCAPE: 1}
        text, kind = [], []
        for number, value in fields(model):
            if number == PIECE:
                piece = dict(fields(value))
                text.append(piece[PIECE_TEXT])
                kind.append(piece.get(PIECE_TYPE, NORMAL))
            elif number == TRAINER:
                trainer |= dict(fields(value))
            elif number == NORMALIZER:
                rules |= dict(fields(value))
        self.kind = np.array(kind)
        if trainer[MODEL_TYPE] != BPE or not trainer[BYTE_FALLBACK] or trainer[SUFFIX_BLANKS] or (self.kind == USER_DEFINED).any():
            raise ValueError("a merging model with byte fallback and leading blanks, without user-defined pieces, is needed")
        self.map = CharsMap(rules[CHARSMAP]) if rules[CHARSMAP] else None
        self.prefix, self.squeeze, self.escape = (bool(rules[x]) for x in (DUMMY_PREFIX, REMOVE_EXTRA, ESCAPE))
        # the same model, whose normaliser leaves texts as they are: a last normaliser message overrides settings
        own = b"".join(bytes([x << 3, 0]) for x in (DUMMY_PREFIX, REMOVE_EXTRA, ESCAPE))
        own = bytes([CHARSMAP << 3 | 2, 0]) + own
        self.merges = SentencePieceProcessor(model_proto=model + bytes([NORMALIZER << 3 | 2, len(own)]) + own)
        self.bos, self.eos = self.merges.bos_id(), self.merges.eos_id()
        self.beside = np.zeros(1 << 16, bool)  # byte pairs that some piece holds
        for t, k in zip(text, kind):
            if k in (NORMAL, UNUSED):
                b = np.frombuffer(t, np.uint8)
                self.beside[b[:-1].astype(np.uint16) << 8 | b[1:]] = True
        self.size = np.array([1 if k == BYTE else len(t) for t, k in zip(text, kind)], np.int64)
        shown = [b"" if k == CONTROL else trainer[UNK_SURFACE] if k == UNKNOWN else bytes([int(t[3:5], 16)]) if k == BYTE
                 else t.replace(SPACE, b" ") for t, k in zip(text, kind)]
        self.led = np.array([t.startswith(SPACE) and k in (NORMAL, UNUSED) for t, k in zip(text, kind)])
        self.shown = np.frombuffer(b"".join(shown), np.uint8)
        self.shown_n = np.array([len(x) for x in shown], np.int64)
        self.shown_at = np.cumsum(self.shown_n) - self.shown_n
        self.high = np.array([k == BYTE and x[0] >= 0x80 for x, k in zip(shown, kind)])

    # --- normalising ---------------------------------------------------------

    def normalize(self, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bytes, offsets, sources): the normalised texts, and for each of their
        bytes, with one more at the end of each text, the byte of the text it
        comes from, counted in the text."""
        n_texts = len(off) - 1
        if self.map is None:
            at = np.flatnonzero((raw & 0xC0) != 0x80)
            taken = given = np.diff(np.append(at, len(raw)))
            data = raw
        else:
            at, taken, given, data = self.map.replace(raw, off)
        owner = np.repeat(np.arange(n_texts), np.diff(np.searchsorted(at, off)))  # the text of each chunk
        doc = np.repeat(owner, given)
        src = np.repeat(at - off[owner], given)
        final = np.diff(off)  # where a text's last byte ends
        lead = np.zeros(n_texts, np.int64)  # where the added blank stands
        some = np.diff(off) > 0
        if self.squeeze:
            blank = data == 0x20
            before = np.concatenate([[True], blank[:-1]])
            before[np.concatenate([[True], doc[1:] != doc[:-1]])[:len(before)]] = True
            first_byte = np.cumsum(given) - given
            bare = (given == 1) & (np.append(data, 0)[first_byte] == 0x20)  # chunks that are one blank
            rest = np.flatnonzero(~bare)
            first = rest[np.unique(owner[rest], return_index=True)[1]]
            some = np.zeros(n_texts, bool)
            some[owner[first]] = True
            lead[owner[first]] = at[first] - off[owner[first]]
            # at the end, written U+2581 counts as a blank
            white = blank.copy()
            mark = np.flatnonzero((data[:-2] == SPACE[0]) & (data[1:-1] == SPACE[1]) & (data[2:] == SPACE[2])) if len(data) > 2 else []
            for k in range(3):
                white[np.asarray(mark, np.int64) + k] = True
            black = np.full(n_texts, -1, np.int64)
            solid = np.flatnonzero(~white)
            black[doc[solid]] = solid  # the last of each text
            inner = np.arange(len(data)) <= black[doc]
            keep = ~(blank & before) & inner
            tail = np.flatnonzero(~(blank & before) & ~inner)
            where, i = np.unique(doc[tail], return_index=True)
            cut_at = final.copy()
            cut_at[where] = src[tail[i]]
            # a text may hold nothing but blanks, or characters that are replaced by nothing
            final = np.where((black >= 0) | (some & (not self.prefix)), cut_at, lead)
            some &= black >= 0
            data, src, doc = data[keep], src[keep], doc[keep]
        white = data == 0x20
        mark = np.frombuffer(SPACE if self.escape else b" ", np.uint8)
        width = np.where(white, len(mark), 1)
        add = np.where(some & self.prefix, len(mark), 0)
        n = np.bincount(doc, weights=width, minlength=n_texts).astype(np.int64) + add if n_texts else np.zeros(0, np.int64)
        out_off = np.concatenate([[0], np.cumsum(n)])
        place = np.cumsum(width) - width + np.cumsum(add)[doc] if len(doc) else np.zeros(0, np.int64)
        out, sources = np.zeros(out_off[-1], np.uint8), np.zeros(out_off[-1] + n_texts, np.int64)
        out[place[~white]] = data[~white]
        sources[place + doc] = src
        for k in range(len(mark)):
            out[place[white] + k] = mark[k]
            sources[place[white] + doc[white] + k] = src[white]
            out[out_off[:-1][add > 0] + k] = mark[k]
            sources[(out_off[:-1] + np.arange(n_texts))[add > 0] + k] = lead[add > 0]
        sources[out_off[1:] + np.arange(n_texts)] = final
        return out, out_off, sources

    # --- encoding ------------------------------------------------------------

    def encode(self, raw: np.ndarray, off: np.ndarray) -> Encoded:
        """The pieces of each text, without begin and end ids."""
        data, data_off, sources = self.normalize(raw, off)
        cut = (data & 0xC0) != 0x80
        cut[1:] &= ~self.beside.take(data[:-1].astype(np.uint16) << 8 | data[1:])
        cut[data_off[:-1][np.diff(data_off) > 0]] = True
        start = np.flatnonzero(cut)
        strings = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [
            None, pa.py_buffer(np.append(start, len(data)).astype(np.int64)), pa.py_buffer(data)])
        coded = strings.dictionary_encode()
        found = self.merges.encode([x.decode() for x in coded.dictionary.to_pylist()], num_threads=1) if len(start) else []
        n = np.array([len(x) for x in found], np.int64)
        flat = np.fromiter(chain.from_iterable(found), np.int32, int(n.sum()))
        which = coded.indices.to_numpy()
        ids = ragged(flat, (np.cumsum(n) - n)[which], n[which])
        ends = np.cumsum(self.size[ids])
        pieces = np.concatenate([[0], np.cumsum(n[which])])[np.searchsorted(start, data_off)]
        if len(ids) and (ends[-1] != len(data) or (ends[pieces[1:][np.diff(pieces) > 0] - 1] != data_off[1:][np.diff(pieces) > 0]).any()):
            raise ValueError("pieces do not cover the normalised text")
        owner = np.repeat(np.arange(len(off) - 1), np.diff(pieces))
        return Encoded(ids, pieces, sources[ends - self.size[ids] + owner], sources[ends + owner], data, data_off, ends)

    # --- decoding ------------------------------------------------------------

    def decode(self, ids: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, offsets) of the texts of several lists of ids: control pieces
        vanish, the leading blank goes, bytes that are no UTF-8 become U+FFFD."""
        n, at = self.shown_n[ids], self.shown_at[ids].copy()
        if self.prefix or self.squeeze:
            visible = np.flatnonzero(n > 0)
            first = np.searchsorted(visible, cut[:-1])
            has = np.append(visible, -1)[first]
            first = has[(has >= cut[:-1]) & (has < cut[1:])]
            first = first[self.led[ids[first]]]
            at[first] += 1
            n[first] -= 1
            if self.squeeze:  # as long as nothing is written, each piece loses its blank
                for i in first[n[first] == 0].tolist():
                    stop, i = int(cut[np.searchsorted(cut, i, side="right")]), i + 1
                    while i < stop and (n[i] == 0 or self.led[ids[i]]):
                        if n[i]:
                            at[i] += 1
                            n[i] -= 1
                            if n[i]:
                                break
                        i += 1
        data = ragged(self.shown, at, n)
        ends = np.concatenate([[0], np.cumsum(n)])
        off = ends[cut]
        odd = np.unique(np.searchsorted(cut, np.flatnonzero(self.high[ids]), side="right") - 1)
        mended = {}
        for d in odd.tolist():
            text = data[off[d]:off[d + 1]].tobytes()
            try:
                text.decode()
            except UnicodeDecodeError:
                mended[d] = self._mend(ids[cut[d]:cut[d + 1]], np.diff(ends[cut[d]:cut[d + 1] + 1]), text)
        if mended:
            texts = [mended.get(d) or data[a:b].tobytes() for d, (a, b) in enumerate(zip(off, off[1:]))]
            data, off = np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in texts])])
        return data, off

    def _mend(self, ids: np.ndarray, n: np.ndarray, text: bytes) -> bytes:
        """One text, where each byte of a run of byte pieces that belongs to no
        character is replaced."""
        out, at, i = [], 0, 0
        while i < len(ids):
            j = i
            while j < len(ids) and self.kind[ids[j]] == BYTE:
                j += 1
            run = text[at:at + j - i]
            while run:
                size = 1 if run[0] < 0x80 else 2 if run[0] < 0xE0 else 3 if run[0] < 0xF0 else 4
                try:
                    run[:size].decode()
                except UnicodeDecodeError:
                    out.append(REPLACEMENT)
                    run = run[1:]
                else:
                    out.append(run[:size])
                    run = run[size:]
            at += j - i
            if j < len(ids):
                out.append(text[at:at + int(n[j])])
                at += int(n[j])
                j += 1
            i = j
        return b"".join(out)

    def framed(self, e: Encoded, off: np.ndarray, bos: bool, eos: bool) -> Encoded:
        """With begin and end ids, which stand for no bytes."""
        n, texts = np.diff(e.cut), len(e.cut) - 1
        cut = np.concatenate([[0], np.cumsum(n + bos + eos)])
        place = np.arange(len(e.ids)) + np.repeat(cut[:-1] + bos - e.cut[:-1], n)
        ids, begin, end = np.zeros(cut[-1], np.int32), np.zeros(cut[-1], np.int64), np.zeros(cut[-1], np.int64)
        ids[place], begin[place], end[place] = e.ids, e.begin, e.end
        if bos:
            ids[cut[:-1]] = self.bos
        if eos and texts:
            ids[cut[1:] - 1] = self.eos
            begin[cut[1:] - 1] = end[cut[1:] - 1] = np.diff(off)
        return Encoded(ids, cut, begin, end, e.data, e.data_off, e.ends)


def codec(path: str) -> Codec:
    """The codec that this worker process holds."""
    return held(("pieces", path), lambda: Codec(path))


def _lists(cut: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(values, kind))


def _texts(docs: DataFrame) -> DataFrame:
    prepare(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def encode_documents(docs: DataFrame, path: str, bos: bool = False, eos: bool = False) -> DataFrame:
    """doc_id, ids, begins, ends for every row of ``docs`` (doc_id, text): the
    piece ids of the whole text, and for each the bytes of the UTF-8 text that it
    stands for, from ``begins`` to before ``ends`` (nothing for begin and end ids,
    for an added blank, and for all but the last of the bytes of one character).

    A null text counts as empty and has no pieces but the begin and end ids. Rows
    stand for themselves: repeated or null doc_ids stay as they are. Extra columns
    are ignored; an empty table gives no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for batch in batches:
            raw, off = string_buffers(batch.column(1))
            for i, j in slices(off, SLICE_BYTES):
                part = off[i:j + 1] - off[i]
                e = c.framed(c.encode(raw[off[i]:off[j]], part), part, bos, eos)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), _lists(e.cut, e.ids, pa.int32()),
                     _lists(e.cut, e.begin, pa.int64()), _lists(e.cut, e.end, pa.int64())], ["doc_id", "ids", "begins", "ends"])
    return _texts(docs).mapInArrow(run, "doc_id long, ids array<int>, begins array<long>, ends array<long>")


def decode_documents(rows: DataFrame, path: str) -> DataFrame:
    """doc_id, text for every row of ``rows`` (doc_id, ids): the text of a list of
    ids as the library decodes it. A null list counts as empty, null ids in it as
    nothing; ids outside the vocabulary raise."""
    prepare(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for batch in batches:
            lists = batch.column(1)
            flat = lists.flatten()
            n = np.array([len(x) if x is not None else 0 for x in lists.to_pylist()], np.int64)
            if len(flat) and (flat.to_numpy(zero_copy_only=False).min() < 0 or flat.to_numpy(zero_copy_only=False).max() >= len(c.kind)):
                raise ValueError("an id is not in the vocabulary")
            data, off = c.decode(flat.to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(n)]))
            text = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(n), [
                None, pa.py_buffer(off.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
            yield pa.RecordBatch.from_arrays([batch.column(0), text.cast(pa.large_string()).cast(pa.string())], ["doc_id", "text"])
    ids = F.filter(F.col("ids").cast("array<int>"), lambda x: x.isNotNull())
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), ids.alias("ids")).mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, n_bytes, n_covered for every
    row of ``docs`` (doc_id, text): the digests of its ids with begin and end ids
    (as little-endian unsigned 32-bit integers) and of their decoded text, the
    bytes of the text and those that the spans of its pieces cover. Nulls, empty
    texts and repeated rows as for ``encode_documents``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for batch in batches:
            raw, off = string_buffers(batch.column(1))
            for i, j in slices(off, SLICE_BYTES):
                part = off[i:j + 1] - off[i]
                e = c.framed(c.encode(raw[off[i]:off[j]], part), part, True, True)
                text, at = c.decode(e.ids, e.cut)
                ids, text = e.ids.astype("<u4").tobytes(), text.tobytes()
                sha = [hashlib.sha256(ids[4 * a:4 * b]).hexdigest() for a, b in zip(e.cut.tolist(), e.cut[1:].tolist())]
                back = [hashlib.sha256(text[a:b]).hexdigest() for a, b in zip(at.tolist(), at[1:].tolist())]
                covered = np.concatenate([[0], np.cumsum(e.end - e.begin)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(np.diff(e.cut)), pa.array(sha, pa.string()),
                     pa.array(back, pa.string()), pa.array(np.diff(part)), pa.array(np.diff(covered[e.cut]))],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_bytes", "n_covered"])
    return _texts(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, "
                                        "n_bytes long, n_covered long")
