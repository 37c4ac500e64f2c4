"""Token ids of whole texts with a public tokenizer file, word by word.

Byte-pair encoding never merges across a pre-token, and a pre-token never spans
the place between a non-space and a space, so a text may be encoded word by
word, each with the white space before it, and a word needs encoding once. Each
worker keeps a table from the hash of a word to its bytes and ids, and looks up,
compares and lays out all words of a batch of texts with array operations; only
words it hasn't seen go to the tokenizer. Texts with white space other than
blank, tab and line ends, or with the marker of special tokens, are given to the
tokenizer whole, and those with runs of white space piece by piece, so the ids
always equal those of the whole text. Words of one hash are told apart by their
bytes.
"""

from __future__ import annotations

import os
import re
import struct

import numpy as np
import pyarrow as pa

from entwise.llm.common import SpanHashes, held, mix64, slices, string_buffers, word_spans

_OTHER_SPACE = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200d\u2028\u2029\u202f\u205f\u2060\u3000\ufeff]")
_ASCII_SPACE = re.compile("[\x0b\x0c\x1c-\x1f]")
_RUNS = ("  ", "\n\n", " \n", "\n ", "\t", "\r")
_PIECES = re.compile(r"[ \t\r\n]*[^ \t\r\n]+|[ \t\r\n]+$")

_LETTERS = re.compile("[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+")
_ENDED = re.compile(f"({_LETTERS.pattern})([!-/:-@[-`{{-~]+)")

#: Pieces held in each of the two generations of the cache for parts of words.
CACHE_PIECES = 50_000
#: Slots of a worker's word table, and ids it holds at most.
SLOTS = 1 << 20
TABLE_IDS = 2 << 20
SLICE_BYTES = 1 << 18

# 1: blank and line end, 2: other white space of one byte, 3: may begin a longer one or a marker
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x0A]] = 1
_KIND[[0x09, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F]] = 2
_KIND[[0x3C, 0xC2, 0xE1, 0xE2, 0xE3, 0xEF]] = 3
_PUNCTUATION, _LETTER = np.zeros(256, bool), np.zeros(256, bool)
for _c in range(0x21, 0x7F):
    _PUNCTUATION[_c], _LETTER[_c] = not chr(_c).isalnum(), chr(_c).isalpha()
_SPLIT = np.ones(256, bool)
_SPLIT[[0x20, 0x0A, 0x09, 0x0D]] = False


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class _Cache(dict):
    """piece -> ids as little-endian 32-bit bytes. The younger generation takes
    new pieces; when full it becomes the older one, whose pieces move up on use."""

    def __init__(self, encode):
        super().__init__()
        self.encode, self.old = encode, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = self.encode(piece)
        if len(self) >= CACHE_PIECES:
            self.old = dict(self)
            self.clear()
        self[piece] = ids
        return ids


class Encoder:
    """Token ids of whole texts. ``by_words``: the tokenizer drops white space and
    case; otherwise a leading blank belongs to its word. ``plain``: the names of
    special tokens inside a text are ordinary text; otherwise they are those
    tokens, as the library has it unless told not to."""

    def __init__(self, path: str, by_words: bool, plain: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        tok = Tokenizer.from_file(path)
        tok.encode_special_tokens = plain
        alphabet = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.tok, self.model, self.by_words = tok, tok.model, by_words
        # the byte alphabet's characters for those of Latin-1, for str.translate
        self.bytes_of = {i: alphabet.pre_tokenize_str(chr(i))[0][0] for i in (*range(0x20, 0x7F), *range(0xA0, 0x100))}
        self.exact = _Cache(self.piece)
        # keyed by the word without its leading blank; a leading line end stays
        self.led = _Cache(self.led_piece)
        self.words = _Words()

    def whole(self, text: str) -> bytes:
        return _packed(self.tok.encode(text, add_special_tokens=False).ids)

    def letters(self, word: str) -> bytes:
        """A word of Latin-1 letters, with or without a leading blank, is one
        pre-token: the model gets it as the normalizer and the byte alphabet
        would write it."""
        if self.by_words:
            word = word.lower()
        return _packed([t.id for t in self.model.tokenize(word.translate(self.bytes_of))])

    def piece(self, piece: str) -> bytes:
        if _LETTERS.fullmatch(piece):
            return self.letters(piece)
        if m := _ENDED.fullmatch(piece):  # punctuation after letters is a pre-token of its own
            return self.exact[m[1]] + self.exact[m[2]]
        return self.whole(piece)

    def led_piece(self, word: str) -> bytes:
        if word[0] == "\n":
            return self.exact["\n"] + self.exact[word[1:]]
        if _LETTERS.fullmatch(word):
            return self.letters(" " + word)
        if m := _ENDED.fullmatch(word):
            return self.led[m[1]] + self.exact[m[2]]
        return self.whole(" " + word)

    def batch(self, col: pa.Array) -> list[np.ndarray]:
        """The ids of each text of a column; a null text has none."""
        raw, off = string_buffers(col)
        out: list[np.ndarray] = []
        for i, j in slices(off, SLICE_BYTES):
            out += self._slice(raw[off[i]:off[j]], off[i:j + 1] - off[i])
        return out

    def _odd(self, raw: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Per text, whether it needs the careful way."""
        kind = _KIND[raw]
        bad = [np.flatnonzero(kind == 2)]
        if self.by_words:
            bad[0] = bad[0][(raw[bad[0]] != 0x09) & (raw[bad[0]] != 0x0D)]
        at = np.flatnonzero(kind == 3)
        next_ = np.append(raw, [0, 0]).astype(np.int32)
        a, b, c = next_[at], next_[at + 1], next_[at + 2]
        bad.append(at[((a == 0x3C) & (b == 0x7C)) | ((a == 0xC2) & ((b == 0x85) | (b == 0xA0)))
                      | ((a == 0xE1) & ((b == 0x9A) | (b == 0xA0)))
                      | ((a == 0xE2) & ((b == 0x81) | ((b == 0x80) & ((c <= 0x8D) | ((c >= 0xA8) & (c <= 0xAF))))))
                      | ((a == 0xE3) & (b == 0x80)) | ((a == 0xEF) & (b == 0xBB))])
        if not self.by_words:  # runs of white space, and white space at the end
            space = kind == 1
            bad.append(np.flatnonzero(space[1:] & space[:-1]))
            last = off[1:][np.diff(off) > 0] - 1
            bad.append(last[space[last]])
        odd = np.zeros(len(off) - 1, bool)
        odd[np.searchsorted(off, np.concatenate(bad), side="right") - 1] = True
        return odd

    def _slice(self, raw: np.ndarray, off: np.ndarray) -> list[np.ndarray]:
        odd = self._odd(raw, off)
        start, end, first = word_spans(raw, off, _SPLIT)
        lead = np.zeros(len(start), np.uint8)  # 0: the text begins with the word, or white space doesn't count
        if not self.by_words:
            inner = start > np.repeat(off[:-1], np.diff(first))
            lead[inner] = raw[start[inner] - 1]
        start, end, lead, first = _without_ends(raw, start, end, lead, first)
        h = SpanHashes(raw).of(start, end)
        h = mix64(h + lead.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
        if self.words.full():
            self.words = _Words()
        words = self.words
        skip = np.repeat(odd, np.diff(first))
        slot = words.find(h, raw, start, end, lead)
        unknown = np.flatnonzero((slot < 0) & ~skip)
        extra: dict[tuple[bytes, int], bytes] = {}
        if len(unknown):
            new, where = np.unique(h[unknown], return_index=True)
            where = unknown[where]
            text = raw.tobytes()
            ids = [self.word(text[a:b], before) for a, b, before in
                   zip(start[where].tolist(), end[where].tolist(), lead[where].tolist())]
            words.add(new, ids, raw, start[where], end[where], lead[where])
            slot[unknown] = words.find(h[unknown], raw, start[unknown], end[unknown], lead[unknown])
            unknown = unknown[slot[unknown] < 0]  # those that found no slot, or one of another word
            named = [(text[a:b], before) for a, b, before in
                     zip(start[unknown].tolist(), end[unknown].tolist(), lead[unknown].tolist())]
            extra = {x: self.word(*x) for x in set(named)}
        slot[skip] = 0
        at, n = words.at[slot].astype(np.int64), words.n[slot].astype(np.int64)
        n[skip] = 0
        pool = words.ids
        if len(unknown):
            more = [np.frombuffer(extra[x], "<u4") for x in named]
            n[unknown] = [len(x) for x in more]
            at[unknown] = words.used + np.cumsum(n[unknown]) - n[unknown]
            pool = np.concatenate([pool[:words.used], *more])
        ends = np.cumsum(n)
        flat = pool[np.repeat(at - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)]
        cut = np.concatenate([[0], ends])[first]
        out = [flat[a:b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]
        for d in np.flatnonzero(odd).tolist():
            out[d] = np.frombuffer(self.ids(raw[off[d]:off[d + 1]].tobytes().decode()), "<u4")
        return out

    def word(self, word: bytes, lead: int) -> bytes:
        """Ids of a word and of the blank or line end before it, if that counts."""
        if not lead:
            return self.piece(word.decode())
        return self.led_piece(word.decode() if lead == 0x20 else "\n" + word.decode())

    def ids(self, text: str | None) -> bytes:
        """The ids of one text as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if "<|" in text or (_ASCII_SPACE if text.isascii() else _OTHER_SPACE).search(text):
            return self.whole(text)
        if self.by_words:
            return b"".join(map(self.exact.__getitem__, text.split()))
        if any(run in text for run in _RUNS) or text[0] in " \n" or text[-1] in " \n":
            return b"".join(map(self.exact.__getitem__, _PIECES.findall(text)))
        first, *rest = text.replace("\n", " \n").split(" ")
        return self.exact[first] + b"".join(map(self.led.__getitem__, rest))


def _without_ends(raw, start, end, lead, first):
    """Words cut before the punctuation that ends them, if a letter stands there:
    it is a pre-token of its own, and words without it repeat more often."""
    if not len(start):
        return start, end, lead, first
    place = np.where(_PUNCTUATION[raw], -1, np.arange(len(raw)))
    last = np.maximum.accumulate(place)[end - 1]
    byte = raw[last]
    letter = _LETTER[byte] | ((byte >= 0x80) & (byte <= 0xBF) & (byte != 0x97) & (byte != 0xB7) & (raw[last - 1] == 0xC3))
    two = (last >= start) & (last < end - 1) & letter
    copies = 1 + two.astype(np.int64)
    at = np.cumsum(copies) - copies
    tail = at[two] + 1
    cut = last[two] + 1
    start, end, lead = (np.repeat(x, copies) for x in (start, end, lead))
    end[tail - 1], start[tail], lead[tail] = cut, cut, 0
    return start, end, lead, np.append(at, len(start))[first]


class _Words:
    """Word hash -> the word's bytes and ids. A word may stand in either of two
    slots; one that finds both taken isn't kept. The table is emptied when it is
    full, so its size is fixed."""

    def __init__(self) -> None:
        self.key = np.zeros(SLOTS, np.uint64)
        self.at, self.n = np.zeros(SLOTS, np.int32), np.zeros(SLOTS, np.int32)
        self.word_at, self.word_n = np.zeros(SLOTS, np.int32), np.zeros(SLOTS, np.int32)
        self.lead = np.zeros(SLOTS, np.uint8)
        self.ids, self.bytes = np.zeros(1 << 16, np.uint32), np.zeros(1 << 16, np.uint8)
        self.used = self.written = self.held = 0

    def slots(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mask = np.uint64(SLOTS - 1)
        return (h & mask).astype(np.int64), ((h >> np.uint64(32)) & mask).astype(np.int64)

    def find(self, h: np.ndarray, raw: np.ndarray, start: np.ndarray, end: np.ndarray, lead: np.ndarray) -> np.ndarray:
        """The slot of each word, or -1."""
        one, two = self.slots(h)
        slot = np.where(self.key[one] == h, one, -1)
        rest = np.flatnonzero(slot < 0)
        slot[rest] = np.where(self.key[two[rest]] == h[rest], two[rest], -1)
        slot[(self.word_n[slot] != end - start) | (self.lead[slot] != lead)] = -1
        known = np.flatnonzero(slot >= 0)
        n = (end - start)[known]
        before = np.cumsum(n) - n
        step = np.arange(n.sum()) - np.repeat(before, n)
        same = self.bytes[np.repeat(self.word_at[slot[known]], n) + step] == raw[np.repeat(start[known], n) + step]
        wrong = np.flatnonzero(~same)
        slot[known[np.searchsorted(before, wrong, side="right") - 1]] = -1
        return slot

    @staticmethod
    def _grown(pool: np.ndarray, size: int) -> np.ndarray:
        while size > len(pool):
            pool = np.concatenate([pool, np.zeros(len(pool), pool.dtype)])
        return pool

    def add(self, h: np.ndarray, ids: list[bytes], raw: np.ndarray, start: np.ndarray, end: np.ndarray,
            lead: np.ndarray) -> None:
        """Add new words; ``h`` holds each hash once."""
        flat = np.frombuffer(b"".join(ids), "<u4")
        n = np.array([len(x) // 4 for x in ids], np.int32)
        size = end - start
        before = np.cumsum(size) - size
        letters = raw[np.repeat(start - before, size) + np.arange(size.sum())]
        self.ids, self.bytes = self._grown(self.ids, self.used + len(flat)), self._grown(self.bytes, self.written + len(letters))
        self.ids[self.used:self.used + len(flat)] = flat
        self.bytes[self.written:self.written + len(letters)] = letters
        at = self.used + np.cumsum(n) - n
        left = np.arange(len(h))
        for slots in self.slots(h):
            free = left[self.key[slots[left]] == 0]
            _, one = np.unique(slots[free], return_index=True)  # of several for a slot, the first
            put = free[one]
            slot = slots[put]
            self.key[slot], self.at[slot], self.n[slot] = h[put], at[put], n[put]
            self.word_at[slot], self.word_n[slot], self.lead[slot] = self.written + before[put], size[put], lead[put]
            left = np.setdiff1d(left, put, assume_unique=True)
        self.used += len(flat)
        self.written += len(letters)
        self.held += len(h)

    def full(self) -> bool:
        return self.used > TABLE_IDS or self.written > 4 * TABLE_IDS or self.held > SLOTS // 2


def encoder(path: str, by_words: bool, plain: bool = False) -> Encoder:
    """The encoder, with its table, that this worker process holds."""
    return held((path, by_words, plain), lambda: Encoder(path, by_words, plain))
