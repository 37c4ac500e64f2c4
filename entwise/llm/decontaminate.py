"""Benchmark passages in documents by Wu-Manber multi-pattern search over words.

Patterns are the windows of ``WINDOW`` consecutive words of each benchmark item;
an item with fewer words is one pattern. Patterns of one length are searched
together. With blocks of two words (one for one-word patterns) and patterns of
m words, the shift table gives for a block its distance from the end of the
nearest pattern that holds it; a block in no pattern shifts by m - 1 words, so
the scan looks at one block in m - 1 and skips the rest. Where the shift is 0,
the suffix-hash bucket of the block names the patterns that may end there, and
their words are compared one by one, then the bytes themselves.

The scan runs on arrays: all cursors of a slice of documents move together.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entwise.llm.common import LOWER, SpanHashes, Work, by_row, mix64, prepare, release, slices, string_buffers, word_spans

WINDOW = 13
#: Benchmark text that one pass holds in each worker; a larger benchmark is
#: searched in as many passes as it takes.
PASS_BYTES = 1 << 20
SLICE_BYTES = 1 << 18

IS_WORD = np.zeros(256, bool)
IS_WORD[0x30:0x3A] = IS_WORD[0x61:0x7B] = IS_WORD[0x80:] = True


def _word_hashes(raw: np.ndarray, offsets: np.ndarray):
    low = LOWER[raw]
    start, end, first = word_spans(low, offsets, IS_WORD)
    return SpanHashes(low).of(start, end), low, start, end, first


def _block(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of the block of ``size`` words that ends at each place (from size - 1)."""
    return words if size == 1 else mix64(words[:-1] * np.uint64(3) + words[1:])


class Patterns:
    """Shift table and suffix buckets for the patterns of one length."""

    def __init__(self, rows: np.ndarray, owners: list[set[str]], texts: list[bytes]):
        self.rows, self.owners, self.texts = rows, owners, texts
        self.m = m = rows.shape[1]
        self.size = size = min(2, m)
        self.default = m - size + 1
        shift: dict[int, int] = {}
        for at in range(size - 1, m):  # a later place in the pattern has the smaller shift
            ends = rows[:, at] if size == 1 else mix64(rows[:, at - 1] * np.uint64(3) + rows[:, at])
            for key in ends.tolist():
                shift[key] = min(shift.get(key, self.default), m - 1 - at)
        self.keys = np.array(sorted(shift), np.uint64)
        self.shift = np.array([shift[k] for k in self.keys.tolist()], np.int64)
        last = rows[:, -1] if size == 1 else mix64(rows[:, -2] * np.uint64(3) + rows[:, -1])
        self.order = np.argsort(last, kind="stable")
        self.last = last[self.order]

    def find(self, words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(end word, pattern) of every place where all words agree."""
        blocks = _block(words, self.size)
        at = first[:-1] + self.m - 1
        stop = first[1:]
        # one cursor for each stretch of a document, so that long ones do not lag
        stretch = 4096
        n = np.maximum(-(-(stop - at) // stretch), 0)
        which = np.repeat(np.arange(len(n)), n)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        at, stop = at[which] + nth * stretch, np.minimum(at[which] + (nth + 1) * stretch, stop[which])
        ends = []
        while len(at):
            key = blocks[at - (self.size - 1)]
            k = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            shift = np.where(self.keys[k] == key, self.shift[k], self.default)
            ends.append(at[shift == 0])
            at = at + np.maximum(shift, 1)
            alive = at < stop
            at, stop = at[alive], stop[alive]
        end = np.concatenate(ends) if ends else np.zeros(0, np.int64)
        lo = np.searchsorted(self.last, blocks[end - (self.size - 1)], side="left")
        hi = np.searchsorted(self.last, blocks[end - (self.size - 1)], side="right")
        places, found, step = [], [], 0
        while len(end):  # the nth pattern of every bucket
            more = lo + step < hi
            end, lo, hi = end[more], lo[more], hi[more]
            p = self.order[lo + step]
            same = np.ones(len(end), bool)
            for w in range(self.m):
                same &= words[end - (self.m - 1) + w] == self.rows[p, w]
            places.append(end[same])
            found.append(p[same])
            step += 1
        if not places:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(places), np.concatenate(found)


def build_patterns(items: list[tuple[str, str | None]], window: int = WINDOW) -> list[Patterns]:
    by_length: dict[int, dict[bytes, tuple[np.ndarray, set[str]]]] = defaultdict(dict)
    for item, text in items:
        raw, off = string_buffers(pa.array([text], pa.string()))
        words, low, start, end, _ = _word_hashes(raw, off)
        m = min(window, len(words))
        for i in range(len(words) - m + 1 if m else 0):
            text = b" ".join(low[a:b].tobytes() for a, b in zip(start[i:i + m], end[i:i + m]))
            by_length[m].setdefault(text, (words[i:i + m], set()))[1].add(item)
    return [Patterns(np.array([w for w, _ in v.values()], np.uint64), [o for _, o in v.values()], list(v))
            for _, v in sorted(by_length.items())]


def _scan(patterns: list[Patterns]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            raw, off = string_buffers(batch.column(1))
            for i, j in slices(off, SLICE_BYTES):
                words, low, start, end, first = _word_hashes(raw[off[i]:off[j]], off[i:j + 1] - off[i])
                hit = np.zeros(len(words) + 1, np.int32)
                items: dict[int, set[str]] = defaultdict(set)
                for p in patterns:
                    for e, k in zip(*p.find(words, first)):
                        s = e - p.m + 1
                        if b" ".join(low[a:b].tobytes() for a, b in zip(start[s:e + 1], end[s:e + 1])) != p.texts[k]:
                            continue
                        hit[s] += 1
                        hit[e + 1] -= 1
                        items[int(np.searchsorted(first, e, side="right")) - 1] |= p.owners[k]
                inside = np.concatenate([[False], np.cumsum(hit[:-1]) > 0, [False]])
                a, b = np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(~inside[1:] & inside[:-1])
                # a run may reach over the end of a document into the next
                cuts = first[1:-1][inside[first[1:-1]] & inside[first[1:-1] + 1]] if len(a) else a
                cuts = np.unique(cuts)
                a, b = np.sort(np.concatenate([a, cuts])), np.sort(np.concatenate([b, cuts]))
                owner = np.searchsorted(first, a, side="right") - 1
                spans: list[list[dict]] = [[] for _ in range(j - i)]
                for d, x, y in zip(owner.tolist(), a.tolist(), b.tolist()):
                    spans[d].append({"start": x - int(first[d]), "end": y - int(first[d])})
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(np.diff(first), pa.int64()),
                     pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                     pa.array([sorted(items[d]) for d in range(j - i)], pa.list_(pa.string()))],
                    ["doc_id", "n_words", "spans", "items"])
    return run


SCANNED = "doc_id long, n_words long, spans array<struct<start:long,end:long>>, items array<string>"
JOINED = ("doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, "
          "spans array<struct<start:long,end:long>>, items array<string>")


def _scan_and_join(patterns: list[Patterns]):
    """Both steps in one worker: two Python operators in a stage would take two for
    each task, which stay and hold memory in the stages that follow."""
    scan = _scan(patterns)
    return lambda batches: _joined(scan(batches))


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Overlapping runs of several passes merged; words and items counted."""
    for batch in batches:
        out: list[tuple] = []
        for spans, items in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            merged: list[dict] = []
            for x in sorted(spans, key=lambda x: (x["start"], x["end"])):
                if merged and x["start"] <= merged[-1]["end"]:
                    merged[-1]["end"] = max(merged[-1]["end"], x["end"])
                else:
                    merged.append(dict(x))
            items = sorted(set(items))
            digest = hashlib.sha256(",".join(items).encode()).hexdigest()
            out.append((sum(x["end"] - x["start"] for x in merged), len(items), digest, merged, items))
        hit, n_items, digest, spans, items = zip(*out) if out else [()] * 5
        words = batch.column(1).to_numpy()
        hits = np.array(hit, np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(hits), pa.array(n_items, pa.int64()),
             pa.array(digest, pa.string()), pa.array((hits > 0) & (20 * hits >= words)),
             pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
             pa.array(items, pa.list_(pa.string()))],
            ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans", "items"])


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans (runs of
    hit words) and items for every row of ``docs`` (doc_id, text) against
    ``benchmark`` (item_id, text).

    Texts are lower-cased (A-Z); words are runs of ASCII letters, digits and
    non-ASCII characters. A word inside any occurrence of a window is hit; a
    document is contaminated if a twentieth of its words are. Null, empty and
    wordless texts have no words; such benchmark items, and those with a null
    item_id, have no window. Item ids are compared as strings. Rows with a null
    doc_id are left out; rows that share a doc_id are documents of their own.
    Extra columns are ignored; empty tables give no rows, or no hits.
    """
    spark = docs.sparkSession
    prepare(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .filter("doc_id IS NOT NULL")
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text")) \
        .filter("item IS NOT NULL AND text IS NOT NULL")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = max(1, -(-size // pass_bytes))
    if passes == 1:
        return _search(texts, items, 1, window)
    # passes are put together by doc_id, so rows that share one get numbers
    return by_row(texts, Work(spark, "decontaminate"), lambda rows: _search(rows, items, passes, window)).drop("row")


def _search(texts: DataFrame, items: DataFrame, passes: int, window: int) -> DataFrame:
    found = None
    for k in range(passes):
        part = items if passes == 1 else items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(passes)) == k)
        patterns = build_patterns([(r.item, r.text) for r in part.collect()], window)
        if passes == 1:
            return texts.mapInArrow(_scan_and_join(patterns), JOINED)
        scanned = texts.mapInArrow(_scan(patterns), SCANNED)
        found = scanned if found is None else found.unionAll(scanned)
    found = found.groupBy("doc_id").agg(
        F.max("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"),
        F.flatten(F.collect_list("items")).alias("items"))
    return found.mapInArrow(_joined, JOINED)
