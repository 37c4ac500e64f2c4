"""Repeated byte passages by bucket-pointer refinement over sampled suffixes.

A byte goes if it lies in a string of ``length`` bytes that starts anywhere else
too. Sorting every suffix of a corpus moves many times its size; but suffixes
need only meet at places that equal strings choose alike. So:

1. Anchors. Of the ``length - Q + 1`` q-grams of a string, the leftmost one with
   the smallest hash is its anchor. Equal strings have their anchors at equal
   offsets, neighbours mostly share one, and about one byte in 130 is an anchor.
   The anchor's q-gram is the initial bucket of the starts that chose it.
2. Refinement. A bucket is split by the identifiers of what follows and precedes
   at further offsets: an interval of starts is taken together, and gets two
   identifiers, of the bytes that *all* of its starts cover and of the bytes that
   *any* of them covers. If another anchor of the bucket has the same identifier
   for the latter, every start of the interval is repeated; if none has the same
   identifier for the former, no start is; else the interval is cut into
   ``FAN`` parts, which are refined in the same way, with the buckets of the last
   round as the ones to refine, down to single starts, where both are the same.

A bucket's members are never brought together: rounds only count equal
identifiers (combined map-side) and join the counts back from written tables, so
a passage in a third of all documents costs a row a document. Members with equal
identifiers everywhere are settled in the first round without being read again.
Strings are told apart by 128 bits of hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entwise.llm.common import SpanHashes, Work, by_row, mix64, release, slices, string_buffers

Q = 128
FAN = 8
SLICE_BYTES = 1 << 18


def _leftmost_minima(h: np.ndarray, width: int) -> np.ndarray:
    """For every window of ``width`` values, the index of its leftmost smallest."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    blocks = -(-len(h) // width)
    pad = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    pad[:len(h)] = h
    grid = pad.reshape(blocks, width)
    place = np.arange(blocks * width).reshape(blocks, width)

    # smallest so far from each block's start; an equal later value does not replace it
    ahead = np.minimum.accumulate(grid, axis=1)
    new = np.ones_like(grid, bool)
    new[:, 1:] = ahead[:, 1:] < ahead[:, :-1]
    ahead_at = np.maximum.accumulate(np.where(new, place, 0), axis=1)
    # smallest from here to each block's end; an equal earlier value does replace it
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1]
    own = grid == back
    back_at = np.minimum.accumulate(np.where(own, place, blocks * width)[:, ::-1], axis=1)[:, ::-1]

    back, back_at, ahead, ahead_at = back.ravel(), back_at.ravel(), ahead.ravel(), ahead_at.ravel()
    left, right = slice(0, n), slice(width - 1, width - 1 + n)
    return np.where(ahead[right] < back[left], ahead_at[right], back_at[left])


def _anchors(length: int):
    """A row for each anchor: doc_id, at, low and high (the starts that chose it,
    as distances before it), bucket, whole (identifier of all bytes they cover)."""
    width = length - Q + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            raw, off = string_buffers(batch.column(1))
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for i, j in slices(off, SLICE_BYTES):
                hashes = SpanHashes(raw[off[i]:off[j]])
                grams = hashes.windows(Q)
                cols: list[list[np.ndarray]] = [[], [], [], [], []]
                for d in range(i, j):
                    a, b = off[d] - off[i], off[d + 1] - off[i]
                    if b - a < length:
                        continue
                    chosen = _leftmost_minima(grams[a:b - Q + 1], width)
                    first = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
                    last = np.concatenate([first[1:], [len(chosen)]]) - 1
                    at = chosen[first]
                    cols[0].append(np.full(len(at), ids[d], np.int64))
                    for c, x in zip(cols[1:], (at, at - last, at - first, at + a)):
                        c.append(x)
                if not cols[0]:
                    continue
                doc, at, low, high, place = map(np.concatenate, cols)
                whole = hashes.of(place - high, place - low + length)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc), pa.array(at.astype(np.int32)), pa.array(low.astype(np.int32)),
                     pa.array(high.astype(np.int32)), pa.array(grams[place].view(np.int64)),
                     pa.array(whole.view(np.int64))],
                    ["doc_id", "at", "low", "high", "bucket", "whole"])
    return run


def _refined(length: int, step: int):
    """Intervals of ``step`` starts inside the given ones, with the identifiers
    of the bytes that all of their starts cover (core) and that any covers
    (whole). Rows carry the bytes around their anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            c = {n: batch.column(k) for k, n in enumerate(batch.schema.names)}
            raw, off = string_buffers(c["near"])
            low, high, left = (c[n].to_numpy() for n in ("low", "high", "left"))  # left: bytes before the anchor
            for i, j in slices(off, SLICE_BYTES):
                hashes = SpanHashes(raw[off[i]:off[j]])
                out: list[list[np.ndarray]] = [[] for _ in range(6)]
                for r in range(i, j):
                    zero = off[r] - off[i] + left[r]
                    k = np.arange(low[r] // step, high[r] // step + 1)
                    lo, hi = np.maximum(k * step, low[r]), np.minimum(k * step + step - 1, high[r])
                    core = hashes.of(zero - k * step, np.maximum(zero - (k * step + step - 1) + length, zero - k * step))
                    whole = mix64(hashes.of(zero - hi, zero - lo + length) + (lo * length + hi).astype(np.uint64))
                    for o, x in zip(out, (np.full(len(k), r, np.int64), lo, hi, k, core, whole)):
                        o.append(x)
                row, lo, hi, k, core, whole = map(np.concatenate, out)
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [c["member"].take(take), c["bucket"].take(take), pa.array(k.astype(np.int32)),
                     pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32)),
                     pa.array(core.view(np.int64)), pa.array(whole.view(np.int64))],
                    ["member", "bucket", "k", "low", "high", "core", "whole"])
    return run


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of bytes to remove, merged; what is left is hashed."""
    for batch in batches:
        raw, off = string_buffers(batch.column(1))
        runs = batch.column(2)
        n_removed, n_spans, kept, spans, rest = [], [], [], [], []
        for i in range(batch.num_rows):
            text, gone = raw[off[i]:off[i + 1]], runs[i].as_py() or []
            merged: list[list[int]] = []
            for r in sorted((x["start"], x["end"]) for x in gone):
                if merged and r[0] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], r[1])
                else:
                    merged.append(list(r))
            ends = [0, *[x for r in merged for x in r], len(text)]
            left = b"".join(text[a:b].tobytes() for a, b in zip(ends[::2], ends[1::2]))
            rest.append(left.decode(errors="replace"))
            n_removed.append(sum(b - a for a, b in merged))
            n_spans.append(len(merged))
            kept.append(hashlib.sha256(left).hexdigest())
            spans.append([{"start": a, "end": b} for a, b in merged])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.diff(off), pa.int64()), pa.array(n_removed, pa.int64()),
             pa.array(n_spans, pa.int64()), pa.array(kept, pa.string()),
             pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(rest, pa.string())],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "text"])


def repeated_runs(docs: DataFrame, length: int, work: Work) -> DataFrame:
    """(doc_id, start, end): byte runs that cover every repeated string of
    ``length`` bytes; runs of one document may overlap."""
    if length < Q:
        raise ValueError(f"length must be at least {Q}")
    anchors = work.table(docs.mapInArrow(
        _anchors(length), "doc_id long, at int, low int, high int, bucket long, whole long"), "anchors")
    same = ["bucket", "low", "high", "whole"]
    # one row for each distinct surrounding; the doc and place of one member stand for it
    kinds = anchors.groupBy(*same).agg(F.count(F.lit(1)).alias("m"), F.min(F.struct("doc_id", "at")).alias("one"))
    kinds = work.table(kinds, "kinds")
    buckets = work.table(kinds.groupBy("bucket").agg(F.count(F.lit(1)).alias("kinds"), F.sum("m").alias("m"))
                         .filter("m > 1"), "buckets")
    done = [work.table(anchors.join(kinds.filter("m > 1").select(*same), same, "left_semi")
                       .select("doc_id", "at", "low", "high"), "equal")]

    # members that only differ further out: their surroundings are refined
    split = kinds.join(buckets.filter("kinds > 1").select("bucket"), "bucket", "left_semi")
    member = F.struct("one.doc_id", "one.at")
    split = work.table(split.select(member.alias("member"), "bucket", "low", "high", "m"), "split")
    place = split.select(F.col("member.doc_id").alias("doc_id"), F.col("member.at").alias("at"), "high", "low")
    bytes_of = docs.select("doc_id", F.encode("text", "UTF-8").alias("raw")) if dict(docs.dtypes)["text"] == "string" \
        else docs.select("doc_id", F.col("text").alias("raw"))
    near = bytes_of.join(place, "doc_id").select(
        F.struct("doc_id", "at").alias("member"),
        F.greatest(F.col("at") - (length - 1), F.lit(0)).alias("from"), "at", "raw")
    near = near.select("member", (F.col("at") - F.col("from")).alias("left"),
                       F.substring("raw", F.col("from") + 1, F.col("at") - F.col("from") + length).alias("near"))
    near = work.table(near, "near")

    kept = split.select("member", "bucket", "low", "high")
    step = 1
    while step * FAN < length:
        step *= FAN
    kind = ["bucket", "k", "core", "whole", "low", "high"]
    while True:
        rows = near.join(kept, "member").select("member", "bucket", "low", "high", "left", "near")
        parts = work.table(rows.mapInArrow(
            _refined(length, step), "member struct<doc_id:long,at:int>, bucket long, k int, low int, high int, "
                                    "core long, whole long"), f"parts-{step}")
        kinds = work.table(parts.groupBy(*kind).agg(F.count(F.lit(1)).alias("m"), F.min("member").alias("member")),
                           f"kinds-{step}")
        equal = kinds.filter("m > 1").select(*kind)
        done.append(work.table(parts.join(equal, kind, "left_semi")
                               .select("member.doc_id", "member.at", "low", "high"), f"equal-{step}"))
        if step == 1:
            break
        # cores with several kinds stay open; one member stands for each kind
        cores = work.table(kinds.groupBy("bucket", "k", "core").agg(F.count(F.lit(1)).alias("kinds"))
                           .filter("kinds > 1").drop("kinds"), f"cores-{step}")
        kept = work.table(kinds.join(cores, ["bucket", "k", "core"], "left_semi")
                          .select("member", "bucket", "low", "high"), f"kept-{step}")
        step //= FAN
    found = done[0]
    for more in done[1:]:
        found = found.unionAll(more)
    return found.select("doc_id", (F.col("at") - F.col("high")).cast("long").alias("start"),
                        (F.col("at") - F.col("low") + length).cast("long").alias("end"))


def remove_repeats(docs: DataFrame, length: int = 400) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, the removed spans (start,
    end in UTF-8 bytes) and the text that is left for every row of ``docs``
    (doc_id, text). Where a character was cut in two, U+FFFD stands in the text.

    Every byte covered by a string of ``length`` bytes that also starts anywhere
    else goes; strings never cross documents and are judged on the input. A null
    or empty text has no bytes. Rows with a null doc_id are left out; rows that
    share a doc_id are documents of their own. Extra columns are ignored; an
    empty table gives an empty result.
    """
    work = Work(docs.sparkSession, "repeats")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .filter("doc_id IS NOT NULL")
    return by_row(texts, work, lambda texts: _removed(texts, length, work)).drop("row")


def _removed(texts: DataFrame, length: int, work: Work) -> DataFrame:
    runs = repeated_runs(texts, length, work)
    runs = work.table(runs.groupBy("doc_id").agg(F.collect_set(F.struct("start", "end")).alias("runs")), "runs")
    return texts.join(runs, "doc_id", "left").select("doc_id", "text", "runs").mapInArrow(
        _cut_out, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
                  "spans array<struct<start:long,end:long>>, text string")
