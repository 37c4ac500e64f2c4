"""Alignment of two tokenizers over a corpus, on Arrow tables.

Both tokenizers write the same bytes (a blank and the text), so their tokens can
be laid side by side. For a chunk of documents, Arrow flattens the lists of ids
and gives each token its document (parent index); cumulative sums of token bytes,
restarted at every document, give the places where tokens end. An Acero hash join
of the two sides on (document, end) finds the ends that both share; these cut
the tokens into groups, numbered by a running sum. A second hash join on the
group, of each side's distinct ids with their repeats, lists the links, and
``Table.group_by`` counts them by document and id pair.

What a pair's links are worth depends on the whole corpus: the number of
documents that hold the pair linked. Each chunk writes its documents' pairs as
places in a list of the chunk's distinct pairs, with partial counts by
``Table.group_by``. Spark adds up the partial counts of all chunks, hands every
chunk the totals of its own pairs, and the documents of the chunk are summed up
against them. So what is shuffled is a row for each pair of a chunk, not of a
document, and totals of frequent pairs meet their chunks in a join of two
written tables, which AQE splits. Nothing is collected.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from entwise.llm.common import Work, held, slices, string_buffers
from entwise.llm.pieces import Codec, ragged
from entwise.llm.tokens import Encoder

#: Text that is aligned at a time, and text of a chunk; a longer document stands alone.
SLICE_BYTES = 1 << 19
CHUNK_BYTES = 8 << 20
#: A group of more links than this has each side's ids made distinct first.
LARGE = 64
#: A pair of ids as one number: the first times this, plus the second.
BASE = 1 << 32

LINKED = ("chunk long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
          "place array<int>, times array<long>, pair array<long>, held array<long>")
LINKED_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(),
                pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64())]
NAMES = ["chunk", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "place", "times", "pair", "held"]


class Vocabulary:
    """The bytes of every id, end to end."""

    def __init__(self, tokens: list[bytes]):
        self.n = np.array([len(t) for t in tokens], np.int64)
        self.at = np.cumsum(self.n) - self.n
        self.pool = np.frombuffer(b"".join(tokens), np.uint8)

    def writes(self, ids: np.ndarray, cut: np.ndarray, raw: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Per document, whether its tokens' bytes joined are its text's."""
        size = np.diff(np.concatenate([[0], np.cumsum(self.n[ids])])[cut])
        ok = size == np.diff(off)
        ids = ids[np.repeat(ok, np.diff(cut))]
        same = ragged(self.pool, self.at[ids], self.n[ids]) == ragged(raw, off[:-1][ok], size[ok])
        ok[ok] = np.diff(np.concatenate([[0], np.cumsum(~same)])[np.concatenate([[0], np.cumsum(size[ok])])]) == 0
        return ok


def byte_alphabet() -> dict[str, int]:
    """The character that a byte-level vocabulary writes for each byte: itself
    where it is printable, else the next one from U+0100 on."""
    # The printable bytes
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Sides:
    """The two tokenizers, byte-level (a) and of pieces (b), with their bytes."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = Encoder(path_a, False, plain=True), Codec(path_b)
        alphabet = byte_alphabet()
        names = {i: t for t, i in self.a.tok.get_vocab(with_added_tokens=False).items()}
        self.bytes_a = Vocabulary([bytes(alphabet[c] for c in names.get(i, "")) for i in range(max(names) + 1)])
        b = self.b
        self.bytes_b = Vocabulary([b.shown[x:x + n].tobytes() for x, n in zip(b.shown_at.tolist(), b.shown_n.tolist())])
        digits = [str(i).encode() for i in range(max(len(self.bytes_a.n), len(self.bytes_b.n)))]
        self.digits = Vocabulary(digits)

    def encode(self, raw: np.ndarray, off: np.ndarray) -> tuple[pa.ListArray, pa.ListArray]:
        """Lists of ids of both sides; empty where a text is, or where the bytes of
        either side's tokens are not those of the blank and the text."""
        some = np.diff(off) > 0
        spaced_off = np.concatenate([[0], np.cumsum(np.diff(off) + some)])
        spaced = np.full(spaced_off[-1], 0x20, np.uint8)
        place = np.ones(len(spaced), bool)
        place[spaced_off[:-1][some]] = False
        spaced[place] = raw
        lists = self.a.batch(pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(some), [None, pa.py_buffer(spaced_off), pa.py_buffer(spaced)]))
        cut_a = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
        ids_a = np.concatenate(lists).astype(np.int64) if lists else np.zeros(0, np.int64)
        e = self.b.encode(raw, off)
        ids_b, cut_b = e.ids.astype(np.int64), e.cut
        ok = self.bytes_a.writes(ids_a, cut_a, spaced, spaced_off) & self.bytes_b.writes(ids_b, cut_b, spaced, spaced_off)

        def kept(ids: np.ndarray, cut: np.ndarray) -> pa.ListArray:
            n = np.where(ok, np.diff(cut), 0)
            return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()),
                                            pa.array(ids[np.repeat(ok, np.diff(cut))]))
        return kept(ids_a, cut_a), kept(ids_b, cut_b)


def _tokens(lists: pa.ListArray, vocabulary: Vocabulary) -> pa.Table:
    """A row for each token: its document, id, place, and as ``end`` the document
    (parent index) with the byte where the token ends, counted in its document."""
    doc, ids = pc.cast(pc.list_parent_indices(lists), pa.int64()), pc.list_flatten(lists)
    size = pc.take(pa.array(vocabulary.n), ids)
    sums = pc.cumulative_sum(size)
    first = pc.take(lists.offsets, doc)  # each document's sum starts anew
    inside = pc.add(pc.subtract(sums, pc.take(sums, first)), pc.take(size, first))
    return pa.table({"doc": doc, "id": ids, "at": pa.array(np.arange(len(ids))),
                     "end": pc.add(pc.multiply(doc, pa.scalar(BASE, pa.int64())), inside)})


def _grouped(a: pa.Table, b: pa.Table) -> tuple[pa.Table, pa.Table]:
    """Both tables with ``group``, the number of shared ends before the token."""
    shared = a.select(["end", "at"]).join(b.select(["end", "at"]), "end", join_type="inner", right_suffix="_b", use_threads=False)
    out = []
    for t, at in ((a, "at"), (b, "at_b")):
        last = np.zeros(len(t), np.int64)
        last[shared[at].to_numpy()] = 1
        out.append(t.append_column("group", pa.array(np.cumsum(last) - last)))
    return out[0], out[1]


def _links(a: pa.Table, b: pa.Table) -> pa.Table:
    """doc, pair, times: how often each id pair is linked in each document."""
    sizes = [np.bincount(t["group"].to_numpy()) for t in (a, b)]
    large = sizes[0] * sizes[1] > LARGE

    def distinct(t: pa.Table) -> pa.Table:
        t = t.select(["group", "id"]).append_column("n", pa.array(np.ones(len(t), np.int64)))
        many = large[t["group"].to_numpy()]
        if not many.any():
            return t
        once = t.filter(pa.array(many)).group_by(["group", "id"], use_threads=False).aggregate([("n", "sum")])
        return pa.concat_tables([t.filter(pa.array(~many)), once.rename_columns(["group", "id", "n"])])

    met = distinct(a).join(distinct(b), "group", join_type="inner", right_suffix="_b", use_threads=False)
    doc = np.zeros(len(large), np.int64)
    doc[a["group"].to_numpy()] = a["doc"].to_numpy()
    pair = pc.add(pc.multiply(met["id"], pa.scalar(BASE, pa.int64())), met["id_b"])
    return pa.table({"doc": pc.take(pa.array(doc), met["group"]), "pair": pair, "times": pc.multiply(met["n"], met["n_b"])}) \
        .group_by(["doc", "pair"], use_threads=False).aggregate([("times", "sum")]).rename_columns(["doc", "pair", "times"])


def _written(a: pa.Table, b: pa.Table, docs: int, digits: Vocabulary) -> list[bytes]:
    """Each document's groups as text: a1,a2|b1;a3|b2,b3."""
    group = np.concatenate([a["group"].to_numpy(), b["group"].to_numpy()])
    ids = np.concatenate([a["id"].to_numpy(), b["id"].to_numpy()])
    doc = np.concatenate([a["doc"].to_numpy(), b["doc"].to_numpy()])
    side = np.repeat([0, 1], [len(a), len(b)])
    order = np.argsort(group * 2 + side, kind="stable")
    group, ids, side, doc = group[order], ids[order], side[order], doc[order]
    after = np.full(len(ids), ord(";"), np.uint8)
    after[:-1][group[1:] == group[:-1]] = ord(",")
    after[:-1][side[1:] > side[:-1]] = ord("|")
    n = digits.n[ids]
    ends = np.cumsum(n + 1)
    out = np.zeros(ends[-1] if len(ends) else 0, np.uint8)
    out[ends - 1] = after
    inside = np.ones(len(out), bool)
    inside[ends - 1] = False
    out[inside] = ragged(digits.pool, digits.at[ids], n)
    cut = np.concatenate([[0], ends])[np.searchsorted(doc, np.arange(docs + 1))]
    text = out.tobytes()
    return [text[x:max(x, y - 1)] for x, y in zip(cut.tolist(), cut[1:].tolist())]


def _slice(sides: Sides, raw: np.ndarray, off: np.ndarray) -> tuple[pa.Table, pa.Table]:
    """(documents, links) of a slice of texts."""
    lists_a, lists_b = sides.encode(raw, off)
    a, b = _grouped(_tokens(lists_a, sides.bytes_a), _tokens(lists_b, sides.bytes_b))
    docs, group, cut = len(off) - 1, a["group"].to_numpy(), lists_a.offsets.to_numpy()
    some = np.diff(cut) > 0
    n_groups = np.zeros(docs, np.int64)
    n_groups[some] = group[cut[1:][some] - 1] + 1 - group[cut[:-1][some]]
    sha = [hashlib.sha256(t).hexdigest() if t else "" for t in _written(a, b, docs, sides.digits)]
    counts = [np.diff(x.offsets.to_numpy()).astype(np.int64) for x in (lists_a, lists_b)]
    return pa.table({"n_a": counts[0], "n_b": counts[1], "n_groups": n_groups, "groups_sha256": pa.array(sha, pa.string())}), _links(a, b)


def _chunk(ids: pa.Array, docs: pa.Table, links: pa.Table, chunk: int) -> Iterator[pa.RecordBatch]:
    """The rows of a chunk: its documents, whose pairs are places in the chunk's
    list of pairs, frequent ones first, and that list with its counts."""
    counts = links.group_by("pair", use_threads=False).aggregate([([], "count_all")]).sort_by(
        [("count_all", "descending"), ("pair", "ascending")])
    place = pc.index_in(links["pair"].combine_chunks(), value_set=counts["pair"].combine_chunks()).to_numpy()
    owner, times, n = links["doc"].to_numpy(), links["times"].to_numpy(), len(ids)
    order = np.lexsort((place, owner))
    total = np.zeros(n, np.int64)
    np.add.at(total, owner, times)
    cut = pa.array(np.searchsorted(owner[order], np.arange(n + 1)), pa.int32())
    none = pa.nulls(n)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, chunk)), ids, *[docs[c].combine_chunks() for c in ("n_a", "n_b", "n_groups")], pa.array(total),
         docs["groups_sha256"].combine_chunks(), pa.ListArray.from_arrays(cut, pa.array(place[order], pa.int32())),
         pa.ListArray.from_arrays(cut, pa.array(times[order], pa.int64())),
         none.cast(LINKED_TYPES[9]), none.cast(LINKED_TYPES[10])], NAMES)
    if len(counts):
        whole = pa.array([0, len(counts)], pa.int32())
        yield pa.RecordBatch.from_arrays(
            [pa.array([chunk]), *[pa.nulls(1).cast(t) for t in LINKED_TYPES[1:9]],
             pa.ListArray.from_arrays(whole, counts["pair"].combine_chunks()),
             pa.ListArray.from_arrays(whole, counts["count_all"].combine_chunks())], NAMES)


def _sides(path_a: str, path_b: str) -> Sides:
    return held(("alignment", path_a, path_b), lambda: Sides(path_a, path_b))


def _link(path_a: str, path_b: str, chunk_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides, part, n = _sides(path_a, path_b), TaskContext.get().partitionId(), 0
        ids, docs, links, size, rows = [], [], [], 0, 0

        def flush() -> Iterator[pa.RecordBatch]:
            yield from _chunk(pa.concat_arrays(ids), pa.concat_tables(docs), pa.concat_tables(links), (part << 32) + n)

        for batch in batches:
            raw, off = string_buffers(batch.column(1))
            for i, j in slices(off, SLICE_BYTES):
                found, linked = _slice(sides, raw[off[i]:off[j]], off[i:j + 1] - off[i])
                ids.append(batch.column(0).slice(i, j - i))
                docs.append(found)
                links.append(linked.set_column(0, "doc", pc.add(linked["doc"], pa.scalar(rows, pa.int64()))))
                size, rows = size + int(off[j] - off[i]), rows + j - i
                if size >= chunk_bytes:
                    yield from flush()
                    ids, docs, links, size, rows, n = [], [], [], 0, 0, n + 1
        if ids:
            yield from flush()
    return run


def _valued(docs: pa.Table, pairs: pa.Table) -> pa.Table:
    """The documents of a chunk against the totals of its pairs."""
    worth = np.zeros(len(pairs), np.int64)
    worth[pairs["place"].to_numpy()] = pairs["worth"].to_numpy()
    place = docs["place"].combine_chunks()
    owner = pc.list_parent_indices(place).to_numpy()
    times = pc.list_flatten(docs["times"].combine_chunks()).to_numpy()
    worth = worth[pc.list_flatten(place).to_numpy()]
    best, total = np.zeros(len(docs), np.int64), np.zeros(len(docs), np.int64)
    np.add.at(best, owner, times * (worth & 1))
    np.add.at(total, owner, times * (worth >> 1))
    return pa.table([*[docs[c] for c in NAMES[1:6]], pa.array(best), pa.array(total), docs["groups_sha256"]],
                    names=[*NAMES[1:6], "n_best", "count_sum", "groups_sha256"])


def linked_pairs(docs: DataFrame, path_a: str, path_b: str, work: Work, chunk_bytes: int = CHUNK_BYTES) -> tuple[DataFrame, DataFrame]:
    """(documents and chunks as ``LINKED``, totals): the totals are id_a, id_b,
    docs (documents that hold the pair linked) and best (whether no other id_b
    has more with this id_a)."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    linked = work.table(texts.mapInArrow(_link(path_a, path_b, chunk_bytes), LINKED), "linked")
    parts = linked.filter("pair IS NOT NULL").select(F.explode(F.arrays_zip("pair", "held")).alias("x")).select("x.*")
    counted = parts.groupBy("pair").agg(F.sum("held").alias("docs"))
    id_a = F.expr(f"pair div {BASE}")
    # an id has at most as many partners as the other vocabulary has ids
    best = F.max("docs").over(Window.partitionBy("id_a"))
    totals = counted.withColumn("id_a", id_a).withColumn("best", F.col("docs") == best)
    return linked, work.table(totals.select("id_a", F.expr(f"pair % {BASE}").alias("id_b"), "docs", "best"), "totals")


def align(docs: DataFrame, path_a: str, path_b: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for
    every row of ``docs`` (doc_id, text).

    A text is encoded by the byte-level tokenizer ``path_a`` with a blank before
    it, and by the piece model ``path_b``, which adds one; names of special tokens
    inside a text are ordinary text. Places where tokens of both end cut them into
    groups; all tokens of a group are linked across. ``n_best`` are the links whose
    pair is held linked by as many documents of the table as any pair of its first
    id, ``count_sum`` sums those numbers over the links, and ``groups_sha256``
    digests the groups. Texts that are null or empty, or whose tokens write other
    bytes (a text that holds U+2581), have no tokens: zeros and an empty digest.

    Rows stand for themselves: each of several rows with a doc_id counts as a
    document, and null doc_ids stay. Extra columns are ignored; an empty table
    gives no rows.
    """
    work = Work(docs.sparkSession, "alignment")
    linked, totals = linked_pairs(docs, path_a, path_b, work, chunk_bytes)
    asked = linked.filter("pair IS NOT NULL").select(F.col("chunk").alias("of"), F.posexplode("pair").alias("place", "pair"))
    pair = (F.col("id_a") * F.lit(BASE) + F.col("id_b")).alias("pair")
    worth = totals.select(pair, (F.col("docs") * 2 + F.col("best").cast("long")).alias("worth"))
    answers = asked.join(worth, "pair").select("of", "place", "worth")
    rows = linked.filter("n_a IS NOT NULL").select(*NAMES[:9])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return _valued(left, right)
    return rows.groupBy("chunk").cogroup(answers.groupBy("of")).applyInArrow(
        run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
