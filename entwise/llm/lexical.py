"""Ranked lexical search by dense blocked matrix products.

An item's score for a document is the sum over the item's terms of weight times
impact, both integers, so it is one cell of the product of an item matrix
(weight times repeats) and a document matrix (impacts). Only terms of the items
matter, so the vocabulary is the items' own, and it is held in Arrow, where
terms are compared byte by byte.

Two passes. The first reads the texts once and writes, for each document, its
length and the occurrences of item terms; document frequencies, the number of
documents and their summed length come from that table. The second multiplies
dense tiles in float64: ``ITEM_TILE`` items by ``DOC_TILE`` documents over the
columns that both hold, in column tiles whose sums stay under 2**53, so every
partial sum is a whole number that a double holds exactly; tiles are added as
64-bit integers. Each task keeps the best k documents of each item, where equal
scores are decided by doc_id, and a last ranking in two steps (parts of an item,
then the item) puts the tasks together.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from entwise.llm.common import LOWER, Work, shuffle_width, slices, string_buffers, word_spans

#: Item text that one pass over the documents serves; more items take more passes.
PASS_BYTES = 32 << 20
ITEM_TILE, DOC_TILE = 512, 1024
#: Cells of a dense tile at most (8 bytes each): longer vocabularies take more column tiles.
TILE_CELLS = 1 << 22
SLICE_BYTES = 1 << 20
#: Whole numbers below this are exact in a double.
EXACT = 1 << 53
#: Saturation and length share of an impact, in tenths and hundredths.
K1, B = 8, 75
#: An impact is SCALE * tf div (1000 * tf + K1 * m), so it is at most SCALE div 1000.
SCALE = 1_000_000_000

IS_TERM = np.zeros(256, bool)
IS_TERM[0x30:0x3A] = IS_TERM[0x41:0x5B] = IS_TERM[0x61:0x7B] = IS_TERM[0x80:] = True


def terms_of(raw: np.ndarray, offsets: np.ndarray) -> tuple[pa.LargeBinaryArray, np.ndarray]:
    """The lower-cased terms of all texts in order, and each text's first term."""
    start, end, first = word_spans(raw, offsets, IS_TERM)
    inside = IS_TERM[raw]
    data = LOWER[raw[inside]]
    at = np.concatenate([[0], np.cumsum(end - start)])
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(start), [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data)]), first


class Items:
    """The items of one pass: sparse rows of (item, term, repeats) and the terms."""

    def __init__(self, ids: list, texts: list[str]):
        raw, off = string_buffers(pa.array(texts, pa.large_string()))
        found, first = terms_of(raw, off)
        coded = found.dictionary_encode()
        self.terms = coded.dictionary
        self.ids = sorted(set(ids))
        place = {x: i for i, x in enumerate(self.ids)}
        owner = np.repeat(np.array([place[x] for x in ids], np.int64), np.diff(first))
        width = max(1, len(self.terms))
        key, self.repeats = np.unique(owner * width + coded.indices.to_numpy(), return_counts=True)
        self.item, self.term = key // width, key % width


def _count_terms(terms: pa.LargeBinaryArray):
    """Per document: its length in terms, and the item terms in it with their occurrences."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = max(1, len(terms))
        for batch in batches:
            raw, off = string_buffers(batch.column(1))
            for i, j in slices(off, SLICE_BYTES):
                found, first = terms_of(raw[off[i]:off[j]], off[i:j + 1] - off[i])
                at = pc.index_in(found, value_set=terms)
                known = np.flatnonzero(at.is_valid().to_numpy(zero_copy_only=False))
                owner = np.searchsorted(first, known, side="right") - 1
                key, tf = np.unique(owner * width + at.drop_null().to_numpy(), return_counts=True)
                cut = pa.array(np.searchsorted(key, np.arange(j - i + 1) * width), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(np.diff(first), pa.int64()),
                     pa.ListArray.from_arrays(cut, pa.array(key % width, pa.int32())),
                     pa.ListArray.from_arrays(cut, pa.array(tf, pa.int64()))], ["doc_id", "n", "term", "tf"])
    return run


def weight(df: int, n_docs: int) -> int:
    """A term's weight from the number of documents that hold it."""
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def column_tiles(tops: np.ndarray, cells: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Tiles of columns whose largest weights (``tops``) times the largest impact
    add up to less than 2**53, of at most ``cells`` columns each. A tile is
    (column, nth, parts): a column too heavy for one tile is split into parts."""
    cap = (EXACT - 1) // (SCALE // 1000)
    parts = np.maximum(-(-tops // cap), 1)
    column = np.repeat(np.arange(len(tops)), parts)
    nth = np.arange(len(column)) - np.repeat(np.cumsum(parts) - parts, parts)
    share = -(-tops // parts)[column]
    cuts, used, n = [0], 0, 0
    for at, x in enumerate(share.tolist()):
        if n and (used + x > cap or n >= cells):
            cuts.append(at)
            used = n = 0
        used, n = used + x, n + 1
    cuts.append(len(column))
    return [(column[a:b], nth[a:b], parts[column[a:b]]) for a, b in zip(cuts, cuts[1:]) if a < b]


def multiply(weights: np.ndarray, impacts: np.ndarray) -> np.ndarray:
    """``weights`` (items x terms) times ``impacts`` (documents x terms): items x
    documents, exact. Both hold whole numbers of at least 0."""
    out = np.zeros((len(weights), len(impacts)), np.int64)
    cells = max(1, TILE_CELLS // max(1, len(weights), len(impacts)))
    for column, nth, parts in column_tiles(weights.max(axis=0, initial=0), cells):
        whole = weights[:, column]
        tile = whole // parts + (nth < whole % parts)
        out += (tile.astype(np.float64) @ impacts[:, column].astype(np.float64).T).astype(np.int64)
    return out


class _Best:
    """The best ``k`` documents of each item so far: falling scores, equal ones by doc_id."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.item, self.doc, self.score = (np.zeros(0, np.int64) for _ in range(3))
        self.least = np.ones(items, np.int64)  # what a document must reach

    def add(self, first: int, docs: np.ndarray, scores: np.ndarray) -> None:
        """``scores`` of the items from ``first`` on for ``docs``."""
        row, col = np.nonzero(scores >= self.least[first:first + len(scores), None])
        if not len(row):
            return
        item = np.concatenate([self.item, row + first])
        doc = np.concatenate([self.doc, docs[col]])
        score = np.concatenate([self.score, scores[row, col]])
        order = np.lexsort((doc, -score, item))
        item = item[order]
        start = np.flatnonzero(np.concatenate([[True], item[1:] != item[:-1]]))
        rank = np.arange(len(item)) - np.repeat(start, np.diff(np.append(start, len(item))))
        kept = rank < self.k
        self.item, self.doc, self.score = item[kept], doc[order][kept], score[order][kept]
        full = rank[kept] == self.k - 1
        self.least[self.item[full]] = self.score[full]


def _score(items: Items, weights: np.ndarray, n_docs: int, length: int, k: int):
    """The best documents of a partition for every item."""
    order = np.argsort(items.item, kind="stable")
    item, term = items.item[order], items.term[order]
    value = (items.repeats[order] * weights[term]).astype(np.int64)
    cut = np.searchsorted(item, np.arange(0, len(items.ids) + ITEM_TILE, ITEM_TILE))

    def tile_scores(at: int, owner: np.ndarray, terms: np.ndarray, impact: np.ndarray, docs: int) -> np.ndarray:
        a, b = cut[at], cut[at + 1]
        here = np.intersect1d(term[a:b], terms)  # the columns that both tiles hold
        column = np.full(len(weights), -1, np.int64)
        column[here] = np.arange(len(here))
        left = np.zeros((min(ITEM_TILE, len(items.ids) - at * ITEM_TILE), len(here)), np.int64)
        x = column[term[a:b]] >= 0
        left[item[a:b][x] - at * ITEM_TILE, column[term[a:b][x]]] = value[a:b][x]
        right = np.zeros((docs, len(here)), np.int64)
        x = column[terms] >= 0
        right[owner[x], column[terms[x]]] = impact[x]
        return multiply(left, right)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(len(items.ids), k)
        for batch in batches:
            for a in range(0, batch.num_rows, DOC_TILE):
                tile = batch.slice(a, DOC_TILE)
                docs, n = tile.column(0).to_numpy(), tile.column(1).to_pylist()
                # Python's integers: the product of three counts may pass 64 bits
                m = np.array([100 - B + (B * x * n_docs) // length for x in n], np.int64)
                owner = pc.list_parent_indices(tile.column(2)).to_numpy()
                terms = pc.list_flatten(tile.column(2)).to_numpy().astype(np.int64)
                tf = pc.list_flatten(tile.column(3)).to_numpy()
                impact = (SCALE * tf) // (1000 * tf + K1 * m[owner])
                for at in range(len(cut) - 1):
                    best.add(at * ITEM_TILE, docs, tile_scores(at, owner, terms, impact, len(docs)))
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays(
            [pa.array(best.item), pa.array(best.doc), pa.array(best.score), pa.array(np.full(len(best.item), part))],
            ["item", "doc_id", "score", "part"])
    return run


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the ``k`` documents (doc_id, text)
    with the highest scores above 0 for every item (item_id, text); all of them,
    if fewer. Equal scores are ranked by ascending doc_id.

    Terms are runs of ASCII letters and digits and of all other characters from
    U+0080 on, A-Z lower-cased. Null, empty and termless texts have no terms:
    such documents don't count and are never ranked, such items give no rows.
    Rows with a null doc_id or item_id are left out altogether. Rows that share a
    doc_id are documents of their own; rows that share an item_id are one item
    with the terms of all. Extra columns are ignored; an empty table on either
    side gives no rows. Items are collected up to ``pass_bytes`` of text at a
    time, and every pass reads all documents.
    """
    spark = docs.sparkSession
    work = Work(spark, "lexical")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .filter("doc_id IS NOT NULL")
    asked = items.select("item_id", F.col("text").cast("string").alias("text")) \
        .filter("item_id IS NOT NULL AND text IS NOT NULL")
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = max(1, -(-size // pass_bytes))
    kind = items.schema["item_id"].dataType
    found = [_one_pass(texts, asked if passes == 1 else asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == p),
                       k, kind, work) for p in range(passes)]
    out = found[0]
    for other in found[1:]:
        out = out.unionAll(other)
    return out


def _one_pass(texts: DataFrame, asked: DataFrame, k: int, kind, work: Work) -> DataFrame:
    spark = texts.sparkSession
    rows = asked.toArrow()
    held = Items(rows["item_id"].to_pylist(), rows["text"].to_pylist())
    counted = work.table(texts.mapInArrow(_count_terms(held.terms), "doc_id long, n long, term array<int>, tf array<long>"),
                         "counted")
    n_docs, length = counted.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    names = spark.createDataFrame(list(enumerate(held.ids)), T.StructType(
        [T.StructField("item", T.LongType()), T.StructField("item_id", kind)]))
    if not n_docs or not len(held.terms):
        best = spark.createDataFrame([], "item long, doc_id long, score long, part long")
    else:
        # one row for each term of the items
        df = counted.select(F.explode("term").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).toArrow()
        weights = np.zeros(len(held.terms), np.int64)
        weights[df["term"].to_numpy()] = [weight(x, n_docs) for x in df["df"].to_pylist()]
        best = counted.filter(F.size("term") > 0).mapInArrow(
            _score(held, weights, n_docs, length, k), "item long, doc_id long, score long, part long")
    order = [F.desc("score"), F.col("doc_id")]
    salt = F.pmod("part", F.lit(shuffle_width(spark)))
    for by in (["item", "salt"], ["item"]):
        best = best.withColumn("salt", salt) if "salt" in by else best
        best = best.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))) \
            .filter(F.col("rank") <= k)
    return best.join(names, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
