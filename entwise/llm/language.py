"""Language identification by blended-spectrum string kernels.

The kernel of two texts compares which n-grams each holds, for n = 1 to 3: the
number of n-grams present in both over the geometric mean of the numbers in each,
averaged over n. Letters are folded to lower case and everything that is no
letter to one sign, so the kernel sees words and their ends only.

Nyström: a text is described by its kernel values with ``LANDMARKS`` training
texts. One kernel ridge regression for each language, against the rest, is
fitted on those values; all are one linear map. Only n-grams that occur in a
landmark can count, so a text becomes a presence vector over that vocabulary, and
a batch of texts is scored by two matrix products.

Landmarks and training rows are bounded samples, dealt evenly over the languages
and chosen by a hash of the id; every text is scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from entwise.llm.common import local_rows, prepare, release, slices, string_buffers

ORDERS = (1, 2, 3)
#: Training rows, and landmarks among them, over all languages.
TRAIN_ROWS = 4_000
LANDMARKS = 192
#: Languages at most; a column with more values is no language column.
MOST_LANGUAGES = 400
RIDGE = 1e-3
SLICE_BYTES = 1 << 18

# classes of bytes: 0 no letter, 1-26 letters, then the bytes of longer characters
_CLASS = np.zeros(256, np.int32)
_CLASS[97:123] = _CLASS[65:91] = np.arange(1, 27)
_CLASS[0x80:0xC0] = 27 + np.arange(64)
_CLASS[0xC0:] = 91 + np.arange(64) % 32
_BITS = 7


def _fold(raw: np.ndarray) -> np.ndarray:
    """Class of each byte; capitals of the Latin-1 letters count as small ones."""
    c = _CLASS[raw]
    upper = (raw[1:] >= 0x80) & (raw[1:] <= 0x9E) & (raw[:-1] == 0xC3)
    c[1:][upper] += 0x20
    return c


def _gram_codes(classes: np.ndarray, n: int) -> np.ndarray:
    if len(classes) < n:
        return np.zeros(0, np.int32)
    m = len(classes) - n + 1
    code = classes[:m].copy()
    for i in range(1, n):
        code = (code << _BITS) | classes[i:i + m]
    return code


class _Distinct:
    """Distinct codes of one text at a time, without sorting: of equal codes, the
    one whose place was written last remains."""

    def __init__(self) -> None:
        self.place = {n: np.zeros(1 << (_BITS * n), np.int32) for n in ORDERS}

    def of(self, codes: np.ndarray, n: int) -> np.ndarray:
        at = np.arange(len(codes), dtype=np.int32)
        self.place[n][codes] = at
        return codes[self.place[n][codes] == at]


def _gram_sets(raw: np.ndarray, offsets: np.ndarray) -> Iterator[list[np.ndarray]]:
    """Per text, the distinct n-grams of each order; text ends count as no letter."""
    distinct = _Distinct()
    rows = len(offsets) - 1
    padded = np.full(len(raw) + 2 * rows, 32, np.uint8)
    starts = offsets[:-1] + 2 * np.arange(rows)
    ends = offsets[1:] + 2 * np.arange(1, rows + 1)
    inside = np.ones(len(padded), bool)
    inside[starts], inside[ends - 1] = False, False
    padded[inside] = raw
    classes = _fold(padded)
    codes = [_gram_codes(classes, n) for n in ORDERS]
    for a, b in zip(starts.tolist(), ends.tolist()):
        yield [distinct.of(c[a:max(a, b - n + 1)], n) for n, c in zip(ORDERS, codes)]


class Vocabulary:
    """The landmarks' n-grams: a column for each, and a row of kernel weights with
    every landmark that holds it."""

    def __init__(self, landmarks: list[list[np.ndarray]]):
        self.columns, self.weights = [], []
        for k, n in enumerate(ORDERS):
            grams = np.unique(np.concatenate([s[k] for s in landmarks]))
            table = np.zeros(1 << (_BITS * n), np.int32)  # 0: not a landmark's n-gram
            table[grams] = np.arange(1, len(grams) + 1)
            weight = np.zeros((len(grams) + 1, len(landmarks)), np.float32)
            for j, s in enumerate(landmarks):
                weight[table[s[k]], j] = 1 / np.sqrt(max(len(s[k]), 1)) / len(ORDERS)
            self.columns.append(table)
            self.weights.append(weight)

    def products(self, raw: np.ndarray, offsets: np.ndarray, weights: list[np.ndarray]) -> np.ndarray:
        """Sum over orders of (presence matrix of a slice of texts, divided by the
        root of each text's n-grams) times ``weights``: with the vocabulary's own
        weights, the kernel values with all landmarks."""
        rows = len(offsets) - 1
        out = np.zeros((rows, weights[0].shape[1]))
        sets = list(_gram_sets(raw, offsets))
        for k, (table, weight) in enumerate(zip(self.columns, weights)):
            counts = np.array([len(s[k]) for s in sets])
            present = table[np.concatenate([s[k] for s in sets])]
            text = np.repeat(np.arange(rows), counts)[present > 0]
            present = present[present > 0]
            first = np.searchsorted(text, np.arange(rows))
            some = np.flatnonzero(np.diff(np.append(first, len(text))))
            if len(some):
                out[some] += np.add.reduceat(weight[present], first[some], dtype=float) / np.sqrt(counts[some])[:, None]
        return out


def fit(kernel: np.ndarray, langs: list[str], names: list[str], landmarks: np.ndarray) -> np.ndarray:
    """Weights (landmarks x languages) of the ridge regressions of one-against-
    rest targets; languages weigh alike whatever their number of rows."""
    y = np.array([[1.0 if x == n else -1.0 for n in names] for x in langs])
    w = np.array([1 / (len(names) * langs.count(x)) for x in langs])
    own = kernel[landmarks]
    gram = kernel.T @ (w[:, None] * kernel) + RIDGE * (own + own.T) / 2 + 1e-8 * np.eye(kernel.shape[1])
    return np.linalg.solve(gram, kernel.T @ (w[:, None] * y))


def _collect_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, off = string_buffers(batch.column(1))
        for i, j in slices(off, SLICE_BYTES):
            sets = list(_gram_sets(raw[off[i]:off[j]], off[i:j + 1] - off[i]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, j - i), pa.array([[g.tolist() for g in s] for s in sets],
                                                           pa.list_(pa.list_(pa.int32())))], ["nth", "sets"])


def _collect_kernel(vocabulary: Vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            raw, off = string_buffers(batch.column(1))
            for i, j in slices(off, SLICE_BYTES):
                k = vocabulary.products(raw[off[i]:off[j]], off[i:j + 1] - off[i], vocabulary.weights)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(k.tolist(), pa.list_(pa.float64()))], ["nth", "k"])
    return run


def _score(vocabulary: Vocabulary, weights: np.ndarray, names: list[str]):
    # the kernel is linear in presence, so both matrix products fold into one
    folded = [w.astype(float) @ weights for w in vocabulary.weights]
    vocabulary.weights = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            col = batch.column(1)
            raw, off = string_buffers(col)
            for i, j in slices(off, SLICE_BYTES):
                out = vocabulary.products(raw[off[i]:off[j]], off[i:j + 1] - off[i], folded)
                best = out.argmax(1)
                e = np.exp(4 * (out - out.max(1, keepdims=True)))
                score = (1 / e.sum(1)).tolist()
                lang = [names[k] for k in best]
                for r in range(i, j):
                    text = col[r].as_py()
                    if text is None or not any(map(str.isalpha, text)):
                        lang[r - i], score[r - i] = "und", 0.0
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(i, j - i) for c in batch.columns[2:]), pa.array(lang, pa.string()),
                     pa.array(score, pa.float64())],
                    [*batch.schema.names[2:], "lang_pred", "score"])
    return run


def identify(docs: DataFrame, train: str = "pmod(crc32(cast(doc_id AS string)), 4) <> 2") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1) for every row, learned
    from the text and lang of rows that meet ``train`` and have both.

    A text that is null or has no letter gets ``und`` and score 0, as does every
    text if there is nothing to learn from. lang, doc_id and all other columns
    are never inputs of a prediction; they are kept, except that columns named
    lang_pred or score are replaced. Equal texts get equal results. Learned are
    the ``MOST_LANGUAGES`` values of lang with the most rows; the fit takes
    ``TRAIN_ROWS`` rows, picked by a hash, of whatever doc_id, null or repeated;
    copies of a row count once.
    """
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.drop("lang_pred", "score")
    text = F.col("text").cast("string")
    text = F.col("text").cast("string")
    usable = docs.filter(F.expr(train)).filter(F.col("lang").isNotNull() & text.rlike(r"\p{L}")).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
        F.xxhash64(F.col("doc_id").cast("long"), text).alias("h"))
    # copies of a row count once
    usable = usable.groupBy("lang", "h").agg(F.min("doc_id").alias("doc_id"))
    counted = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(MOST_LANGUAGES).collect()
    names = sorted(r.lang for r in counted)
    if not names:
        return docs.withColumns({"lang_pred": F.lit("und"), "score": F.lit(0.0)})
    each, marked = max(1, TRAIN_ROWS // len(names)), max(2, LANDMARKS // len(names))
    # the smallest hashes of a language; those far above the place where they must end are never moved
    ends = {r.lang: min(1.0, (3 * each + 100) / r.n) for r in counted}
    end = F.element_at(F.create_map(*[F.lit(x) for kv in ends.items() for x in kv]), F.col("lang"))
    near = (F.col("h").cast("double") / 2.0 ** 64 + 0.5) <= end
    first = Window.partitionBy("lang").orderBy("h", "doc_id")
    ranked = usable.filter(F.col("lang").isin(*names)).filter(near).withColumn("r", F.row_number().over(first)).filter(F.col("r") <= each)
    picked = sorted(((r.lang, r.r, r.doc_id, r.h) for r in ranked.collect()), key=lambda x: x[:2])
    langs = [x[0] for x in picked]
    marks = np.array([i for i, x in enumerate(picked) if x[1] <= marked])

    def texts(of: list[int]) -> DataFrame:
        chosen = local_rows(spark, {"nth": pa.int32(), "d": pa.int64(), "k": pa.int64(), "l": pa.string()},
                            [(i, picked[i][2], picked[i][3], langs[i]) for i in of])
        same = F.col("doc_id").cast("long").eqNullSafe(F.col("d")) & (F.col("lang").cast("string") == F.col("l")) \
            & (F.xxhash64(F.col("doc_id").cast("long"), text) == F.col("k"))
        return docs.join(F.broadcast(chosen), same).select("nth", text.alias("text"))

    sets = {r.nth: [np.array(g, np.int32) for g in r.sets] for r in texts(marks.tolist()).mapInArrow(
        _collect_sets, "nth int, sets array<array<int>>").collect()}
    vocabulary = Vocabulary([sets[i] for i in marks.tolist()])
    rows = {r.nth: r.k for r in texts(range(len(picked))).mapInArrow(
        _collect_kernel(vocabulary), "nth int, k array<double>").collect()}
    weights = fit(np.array([rows[i] for i in range(len(picked))]), langs, names, marks)

    kept = docs.select(F.col("doc_id").alias("_id"), F.col("text").cast("string").alias("_text"), *docs.columns)
    out = kept.schema.fields[2:]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out)
    return kept.mapInArrow(_score(vocabulary, weights, names), f"{schema}, lang_pred string, score double")
