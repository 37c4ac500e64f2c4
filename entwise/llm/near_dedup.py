"""Near-duplicate documents from bottom-k sketches of one hash function.

1. Every text becomes its set of word shingles, hashed by one 63-bit function.
   The ``K`` smallest values are its sketch. Documents with equal sets collapse
   to the smallest id first.
2. Inverted lists of retained values. A list is keyed by ``RUN`` values that
   stand next to each other in the sketch's order; a document enters the lists
   of its ``LISTS`` smallest such keys. Two sets above the threshold differ in
   few values, so long runs stay equal: with whole sets of up to ``SMALL`` values
   a common run is certain, with ``K`` = 192 retained values a pair exactly at
   0.80 misses every common run with a chance of about 1e-9, and one above it with
   less. A frequent value alone makes no list, so a line that a third of the
   documents share does not bring them together. Lists with the same members are
   one, and lists that share members make a family.
3. Within a family, pairs are compared in blocks. The overlaps of all pairs of a
   block come from its presence matrix, which is its inverted lists of retained
   values side by side, so no pair is written for that. The union sketch (the
   smallest values of both sketches) estimates a pair's similarity; pairs it puts
   more than ``SLACK`` below the threshold are out, which a pair exactly at 0.80
   meets with a chance under 2e-9 whatever its sizes, nested sets included.
   The first block of a family meets all others, which links most copies of one
   text; after that only members outside a family's largest component are compared,
   with each other and with those inside. So a family of m near copies takes about
   2 m rows, not the square of its blocks.
4. Pairs that remain are confirmed on full sets: in the block itself where both
   sets have at most ``WHOLE`` values and so are there in full, else by their
   texts. Only components are wanted: a block hands on one spanning forest of
   its links, and of pairs of long texts first a forest of the likeliest, then
   every pair between components that is still open.

No list or family is capped: a long one is dealt into blocks, and pairs of
blocks are separate groups; beyond ``FAMILY`` members, the blocks are those of
the lists themselves.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entwise.llm.common import FILTER_BITS, LOWER, SpanHashes, Work, by_row, mix64, release, slices, string_buffers, word_spans
from entwise.llm.components import components
from entwise.operators.runtime_filter import KeyFilter

K = 192
RUN = 4
LISTS = 48
SMALL = 32
SLACK = 0.20
WHOLE = 2048
#: As SLACK, for estimates from the WHOLE smallest values of longer sets.
LONG_SLACK = 0.06
BLOCK = 512
FAMILY = 8192
SLICE_BYTES = 1 << 18

IS_WORD = np.ones(256, bool)
IS_WORD[[0x20, 9, 10, 11, 12, 13]] = False


def _short_run(percent: int) -> int:
    """The longest run that any two sets with a union of at most SMALL values
    share for certain, if they reach the threshold without being equal."""
    best = RUN
    for u in range(1, SMALL + 1):
        d = u * (100 - percent) // 100
        if d:
            best = min(best, math.ceil((u - d) / (d + 1)))
    return max(1, best)


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """Per document, the sorted distinct hashes of its word shingles. Fewer
    words than ``width`` make one shingle; no word makes none."""
    low = LOWER[raw]
    start, end, first = word_spans(low, offsets, IS_WORD)
    words = SpanHashes(low).of(start, end)
    n = len(words)
    acc = np.zeros(max(n - width + 1, 0), np.uint64)
    for i in range(width):
        acc = mix64(acc * np.uint64(3) + words[i:i + len(acc)])
    acc >>= np.uint64(1)
    for d in range(len(offsets) - 1):
        a, b = int(first[d]), int(first[d + 1])
        if b - a >= width:
            yield np.unique(acc[a:b - width + 1])
        elif b > a:
            one = np.zeros(1, np.uint64)
            for w in words[a:b]:
                one = mix64(one * np.uint64(5) + w)
            yield one >> np.uint64(1)
        else:
            yield acc[:0]


def _runs(values: np.ndarray, width: int) -> np.ndarray:
    m = len(values) - width + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    key = np.full(m, width, np.uint64)
    for i in range(width):
        key = mix64(key * np.uint64(3) + values[i:i + m])
    return key >> np.uint64(1)


def list_keys(sketch: np.ndarray, size: int, short: int) -> np.ndarray:
    keys = np.sort(_runs(sketch, RUN))
    if size <= SMALL:
        return keys if short == RUN else np.concatenate([keys, _runs(sketch, short)])
    return keys[:LISTS]


def _signatures(width: int, percent: int):
    short = _short_run(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            raw, off = string_buffers(batch.column(1))
            for i, j in slices(off, SLICE_BYTES):
                ns, prints, keys = [], [], []
                for s in shingle_sets(raw[off[i]:off[j]], off[i:j + 1] - off[i], width):
                    ns.append(len(s))
                    prints.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                    keys.append(np.unique(list_keys(s[:K], len(s), short)).astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(ns, pa.int64()), pa.array(prints, pa.binary()),
                     pa.array(keys, pa.list_(pa.int64()))],
                    ["doc_id", "n", "print", "keys"])
    return run


def _smallest(width: int):
    """The WHOLE smallest values of each text's set, and the set's size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            raw, off = string_buffers(batch.column(1))
            for i, j in slices(off, SLICE_BYTES):
                sets = list(shingle_sets(raw[off[i]:off[j]], off[i:j + 1] - off[i], width))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array([len(x) for x in sets], pa.int64()),
                     pa.array([x[:WHOLE].astype(np.int64) for x in sets], pa.list_(pa.int64()))],
                    ["doc_id", "n", "smallest"])
    return run


def _common(values: np.ndarray, owner: np.ndarray, m: int) -> np.ndarray:
    """Number of common values of all pairs of ``m`` sets."""
    _, column, times = np.unique(values, return_inverse=True, return_counts=True)
    shared = np.flatnonzero(times > 1)
    rank = np.full(len(times), -1)
    rank[shared] = np.arange(len(shared))
    column = rank[column]
    common = np.zeros((m, m), np.float32)
    for low in range(0, len(shared), 4096):
        here = (column >= low) & (column < low + 4096)
        there = np.zeros((m, min(4096, len(shared) - low)), np.float32)
        there[owner[here], column[here] - low] = 1
        common += there @ there.T
    return common


class _Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        self.up[x] = y
        return x != y


def _block_links(percent: int, every: bool):
    """Links of one block (or between two blocks) of a family: (a, b, sure). Sure
    ones are exact, a spanning forest; the others involve a set of more than WHOLE
    values and pass by estimate: a forest of the likeliest or, with ``every``, all
    pairs between different components."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ids, root = table["doc_id"].to_numpy(), table["root"].to_numpy()
        size, side = table["n"].to_numpy(), table["side"].to_numpy()
        lists = pa.concat_arrays(table["smallest"].chunks)
        values, bounds = lists.values.to_numpy(), lists.offsets.to_numpy()
        kept, m = np.diff(bounds), len(ids)
        values = values[bounds[0]:bounds[-1]]
        owner = np.repeat(np.arange(m), kept)
        place = np.arange(len(values)) - np.repeat(bounds[:-1] - bounds[0], kept)

        ok = np.triu(np.minimum.outer(size, size) * 100 >= percent * np.maximum.outer(size, size), 1)
        if (side >= 0).any():
            ok &= side[:, None] != side[None, :]
        ok &= root[:, None] != root[None, :]  # at first every document is a component
        # the union sketch holds at least as many values as either of both sketches
        sketch = np.minimum(kept, K)
        retained = _common(values[place < K], owner[place < K], m)
        ok &= retained >= (percent / 100 - SLACK) * np.maximum.outer(sketch, sketch)
        near = np.flatnonzero(ok.any(0) | ok.any(1))
        out: list[tuple[int, int, bool]] = []
        if len(near):
            back = np.full(m, -1)
            back[near] = np.arange(len(near))
            mine = back[owner] >= 0
            common = _common(values[mine], back[owner[mine]], len(near))
            ok, size, kept, ids = ok[np.ix_(near, near)], size[near], kept[near], ids[near]
            whole = size <= WHOLE
            both = whole[:, None] & whole[None, :]
            links = ok & both & (100 * common >= percent * (size[:, None] + size[None, :] - common))
            forest = _Forest(len(near))
            if not every:
                out += [(x, y, True) for x, y in zip(*map(np.ndarray.tolist, np.nonzero(links))) if forest.join(x, y)]
            bound = common / np.maximum.outer(kept, kept)
            likely = ok & ~both & (bound >= percent / 100 - LONG_SLACK)
            x, y = np.nonzero(likely)
            order = np.argsort(-bound[x, y], kind="stable")
            for i, j in zip(x[order].tolist(), y[order].tolist()):
                if every or forest.join(i, j):
                    out.append((i, j, False))
            out = [(min(ids[i], ids[j]), max(ids[i], ids[j]), sure) for i, j, sure in out]
        cols = list(zip(*out)) if out else [[], [], []]
        return pa.table({"a": pa.array(cols[0], pa.int64()), "b": pa.array(cols[1], pa.int64()),
                         "sure": pa.array(cols[2], pa.bool_())})
    return run


def _confirm(width: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            ra, oa = string_buffers(batch.column(2))
            rb, ob = string_buffers(batch.column(3))
            yes = []
            for i in range(batch.num_rows):
                x, y = (next(shingle_sets(r[o[i]:o[i + 1]], np.array([0, o[i + 1] - o[i]]), width))
                        for r, o in ((ra, oa), (rb, ob)))
                both = len(np.intersect1d(x, y, assume_unique=True))
                yes.append(100 * both >= percent * (len(x) + len(y) - both))
            keep = pa.array(yes, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), keep], ["a", "b", "linked"])
    return run


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles,
    component_id, kept.

    A text is lower-cased (A-Z) and split at ASCII white space; its set holds
    the distinct ``width``-word shingles, or the whole sequence as one if it has
    fewer words. Documents are linked if 100 * |A and B| >= ``percent`` *
    |A or B|; ``component_id`` is the smallest doc_id reachable by links, and the
    document with that id is kept.

    Null, empty and blank texts have no shingles and stay alone. Rows that share
    a doc_id are documents of their own, of which one row of a component is kept.
    Rows with a null doc_id do not take part and are left out. Extra columns are
    ignored. An empty table gives an empty result.
    """
    work = Work(docs.sparkSession, "near-dedup")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .filter("doc_id IS NOT NULL")
    found = by_row(texts, work, lambda texts: _components_of(texts, width, percent, work))
    if "row" not in found.columns:
        return found.withColumn("kept", F.col("component_id") == F.col("doc_id"))
    found = work.table(found, "by-row")
    names = found.groupBy("component_id").agg(F.min("doc_id").alias("name"), F.min("row").alias("first"))
    return found.join(work.table(names, "names"), "component_id").select(
        "doc_id", "n_shingles", F.col("name").alias("component_id"), (F.col("row") == F.col("first")).alias("kept"))


def all_but_first(found: DataFrame, rows: DataFrame, row: str, work: Work) -> DataFrame:
    """The ``row`` values of a component's rows but that of the smallest doc_id, of
    equal ones the smallest row. ``found`` is a written table (row, component_id),
    ``rows`` has row and doc_id; a null doc_id counts as the largest. Rows of
    components of their own are never moved beside the first aggregate."""
    several = found.groupBy("component_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("component_id")
    linked = found.join(work.table(several, "several"), "component_id")  # two plain scans: AQE splits a large group
    if row != "doc_id":
        linked = linked.join(rows.select(row, "doc_id"), row)
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("d"), F.col(row).alias("r"))
    first = linked.groupBy("component_id").agg(F.min(order).alias("first"))
    return linked.select(row).join(work.table(first.select(F.col("first.r").alias(row)), "first"), row, "left_anti")


_SIDES = ["doc_id", "g", "x", "y", "side"]


def _hub(rows: DataFrame) -> DataFrame:
    """(doc_id, g, x, y, side) for the comparisons of each group's first block with
    itself and with every other block; ``rows`` are (doc_id, g, nb), nb the number
    of blocks. As many rows as the group has, and as many again."""
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("nb")).cast("int"))
    first = rows.filter("block = 0").withColumn("y", F.explode(F.sequence(F.lit(0), F.col("nb") - 1))) \
        .select("doc_id", "g", F.lit(0).alias("x"), "y", F.when(F.col("y") == 0, -1).otherwise(0).alias("side"))
    return first.unionAll(rows.filter("block > 0").select("doc_id", "g", F.lit(0).alias("x"), F.col("block").alias("y"),
                                                          F.lit(1).alias("side")))


def _rest(state: DataFrame, asked: str, work: Work) -> DataFrame:
    """As ``_hub``, for what may still be linked in groups that hold several
    components: the members outside a group's largest component with each other
    and with the members inside. ``state`` is (doc_id, g, nb, root, n), written;
    only groups of which ``asked`` holds take part."""
    sizes = state.groupBy("g", "root").agg(F.count(F.lit(1)).alias("m"), F.max("n").alias("n"), F.max("nb").alias("nb"))
    sizes = sizes.groupBy("g").agg(F.max_by("root", F.struct("m", "root")).alias("main"), F.max("n").alias("n"), F.max("nb").alias("nb"),
                                   F.max("m").alias("inside"), F.sum("m").alias("all"))
    sizes = work.table(sizes.filter("all > inside").filter(asked).select(
        "g", "main", F.ceil((F.col("all") - F.col("inside")) / BLOCK).cast("int").alias("outer"),
        F.ceil(F.col("inside") / BLOCK).cast("int").alias("inner")), "open")
    rows = state.select("doc_id", "g", "root").join(sizes, "g")
    inside = F.col("root") == F.col("main")
    h = F.xxhash64("doc_id")
    rows = rows.withColumn("block", F.when(inside, F.col("outer") + F.pmod(h, F.col("inner"))).otherwise(F.pmod(h, F.col("outer"))).cast("int"))
    one = rows.filter(~inside).withColumn("y", F.explode(F.sequence(F.col("block"), F.col("outer") + F.col("inner") - 1))) \
        .select("doc_id", "g", F.col("block").alias("x"), "y", F.when(F.col("y") == F.col("block"), -1).otherwise(0).alias("side"))
    stop = F.least(F.col("block"), F.col("outer")) - 1
    two = rows.filter("block > 0").withColumn("x", F.explode(F.sequence(F.lit(0), stop))) \
        .select("doc_id", "g", "x", F.col("block").alias("y"), F.lit(1).alias("side"))
    return one.unionAll(two).select(*_SIDES)


def _components_of(texts: DataFrame, width: int, percent: int, work: Work) -> DataFrame:
    sk = work.table(texts.mapInArrow(_signatures(width, percent), "doc_id long, n long, print binary, keys array<long>"),
                    "signatures")
    reps = work.table(sk.filter("n > 0").groupBy("print").agg(F.min("doc_id").alias("rep")), "reps")
    members = work.table(sk.join(reps.select(F.col("rep").alias("doc_id")), "doc_id")
                         .select("doc_id", F.explode("keys").alias("key")), "members")
    # most keys are of one document: they go before the join moves any
    repeated = work.table(members.groupBy("key").agg(F.count(F.lit(1)).alias("m")).filter("m > 1").select("key"), "repeated")
    met = KeyFilter(repeated, "key", FILTER_BITS).holds("key")
    members = work.table(members.filter(met).join(repeated, "key", "left_semi").select("doc_id", "key"), "met")
    # lists with the same members are one: only the smallest key of them stays
    shared = members.groupBy("key").agg(
        F.count(F.lit(1)).alias("m"), F.min("doc_id").alias("low"), F.bit_xor(F.xxhash64("doc_id")).alias("x"),
        F.bit_xor(F.xxhash64("doc_id", F.lit(1))).alias("y")).filter("m > 1")
    shared = work.table(shared.groupBy("m", "low", "x", "y").agg(F.min("key").alias("key")).select("key", "low"), "shared")
    lists = work.table(members.join(shared, "key"), "lists")
    family = components(lists.filter("low < doc_id"), work, "doc_id", "low")
    sizes = work.table(family.groupBy("root").agg(F.count(F.lit(1)).alias("m")), "families")
    family = work.table(family.join(sizes, "root").select(F.col("node").alias("doc_id"), F.col("root").alias("family"), "m"),
                        "family")
    # most texts have no partner: they go before the join moves any
    partnered = KeyFilter(family, "doc_id", FILTER_BITS).holds("doc_id")
    full = work.table(texts.filter(partnered).join(family.select("doc_id"), "doc_id", "left_semi"), "texts")
    smallest = work.table(full.mapInArrow(_smallest(width), "doc_id long, n long, smallest array<long>"), "smallest")

    # families, or the lists of very large ones, dealt into blocks
    large = lists.join(family.filter(F.col("m") > FAMILY).select("doc_id"), "doc_id")
    groups = family.filter(F.col("m") <= FAMILY).select(F.struct(F.lit(0).alias("kind"), F.col("family").alias("key")).alias("g"),
                                                        "doc_id") \
        .unionAll(large.select(F.struct(F.lit(1).alias("kind"), F.col("key")).alias("g"), "doc_id"))
    groups = work.table(groups, "groups")
    counts = work.table(groups.groupBy("g").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("nb")), "blocks")
    asks = [_hub(groups.join(counts, "g"))]
    links = roots = checked = None
    for turn in range(3):
        every = turn == 2
        data = smallest.withColumn("root", F.col("doc_id"))
        if turn:  # components are known now: what lies in one of them needs no comparison
            data = work.table(smallest.join(roots, F.col("doc_id") == F.col("node"), "left").select(
                "doc_id", "n", "smallest", F.coalesce("root", "doc_id").alias("root")), "rooted")
            state = work.table(groups.join(counts, "g").join(data.select("doc_id", "root", "n"), "doc_id"), "state")
            asks.append(_rest(state, f"n > {WHOLE}" if every else "nb > 1", work))
        pairs = work.table(asks[-1].join(data, "doc_id").groupBy("g", "x", "y")
                           .applyInArrow(_block_links(percent, every), "a long, b long, sure boolean").distinct(), "pairs")
        unsure = pairs.filter("NOT sure").select("a", "b")
        if checked is not None:
            unsure = unsure.join(checked.select("a", "b"), ["a", "b"], "left_anti")
        ta = full.select(F.col("doc_id").alias("a"), F.col("text").alias("ta"))
        tb = full.select(F.col("doc_id").alias("b"), F.col("text").alias("tb"))
        done = work.table(unsure.join(tb, "b").join(ta, "a").select("a", "b", "ta", "tb")
                          .mapInArrow(_confirm(width, percent), "a long, b long, linked boolean"), "confirmed")
        new = done.filter("linked").select("a", "b").unionAll(pairs.filter("sure").select("a", "b"))
        if turn and new.limit(1).count() == 0:
            continue
        links = new if links is None else links.unionAll(new)
        checked = done if checked is None else checked.unionAll(done)
        roots = work.table(components(links, work), "roots")

    final = reps.join(roots, F.col("rep") == F.col("node"), "left") \
        .select(F.col("print").alias("rp"), F.coalesce("root", "rep").alias("c"))
    final = work.table(final, "final")
    return sk.join(final, F.col("print") == F.col("rp"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("c", "doc_id").alias("component_id"))
