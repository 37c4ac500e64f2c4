import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from entwise.llm import near_dedup as nd

from .conftest import with_clashes, words

WORD = r"[^\x20\x09-\x0D]+"


def brute(rows, n, percent):
    """Components by comparing all pairs that share a rare shingle (prefix filter)."""
    sets, up = {}, {}
    for i, t in rows:
        w = words(WORD, t)
        sets[i] = frozenset(tuple(w[j:j + n]) for j in range(len(w) - n + 1)) if len(w) >= n else \
            frozenset([tuple(w)] if w else [])
        up[i] = i

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    df = Counter(x for s in sets.values() for x in s)
    lists = defaultdict(list)
    for i in sorted(sets, key=lambda i: len(sets[i])):
        s, seen = sets[i], set()
        prefix = sorted(s, key=lambda x: (df[x], x))[:len(s) - math.ceil(percent * len(s) / 100) + 1]
        for x in prefix:
            for j in lists[x]:
                if j not in seen:
                    seen.add(j)
                    k = len(s & sets[j])
                    if 100 * k >= percent * (len(s) + len(sets[j]) - k):
                        a, b = root(i), root(j)
                        up[max(a, b)] = min(a, b)
            lists[x].append(i)
    return {i: (len(sets[i]), root(i), root(i) == i) for i in sets}


def ours(df, n, percent):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in nd.near_duplicates(df, n, percent).collect()}


def synthetic(hot=150):
    rnd = random.Random(5)
    vocabulary = [f"w{i}" for i in range(200)]

    def edited(text, k):
        w = text.split()
        for _ in range(k):
            i = rnd.randrange(len(w))
            w[i:i + rnd.choice([0, 1])] = rnd.choices(vocabulary, k=rnd.choice([0, 1, 1]))
            w = w or ["x"]
        return " ".join(w)
    rows = []
    for length in (3, 6, 7, 8, 10, 20, 60, 300):
        base = " ".join(rnd.choices(vocabulary, k=length))
        rows += [edited(base, rnd.randint(0, max(1, length // 25))) for _ in range(10)]
    base = " ".join(rnd.choices(vocabulary, k=140))      # one large group of near copies
    rows += [edited(base, rnd.randint(1, 4)) for _ in range(hot)]
    line = " ".join(rnd.choices(vocabulary, k=12))       # one line that many documents share
    rows += [line + " " + " ".join(rnd.choices(vocabulary, k=rnd.randint(5, 60))) for _ in range(hot)]
    rows += [None, "", " \n", "A b C", "a B c", "one", "ONE", "two w", "two  W"]
    return list(enumerate(rows))


@pytest.mark.parametrize("n,percent", [(3, 85), (5, 80)])
def test_components_equal_brute_force(spark, n, percent):
    rows = synthetic()
    df = with_clashes(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert ours(df, n, percent) == brute(rows, n, percent)


def test_small_blocks_and_long_sets(spark, monkeypatch):
    # everything is long, groups are cut into many blocks, families beyond the limit
    for name, value in (("BLOCK", 40), ("FAMILY", 30), ("WHOLE", 30), ("LONG_SLACK", 0.16)):
        monkeypatch.setattr(nd, name, value)
    rows = synthetic(60)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert ours(df, 3, 85) == brute(rows, 3, 85)


def test_whole_table(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert ours(documents, 3, 85) == brute(rows, 3, 85)


def test_short_run_is_certain():
    assert nd._short_run(85) == 3 and nd._short_run(80) == 2


def test_edge_cases(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert nd.near_duplicates(empty).count() == 0
    df = spark.createDataFrame([(1, "a b c d"), (1, "a b c d"), (2, "a B c d"), (None, "a b c d"), (3, None),
                                (3, None)], "doc_id long, text string")
    got = sorted(map(tuple, nd.near_duplicates(df, 3, 85).collect()))
    assert [g[:3] for g in got] == [(1, 2, 1), (1, 2, 1), (2, 2, 1), (3, 0, 3), (3, 0, 3)]
    assert [g[3] for g in got].count(True) == 3      # one of the three copies, and both texts without words


def thue_morse(n):
    word = "a"
    while len(word) < n:
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_long_words_of_equal_structure_are_told_apart(spark):
    a, b = thue_morse(1024)
    c, d = thue_morse(2048)
    rows = [(1, a), (2, b), (3, c), (4, d), (5, a)]
    got = {r.doc_id: r.component_id for r in nd.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 4, 5: 1}


@pytest.mark.parametrize("percent,width", [(85, 3), (80, 5)])
def test_a_text_cut_short_at_the_threshold_is_linked(spark, percent, width):
    """One set inside the other, exactly at the threshold: the widest spread of the estimate."""
    rows, n = [], 2000
    for seed in range(8):
        rnd = random.Random(8434 + seed)
        text = [f"{rnd.getrandbits(40):x}" for _ in range(n + width - 1)]
        rows += [(2 * seed, " ".join(text)), (2 * seed + 1, " ".join(text[:n * percent // 100 + width - 1]))]
    got = {r.doc_id: r.component_id for r in nd.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width, percent).collect()}
    assert got == {i: i // 2 * 2 for i in range(16)}


@pytest.mark.parametrize("percent", [85, 80])
def test_chance_to_miss_a_nested_pair_at_the_threshold(percent):
    """The estimate filter's tail, and common runs, over random nested sketches."""
    k, limit = nd.K, (percent / 100 - nd.SLACK) * nd.K
    below = sum(math.comb(k, x) * (percent / 100) ** x * (1 - percent / 100) ** (k - x) for x in range(math.ceil(limit)))
    assert below < 2e-9
    # a quarter of the lists: what it misses happens to all four with the fourth power
    rng = np.random.default_rng(percent)
    missed = 0
    for _ in range(4000):
        big = np.sort(rng.integers(0, 1 << 62, 2000).astype(np.uint64))
        small = np.sort(rng.permutation(big)[:2000 * percent // 100])
        keys = [set(nd.list_keys(x[:k], len(x), nd.RUN)[:nd.LISTS // 4].tolist()) for x in (big, small)]
        missed += not keys[0] & keys[1]
    assert (max(missed, 1) / 4000) ** 4 < 5e-9


def test_many_blocks_with_several_components(spark, monkeypatch):
    """Small blocks: families of many blocks, in which some members link to none of the first."""
    monkeypatch.setattr(nd, "BLOCK", 6)
    rnd = random.Random(11)
    line = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(90):                      # near copies of one text, a chain of slow change, and bystanders with its half
        words_ = list(line)
        for _ in range(rnd.randint(0, 3)):
            words_[rnd.randrange(60)] = f"x{rnd.randrange(1000)}"
        rows.append((i, " ".join(words_)))
    for i in range(40):
        rows.append((200 + i, " ".join([f"c{j}" for j in range(i, i + 40)])))
        rows.append((300 + i, " ".join(line[:30] + [f"{i}o{j}" for j in range(9)])))
    got = ours(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85)
    assert got == brute(rows, 3, 85) and len({c for _, c, _ in got.values()}) > 10


def test_rows_compared_grow_with_a_group_not_with_its_square(spark, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK", 8)
    made = {}
    for m in (80, 320):
        rows = spark.range(m).selectExpr("id AS doc_id", "named_struct('kind', 0, 'key', 1L) AS g", f"{m // 8} AS nb")
        made[m] = nd._hub(rows).count()
    assert made[320] <= 4.2 * made[80]


def test_key_filters_are_small_enough_for_the_driver(spark, monkeypatch):
    """A filter of 2 MB, serialized with each closure, took 300 MB of the driver's heap."""
    made = []

    class Recorded(nd.KeyFilter):
        def __init__(self, *args):
            super().__init__(*args)
            made.append(self.bits)

    monkeypatch.setattr(nd, "KeyFilter", Recorded)
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text), (2, text + " end"), (3, "something else entirely here now")]
    found = nd.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.component_id for r in found.collect()} == {1: 1, 2: 1, 3: 3}
    assert len(made) == 2 and max(made) <= nd.FILTER_BITS == 1 << 23
