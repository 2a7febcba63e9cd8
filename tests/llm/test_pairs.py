"""N-gram Jaccard join and benchmark decontamination against brute force."""

import math
import random
from collections import Counter

import brute
import cases
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from homeward.llm import decontaminate, jaccard_join
from homeward.llm.common import word_arrays
from homeward.llm.components import connected_components


def links(rows, threshold=0.8):
    """(id, class, links) of each row, by comparing all pairs."""
    sets = [brute.shingles(t) for _, t, *_ in rows]
    ids = [math.inf if r[0] is None else r[0] for r in rows]
    root = list(range(len(rows)))
    count = Counter()

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both >= threshold * (len(sets[i]) + len(sets[j]) - both) - 1e-9:
                count[i] += 1
                count[j] += 1
                root[find(i)] = find(j)
    least = {}
    for i in range(len(rows)):
        least[find(i)] = min(least.get(find(i), math.inf), ids[i])
    return sorted((ids[i], least[find(i)], count[i]) for i in range(len(rows)))


def found(df):
    return sorted((math.inf if r.doc_id is None else r.doc_id, math.inf if r.class_id is None else r.class_id, r.n_links) for r in df.collect())


def near_copies(seed, groups=6, size=14, words=80):
    """Groups of copies with a few changed words, similar or not quite."""
    r = random.Random(seed)
    rows = []
    for g in range(groups):
        base = cases.words((seed, g).__hash__(), words, 2000)
        for _ in range(size):
            w = list(base)
            for _ in range(r.randrange(4)):
                w[r.randrange(words)] = f"new{r.randrange(30)}"
            rows.append((len(rows), " ".join(w), None))
    return rows


def test_links_of_awkward_documents(spark):
    rows = cases.documents()
    df = cases.clashing(cases.table(spark, rows))
    assert found(jaccard_join.jaccard_links(df)) == links(rows)
    kept = jaccard_join.one_of_each(df)
    assert kept.columns == df.columns
    ids = sorted((r.doc_id is None, r.doc_id or 0) for r in kept.select("doc_id").collect())
    # 7 copies 6, 8 is near 6; of the rows without id one stays
    assert ids == [(False, i) for i in range(1, 21) if i not in (7, 8)] + [(True, 0)]


@pytest.mark.parametrize("seed", range(2))
def test_links_of_near_copies(spark, seed):
    rows = near_copies(seed)
    assert found(jaccard_join.jaccard_links(cases.table(spark, rows))) == links(rows)
    # a group over many blocks of a few texts gives the same
    small = jaccard_join.JoinSpec(block_texts=3)
    assert found(jaccard_join.jaccard_links(cases.table(spark, rows), small)) == links(rows)


def test_one_of_each_goes_by_the_class(spark):
    a, b, c = (" ".join(cases.words(80 + i, 60, 5000)) for i in range(3))
    near = a + " more"
    rows = [
        (1, a, "a"), (1, b, "b"), (2, near, "near a"), (3, b, "copy of b"),  # one id, two texts
        (None, c, "c"), (None, c + " more", "near c"),
        (4, "", "empty"), (4, "", "empty"), (None, None, "null"), (None, " \t", "blank"), (None, " \t", "blank"),
    ]
    left = Counter(r.lang for r in jaccard_join.one_of_each(cases.table(spark, rows)).collect())
    assert left.pop("c", 0) + left.pop("near c", 0) == 1
    assert left == {"a": 1, "b": 1, "empty": 2, "null": 1, "blank": 2}


def test_no_documents(spark):
    assert jaccard_join.jaccard_links(cases.empty(spark)).count() == 0
    assert jaccard_join.one_of_each(cases.empty(spark)).count() == 0


def test_pruning_rarely_drops_a_pair_at_the_threshold():
    spec = jaccard_join.JoinSpec()
    least = np.array(jaccard_join.least_matches(spec))
    r = np.random.default_rng(3)
    agree = r.random((200_000, spec.hashes)) < spec.threshold
    matches = np.cumsum(agree, axis=1)[:, jaccard_join.STEP - 1 :: jaccard_join.STEP]
    assert (matches >= least[1:]).all(axis=1).mean() > 0.9999
    far = np.cumsum(r.random((20_000, spec.hashes)) < 0.3, axis=1)[:, jaccard_join.STEP - 1 :: jaccard_join.STEP]
    assert not (far >= least[1:]).all(axis=1).any()


def test_minhash_estimates_similarity():
    r = np.random.default_rng(1)
    both, own = r.integers(0, 2**63, 800, np.uint64), r.integers(0, 2**63, 200, np.uint64)
    flat = np.concatenate([both, own, both])
    s = jaccard_join.minhash(flat, np.array([0, 1000, 1800]), 288)
    assert abs((s[0] == s[1]).mean() - 0.8) < 0.1


def test_components(spark):
    r = random.Random(2)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5, 5)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    got = {x.vertex: x.root for x in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {v: find(v) for a, b in edges if a != b for v in (a, b)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- decontamination --------------------------------------------------------


def plain_tiles(a, b, least):
    """Greedy string tiling by trying every pair of places."""
    free_a, free_b, out = [True] * len(a), [True] * len(b), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and free_a[i + n] and free_b[j + n]:
                    n += 1
                best = max(best, (n, -i, -j))
        n, i, j = best[0], -best[1], -best[2]
        if n < least:
            return out
        free_a[i : i + n] = free_b[j : j + n] = [False] * n
        out += n


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from("abcd"), max_size=24), st.lists(st.sampled_from("abcd"), max_size=24), st.integers(1, 4))
def test_tiles(a, b, least):
    codes = {c: np.uint64(i * 0x9E3779B97F4A7C15 % 2**64) for i, c in enumerate("abcd", 1)}
    x, y = (np.array([codes[c] for c in s], np.uint64) for s in (a, b))
    found = decontaminate.tiles(x, y, least)
    for i, j, n in found:
        assert n >= least and a[i : i + n] == b[j : j + n]
    for side in (0, 1):
        places = [p for t in found for p in range(t[side], t[side] + t[2])]
        assert len(places) == len(set(places))
    # ties may be laid otherwise, but the longest match is always a tile and
    # no free match is left
    left_a = [c if not any(t[0] <= i < t[0] + t[2] for t in found) else ("a", i) for i, c in enumerate(a)]
    left_b = [c if not any(t[1] <= i < t[1] + t[2] for t in found) else ("b", i) for i, c in enumerate(b)]
    assert plain_tiles(left_a, left_b, least) == 0
    if found:
        assert max(t[2] for t in found) == max(n for n in range(1, 25) if any(a[i : i + n] == b[j : j + n] and len(a[i : i + n]) == n for i in range(len(a)) for j in range(len(b)) if j + n <= len(b)))


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_contaminated_documents(spark):
    item = cases.words(50, 40, 5000)
    reordered = item[24:40] + cases.words(51, 9) + item[8:24] + ["x"] + item[:8]
    half = item[:20]
    rows = [
        (1, " ".join(cases.words(52, 50) + item + cases.words(53, 50)), None),
        (2, " ".join(reordered), None),
        (3, " ".join(half), None),
        (4, " ".join(item[:19]), None),
        (5, " ".join(cases.words(54, 500)), None),
        (6, ", ".join(w.upper() for w in item) + "!", None),
        (7, " ".join(x for i in range(0, 40, 4) for x in item[i : i + 4] + ["y"]), None),  # no five words in a row
        (8, " ".join(cases.words(55, 40_000, 60_000) + item), None),
        (9, None, None),
        (10, "", None),
        (1, " ".join(item), None),
        (None, " ".join(item), None),
    ]
    benchmark = items(spark, [(0, " ".join(item)), (0, " ".join(item)), (1, None), (2, ""), (3, "the few words"), (None, " ".join(cases.words(60, 30, 5000)))])
    got = decontaminate.contaminated(cases.clashing(cases.table(spark, rows)), benchmark).collect()
    assert Counter((r.doc_id, r.item_id) for r in got) == {(1, 0): 4, (2, 0): 2, (3, 0): 2, (6, 0): 2, (8, 0): 2, (None, 0): 2}
    by = {r.doc_id: (r.coverage, r.n_tiles, r.n_words) for r in got}
    assert by[2] == (1.0, 3, 40) and by[3] == (0.5, 1, 20)
    clean = decontaminate.clean(cases.clashing(cases.table(spark, rows)), benchmark)
    assert sorted(r.doc_id for r in clean.collect()) == [4, 5, 7, 9, 10]
    assert clean.columns == cases.clashing(cases.table(spark, rows)).columns
    assert decontaminate.clean(cases.table(spark, rows), items(spark, [])).count() == len(rows)
    assert decontaminate.clean(cases.empty(spark), benchmark).count() == 0


def test_items_shorter_than_a_seed(spark):
    rows = [(1, "So the few, Words! the few words", None), (2, "the few", None), (3, "words of the few", None), (4, "x " * 9, None), (5, "the", None), (6, "few words the", None), (7, None, None)]
    benchmark = items(spark, [(0, "the few words"), (1, "THE FEW WORDS"), (2, "the"), (3, ""), (4, "words of the few"), (5, None), (6, "x x")])
    got = decontaminate.contaminated(cases.table(spark, rows), benchmark).collect()
    want = {(1, 0), (1, 1), (1, 2), (2, 2), (3, 2), (3, 4), (4, 6), (5, 2), (6, 2)}
    assert Counter((r.doc_id, r.item_id) for r in got) == dict.fromkeys(want, 1)
    assert all((r.coverage, r.n_tiles) == (1.0, 1) for r in got) and {r.item_id: r.n_words for r in got} == {0: 3, 1: 3, 2: 1, 4: 4, 6: 2}
    assert [r.doc_id for r in decontaminate.clean(cases.table(spark, rows), benchmark).collect()] == [7]


def greedy_tiles(a, b, least):
    """The longest free match, the first of equal ones, until none is left."""
    a, b, out = list(a), list(b), []
    while True:
        best = (least - 1, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] is not None and a[i + n] == b[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return out
        a[i : i + n] = [None] * n
        b[j : j + n] = [None] * n
        out.append((i, j, n))


def test_tiles_are_strictly_greedy():
    r = random.Random(5)
    for _ in range(1500):
        letters, least = r.choice("23456"), r.randrange(1, 5)
        a, b = ([r.randrange(int(letters)) for _ in range(r.randrange(1, 30))] for _ in range(2))
        x, y = (np.array(v, np.uint64) + np.uint64(17) for v in (a, b))
        assert decontaminate.tiles(x, y, least) == greedy_tiles(a, b, least)


def test_filter_of_any_size_finds_the_same(spark):
    item = [" ".join(cases.words(70 + i, 30, 5000)) for i in range(9)] + ["w1 w2", "w3"]
    rows = [(i, f"before {t} after", None) for i, t in enumerate(item)] + [(50, " ".join(item), None)] * 3 + [(60, " ".join(cases.words(80, 3000, 5000)), None)]
    benchmark = items(spark, [*enumerate(item), (20, item[0])])
    whole = decontaminate.tiled_hits(cases.table(spark, rows), benchmark)
    full = decontaminate.tiled_hits(cases.table(spark, rows), benchmark, most_bits=1024)  # nearly all bits are set
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, full.collect()))
    got = Counter((r.doc_id, r.item_id) for r in decontaminate.contaminated(cases.table(spark, rows), benchmark).collect())
    folded = [f" {t} " for t in item]
    want = Counter((d, m) for d, t, _ in rows for m, x in [*enumerate(folded), (20, folded[0])] if x in f" {t} ")
    assert got == want and got[50, 20] == 3


def test_folded_words():
    data = np.frombuffer("The CAT, sat-down.\nThe cat sat down".encode(), np.uint8)
    words, _ = decontaminate.folded_words(data, np.array([0, len(data)]))
    assert words[:4].tolist() == words[4:].tolist()
    assert len(word_arrays(data, np.array([0, len(data)]))[0]) == 7
