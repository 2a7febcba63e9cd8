"""Repeated bytes and words against brute force."""

import hashlib
import random

import brute
import cases
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from homeward.llm import substring_dedup, suffix_dedup
from homeward.llm.anchors import BYTES, WORDS, segments
from homeward.llm.common import sliding_min, word_arrays


def test_bytes(spark):
    rows = [r for r in cases.documents() if r[1] is None or len(r[1]) < 40_000]
    got = suffix_dedup.remove_repeats(cases.clashing(cases.table(spark, rows)), digest=True).collect()
    want = brute.repeated_bytes([t for _, t, _ in rows])
    assert sorted((tuple(r) for r in got), key=str) == sorted(((i, *w) for (i, _, _), w in zip(rows, want)), key=str)


def rolled_bytes(texts, k):
    """``brute.repeated_bytes`` in time linear in the texts: windows by a
    rolling hash modulo a large prime."""
    prime, base = (1 << 127) - 1, 0x1F3D5B79_2468ACE1
    top = pow(base, k - 1, prime)
    data, hashes, seen = [(t or "").encode() for t in texts], [], {}
    for d in data:
        h, own = 0, []
        for i, c in enumerate(d):
            if i >= k:
                h -= (d[i - k] + 1) * top
            h = (h * base + c + 1) % prime
            if i >= k - 1:
                own.append(h)
                seen[h] = seen.get(h, 0) + 1
        hashes.append(own)
    out = []
    for d, own in zip(data, hashes):
        kept, end, removed, spans = bytearray(), 0, 0, 0
        for i, c in enumerate(d):
            if i < len(own) and seen[own[i]] > 1:
                spans += end < i or not i
                end = i + k
            if i < end:
                removed += 1
            else:
                kept.append(c)
        out.append((len(d), removed, spans, hashlib.sha256(kept).hexdigest()))
    return out


def check_all_bytes(spark, piece=7001):
    r = random.Random(9)
    a, b, c, d, passage = ("".join(r.choice("abcdefgh ") for _ in range(n)) for n in (piece - 200, 9000, 21_000, 500, 420))
    # a passage over a cut
    rows = [*cases.documents(), (30, a + passage + b, None), (31, c + passage + d, None)]
    got = suffix_dedup.remove_repeats(cases.clashing(cases.table(spark, rows)), digest=True).collect()
    want = rolled_bytes([t for _, t, _ in rows], 400)
    assert sorted((tuple(r) for r in got), key=str) == sorted(((i, *w) for (i, _, _), w in zip(rows, want)), key=str)
    by = {r.doc_id: r for r in got}
    # the very long text, the long word and the periodic text lose bytes
    assert all(by[i].n_removed for i in (12, 15, 19, 30, 31))


def test_rolled_bytes():
    r = random.Random(8)
    texts = [None, "", *("".join(r.choice("abé") for _ in range(r.randrange(90))) for _ in range(20)), "ab" * 40]
    assert rolled_bytes(texts, 7) == brute.repeated_bytes(texts, 7)


def test_bytes_of_all_texts(spark):
    check_all_bytes(spark)


def test_bytes_of_all_texts_in_pieces(spark, monkeypatch):
    from homeward.llm import anchors

    whole = anchors.map_arrow

    def lowered(df, function, schema):
        def run(batches):
            # in the worker, for this task
            from homeward.llm import anchors

            before = anchors.PIECE, anchors.SLICE_BYTES
            anchors.PIECE, anchors.SLICE_BYTES = 7001, 5000
            try:
                yield from function(batches)
            finally:
                anchors.PIECE, anchors.SLICE_BYTES = before

        return whole(df, run, schema)

    monkeypatch.setattr(anchors, "map_arrow", lowered)
    check_all_bytes(spark)


@pytest.mark.parametrize("seed", range(3))
def test_bytes_of_a_small_alphabet(spark, seed):
    # short strings repeat inside and across texts, hot ones in most of them
    r = random.Random(seed)
    hot = "".join(r.choice("ab") for _ in range(80))
    rows = [(i, "".join(r.choice(["a", "b", hot[r.randrange(40) :], "é"]) for _ in range(r.randrange(30))), None) for i in range(60)]
    got = suffix_dedup.remove_repeats(cases.table(spark, rows), span=40, anchor=12).collect()
    want = dict(zip([i for i, _, _ in rows], brute.repeated_bytes([t for _, t, _ in rows], 40)))
    for x in got:
        assert (x.n_bytes, x.n_removed, x.n_spans) == want[x.doc_id][:3]


def test_bytes_over_a_boundary(spark, monkeypatch):
    # many buckets for few suffixes: equal ones straddle them
    hot = "".join(random.Random(5).choice("abcdefgh") for _ in range(70))
    rows = [(i, f"{i:03d}" * 4 + hot + f"{i:04d}" * 4, None) for i in range(80)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "61")
    try:
        got = suffix_dedup.remove_repeats(cases.table(spark, rows), span=40, anchor=12).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want = brute.repeated_bytes([t for _, t, _ in rows], 40)
    assert sorted(x[:3] for x in want) == sorted((x.n_bytes, x.n_removed, x.n_spans) for x in got)


def test_words(spark):
    rows = cases.documents()
    got = substring_dedup.remove_repeats(cases.clashing(cases.table(spark, rows)), digest=True).collect()
    want = brute.repeated_words([(i, t) for i, t, _ in rows])
    assert sorted((tuple(r) for r in got), key=str) == sorted(((i, *w) for (i, _, _), w in zip(rows, want)), key=str)


@pytest.mark.parametrize("seed", range(3))
def test_words_of_a_small_vocabulary(spark, seed):
    r = random.Random(seed)
    hot = [f"h{r.randrange(9)}" for _ in range(40)]
    rows = []
    for i in range(60):
        text = []
        for _ in range(r.randrange(8)):
            a = r.randrange(30)
            text += hot[a : a + r.randrange(30)] if r.random() < 0.7 else cases.words((seed, i).__hash__(), 6, 12)
        rows.append((r.randrange(40), " ".join(text), None))
    got = substring_dedup.remove_repeats(cases.table(spark, rows), span=10, seed=4, digest=True).collect()
    want = brute.repeated_words([(i, t) for i, t, _ in rows], 10)
    assert sorted(tuple(x) for x in got) == sorted((i, *w) for (i, _, _), w in zip(rows, want))


def test_maximal_repeats(spark):
    rows = [(1, " ".join(f"a{i}" for i in range(90)), None), (2, "x y " + " ".join(f"a{i}" for i in range(10, 80)) + " z", None)]
    got = [tuple(r) for r in substring_dedup.maximal_repeats(cases.table(spark, rows)).collect()]
    assert got == [(2, 2, 72)]


def test_empty_tables(spark):
    assert suffix_dedup.remove_repeats(cases.empty(spark)).count() == 0
    assert substring_dedup.remove_repeats(cases.empty(spark)).count() == 0
    assert substring_dedup.maximal_repeats(cases.empty(spark)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=60), max_size=5), st.integers(2, 9), st.integers(0, 8))
def test_segments_cover_each_window_once(texts, k, more):
    span = k + more
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    values, at = BYTES.read(data, offsets)
    text, start, n, _, _ = segments(values, at, span, k, BYTES.powers)
    got = sorted((int(t), int(s) + i) for t, s, c in zip(text, start, n) for i in range(c))
    assert got == [(t, s) for t, x in enumerate(texts) for s in range(len(x) - span + 1)]


def test_long_texts_in_pieces(monkeypatch):
    from homeward.llm import anchors

    data = np.frombuffer(random.Random(1).randbytes(5000), np.uint8)
    values, at = BYTES.read(data, np.array([0, 5000]))
    monkeypatch.setattr(anchors, "PIECE", 700)
    text, start, n, _, _ = segments(values, at, 40, 12, BYTES.powers)
    assert sorted(int(s) + i for s, c in zip(start, n) for i in range(c)) == list(range(5000 - 39))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\t\x0bé\u2003", max_size=20), max_size=6))
def test_word_arrays(texts):
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in raw])]).astype(np.int64)
    starts, hashes, at = word_arrays(data, offsets)
    want = [w for t in texts for w in brute.WORD.findall(t)]
    assert len(starts) == len(want) and np.diff(at).tolist() == [len(brute.WORD.findall(t)) for t in texts]
    seen = {}
    for w, h in zip(want, hashes.tolist()):
        assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)
    assert WORDS.read(data, offsets)[1].tolist() == at.tolist()


@given(st.lists(st.integers(0, 50), max_size=60), st.integers(1, 12))
def test_sliding_min(values, w):
    x = np.array(values, np.uint64)
    assert sliding_min(x, w).tolist() == [min(values[i : i + w]) for i in range(len(values) - w + 1)]


@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3), st.integers(0, 99)), max_size=80))
def test_multikey_quicksort(rows):
    keys = [np.array([r[i] for r in rows], np.int64) for i in range(3)]
    assert [rows[i] for i in suffix_dedup.multikey_quicksort(keys)] == sorted(rows)


def test_multikey_quicksort_of_many():
    r = np.random.default_rng(1)
    keys = [r.integers(0, 4, 60_000), r.integers(0, 300, 60_000), r.integers(-(2**62), 2**62, 60_000)]
    assert (suffix_dedup.multikey_quicksort(keys) == np.lexsort(keys[::-1])).all()


def test_many_equal_rows_without_id(spark):
    """3,000 times the same row: the work of one text and a result for each."""
    text = " ".join(cases.words(91, 2500, 40_000))
    row = spark.createDataFrame([(None, text, None), (5, "other " + text, None)], cases.SCHEMA)
    rows = row.where("doc_id is null").withColumn("_n", F.explode(F.sequence(F.lit(1), F.lit(3000)))).drop("_n")
    rows = rows.unionAll(row.where("doc_id = 5")).repartition(8)
    n = len(text.encode())
    got = suffix_dedup.remove_repeats(rows).groupBy("doc_id", "n_bytes", "n_removed", "n_spans").count().collect()
    assert sorted(map(tuple, got), key=str) == sorted([(None, n, n, 1, 3000), (5, n + 6, n, 1, 1)], key=str)
    got = substring_dedup.remove_repeats(rows).groupBy("doc_id", "n_words", "n_removed").count().collect()
    # ids that are null come after all others
    assert sorted(map(tuple, got), key=str) == sorted([(None, 2500, 2500, 3000), (5, 2501, 0, 1)], key=str)
