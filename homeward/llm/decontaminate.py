"""Benchmark decontamination by greedy string tiling.

Words of a text and of a benchmark item are compared after ASCII letters are
lower-cased and ASCII punctuation is taken as space.  A text and an item
that share a seed (``seed`` consecutive words) are tiled: the longest
matches of words not yet marked on either side are marked first, found by
running Karp-Rabin (hashes of all windows of one length, halved from round
to round), down to tiles of ``seed`` words.  The share of the item's words
under tiles is its coverage; tiles may lie anywhere, so a passage whose
parts were reordered is caught.  A text is contaminated by every item with
``coverage`` or more.

Neither side passes through the driver.  Distinct items are written as a
table of their seeds, with a Bloom filter over them of at most ``FILTER_BITS``
bits (16 MB), which is all that is broadcast.  A map over the texts keeps the
seeds that pass the filter; they meet the item seeds in a join on the seed,
which settles the filter's false positives.  A pair of text and item whose
seeds could reach the coverage is tiled, which loses none: every tile consists
of seeds.  Equal texts, and equal items, are tiled once, under a key of two
hashes of the text.

Null texts and items have no word; an item without words contaminates
nothing.  An item with fewer words than a seed contaminates the texts that
hold its whole word sequence, as one tile.  An empty benchmark leaves all
texts clean.
Repeated rows get equal rows; items with the same id are tested one by one.
Texts are read whole.  Item ids may be null and are then null in the result.
"""

from __future__ import annotations

import heapq
import string
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import U64, WORD_POWERS, Rolling, flat_text, map_arrow, mix, stage_table, text_slices, word_arrays

SLICE_BYTES = 1 << 18
FILTER_BITS = 1 << 27  # most bits of the filter
BITS_OF_SEED = 32

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[[ord(c) for c in string.punctuation]] = 32
_FOLD[65:91] += 32


@dataclass(frozen=True)
class TilingSpec:
    seed: int = 5
    coverage: float = 0.5


def folded_words(data: np.ndarray, offsets: np.ndarray):
    _, words, at = word_arrays(_FOLD[data], offsets)
    return words, at


def tiles(a: np.ndarray, b: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two word arrays: (place in a, place in b,
    words) of each tile, of ``least`` words or more.  Every tile is the
    longest match that is free when it is marked, of equal ones the first
    in a, then in b."""
    rolling_a, rolling_b = Rolling(a, WORD_POWERS), Rolling(b, WORD_POWERS)
    free_a, free_b = np.ones(len(a), bool), np.ones(len(b), bool)
    out = []
    length = max(least, min(len(a), len(b)))
    while True:
        waiting = [(-n, i, j) for i, j, n in _matches(a, b, rolling_a, rolling_b, free_a, free_b, length)]
        heapq.heapify(waiting)
        while waiting:
            n, i, j = heapq.heappop(waiting)
            free = free_a[i : i - n] & free_b[j : j - n]
            if free.all():
                free_a[i : i - n] = free_b[j : j - n] = False
                out.append((i, j, -n))
                continue
            # what longer tiles left of it takes its place among the others
            edges = np.flatnonzero(np.diff(np.concatenate([[0], free.astype(np.int8), [0]])))
            for start, end in edges.reshape(-1, 2).tolist():
                if end - start >= length:
                    heapq.heappush(waiting, (start - end, i + start, j + start))
        if length <= least:
            return out
        length = max(least, length // 2)


def _matches(a, b, rolling_a, rolling_b, free_a, free_b, length) -> list[tuple[int, int, int]]:
    """Maximal matches of ``length`` or more free words, the longest first,
    of equal ones the first."""
    if length > min(len(a), len(b)):
        return []

    def windows(rolling, free):
        whole = np.concatenate([[0], np.cumsum(free)])
        at = np.flatnonzero(whole[length:] - whole[:-length] == length)
        return at, rolling.windows(length)[at]

    at_a, h_a = windows(rolling_a, free_a)
    at_b, h_b = windows(rolling_b, free_b)
    order = np.argsort(h_b, kind="stable")
    h_b, at_b = h_b[order], at_b[order]
    low, high = np.searchsorted(h_b, h_a, "left"), np.searchsorted(h_b, h_a, "right")
    hit = high > low
    n = (high - low)[hit]
    i = np.repeat(at_a[hit], n)
    j = at_b[np.repeat(low[hit] - np.cumsum(n) + n, n) + np.arange(n.sum())]
    # on each diagonal, hits that follow one another are one match
    order = np.lexsort((i, i - j))
    i, j = i[order], j[order]
    if not len(i):
        return []
    start = np.flatnonzero(np.concatenate([[True], (np.diff(i) != 1) | (np.diff(j) != 1)]))
    size = np.diff(np.append(start, len(i))) + length - 1
    rank = np.lexsort((j[start], i[start], -size))
    return [(int(i[s]), int(j[s]), int(m)) for s, m in zip(start[rank], size[rank])]


def _text_key(text: Column) -> tuple[Column, Column]:
    return F.xxhash64(text), F.xxhash64(F.lit("second"), text)


def _keyed(df: DataFrame, text_col: str, names: tuple[str, str]) -> DataFrame:
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return df.select(*[k.alias(n) for k, n in zip(_text_key(text), names)], text.alias("text"))


def _grams(words: np.ndarray, at: np.ndarray, n: int, keep=None):
    """(key, text) of the windows of ``n`` words inside a text; ``keep``
    tells which keys count."""
    keys = mix(Rolling(words, WORD_POWERS).windows(n) ^ U64(n))
    place = np.arange(len(keys)) if keep is None else np.flatnonzero(keep(keys))
    text = np.searchsorted(at, place, "right") - 1
    inside = place + n <= at[text + 1]
    return keys[place[inside]], text[inside]


def _distinct(keys: np.ndarray, text: np.ndarray):
    """(key, text, how often) of equal windows of a text."""
    order = np.lexsort((keys, text))
    keys, text = keys[order], text[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    return keys[first], text[first], np.diff(np.append(first, len(keys)))


def item_seeds(tests: DataFrame, spec: TilingSpec) -> DataFrame:
    """(x1, x2, seed, places, words, size) of each distinct seed of each item:
    where it has it how often, the item's words, the seed's words."""
    names = ["x1", "x2", "seed", "places", "words", "size"]

    def run(batches):
        for batch in batches:
            data, offsets = flat_text(batch.column(2))
            for a, b in text_slices(offsets, SLICE_BYTES):
                words, at = folded_words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                total = np.diff(at)
                for n in range(1, spec.seed + 1):
                    keys, text, places = _distinct(*_grams(words, at, n))
                    own = total[text] >= spec.seed if n == spec.seed else total[text] == n
                    keys, text, places = keys[own], text[own], places[own]
                    keys_of = [batch.column(i).take(pa.array(a + text)) for i in (0, 1)]
                    yield pa.RecordBatch.from_arrays([*keys_of, pa.array(keys.view(np.int64)), pa.array(places), pa.array(total[text]), pa.array(np.full(len(text), n))], names)

    return map_arrow(tests, run, "x1 bigint, x2 bigint, seed bigint, places bigint, words bigint, size bigint")


def seed_filter(seeds: DataFrame, most_bits: int = FILTER_BITS) -> np.ndarray:
    """Bloom filter of two bits a seed, as 64-bit words; a power of two, with
    at most ``most_bits`` bits."""
    n = seeds.count()
    bits = 1024
    while bits < min(most_bits, BITS_OF_SEED * n):
        bits *= 2
    at = F.explode(F.array(F.col("seed").bitwiseAND(F.lit(bits - 1)), F.shiftrightunsigned("seed", 32).bitwiseAND(F.lit(bits - 1)))).alias("at")
    set_bits = seeds.select(at).select(F.shiftright("at", 6).alias("word"), F.expr("shiftleft(1L, cast(at & 63 as int))").alias("bit"))
    found = set_bits.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(bits // 64, U64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(U64)
    return out


def _passes(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    mask = U64(64 * len(table) - 1)

    def test(at):
        return (table[at >> U64(6)] >> (at & U64(63))) & U64(1) != 0

    return test(keys & mask) & test((keys >> U64(32)) & mask)


def text_seeds(texts: DataFrame, sizes: list[int], sent) -> DataFrame:
    """(t1, t2, seed) of each distinct window of each text that passes the
    filter, for every seed size."""

    def run(batches):
        table = sent.value
        for batch in batches:
            data, offsets = flat_text(batch.column(2))
            for a, b in text_slices(offsets, SLICE_BYTES):
                words, at = folded_words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                for n in sizes:
                    keys, text, _ = _distinct(*_grams(words, at, n, lambda k: _passes(table, k)))
                    if len(keys):
                        yield pa.RecordBatch.from_arrays([*(batch.column(i).take(pa.array(a + text)) for i in (0, 1)), pa.array(keys.view(np.int64))], ["t1", "t2", "seed"])

    return map_arrow(texts, run, "t1 bigint, t2 bigint, seed bigint")


def _tiled(pairs: DataFrame, spec: TilingSpec) -> DataFrame:
    """(t1, t2, x1, x2, coverage, tiles, words) of the pairs (t1, t2, x1, x2,
    text, item) that reach the coverage."""
    names = ["t1", "t2", "x1", "x2", "coverage", "tiles", "words"]

    def words_of(text: str) -> np.ndarray:
        data = np.frombuffer(text.encode(), np.uint8)
        return folded_words(data, np.array([0, len(data)]))[0]

    def run(batches):
        for batch in batches:
            rows, last, words = [], None, None
            for k, (t1, t2, text, item) in enumerate(zip(*(batch.column(i).to_pylist() for i in (0, 1, 4, 5)))):
                if last != (t1, t2):
                    last, words = (t1, t2), words_of(text)
                test = words_of(item)
                found = tiles(words, test, min(spec.seed, len(test)))
                marked = sum(x[2] for x in found)
                if found and marked >= spec.coverage * len(test):
                    rows.append((k, marked / len(test), len(found), marked))
            k, *values = (list(x) for x in zip(*rows)) if rows else ([], [], [], [])
            keys = [batch.column(i).take(pa.array(k, pa.int64())) for i in range(4)]
            kinds = (pa.float64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([*keys, *map(pa.array, values, kinds)], names)

    return map_arrow(pairs.select("t1", "t2", "x1", "x2", "text", "item"), run, "t1 bigint, t2 bigint, x1 bigint, x2 bigint, coverage double, tiles bigint, words bigint")


def tiled_hits(df: DataFrame, items: DataFrame, spec: TilingSpec = TilingSpec(), *, text_col: str = "text", item_text_col: str = "text", most_bits: int = FILTER_BITS) -> DataFrame:
    """(t1, t2, x1, x2, coverage, tiles, words), a row for each different text
    and different item that contaminates it, under the keys of both."""
    tests = _keyed(items, item_text_col, ("x1", "x2")).groupBy("x1", "x2").agg(F.first("text").alias("item"))
    tests = stage_table(tests, "items")
    seeds = stage_table(item_seeds(tests, spec), "item-seeds")
    sizes = sorted(r["size"] for r in seeds.select("size").distinct().collect())  # at most one for each word of a seed
    sent = df.sparkSession.sparkContext.broadcast(seed_filter(seeds, most_bits))
    texts = _keyed(df, text_col, ("t1", "t2"))
    # equal texts fall together here, so a hot text is one row of the join
    shared = stage_table(text_seeds(texts, sizes, sent).distinct(), "text-seeds")
    met = shared.join(seeds, "seed").groupBy("t1", "t2", "x1", "x2").agg((F.sum("places") * F.first("size")).alias("most"), F.first("words").alias("words"))
    pairs = stage_table(met.where(F.col("most") >= spec.coverage * F.col("words")).select("t1", "t2", "x1", "x2"), "pairs")
    chosen = texts.join(pairs.select("t1", "t2").distinct(), ["t1", "t2"], "left_semi").groupBy("t1", "t2").agg(F.first("text").alias("text"))
    return stage_table(_tiled(pairs.join(chosen, ["t1", "t2"]).join(tests, ["x1", "x2"]), spec), "hits")


KEYS = ("__t1", "__t2")


def _with_keys(df: DataFrame, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return df.withColumns(dict(zip(KEYS, _text_key(text))))


def contaminated(df: DataFrame, items: DataFrame, spec: TilingSpec = TilingSpec(), *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(id, item_id, coverage, n_tiles, n_words): a row for each text and
    item that contaminates it."""
    hits = tiled_hits(df, items, spec, text_col=text_col, item_text_col=item_text_col)
    text = F.coalesce(F.col(f"`{item_text_col}`"), F.lit(""))
    ids = items.select(*[k.alias(n) for k, n in zip(_text_key(text), ("x1", "x2"))], F.col(f"`{item_col}`").alias("__item"))
    named = hits.join(ids, ["x1", "x2"]).select(F.col("t1").alias(KEYS[0]), F.col("t2").alias(KEYS[1]), "__item", "coverage", "tiles", "words")
    rows = _with_keys(df.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text_col}`").alias("__text")), "__text").drop("__text")
    return rows.join(named, list(KEYS)).select(F.col("__id").alias(id_col), F.col("__item").alias("item_id"), "coverage", F.col("tiles").alias("n_tiles"), F.col("words").alias("n_words"))


def clean(df: DataFrame, items: DataFrame, spec: TilingSpec = TilingSpec(), *, text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that no item contaminates."""
    hits = tiled_hits(df, items, spec, text_col=text_col)
    bad = hits.select(F.col("t1").alias(KEYS[0]), F.col("t2").alias(KEYS[1])).distinct()
    return _with_keys(df, text_col).join(bad, list(KEYS), "left_anti").select(*[F.col(f"`{c}`") for c in df.columns])
