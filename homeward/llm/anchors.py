"""Winnowed anchors and the windows they stand for.

A window is ``span`` consecutive symbols (bytes or words) of one text.  Its
anchor is the ``k``-gram in it with the least hash, the leftmost of equals:
it depends on the window's content alone, so equal windows have the same
anchor at the same place.  Consecutive windows with one anchor form a
segment, about one per ``(span - k + 2) / 2`` symbols; a text is known by
its segments, and a window can only be repeated if its anchor's ``k``-gram
is.  So anchors are counted first, and only segments whose anchor occurs
again are looked at window by window.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BYTE_CODES, BYTE_POWERS, NO_ID, U64, WORD_POWERS, Powers, Rolling, flat_text, map_arrow, sliding_min, text_slices, word_arrays

SLICE_BYTES = 1 << 18
PIECE = 1 << 21  # windows of a long text taken at once
PLACE = U64((1 << 24) - 1)


@dataclass(frozen=True)
class Symbols:
    """How a text becomes an array of 64-bit symbols."""

    read: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]  # -> symbols, offsets by text
    powers: Powers


BYTES = Symbols(lambda data, offsets: (BYTE_CODES[data], offsets), BYTE_POWERS)
WORDS = Symbols(lambda data, offsets: word_arrays(data, offsets)[1:], WORD_POWERS)


def symbol_slices(batch: pa.RecordBatch, column: int, symbols: Symbols) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, bytes, symbols, offsets by text) of slices of a batch."""
    data, offsets = flat_text(batch.column(column))
    for a, b in text_slices(offsets, SLICE_BYTES):
        part = data[offsets[a] : offsets[b]]
        yield a, part, *symbols.read(part, offsets[a : b + 1] - offsets[a])


def segments(values: np.ndarray, offsets: np.ndarray, span: int, k: int, powers: Powers):
    """Arrays (text, first window, windows, anchor hash, content hash)."""
    if len(offsets) == 2 and offsets[1] - offsets[0] > PIECE + span:
        # a long text in pieces; each window lies in one of them
        parts = []
        for start in range(int(offsets[0]), int(offsets[1]) - span + 1, PIECE):
            piece = values[start : min(start + PIECE + span - 1, int(offsets[1]))]
            t, s, *rest = segments(piece, np.array([0, len(piece)]), span, k, powers)
            parts.append((t, s + start - int(offsets[0]), *rest))
        return tuple(np.concatenate(x) for x in zip(*parts))
    n = len(values)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    whole = np.flatnonzero(np.arange(n) + span <= offsets[1:][text]) if n else np.zeros(0, np.int64)
    if not len(whole):
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, U64, U64))
    rolling = Rolling(values, powers)
    grams = rolling.windows(k)
    keys = (grams & ~PLACE) | np.arange(len(grams), dtype=U64)
    anchor = (sliding_min(keys, span - k + 1) & PLACE).astype(np.int64)[whole]
    first = np.flatnonzero(np.concatenate([[True], (np.diff(whole) != 1) | (np.diff(anchor) != 0)]))
    count = np.diff(np.append(first, len(whole)))
    start = whole[first]
    return text[start], start - offsets[text[start]], count, grams[anchor[first]], rolling.ranges(start, start + count - 1 + span)


SEGMENT_SCHEMA = "did bigint, th bigint, start bigint, n bigint, anchor bigint, seg bigint"


def segment_table(keyed: DataFrame, symbols: Symbols, span: int, k: int) -> DataFrame:
    """One row per segment of each text of ``keyed`` (did, th, text)."""

    def run(batches):
        for batch in batches:
            did, th = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for row, _, values, offsets in symbol_slices(batch, 2, symbols):
                text, start, n, anchor, seg = segments(values, offsets, span, k, symbols.powers)
                columns = [did[row + text], th[row + text], start, n, anchor.view(np.int64), seg.view(np.int64)]
                for i in range(0, len(start), 1 << 16):
                    yield pa.RecordBatch.from_arrays([pa.array(c[i : i + (1 << 16)], pa.int64()) for c in columns], ["did", "th", "start", "n", "anchor", "seg"])

    return map_arrow(keyed.select("did", "th", "text"), run, SEGMENT_SCHEMA)


def window_table(keyed: DataFrame, wanted: DataFrame, symbols: Symbols, span: int, form: Callable, names: list[str], extra: list[str]) -> DataFrame:
    """Rows for each window of the wanted segments (did, th, start, n and
    the ``extra`` columns, all bigint).  ``form(data, at, place, n, h1, h2,
    key, extras)`` makes the named columns of one text's windows: ``at`` is
    the window's byte or word in the slice, ``place`` that in the text,
    ``h1`` and ``h2`` two 64-bit content hashes, ``n`` windows by segment."""
    lists = wanted.groupBy("did", "th").agg(F.collect_set(F.struct("start", "n", *extra)).alias("segs"))
    rows = keyed.select("did", "th", "text").join(lists, ["did", "th"]).select("did", "th", "text", "segs")

    def once(batches):
        """Rows that repeat id and text follow one another behind the join;
        the windows of one of them are enough."""
        last = None
        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)])
            new = np.ones(keys.shape[1], bool)
            new[1:] = (keys[:, 1:] != keys[:, :-1]).any(axis=0)
            if len(new):
                new[0] = last is None or (keys[:, 0] != last).any()
                last = keys[:, -1]
            yield batch if new.all() else batch.filter(pa.array(new))

    def run(batches):
        for batch in once(batches):
            did, th = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            flat = batch.column(3).flatten()
            starts, counts, *extras = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(2 + len(extra)))
            ends = np.concatenate([[0], np.cumsum(batch.column(3).value_lengths().to_numpy(zero_copy_only=False))])
            for row, data, values, offsets in symbol_slices(batch, 2, symbols):
                a = Rolling(values, symbols.powers)
                b = Rolling(values ^ (values >> U64(7)), OTHER_POWERS)
                texts = len(offsets) - 1
                of = slice(ends[row], ends[row + texts])
                n = counts[of]
                own = np.repeat(np.arange(row, row + texts), np.diff(ends[row : row + texts + 1]))
                # a few windows at a time, whatever the slice holds
                for i in range(0, len(n), CHUNK):
                    m = n[i : i + CHUNK]
                    key = np.repeat(own[i : i + CHUNK], m)
                    inside = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
                    place = np.repeat(starts[of][i : i + CHUNK], m) + inside
                    at = place + offsets[key - row]
                    hashes = (x.ranges(at, at + span) for x in (a, b))
                    columns = form(data, at, place, inside, *hashes, (did[key], th[key]), [np.repeat(x[of][i : i + CHUNK], m) for x in extras])
                    yield pa.RecordBatch.from_arrays([pa.array(c.view(np.int64), pa.int64()) for c in columns], names)

    return map_arrow(rows, run, ", ".join(f"{c} bigint" for c in names))


CHUNK = 512  # segments
OTHER_POWERS = Powers(0xD1342543DE82EF95)


def runs_of(starts: np.ndarray, counts: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal covered runs (start, end) of windows at ``start .. start + n
    - 1``, sorted."""
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.argsort(starts, kind="stable")
    a, e = starts[order], (starts + counts - 1 + span)[order]
    reach = np.maximum.accumulate(e)
    first = np.flatnonzero(np.concatenate([[True], a[1:] > reach[:-1]]))
    return a[first], np.append(reach[first[1:] - 1], reach[-1])


def covered_lists(*parts: DataFrame) -> DataFrame:
    """(did, th, found): the repeated windows of each text.  A set, so that a
    text's list is bounded by its own length however many rows repeat it."""
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return rows.groupBy("did", "th").agg(F.collect_set(F.struct("start", "n")).alias("found"))


def with_runs(keyed: DataFrame, found: DataFrame) -> DataFrame:
    """(row_id, text, found) of all rows.  The id is made from its key, so
    that this join shuffles the same columns of the texts as the one in
    ``window_table`` and Spark shuffles them once."""
    kind = keyed.schema["row_id"].dataType
    row_id = F.when(F.col("did") < NO_ID, F.col("did")).cast(kind).alias("row_id")
    return keyed.select("did", "th", "text").join(found, ["did", "th"], "left").select(row_id, "text", "found")


def found_runs(column: pa.Array, span: int):
    """Runs of each row of a ``found`` column."""
    flat = column.flatten()
    starts, counts = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(2)) if len(flat) else (np.zeros(0, np.int64),) * 2
    lengths = np.nan_to_num(column.value_lengths().to_numpy(zero_copy_only=False).astype(float)).astype(np.int64)
    at = 0
    for m in lengths:
        yield runs_of(starts[at : at + m], counts[at : at + m], span)
        at += m
