"""Removal of long repeated byte strings by a distributed suffix sort.

A byte is removed when a string of ``span`` bytes that covers it also starts
anywhere else, in the same text or another; strings are judged on the input
and never cross texts.

Only suffixes that can be repeated are sorted.  A first pass counts winnowed
anchors (``k`` bytes, one in each ``span`` bytes at least); a suffix whose
anchor occurs once is unique.  Segments of suffixes with the same bytes are
one class, sorted once.  The suffixes left are range-partitioned by their
leading bytes with splitters that Spark samples (ties by content hash, so a
frequent beginning is spread, and by place, so that even one suffix that
occurs in every bucket is).  Each bucket is sorted by multikey quicksort and
equal neighbours are found; the first and last run of every bucket may go on
in the next one, so their sizes are summed across boundaries.

A null text is empty.  Rows that repeat id and text are repeats of each
other, and get equal results.  Texts are read whole.  Suffixes are told
apart by eight leading bytes and 114 bits of two hashes.  A bucket is held
in memory by its task: ``spark.sql.shuffle.partitions`` sets how many there
are, and splitters keep them even.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .anchors import BYTES, covered_lists, found_runs, segment_table, window_table, with_runs
from .common import U64, map_arrow, row_key, stage_table

SPAN = 400
ANCHOR = 200

LOW = 14  # bits of a tag below the second hash: 13 for the place in its segment, 1 for the weight
SMALL = 1 << 13


def multikey_quicksort(keys: list[np.ndarray]) -> np.ndarray:
    """Order of rows by several key columns.  Rows are parted at a pivot of
    the first column into less, equal and greater; the equal ones go on with
    the next column, the others with the same one."""
    done, todo = [], [(np.arange(len(keys[0])), 0)]
    while todo:
        rows, depth = todo.pop()
        if depth == len(keys):
            done.append(rows)
            continue
        column = keys[depth][rows]
        if len(rows) <= SMALL:
            done.append(rows[np.lexsort([k[rows] for k in keys[:depth:-1]] + [column])])
            continue
        pivot = np.partition(column[:: max(1, len(rows) // 255)], 127)[127] if len(rows) > 255 else column[0]
        less, equal = column < pivot, column == pivot
        # the last part put on the stack is taken first
        todo += [(rows[~(less | equal)], depth), (rows[equal], depth + 1), (rows[less], depth)]
    return np.concatenate(done) if done else np.zeros(0, np.int64)


def _suffix(data, at, place, inside, h1, h2, key, extras):
    """(leading bytes, hash, tag, segment) of each suffix."""
    lead = np.zeros(len(at), U64)
    for j in range(8):
        lead = lead << U64(8) | data[at + j].astype(U64)
    seg, weight = extras
    tag = h2 & ~U64((1 << LOW) - 1) | inside.astype(U64) << U64(1) | (weight > 1).astype(U64)
    # with the top bit turned, signed order is the order of the bytes
    return [lead ^ U64(1 << 63), h1, tag, seg]


BUCKET_SCHEMA = "kind int, lead bigint, h1 bigint, h2 bigint, seg bigint, inside bigint, total bigint"
INNER, RUN, OPEN = 0, 1, 2


def _sorted_bucket(batches):
    """Sort one bucket and compare neighbours.  Yields the suffixes of runs
    of two or more (INNER); of the first and last run, which other buckets
    may share, the size (RUN) and the suffixes (OPEN)."""
    parts = [[b.column(i).to_numpy(zero_copy_only=False) for i in range(4)] for b in batches]
    parts = [p for p in parts if len(p[0])]
    if not parts:
        return
    lead, h1, tag, seg = (np.concatenate(x) for x in zip(*parts))
    order = multikey_quicksort([lead, h1, tag])
    lead, h1, tag, seg = lead[order], h1[order], tag[order], seg[order]
    h2 = tag >> LOW
    first = np.flatnonzero(np.concatenate([[True], (lead[1:] != lead[:-1]) | (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]))
    many = (tag & 1) == 1  # stands for two or more places
    totals = np.add.reduceat(1 + many.astype(np.int64), first)
    edge = np.zeros(len(first), bool)
    edge[[0, -1]] = True
    times = np.diff(np.append(first, len(lead)))
    of_run = np.repeat(totals, times)
    at_edge = np.repeat(edge, times)
    out = np.flatnonzero(~many & (at_edge | (of_run >= 2)))
    kind = np.where(at_edge[out], OPEN, INNER).astype(np.int32)
    runs = first[edge]
    for rows, kinds, total in ((out, kind, of_run[out]), (runs, np.full(len(runs), RUN, np.int32), totals[edge])):
        inside = tag[rows] >> 1 & (1 << LOW - 1) - 1
        columns = [lead[rows], h1[rows], h2[rows], seg[rows], inside, total]
        for i in range(0, len(rows), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(kinds[i : i + (1 << 16)]), *(pa.array(c[i : i + (1 << 16)], pa.int64()) for c in columns)], ["kind", "lead", "h1", "h2", "seg", "inside", "total"])


def repeated_suffixes(suffixes: DataFrame, buckets: int) -> DataFrame:
    """(seg, inside) of suffixes (lead, h1, tag, seg) that occur again."""
    # an explicit number: both readers below must see the same buckets
    dealt = suffixes.repartitionByRange(buckets, "lead", "h1", "tag", "seg")
    sorted_ = map_arrow(dealt, _sorted_bucket, BUCKET_SCHEMA)
    key = ["lead", "h1", "h2"]
    # two rows for each bucket at most
    across = sorted_.where(F.col("kind") == RUN).groupBy(*key).agg(F.sum("total").alias("across")).where("across >= 2")
    rows = sorted_.where(F.col("kind") != RUN).join(F.broadcast(across), key, "left")
    return rows.where((F.col("total") >= 2) | ((F.col("kind") == OPEN) & F.col("across").isNotNull())).select("seg", "inside")


def repeated_windows(keyed: DataFrame, *, span: int = SPAN, anchor: int = ANCHOR) -> DataFrame:
    """(did, th, found): starts of strings of each text that occur again."""
    if span - anchor + 1 >= 1 << LOW - 1 or anchor < 8:
        raise ValueError("anchor must have 8 bytes and lie within 8190 bytes of span")
    segs = segment_table(keyed, BYTES, span, anchor)
    # counts are written before they are joined back: in one stage with the
    # aggregation, Spark could not split the join of a hot anchor or class
    anchors = segs.groupBy("anchor").agg(F.count(F.lit(1)).alias("n_places"), F.min("seg").alias("s_low"), F.max("seg").alias("s_high"))
    anchors = stage_table(anchors.where("n_places > 1"), "anchors")
    shared = stage_table(segs.join(anchors, "anchor").select("did", "th", "start", "n", "anchor", "seg", (F.col("s_low") == F.col("s_high")).alias("alike")), "shared")
    place = ["did", "th", "start", "n"]
    alike = shared.where("alike").select(*place)
    # a class has the same anchor and the same segment: two hashes agree
    same = ["anchor", "seg"]
    several = shared.where("not alike").select(*place, *same)
    classes = stage_table(several.groupBy(*same).agg(F.count(F.lit(1)).alias("places"), F.min(F.struct(*place)).alias("one")), "classes")
    copies = several.join(classes.where("places > 1").select(*same), same).select(*place)
    wanted = classes.select("one.*", "seg", "places")
    suffixes = window_table(keyed, wanted, BYTES, span, _suffix, ["lead", "h1", "tag", "seg"], ["seg", "places"])
    buckets = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = repeated_suffixes(suffixes, buckets)
    singles = classes.where("places = 1").select("seg", "one.did", "one.th", "one.start")
    met = found.join(singles, "seg").select("did", "th", (F.col("start") + F.col("inside")).alias("start"), F.lit(1).cast("long").alias("n"))
    return covered_lists(alike, copies, met)


def remove_repeats(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN, anchor: int = ANCHOR, digest: bool = False) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept): the bytes left of each text,
    or their SHA-256 (``kept_sha256``)."""
    keyed = row_key(df, id_col, text_col)
    rows = with_runs(keyed, repeated_windows(keyed, span=span, anchor=anchor))

    def run(batches):
        for b in batches:
            total, gone, spans, out = [], [], [], []
            texts = b.column(1)
            for i, (starts, ends) in enumerate(found_runs(b.column(2), span)):
                data = texts[i].as_py().encode()
                total.append(len(data))
                gone.append(int((ends - starts).sum()))
                spans.append(len(starts))
                edges = np.concatenate([[0], ends]), np.append(starts, len(data))
                kept = b"".join(data[a:e] for a, e in zip(*edges)) if len(starts) else data
                out.append(hashlib.sha256(kept).hexdigest() if digest else kept)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(x, pa.int64()) for x in (total, gone, spans)), pa.array(out, pa.string() if digest else pa.binary())],
                ["row_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    kind = rows.schema["row_id"].dataType.simpleString()
    out = map_arrow(rows, run, f"row_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept {'string' if digest else 'binary'}")
    return out.withColumnsRenamed({"row_id": id_col, "kept": "kept_sha256" if digest else "kept"})
