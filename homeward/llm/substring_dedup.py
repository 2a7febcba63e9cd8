"""Substring deduplication by seed and extend.

Seeds are winnowed anchors (``k`` words).  Texts meet on a seed they share;
the match is then extended both ways, up to every ``span``-word window that
holds the seed.  Extension does not form pairs of texts: texts with the
same words around a seed are one class, whose first text (least id) stands
for it, and where several classes share a seed their windows meet by
content.  Windows that an earlier text has are joined to maximal repeats.

Words are ``[^\\x20\\x09-\\x0D]+``.  A word is removed when a window that
covers it also starts in a text with a smaller id; windows are judged on
the input.  A null text has no word.  A null id counts as larger than all
others, and no row is smaller than another with the same id.  Rows that
repeat id and text get equal results.  Texts are read whole.

A seed that a third of all texts share costs one combined row per task, not
a group in one task: seeds, classes and windows are aggregated before they
are joined back, and the joins can be split by Spark where they are skewed.
Windows are compared by two 64-bit hashes: the chance that any two of N
different windows agree is below N * N / 2**129.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .anchors import WORDS, covered_lists, found_runs, segment_table, window_table, with_runs
from .common import map_arrow, row_key, stage_table

SPAN = 50
SEED = 20


def earlier_windows(keyed: DataFrame, *, span: int = SPAN, seed: int = SEED) -> DataFrame:
    """(did, th, found): windows of each text that an earlier text has."""
    segs = segment_table(keyed, WORDS, span, seed)
    # aggregates are written before they are joined back: in one stage with
    # the aggregation, Spark could not split the join of a hot key
    seeds = segs.groupBy("anchor").agg(F.min("did").alias("a_first"), F.max("did").alias("a_last"), F.min("seg").alias("s_low"), F.max("seg").alias("s_high"))
    shared = stage_table(segs.join(stage_table(seeds.where("a_first < a_last"), "seeds"), "anchor"), "shared")
    # one class: all texts have the same words around the seed
    alike = shared.where("s_low = s_high and did > a_first").select("did", "th", "start", "n")
    # a class has the same seed and the same words around it: two hashes agree
    same = ["anchor", "seg"]
    several = shared.where("s_low < s_high").select("did", "th", "start", "n", *same)
    classes = stage_table(several.groupBy(*same).agg(F.min("did").alias("s_first")), "classes")
    judged = several.join(classes, same)
    later = judged.where("did > s_first").select("did", "th", "start", "n")
    firsts = judged.where("did = s_first").select("did", "th", "start", "n")
    windows = window_table(keyed, firsts, WORDS, span, _window, ["did", "th", "start", "h1", "h2"], [])
    met = windows.groupBy("h1", "h2").agg(F.min("did").alias("w_first"), F.max("did").alias("w_last"))
    met = stage_table(met.where("w_first < w_last").select("h1", "h2", "w_first"), "windows")
    extended = windows.join(met, ["h1", "h2"]).where("did > w_first").select("did", "th", "start", F.lit(1).cast("long").alias("n"))
    return covered_lists(alike, later, extended)


def _window(data, at, place, inside, h1, h2, key, extras):
    return [*key, place, h1, h2]


def maximal_repeats(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN, seed: int = SEED) -> DataFrame:
    """One row per maximal repeat: (id, first word, end word)."""
    keyed = row_key(df, id_col, text_col)
    rows = with_runs(keyed, earlier_windows(keyed, span=span, seed=seed)).where("found is not null").select("row_id", "found")

    def run(batches):
        for b in batches:
            runs = list(found_runs(b.column(1), span))
            times = [len(a) for a, _ in runs]
            ids = b.column(0).take(pa.array(np.repeat(np.arange(b.num_rows), times)))
            starts, ends = (np.concatenate([r[i] for r in runs]) if runs else np.zeros(0, np.int64) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([ids, pa.array(starts, pa.int64()), pa.array(ends, pa.int64())], ["row_id", "first_word", "end_word"])

    kind = rows.schema["row_id"].dataType.simpleString()
    return map_arrow(rows, run, f"row_id {kind}, first_word bigint, end_word bigint").withColumnRenamed("row_id", id_col)


def remove_repeats(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN, seed: int = SEED, digest: bool = False) -> DataFrame:
    """(id, n_words, n_removed, kept): the words left of each text, joined by
    one space, or their SHA-256 (``kept_sha256``)."""
    keyed = row_key(df, id_col, text_col)
    rows = with_runs(keyed, earlier_windows(keyed, span=span, seed=seed))

    def run(batches):
        for b in batches:
            total, gone, out = [], [], []
            texts = b.column(1)
            for i, (starts, ends) in enumerate(found_runs(b.column(2), span)):
                words = texts[i].as_py().encode().split()
                total.append(len(words))
                gone.append(int((ends - starts).sum()))
                for a, e in zip(starts[::-1], ends[::-1]):
                    del words[a:e]
                kept = b" ".join(words)
                out.append(hashlib.sha256(kept).hexdigest() if digest else kept.decode())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(out, pa.string())], ["row_id", "n_words", "n_removed", "kept"])

    kind = rows.schema["row_id"].dataType.simpleString()
    out = map_arrow(rows, run, f"row_id {kind}, n_words bigint, n_removed bigint, kept string")
    return out.withColumnsRenamed({"row_id": id_col, "kept": "kept_sha256" if digest else "kept"})
