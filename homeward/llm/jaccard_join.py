"""Jaccard join of word n-grams with Bayesian candidate pruning.

Texts whose sets of ``k``-word shingles have a Jaccard similarity of
``threshold`` or more are linked.

1. Texts with the same shingle set are one class (copies are never paired).
2. MinHash bands of the classes give candidates: classes that share a band
   are joined to the band's least class, and the components of that graph
   hold every pair that shares a band.  With 48 bands of 6 values a pair at
   similarity 0.8 shares none with probability 5e-7.
3. Within a component all pairs are candidates.  Their MinHash values are
   compared ``STEP`` at a time; with a uniform prior, the posterior of the
   similarity after m of n agree is Beta(m + 1, n - m + 1), and a pair is
   dropped as soon as the chance of reaching the threshold is below
   ``tolerance``.  What is left is verified exactly.
4. A large component is cut into blocks, one task for each pair of blocks,
   so a group of near copies is spread however large it is.  Tasks return
   link counts and the edges of a spanning forest, never pairs.

The result has one row per document: its class (least id of the documents
that links connect), its representative (least id with the same shingle
set) and how many documents it is linked to, copies included.

A text of fewer than ``k`` words has one shingle, all its words.  A null
text, or one without words, is a class by itself without links.  A null id
counts as larger than all others and is null in the result.  Rows that
repeat id and text count as documents of their own.  Texts are read whole.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NO_ID, U64, WORD, WORD_POWERS, Rolling, flat_text, map_arrow, mix, row_key, stage_table, text_slices, word_arrays
from .components import connected_components

SLICE_BYTES = 1 << 18
STEP = 16  # MinHash values compared at a time


@dataclass(frozen=True)
class JoinSpec:
    shingle: int = 5
    threshold: float = 0.8
    bands: int = 48
    band_size: int = 6
    tolerance: float = 1e-9
    block_texts: int = 1536
    block_shingles: int = 1 << 20

    @property
    def hashes(self) -> int:
        return self.bands * self.band_size


@lru_cache(maxsize=4)
def _family(n: int) -> tuple[np.ndarray, np.ndarray]:
    r = mix(np.arange(1, 2 * n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15))
    return (r[:n] >> U64(32)).astype(np.uint32) | np.uint32(1), (r[n:] >> U64(32)).astype(np.uint32)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int):
    """(distinct shingle hashes in order, offsets by text)."""
    _, words, at = word_arrays(data, offsets)
    n_words = np.diff(at)
    rolling = Rolling(words, WORD_POWERS)
    text = np.repeat(np.arange(len(n_words)), n_words)
    whole = np.flatnonzero(np.arange(len(words)) + k <= at[1:][text]) if len(words) else np.zeros(0, np.int64)
    short = np.flatnonzero((n_words > 0) & (n_words < k))
    hashes = np.concatenate([rolling.windows(k)[whole], rolling.ranges(at[short], at[short + 1])])
    owner = np.concatenate([text[whole], short])
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[new], np.searchsorted(owner[new], np.arange(len(n_words) + 1))


def minhash(hashes: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """Signatures (sets x n) of non-empty sets."""
    a, b = _family(n)
    x = (hashes >> U64(32)).astype(np.uint32)
    out = np.empty((len(offsets) - 1, n), np.uint32)
    for i in range(n):
        out[:, i] = np.minimum.reduceat(x * a[i] + b[i], offsets[:-1])
    return out


def band_keys(signatures: np.ndarray, spec: JoinSpec) -> np.ndarray:
    parts = signatures.reshape(len(signatures), spec.bands, spec.band_size).astype(U64)
    key = np.tile(np.arange(1, spec.bands + 1, dtype=U64), (len(signatures), 1))
    for j in range(spec.band_size):
        key = mix(key * U64(0x9E3779B97F4A7C15) + parts[:, :, j])
    return key


def least_matches(spec: JoinSpec) -> list[int]:
    """By number of steps: matches below which the posterior probability of
    the threshold is under the tolerance.  P(J >= t) after m of n equals
    P(Binomial(n + 1, t) <= m)."""
    out, t = [0], spec.threshold
    for n in range(STEP, spec.hashes + 1, STEP):
        total, m = 0.0, 0
        while m <= n:
            total += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if total >= spec.tolerance:
                break
            m += 1
        out.append(m)
    return out


def describe(keyed: DataFrame, spec: JoinSpec) -> DataFrame:
    """(did, th, n, f1, f2, bands) of each text: size and fingerprint of its
    shingle set, band keys."""

    def run(batches):
        for batch in batches:
            did, th = (batch.column(i) for i in (0, 1))
            data, offs = flat_text(batch.column(2))
            n, f1, f2, bands = [], [], [], []
            for a, b in text_slices(offs, SLICE_BYTES):
                hashes, at = shingle_sets(data[offs[a] : offs[b]], offs[a : b + 1] - offs[a], spec.shingle)
                size = np.diff(at)
                some = np.flatnonzero(size)
                keys = np.zeros((len(size), spec.bands), U64)
                prints = np.zeros((2, len(size)), U64)
                if len(some):
                    packed = np.append(at[some], at[-1])
                    keys[some] = band_keys(minhash(hashes, packed, spec.hashes), spec)
                    prints[0, some] = np.add.reduceat(mix(hashes), packed[:-1])
                    prints[1, some] = np.add.reduceat(mix(hashes ^ U64(0x5851F42D4C957F2D)), packed[:-1])
                n.append(size)
                f1.append(prints[0])
                f2.append(prints[1])
                bands.append(keys)
            if not n:
                continue
            n, f1, f2 = (np.concatenate(x).view(np.int64) for x in (n, f1, f2))
            flat = pa.array(np.concatenate(bands).view(np.int64).ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, spec.bands), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([did, th, pa.array(n), pa.array(f1), pa.array(f2), lists], ["did", "th", "n", "f1", "f2", "bands"])

    return map_arrow(keyed.select("did", "th", "text"), run, "did bigint, th bigint, n bigint, f1 bigint, f2 bigint, bands array<bigint>")


def _blocks(members: DataFrame, spec: JoinSpec) -> DataFrame:
    """Adds each member's block and the number of blocks of its component."""
    sizes = members.groupBy("comp").agg(F.count(F.lit(1)).alias("texts"), F.sum("n").alias("shingles"))
    cut = F.greatest(F.ceil(F.col("texts") / spec.block_texts), F.ceil(F.col("shingles") / spec.block_shingles)).cast("int")
    sizes = stage_table(sizes.select("comp", cut.alias("blocks")), "sizes")
    return members.join(sizes, "comp").withColumn("block", F.pmod(F.xxhash64("vid"), F.col("blocks")).cast("int"))


def _member_shingles(keyed: DataFrame, members: DataFrame, spec: JoinSpec) -> DataFrame:
    rows = keyed.select("did", "th", "text").join(members, ["did", "th"]).select("comp", "vid", "size", "block", "blocks", "text")
    names = ["comp", "vid", "size", "block", "blocks", "shingles"]

    def run(batches):
        for batch in batches:
            data, offs = flat_text(batch.column(5))
            for a, b in text_slices(offs, SLICE_BYTES):
                hashes, at = shingle_sets(data[offs[a] : offs[b]], offs[a : b + 1] - offs[a], spec.shingle)
                sets = pa.array([hashes[i:j].tobytes() for i, j in zip(at, at[1:])], pa.binary())
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(a, b - a) for i in range(5)), sets], names)

    return map_arrow(rows, run, "comp bigint, vid bigint, size bigint, block int, blocks int, shingles binary")


class _Block:
    """Texts of one task: signatures, and postings of their shingles."""

    def __init__(self, sets: list[np.ndarray], spec: JoinSpec):
        self.sets, self.length = sets, np.array([len(s) for s in sets])
        flat = np.concatenate(sets)
        self.signatures = minhash(flat, np.concatenate([[0], np.cumsum(self.length)]), spec.hashes)
        owner = np.repeat(np.arange(len(sets)), self.length)
        self._values, inverse = np.unique(flat, return_inverse=True)
        self._owner = owner[np.argsort(inverse, kind="stable")]
        self._at = np.concatenate([[0], np.cumsum(np.bincount(inverse))])

    def common(self, s: np.ndarray, among: np.ndarray) -> np.ndarray:
        """Shingles of ``s`` that each text of ``among`` has, exactly."""
        if len(among) <= 4:
            return np.array([len(np.intersect1d(s, self.sets[j], assume_unique=True)) for j in among])
        i = np.minimum(np.searchsorted(self._values, s), len(self._values) - 1)
        i = i[self._values[i] == s]
        counts = np.zeros(len(self.sets), np.int64)
        for part in np.array_split(i, len(i) // 256 + 1):
            n = self._at[part + 1] - self._at[part]
            rows = np.repeat(self._at[part] - np.cumsum(n) + n, n) + np.arange(n.sum())
            counts += np.bincount(self._owner[rows], minlength=len(counts))
        return counts[among]


def _survivors(signature: np.ndarray, signatures: np.ndarray, rows: np.ndarray, least: list[int]) -> np.ndarray:
    """Rows whose posterior never falls below the tolerance."""
    matches = np.zeros(len(rows), np.int64)
    for step in range(1, len(least)):
        at = slice(STEP * (step - 1), STEP * step)
        matches += (signatures[rows, at] == signature[at]).sum(axis=1)
        alive = matches >= least[step]
        rows, matches = rows[alive], matches[alive]
        if not len(rows):
            break
    return rows


def _join_block(pdf: pd.DataFrame, spec: JoinSpec) -> pd.DataFrame:
    """Links between two blocks of a component (or within one): for each
    text that has any, how many documents, and an edge of a forest."""
    pdf = pdf.drop_duplicates("vid").sort_values(["block", "vid"])
    vid, size = pdf["vid"].to_numpy(), pdf["size"].to_numpy()
    if len(pdf) < 2:
        return pd.DataFrame({"vid": vid[:0], "links": size[:0], "root": vid[:0]})
    block = _Block([np.frombuffer(x, U64) for x in pdf["shingles"]], spec)
    side = pdf["block"].to_numpy()
    within = int(pdf["b_low"].iloc[0]) == int(pdf["b_high"].iloc[0])
    split = len(pdf) if within else int((side == side[0]).sum()) if side[0] != side[-1] else 0
    least = least_matches(spec)
    links, root = np.zeros(len(pdf), np.int64), np.arange(len(pdf))
    for i in range(len(pdf) if within else split):
        rows = np.arange(i + 1 if within else split, len(pdf))
        rows = _survivors(block.signatures[i], block.signatures, rows, least)
        if not len(rows):
            continue
        both = block.common(block.sets[i], rows)
        # in whole numbers, so that the threshold itself counts
        rows = rows[both >= spec.threshold * (block.length[i] + block.length[rows] - both) - 1e-9]
        if not len(rows):
            continue
        links[i] += size[rows].sum()
        links[rows] += size[i]
        # all texts of the same trees as i or its partners get one root
        roots = np.unique(np.append(root[rows], root[i]))
        if len(roots) > 1:
            root[np.isin(root, roots[1:])] = roots[0]
    found = links > 0
    return pd.DataFrame({"vid": vid[found], "links": links[found], "root": vid[root[found]]})


def similar(df: DataFrame, spec: JoinSpec = JoinSpec(), *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(did, th, row_id, class_id, rep_id, n_links, class_key), a row per
    document.  ``class_key`` is one number for each class, whatever the ids,
    and null for texts without words."""
    keyed = row_key(df, id_col, text_col)
    found = stage_table(describe(keyed, spec), "shingles")
    some = found.where("n > 0")
    classes = some.groupBy("f1", "f2").agg(F.min(F.struct("did", "th", "n", "bands")).alias("one"), F.count(F.lit(1)).alias("size"))
    # written once, so the numbers stay what they are
    classes = stage_table(classes.select("f1", "f2", "size", "one.*", F.monotonically_increasing_id().alias("vid")), "classes")

    buckets = classes.select("vid", F.explode("bands").alias("band"))
    # aggregates are written before they are joined back: a join in a stage
    # of its own can be split at a hot band or class
    least = stage_table(buckets.groupBy("band").agg(F.min("vid").alias("low"), F.max("vid").alias("high")).where("low < high").select("band", "low"), "bands")
    candidates = buckets.join(least, "band").where("vid > low").select(F.col("vid").alias("a"), F.col("low").alias("b"))
    grouped = stage_table(connected_components(candidates).select(F.col("vertex").alias("vid"), F.col("root").alias("comp")), "grouped")

    members = _blocks(grouped.join(classes.select("vid", "did", "th", "n", "size"), "vid"), spec).select("comp", "vid", "did", "th", "size", "block", "blocks")
    rows = _member_shingles(keyed, members, spec)
    pairs = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pairs = pairs.withColumns({"b_low": F.least("block", "other"), "b_high": F.greatest("block", "other")}).drop("other", "blocks")
    linked = stage_table(pairs.groupBy("comp", "b_low", "b_high").applyInPandas(lambda pdf: _join_block(pdf, spec), "vid bigint, links bigint, root bigint"), "links")

    joined = connected_components(linked.select(F.col("vid").alias("a"), F.col("root").alias("b"))).select(F.col("vertex").alias("vid"), "root")
    named = joined.join(classes.select("vid", "did"), "vid")
    named = stage_table(named, "named")
    first = stage_table(named.groupBy("root").agg(F.min("did").alias("class_did")), "first")
    named = named.join(first, "root").select("vid", "class_did", "root")
    totals = linked.groupBy("vid").agg(F.sum("links").alias("links"))
    judged = classes.select("f1", "f2", "vid", "size", F.col("did").alias("rep_did")).join(totals, "vid", "left").join(named, "vid", "left")
    out = found.select("did", "th", "n", "f1", "f2").join(judged.withColumn("some", F.lit(True)), ["f1", "f2"], "left")
    own = F.col("some").isNull() | (F.col("n") == 0)

    def as_id(column):
        value = F.when(own, F.col("did")).otherwise(column)
        return F.when(value < 2**63 - 1, value)

    return out.select(
        "did",
        "th",
        F.when(F.col("did") < 2**63 - 1, F.col("did")).alias("row_id"),
        as_id(F.coalesce("class_did", "rep_did")).alias("class_id"),
        as_id(F.col("rep_did")).alias("rep_id"),
        F.when(own, F.lit(0).cast("long")).otherwise(F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"),
        F.when(~own, F.coalesce("root", "vid")).alias("class_key"),
    )


def jaccard_links(df: DataFrame, spec: JoinSpec = JoinSpec(), *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, class_id, rep_id, n_links), a row per document."""
    return similar(df, spec, id_col=id_col, text_col=text_col).select(F.col("row_id").alias(id_col), "class_id", "rep_id", "n_links")


def one_of_each(df: DataFrame, spec: JoinSpec = JoinSpec(), *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with one document of each class, that of the least id.  Texts
    without words all stay."""
    found = similar(df, spec, id_col=id_col, text_col=text_col)
    kept = found.where("class_key is not null").groupBy("class_key").agg(F.min(F.struct("did", "th")).alias("one")).select("one.*")
    key = {"__did": F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)), "__th": F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))}
    has_words = F.coalesce(F.col(text_col).rlike(WORD), F.lit(False))
    rows = df.where(has_words).withColumns(key)
    left = rows.join(kept, (rows["__did"] == kept["did"]) & (rows["__th"] == kept["th"]), "left_semi")
    return left.dropDuplicates(["__did", "__th"]).select(*df.columns).union(df.where(~has_words))
