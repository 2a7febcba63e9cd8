"""Product codes of vectors in whole numbers.

Vectors are scaled to integers and cut into equal parts; each part is coded
by the nearest entry of its position's codebook.  Codebooks start as the
parts of the smallest ids and are improved in rounds (assign, then replace
each entry by the floored mean of its parts).

Distances come from a lexicographic trie over the distinct parts of a batch:
sorted parts are its leaves, and a node holds the distances that its prefix
has accumulated to all entries, so parts that begin alike share that sum.
Nodes are visited in order of the leaves, level by level within a slice of
leaves; a branch without forks is one edge, whose distances are one matrix
product (all numbers are whole and below 2**53, so exact).  A leaf takes the
first least entry and adds its part to it, as often as the part occurs.

A round is one pass over the table: tasks keep sums of ``entries`` numbers a
dimension and a position, so only these are shuffled and collected, whatever
the number of rows, and a vector that many rows share costs its task one leaf.

Rows whose vector is null, holds null or non-finite components, or differs in
length from the first kept vector's are dropped.  A length that is no multiple
of ``parts`` gives the first positions one more component.  With fewer rows
than entries the codebooks are smaller; without rows the result is empty.
Repeated ids are ordered by vector and label, repeated rows get equal results,
and null ids come last.  Scaled components have to stay below 2**24.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, stage_table
from .vectors import integer_matrix, whole_vectors

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
_SLICE = 4096
# rows of a label's total are spread over so many join keys
_SALTS = 16


def cuts(width: int, parts: int) -> list[tuple[int, int]]:
    """Component ranges of the parts."""
    edges = np.cumsum([0] + [len(p) for p in np.array_split(np.arange(width), parts)])
    return list(zip(edges[:-1].tolist(), edges[1:].tolist()))


def leaves(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct rows in lexicographic order, how often each occurs, and the
    leaf of each row."""
    order = np.lexsort(points.T[::-1])
    ordered = points[order]
    new = np.ones(len(points), bool)
    new[1:] = (ordered[1:] != ordered[:-1]).any(axis=1)
    leaf = np.cumsum(new) - 1
    back = np.empty(len(points), np.int64)
    back[order] = leaf
    return ordered[new], np.bincount(leaf), back


def nearest(points: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of distinct sorted points: the trie."""
    entry, distance = np.empty(len(points), np.int64), np.empty(len(points), np.int64)
    for start in range(0, len(points), _SLICE):
        part = points[start : start + _SLICE]
        entry[start : start + _SLICE], distance[start : start + _SLICE] = _walk(part.astype(np.float64), book.astype(np.float64))
    return entry, distance


def _walk(points: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n, width = points.shape
    # components that a leaf shares with the leaf before it
    same = np.full(n + 1, -1)
    if n > 1:
        differs = points[1:] != points[:-1]
        same[1:n] = differs.argmax(axis=1)
    # depth from which no other leaf is below a leaf's node
    alone = np.minimum(np.maximum(same[:n], same[1:]) + 1, width)
    entry, distance = np.zeros(n, np.int64), np.zeros(n, np.int64)
    active = np.arange(n)
    node = np.zeros(n, np.int64)  # of each active leaf, at the present depth
    sums = np.zeros((1, len(book)))  # accumulated distances of each node
    depth = 0
    while len(active):
        done = alone[active] == depth
        if done.any():
            at, tail = active[done], slice(depth, width)
            rest, ends = points[at, tail], book[:, tail]
            total = sums[node[done]] + (rest**2).sum(axis=1)[:, None] - 2 * (rest @ ends.T) + (ends**2).sum(axis=1)
            best = total.argmin(axis=1)  # the first of equally near ones
            entry[at], distance[at] = best, total[np.arange(len(at)), best].astype(np.int64)
            active, node = active[~done], node[~done]
            if not len(active):
                break
        # children: runs of active leaves with one more common component
        value = points[active, depth]
        fork = np.ones(len(active), bool)
        fork[1:] = (node[1:] != node[:-1]) | (value[1:] != value[:-1])
        sums = sums[node[fork]] + (value[fork][:, None] - book[:, depth]) ** 2
        node = np.cumsum(fork) - 1
        depth += 1
    return entry, distance


def _pass(rows: DataFrame, books: list[np.ndarray], scale: int, width: int) -> dict:
    """Sums and counts of one round: {(position, entry): (count, sums)}."""
    ranges = cuts(width, len(books))

    def sums(batches):
        counts = [np.zeros(len(b), np.int64) for b in books]
        totals = [np.zeros(b.shape, np.int64) for b in books]
        for batch in batches:
            if not len(batch):
                continue
            values = integer_matrix(batch.column(0), scale)
            for p, (a, b) in enumerate(ranges):
                points, weights, _ = leaves(values[:, a:b])
                entry, _ = nearest(points, books[p])
                counts[p] += np.bincount(entry, weights, len(books[p])).astype(np.int64)
                for d in range(b - a):
                    totals[p][:, d] += np.bincount(entry, points[:, d] * weights, len(books[p])).astype(np.int64)
        for p, count in enumerate(counts):
            used = np.flatnonzero(count)
            for d in range(-1, totals[p].shape[1]):
                value = count[used] if d < 0 else totals[p][used, d]
                size = len(used)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(size, p)), pa.array(used), pa.array(np.full(size, d)), pa.array(value)], names=["p", "e", "d", "v"])

    found = map_arrow(rows.select("vector"), sums, "p long, e long, d long, v long").groupBy("p", "e", "d").agg(F.sum("v").alias("v"))
    return {(r["p"], r["e"], r["d"]): r["v"] for r in found.collect()}


def train(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> list[np.ndarray]:
    """Codebooks of ``whole_vectors``, an integer matrix for each position; an
    empty list without rows."""
    order = F.col("vec_id").asc_nulls_last(), F.col("vector").asc(), F.col("label").asc()
    first = rows.orderBy(*order).limit(1).collect()
    if not first:
        return []
    width = len(first[0]["vector"])
    rows = rows.where(F.size("vector") == width)
    seeds = np.array([r["vector"] for r in rows.orderBy(*order).limit(entries).collect()], np.float64)
    seeds = np.floor(seeds * scale).astype(np.int64)
    books = [seeds[:, a:b].copy() for a, b in cuts(width, parts)]
    for _ in range(rounds):
        found = _pass(rows, books, scale, width)
        for (p, e, d), v in found.items():
            if d >= 0:
                books[p][e, d] = v // found[p, e, -1]
    return books


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components by position, entry and place, comma-joined."""
    return hashlib.sha256(",".join(str(x) for book in books for x in book.ravel().tolist()).encode()).hexdigest()


def encode(rows: DataFrame, books: list[np.ndarray], scale: int = SCALE) -> DataFrame:
    """(vec_id, label, code, error) of ``whole_vectors``: an index for each
    position as two hex digits (or as many as the largest index needs)."""
    width = sum(b.shape[1] for b in books)
    ranges = cuts(width, len(books)) if books else []
    digits = max([2, *[len(f"{len(b) - 1:x}") for b in books]])

    def codes(batches):
        names = np.array([f"{i:0{digits}x}" for i in range(max([1, *[len(b) for b in books]]))], object)
        for batch in batches:
            if not len(batch):
                continue
            values = integer_matrix(batch.column(2), scale)
            code, error = np.full(len(batch), "", object), np.zeros(len(batch), np.int64)
            for p, (a, b) in enumerate(ranges):
                points, _, leaf = leaves(values[:, a:b])
                entry, distance = nearest(points, books[p])
                code = code + names[entry[leaf]]
                error += distance[leaf]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(code, pa.string()), pa.array(error)], names=["vec_id", "label", "code", "error"])

    label = rows.schema["label"].dataType.simpleString()
    same = rows.where(F.size("vector") == width)
    return map_arrow(same.select("vec_id", "label", "vector"), codes, f"vec_id long, label {label}, code string, error long")


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every kept row."""
    rows = whole_vectors(vectors, id_col, vector_col, label_col)
    books = train(rows, parts, entries, rounds, scale)
    coded = stage_table(encode(rows, books, scale), "vector-codes")
    # totals are written, so that their real size decides how they are joined;
    # beyond the broadcast limit a label's rows go by several keys
    totals = stage_table(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    salts = F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1)))
    totals = totals.select(F.col("label").alias("_label"), "label_error", salts.alias("_salt"))
    salted = coded.withColumn("_own", F.pmod(F.xxhash64("vec_id", "code"), F.lit(_SALTS)).cast("int"))
    joined = salted.join(totals, F.col("label").eqNullSafe(F.col("_label")) & (F.col("_own") == F.col("_salt")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
