"""Hard negatives by zone maps over Hilbert-ordered blocks.

A row's score for an anchor is the inner product of their vectors in whole
numbers (``floor(scale * x)``); higher scores come first, ties by smaller id.
An anchor's positives are its first rows of the same label.  For each positive
the first rows of other labels whose score lies in a window below the
positive's are its hard negatives.

* *Blocks.*  Rows are sorted along a Hilbert curve through the dimensions of
  largest variance and written as Parquet rows of up to ``BLOCK`` vectors, with
  the least and greatest value of every dimension (the zone map).
* *Choosing.*  For an anchor and a block, interval arithmetic over the zone map
  gives bounds of all scores in it, ``[a+ . low + a- . high, a+ . high + a- .
  low]``.  An anchor reads a block for positives if the upper bound reaches
  the last of the positives that its own block gives it, and for negatives if
  the bounds meet one of its windows.  Only zone maps take part in this.
* *Reading.*  Chosen blocks meet the anchors that chose them, in groups of up
  to ``GROUP``; a task scores a block against a group with one matrix product
  and keeps the first rows of each anchor over all blocks it reads, so a task
  sends a few rows for each anchor and not one for each pair.

Anchors (a stated part of the rows) are compared with all rows in blocks, as
far as bounds cannot rule a block out: work grows with anchors times chosen
blocks.  Nothing is capped or sampled; block and group sizes bound memory.

Rows with a null label, a null vector, a null or non-finite component, or a
length other than the first kept row's take no part; a row without id is never an anchor and comes last among equal scores.
An anchor's own id is never among its positives and negatives.  Rows equal in
id, label and vector are one anchor; as candidates each counts.  Components
have to stay below 2**31 once scaled, and labels are whole numbers.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import NO_ID, map_arrow, stage_table
from .vectors import integer_matrix, whole_vectors

BLOCK, GROUP = 1024, 1024
SCALE, EVERY, POSITIVES, NEGATIVES = 256, 50, 5, 3
# window of negatives, in hundredths of the positive's score
WINDOW = (50, 95)
HILBERT_DIMS, HILBERT_BITS = 8, 7
# zone maps that travel together, and ranges of anchors before hashing
_STRIPE, _RANGES = 256, 4096
_NONE = -(2**62)  # no score

_BLOCK_SCHEMA = "block long, size int, ids binary, labels binary, vectors binary, low binary, high binary"


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each row of ``cells`` (whole numbers below 2**bits) on the
    Hilbert curve (Skilling's transform, for all rows at once)."""
    x = [c.copy() for c in cells.T.astype(np.int64)]
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            flip = (x[i] & q) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(flip, x[0] ^ p, x[0]) ^ swap
            x[i] = x[i] ^ swap if i else x[0]
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn = np.where((x[n - 1] & q) != 0, turn ^ (q - 1), turn)
        q >>= 1
    place = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            place = place << 1 | ((x[i] ^ turn) >> bit) & 1
    return place


def _spread_of(rows: DataFrame, scale: int) -> tuple[list[int], np.ndarray, np.ndarray]:
    """The dimensions of largest variance and their ranges, from all rows
    (a few numbers for each dimension and task are shuffled)."""

    def sums(batches):
        for batch in batches:
            if len(batch):
                values = integer_matrix(batch.column(0), scale).astype(np.float64)
                cols = [np.arange(values.shape[1]), np.full(values.shape[1], float(len(values))), values.sum(0), (values**2).sum(0), values.min(0), values.max(0)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["d", "n", "s", "q", "low", "high"])

    found = map_arrow(rows.select("vector"), sums, "d long, n double, s double, q double, low double, high double")
    found = found.groupBy("d").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"), F.min("low").alias("low"), F.max("high").alias("high"))
    stats = sorted(found.collect(), key=lambda r: (-(r["q"] / r["n"] - (r["s"] / r["n"]) ** 2), r["d"]))[:HILBERT_DIMS]
    return [r["d"] for r in stats], np.array([r["low"] for r in stats]), np.array([r["high"] for r in stats])


def blocks_of(rows: DataFrame, scale: int = SCALE, size: int = BLOCK) -> DataFrame:
    """``whole_vectors`` of one length, as a written table of blocks."""
    dims, low, high = _spread_of(rows, scale)
    bits = HILBERT_BITS
    step = np.maximum(high - low, 1.0)

    def placed(batches):
        for batch in batches:
            if not len(batch):
                continue
            values = integer_matrix(batch.column(2), scale)
            cells = ((values[:, dims] - low) / step * ((1 << bits) - 1)).astype(np.int64)
            packed = pa.array([v.tobytes() for v in values.astype("<i4")], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(hilbert(cells, bits)), batch.column(0), batch.column(1), packed], names=["place", "vec_id", "label", "v"])

    def cut(batches):
        part, seen = TaskContext.get().partitionId(), 0
        held: list[pa.RecordBatch] = []

        def blocks(last: bool):
            nonlocal held, seen
            table = pa.Table.from_batches(held).combine_chunks()
            whole = len(table) if last else len(table) // size * size
            for start in range(0, whole, size):
                rows = table.slice(start, min(size, whole - start)).to_batches()[0]
                ids = rows.column(1).to_numpy(zero_copy_only=False)
                order = np.argsort(ids, kind="stable")  # a block lists its rows by id
                v = np.frombuffer(b"".join(rows.column(3).to_pylist()), "<i4").reshape(len(ids), -1)[order]
                labels = rows.column(2).to_numpy(zero_copy_only=False)[order]
                fields = [part << 32 | seen, len(ids), ids[order].astype("<i8").tobytes(), labels.astype("<i8").tobytes(), v.tobytes(), v.min(0).tobytes(), v.max(0).tobytes()]
                types = [pa.int64(), pa.int32()] + [pa.binary()] * 5
                names = ["block", "size", "ids", "labels", "vectors", "low", "high"]
                yield pa.RecordBatch.from_arrays([pa.array([f], t) for f, t in zip(fields, types)], names=names)
                seen += 1
            held = table.slice(whole).to_batches()

        for batch in batches:
            if len(batch):
                held.append(batch)
                if sum(map(len, held)) >= size:
                    yield from blocks(False)
        if held:
            yield from blocks(True)

    keyed = map_arrow(
        rows.select(F.coalesce("vec_id", F.lit(NO_ID)).alias("vec_id"), F.col("label").cast("long").alias("label"), "vector"),
        placed,
        "place long, vec_id long, label long, v binary",
    )
    keyed = stage_table(keyed, "hilbert-places")
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = min(n, max(1, math.ceil(keyed.count() / size)))
    sorted_rows = keyed.repartitionByRange(n, "place", "vec_id", "label", "v").sortWithinPartitions("place", "vec_id", "label", "v")
    return stage_table(map_arrow(sorted_rows, cut, _BLOCK_SCHEMA), "hilbert-blocks")


def _matrix(raw: bytes, rows: int) -> np.ndarray:
    return np.frombuffer(raw, "<i4").reshape(rows, -1)


def _scores(anchors: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact inner products: by floats while sums stay below 2**53."""
    most = int(max(np.abs(anchors.astype(np.int64)).max(initial=0), np.abs(vectors.astype(np.int64)).max(initial=0)))
    if most * most * anchors.shape[1] < 2**53:
        return (anchors.astype(np.float64) @ vectors.T.astype(np.float64)).astype(np.int64)
    return anchors.astype(np.int64) @ vectors.T.astype(np.int64)


def _first(scores: np.ndarray, allowed: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(scores, ids) of the first ``k`` allowed columns of each row; columns
    are in order of their ids."""
    found = np.full((len(scores), k), _NONE), np.full((len(scores), k), NO_ID)
    at, columns = np.nonzero(allowed)
    if not len(at):
        return found
    order = np.lexsort((columns, -scores[at, columns], at))
    at, columns = at[order], columns[order]
    start = np.searchsorted(at, np.arange(len(scores)))
    rank = np.arange(len(at)) - start[at]
    keep = rank < k
    at, columns, rank = at[keep], columns[keep], rank[keep]
    found[0][at, rank], found[1][at, rank] = scores[at, columns], ids[columns]
    return found


def _merge(one, other, k: int):
    """First ``k`` of two lists of (scores, ids), along the last axis."""
    scores, ids = np.concatenate([one[0], other[0]], -1), np.concatenate([one[1], other[1]], -1)
    order = np.argsort(ids, axis=-1, kind="stable")
    order = np.take_along_axis(order, np.argsort(-np.take_along_axis(scores, order, -1), axis=-1, kind="stable"), -1)[..., :k]
    return np.take_along_axis(scores, order, -1), np.take_along_axis(ids, order, -1)


def anchors_of(blocks: DataFrame, every: int = EVERY, positives: int = POSITIVES) -> DataFrame:
    """(anchor_id, label, v, block, bound) of every anchor; ``bound`` is the
    score of the last positive that its own block has."""

    def found(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids, labels = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["labels"], "<i8")
                v = _matrix(row["vectors"], row["size"])
                at = np.flatnonzero((ids % every == 0) & (ids != NO_ID))
                if not len(at):
                    continue
                bound = np.full(len(at), _NONE)
                for part in range(0, len(at), 256):
                    mine = at[part : part + 256]
                    same = (labels[mine][:, None] == labels) & (ids[mine][:, None] != ids)
                    bound[part : part + 256] = _first(_scores(v[mine], v), same, ids, positives)[0][:, -1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[at]), pa.array(labels[at]), pa.array([x.tobytes() for x in v[at]], pa.binary()), pa.array(np.full(len(at), row["block"])), pa.array(bound)],
                    names=["anchor_id", "label", "v", "block", "bound"],
                )

    anchors = map_arrow(blocks, found, "anchor_id long, label long, v binary, block long, bound long")
    return anchors.groupBy("anchor_id", "label", "v").agg(F.min("block").alias("block"), F.max("bound").alias("bound"))


def groups_of(anchors: DataFrame, size: int = GROUP) -> DataFrame:
    """Anchors of neighbouring blocks in groups of about ``size``: (g,
    members).  Ranges of blocks hold equally many anchors; what one range has
    too many of (the copies of one vector) is dealt by a hash."""
    total = anchors.count()
    ranges = min(_RANGES, max(1, math.ceil(total / size)))
    edges = []
    if ranges > 1:
        share = [i / ranges for i in range(1, ranges)]
        edges = sorted(set(anchors.agg(F.percentile_approx("block", share, 10 * ranges).alias("e")).first()["e"]))
    place = F.size(F.filter(F.array(*[F.lit(e).cast("long") for e in edges]), lambda e: e < F.col("block"))) if edges else F.lit(0)
    ranged = anchors.withColumn("range", place)
    counts = {r["range"]: math.ceil(r["count"] / size) for r in ranged.groupBy("range").count().collect()}
    dealt = F.get(F.array(*[F.lit(counts.get(i, 1)) for i in range(len(edges) + 1)]), F.col("range"))
    g = F.col("range").cast("long") * (1 << 32) + F.pmod(F.xxhash64("anchor_id", "v"), dealt)
    return ranged.withColumn("g", g).groupBy("g").agg(F.sort_array(F.collect_list(F.struct("anchor_id", "label", "v", "bound"))).alias("members"))


_CHOSEN = "block long, g long, size int, places binary, anchor_ids binary, anchor_labels binary, anchors binary, windows binary"


def _choose(groups: DataFrame, zones: DataFrame) -> DataFrame:
    """A row for each group and block that some of its anchors must read, with
    those anchors.  ``groups``: (stripe, g, members), a member being
    (anchor_id, label, v, lowest, highest, windows)."""

    def chosen(batches):
        for batch in batches:
            for row in batch.to_pylist():
                members = row["members"]
                a = np.frombuffer(b"".join(m["v"] for m in members), "<i4").reshape(len(members), -1).astype(np.float64)
                low = np.frombuffer(b"".join(z["low"] for z in row["zones"]), "<i4").reshape(len(row["zones"]), -1).astype(np.float64)
                high = np.frombuffer(b"".join(z["high"] for z in row["zones"]), "<i4").reshape(len(row["zones"]), -1).astype(np.float64)
                up, down = np.maximum(a, 0), np.minimum(a, 0)
                # sums beyond 2**53 round: widened, so that no block is missed
                most, least = up @ high.T + down @ low.T, up @ low.T + down @ high.T
                slack = 1e-12 * (np.abs(most) + np.abs(least)) * (np.maximum(np.abs(most), np.abs(least)) >= 2**52)
                lowest, highest = np.array([m["lowest"] for m in members], np.float64), np.array([m["highest"] for m in members], np.float64)
                needs = (most + slack >= lowest[:, None]) & (least - slack <= highest[:, None])
                ids, labels = np.array([m["anchor_id"] for m in members], "<i8"), np.array([m["label"] for m in members], "<i8")
                for z, zone in enumerate(row["zones"]):
                    at = np.flatnonzero(needs[:, z])
                    if len(at):
                        windows = b"".join(members[i]["windows"] for i in at)
                        fields = [zone["block"], row["g"], len(at), at.astype("<i4").tobytes(), ids[at].tobytes(), labels[at].tobytes(), a[at].astype("<i4").tobytes(), windows]
                        types = [pa.int64(), pa.int64(), pa.int32()] + [pa.binary()] * 5
                        names = [f.split()[0] for f in _CHOSEN.split(", ")]
                        yield pa.RecordBatch.from_arrays([pa.array([f], t) for f, t in zip(fields, types)], names=names)

    return map_arrow(groups.join(zones, "stripe").select("g", "members", "zones"), chosen, _CHOSEN)


def _read(chosen: DataFrame, blocks: DataFrame, depth: int, k: int, negatives: bool) -> DataFrame:
    """First ``k`` rows of each anchor (and window) over chosen blocks, as far
    as a task has read them: (g, place, anchor_id, window, id, score)."""

    def scored(batches):
        tops: dict[int, tuple] = {}  # of each group: (scores, ids) by place, and anchor ids
        for batch in batches:
            for row in batch.to_pylist():
                n, m = row["size"], row["rows"]
                place, own = np.frombuffer(row["places"], "<i4"), np.frombuffer(row["anchor_ids"], "<i8")
                own_labels = np.frombuffer(row["anchor_labels"], "<i8")
                ids, labels = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["labels"], "<i8")
                windows = np.frombuffer(row["windows"], "<i8").reshape(n, depth, 2)
                scores = _scores(_matrix(row["anchors"], n), _matrix(row["vectors"], m))
                allowed = ((own_labels[:, None] != labels) if negatives else (own_labels[:, None] == labels)) & (own[:, None] != ids)
                firsts = [_first(scores, allowed & (scores >= windows[:, w, :1]) & (scores <= windows[:, w, 1:]), ids, k) for w in range(depth)]
                new = np.stack([f[0] for f in firsts], 1), np.stack([f[1] for f in firsts], 1)
                size = place[-1] + 1
                held = tops.get(row["g"])
                if held is None or len(held[2]) < size:
                    grown = np.full((size, depth, k), _NONE), np.full((size, depth, k), NO_ID), np.zeros(size, np.int64)
                    if held is not None:
                        for g, h in zip(grown, held):
                            g[: len(h)] = h
                    tops[row["g"]] = held = grown
                merged = _merge((held[0][place], held[1][place]), new, k)
                held[0][place], held[1][place], held[2][place] = merged[0], merged[1], own
        for g, (scores, ids, own) in tops.items():
            place, window, rank = np.nonzero(scores > _NONE)
            for start in range(0, len(place), 1 << 16):
                p, w, r = (x[start : start + (1 << 16)] for x in (place, window, rank))
                cols = [np.full(len(p), g), p, own[p], w, ids[p, w, r], scores[p, w, r]]
                yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in cols], names=["g", "place", "anchor_id", "window", "id", "score"])

    payload = blocks.select("block", F.col("size").alias("rows"), "ids", "labels", "vectors")
    return map_arrow(chosen.join(payload, "block").drop("block"), scored, "g long, place long, anchor_id long, window long, id long, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` of each anchor and window over all tasks, ranked."""
    order = Window.partitionBy("g", "place", "window").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    scale: int = SCALE,
    every: int = EVERY,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    window: tuple[int, int] = WINDOW,
    block: int = BLOCK,
    group: int = GROUP,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score): for each anchor (id divisible by ``every``) and positive
    the first rows of other labels with ``window[0] * positive <= 100 *
    negative <= window[1] * positive``."""
    spark = vectors.sparkSession
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    rows = whole_vectors(vectors, id_col, vector_col, label_col).where(F.col("label").isNotNull())
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector").select(F.size("vector").alias("n")).limit(1).collect()
    if not first:
        return spark.createDataFrame([], schema)
    blocks = blocks_of(rows.where(F.size("vector") == first[0]["n"]), scale, block)
    members = stage_table(groups_of(anchors_of(blocks, every, positives), group), "anchor-groups")

    stripes = max(1, math.ceil(blocks.count() / _STRIPE))
    zones = blocks.select(F.pmod(F.xxhash64("block"), F.lit(stripes)).cast("int").alias("stripe"), "block", "low", "high")
    zones = stage_table(zones.groupBy("stripe").agg(F.collect_list(F.struct("block", "low", "high")).alias("zones")), "zone-maps")
    every_stripe = F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))).alias("stripe")

    whole = F.lit(np.array([_NONE + 1, 2**62], "<i8").tobytes())
    seeded = F.transform("members", lambda m: F.struct(m["anchor_id"].alias("anchor_id"), m["label"].alias("label"), m["v"].alias("v"), m["bound"].alias("lowest"), F.lit(2**62).alias("highest"), whole.alias("windows")))
    chosen = _choose(members.select("g", seeded.alias("members"), every_stripe), zones)
    found = stage_table(_best(_read(chosen, blocks, 1, positives, False), positives), "positives")

    # windows of the anchors that have positives, packed by positive
    listed = found.groupBy("g", "place").agg(F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("of"))
    placed = members.select("g", F.posexplode("members").alias("place", "m")).join(listed.withColumn("place", F.col("place").cast("int")), ["g", "place"])
    ready = _windows(placed.select("g", "m.anchor_id", "m.label", "m.v", "of"), positives, window).where("lowest <= highest")
    again = ready.groupBy("g").agg(F.sort_array(F.collect_list(F.struct("anchor_id", "label", "v", "lowest", "highest", "windows"))).alias("members"))
    again = stage_table(again, "anchor-windows")
    chosen = _choose(again.select("g", "members", every_stripe), zones)
    best = _best(_read(chosen, blocks, positives, negatives, True), negatives)

    # an anchor of this stage by its place in both lists
    own = again.select("g", F.posexplode("members").alias("at", "m")).select("g", F.col("at").cast("long").alias("at"), F.col("m.anchor_id"), F.col("m.label"), F.col("m.v"))
    before = members.select("g", F.posexplode("members").alias("place", "m")).select("g", F.col("place").cast("long").alias("place"), "m.anchor_id", "m.label", "m.v")
    places = own.join(before, ["g", "anchor_id", "label", "v"]).select("g", "at", "place")
    links = places.join(found.select("g", "place", F.col("rank").alias("window"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), ["g", "place"])
    hits = best.select("g", F.col("place").alias("at"), "anchor_id", (F.col("window") + 1).alias("window"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    joined = hits.join(links, ["g", "at", "window"])
    known = [F.when(F.col(c) != NO_ID, F.col(c)).alias(c) for c in ("positive_id", "negative_id")]
    return joined.select("anchor_id", known[0], F.col("rank").cast("int").alias("rank"), known[1], "positive_score", "negative_score")


def _windows(anchors: DataFrame, positives: int, window: tuple[int, int]) -> DataFrame:
    """Score windows of each anchor's positives as bytes, and their hull;
    scores are whole, so bounds are rounded inwards."""

    def packed(batches):
        for batch in batches:
            rows = batch.to_pylist()
            out = []
            for row in rows:
                bounds = np.tile(np.array([1, 0], "<i8"), (positives, 1))  # holds no score
                for of in row["of"]:
                    p = of["score"]
                    bounds[of["rank"] - 1] = -((-window[0] * p) // 100), (window[1] * p) // 100
                some = bounds[bounds[:, 0] <= bounds[:, 1]]
                out.append((int(some[:, 0].min()) if len(some) else 1, int(some[:, 1].max()) if len(some) else 0, bounds.tobytes()))
            cols = [pa.array([r[c] for r in rows], t) for c, t in (("g", pa.int64()), ("anchor_id", pa.int64()), ("label", pa.int64()), ("v", pa.binary()))]
            cols += [pa.array([o[i] for o in out], t) for i, t in ((0, pa.int64()), (1, pa.int64()), (2, pa.binary()))]
            yield pa.RecordBatch.from_arrays(cols, names=["g", "anchor_id", "label", "v", "lowest", "highest", "windows"])

    return map_arrow(anchors, packed, "g long, anchor_id long, label long, v binary, lowest long, highest long, windows binary")
