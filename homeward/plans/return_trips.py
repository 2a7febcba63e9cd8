"""Return-trip matching.

Trip *b* is a return trip of trip *a* when

1. ``0 < b.pickup - a.dropoff < max_gap_s`` (whole seconds);
2. ``b.pickup`` is within ``radius_m`` metres of ``a.dropoff``;
3. ``b.dropoff`` is within ``radius_m`` metres of ``a.pickup``.

The theta self-join becomes an equi-join on bucket keys plus the exact
predicates as the join's residual; nothing forms all pairs.

Fine keys (100 m cells, slots of about 8 h)::

    to   (trip a): a.pickup cloned to the cells its 100 m disc touches,
                   exact cell of a.dropoff, exact slot of a.dropoff
    back (trip b): exact cell of b.dropoff, b.pickup cloned to its cells
                   and to the slots of every dropoff it can follow
    to JOIN back ON 5 keys, residual: gap, distance x 2

Each pair meets in exactly one (to, back) clone combination, so the
result is a bag with the input's multiplicities and needs no
de-duplication.

One plan at every size, in two resolutions:

* Each trip is cloned to *wide* keys (``WIDE`` coarse cells of
  ``Layout.coarse`` fine cells, about 4 rows per trip for both sides instead
  of about 20), packed into one long, and each side has one exchange on it.
* Behind the exchange, rows are cloned to the fine keys inside their wide one
  and joined where they are (``operators.balanced.wide_join``).
* Fine keys of too many candidates are found before the match and cut into
  a grid, on which equal trips travel as one row with a count.  So no task is
  given many more candidates than others, however dense a place is.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.utils import is_remote

from ..functions.geo import EARTH_RADIUS_M, cos_lat, epoch_seconds, within
from ..functions.grid import (
    METRIC,
    REACH_MARGIN,
    SCRIPT_TIME_SLOT_S,
    TIME_SLOT_S,
    CELL_EDGE_M,
    CellKeys,
    GridSpec,
    SlotKeys,
    floor_div,
    metric_grid,
    pack_key,
    time_slot,
    CELL_BITS,
    SLOT_BITS,
)
from ..operators.clean import clean as clean_input
from ..operators.clean import nonzero_coordinates
from ..operators.expand import clones_within, explode_keys, masked, numbered, polar_cell, range_clones, some, with_span
from ..operators.balanced import PAIRS, balanced_join, keyed_join, wide_join
from ..operators.summary import count_rows
from ..session import keep
from ..sources.schema import CANONICAL, YELLOW_CAB, TripColumns

PAIR_COLUMNS = tuple(f"to_{c}" for c in CANONICAL) + tuple(f"back_{c}" for c in CANONICAL)
# Columns of the adjacent-slot variant: no to.pickup time, no back.dropoff time.
ADJACENT_COLUMNS = tuple(c for c in PAIR_COLUMNS if c not in ("to_pickup_ts", "back_dropoff_ts"))


@dataclass(frozen=True)
class MatchSpec:
    """Parameters of a return-trip match.

    ``slot_mode``: ``"reach"`` (slots from the gap; any width works),
    ``"fixed"`` (a slot and the one before; width must cover the gap),
    ``"adjacent"`` (same keys, and no upper gap limit: the script rule),
    ``"none"`` (space-only key: every time pairs, candidates grow with the
    time span; kept to count the classic space-only candidates).
    """

    radius_m: float = 100.0
    max_gap_s: int | None = 28800
    grid: GridSpec | None = None  # None: 101 m cells, or 1.01 x radius above 100 m
    neighbours: str = "reach"
    slot_width_s: int = TIME_SLOT_S
    slot_mode: str = "reach"

    @property
    def cells(self) -> CellKeys:
        return CellKeys(self.fine_grid, self.radius_m, self.neighbours)

    @property
    def fine_grid(self) -> GridSpec:
        if self.grid is not None:
            return self.grid
        # cells about as wide as the radius keep the reach to a 3 x 3 block
        return METRIC if self.radius_m <= 100.0 else metric_grid(self.radius_m * CELL_EDGE_M / 100.0)

    @property
    def slots(self) -> SlotKeys | None:
        if self.slot_mode == "none":
            return None
        max_gap = self.max_gap_s if self.slot_mode != "adjacent" else None
        return SlotKeys(self.slot_width_s, max_gap, 0, self.slot_mode)


CANONICAL_SPEC = MatchSpec()
# The script's uniform 176-per-degree grid is kept as an option; with
# ``neighbours="reach"`` the candidate grid never changes the result, and
# 101 m cells give far fewer candidates than 632 m ones.
ADJACENT_SPEC = MatchSpec(max_gap_s=None, slot_width_s=SCRIPT_TIME_SLOT_S, slot_mode="adjacent")


def trip_table(trips: DataFrame, cols: TripColumns = YELLOW_CAB) -> DataFrame:
    """The six matching columns under canonical names (the other columns
    are pruned from the scan)."""
    return trips.select(*[F.col(src).alias(dst) for src, dst in zip(cols.names(), CANONICAL)])


def matchable(base: DataFrame) -> DataFrame:
    """Rows that can be in a pair: no null, and finite coordinates (no
    distance to NaN or infinity is within a radius).  Finite values out of
    range stay: equal ones match by definition.  On input columns, so such
    rows never reach an exchange.

    ``x * 0`` is 0 for finite x alone, so one sum tests all coordinates and
    names each once: where columns are derived, the condition holds their
    expressions, and generated code that names them several times passes the
    size up to which the JVM compiles a method (8,000 bytes), which made
    such a scan ten times slower."""
    zero, times = F.lit(0.0), None
    for name in CANONICAL:
        if name.endswith("_ts"):
            term = F.col(name).isNotNull()
            times = term if times is None else times & term
        else:
            zero = zero + F.col(name) * F.lit(0.0)
    return base.where((zero == 0.0) & times)


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows over the cluster's cores when the input has fewer
    splits than there are cores: a small file, or one of any size that
    cannot be split (gzip), would be cloned in one task.

    Real splits are counted, which runs no job as long as the plan has no
    exchange; behind an exchange the rows are dealt already."""
    if is_remote():  # no access to the plan
        return df
    query = df._jdf.queryExecution()
    if re.search(r"(?m)^[ :+*()0-9-]*Exchange ", query.executedPlan().toString()):
        return df
    splits = query.toRdd().getNumPartitions()
    target = parallelism(df.sparkSession)
    if not 0 < splits < target:
        return df
    # dealt by row number, which a scan gives again when a task is lost; a
    # plain repartition would sort each split first
    numbered = df.withColumn("_row", F.monotonically_increasing_id())
    return numbered.repartition(target, "_row").drop("_row")


def parallelism(spark) -> int:
    """Cores of the cluster (the shuffle partition setting where the
    session exposes no SparkContext, as with Spark Connect)."""
    if is_remote():
        return int(spark.conf.get("spark.sql.shuffle.partitions"))
    return int(spark.sparkContext.defaultParallelism)


def _epoch(df: DataFrame, name: str) -> Column:
    return epoch_seconds(F.col(name), df.schema[name].dataType)


def _role(base: DataFrame, prefix: str) -> DataFrame:
    return base.select(*[F.col(c).alias(f"{prefix}_{c}") for c in CANONICAL])


# Join keys of the fine level: (to column, back column).
_FINE_SPACE = [("_t_plat", "_b_dlat"), ("_t_plon", "_b_dlon"), ("_t_dlat", "_b_plat"), ("_t_dlon", "_b_plon")]
_FINE_TIME = [("_t_slot", "_b_slot")]


def _fine_keys(spec: MatchSpec) -> list[tuple[str, str]]:
    return _FINE_SPACE + (_FINE_TIME if spec.slots is not None else [])


def _fine_to(to: DataFrame, spec: MatchSpec) -> DataFrame:
    """Outbound trip: exact dropoff cell and slot, pickup cloned to the
    cells its radius disc touches."""
    cells, slots = spec.cells, spec.slots
    dlat, dlon = cells.exact(F.col("to_dropoff_lat"), F.col("to_dropoff_lon"))
    exact = {"_t_dlat": dlat, "_t_dlon": dlon}
    if slots is not None:
        exact["_t_slot"] = slots.exact(_epoch(to, "to_dropoff_ts"))
    plat, plon = cells.reach(F.col("to_pickup_lat"), F.col("to_pickup_lon"))
    return explode_keys(to.withColumns(exact), {"_t_plat": plat, "_t_plon": plon})


def _fine_back(back: DataFrame, spec: MatchSpec) -> DataFrame:
    """Return trip: exact dropoff cell, pickup cloned to its neighbour cells
    and to the slots of every dropoff it can follow."""
    cells, slots = spec.cells, spec.slots
    dlat, dlon = cells.exact(F.col("back_dropoff_lat"), F.col("back_dropoff_lon"))
    plat, plon = cells.reach(F.col("back_pickup_lat"), F.col("back_pickup_lon"))
    clones = {"_b_plat": plat, "_b_plon": plon}
    if slots is not None:
        clones["_b_slot"] = slots.reach(_epoch(back, "back_pickup_ts"))
    return explode_keys(back.withColumns({"_b_dlat": dlat, "_b_dlon": dlon}), clones)


def _sides(base: DataFrame, spec: MatchSpec) -> tuple[DataFrame, DataFrame, list[tuple[str, str]]]:
    return _fine_to(_role(base, "to"), spec), _fine_back(_role(base, "back"), spec), _fine_keys(spec)


@dataclass(frozen=True)
class Layout:
    """How the work of a match is cut (never changes the result).

    ``coarse``: edge of a coarse cell in fine cells; trips travel by cells of
    ``WIDE`` coarse edges.  ``pairs``: candidates of a fine key beyond which it
    is split; by default ``PAIRS``, or more where all keys are that large.
    ``partitions``: of each exchange; by default from the input's size
    (``join_partitions``) and the number of clones.
    """

    coarse: int = 3
    pairs: int | None = None
    partitions: int | None = None


DEFAULT_LAYOUT = Layout()
# coarse edges of the cells that trips travel by, and reaches of the gap that
# their slots last
WIDE, SPAN = 3, 4

# bytes of a cloned row in an exchange, clones of a trip on both sides
_ROW_BYTES, _CLONES, _PARTITION_BYTES = 150, 6, 128 << 20


def _estimated_bytes(df: DataFrame) -> int | None:
    """The planner's estimate; None where it has none (Spark then gives a
    number near the largest long, e.g. for rows made in the driver)."""
    if is_remote():
        return None
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < 1 << 56 else None


def join_partitions(spark, estimate: int | None, row_bytes: int = 56) -> int:
    """Partitions of an exchange of cloned trips, from the estimated bytes
    of the trips: the session's setting, or as many as keep a partition at
    128 MB, whichever is more."""
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if estimate is None:
        return least
    return max(least, math.ceil(estimate / row_bytes * _CLONES * _ROW_BYTES / _PARTITION_BYTES))


def _trip_cells(base: DataFrame, spec: MatchSpec) -> DataFrame:
    """Fine cells and slots of each trip, for either role: the ranges that
    partners of its pickup can lie in, the cell of its dropoff, the slot of its
    dropoff (``_s``) and the slots that its pickup can follow (``_s0`` to
    ``_s1``)."""
    cells, slots, f = spec.cells, spec.slots, spec.cells.merge_factor
    base = with_span(base, cells, "pickup_lat", "pickup_lon")
    lat, lon = cells.parts.exact(F.col("dropoff_lat"), F.col("dropoff_lon"))
    out = {}
    out |= {"_lat": floor_div(lat, f), "_lon": floor_div(lon, f)}
    if slots is None:
        out |= {k: F.lit(0).cast("long") for k in ("_s", "_s0", "_s1")}
    else:
        first, last = slots.reach_span(_epoch(base, "pickup_ts"))
        out |= {"_s": slots.exact(_epoch(base, "dropoff_ts")), "_s0": first, "_s1": last}
    return base.withColumns(out)


def _key(outbound: bool, y: Column, x: Column, lat: Column, lon: Column, slot: Column) -> Column:
    """Packed key of a clone: cells of a.pickup ~ b.dropoff, then of
    a.dropoff ~ b.pickup."""
    return pack_key([y, x, lat, lon] if outbound else [lat, lon, y, x], slot)


def _wide_slots(spec: MatchSpec) -> int:
    """Slots of a wide slot: so many that few trips lie in two of them."""
    slots = spec.slots
    if slots is None:
        return 1
    reach = math.ceil((slots.max_gap_s or slots.width_s) / slots.width_s)
    # numbers of a reach must differ in a packed key, in slots and in wide slots
    return SPAN * reach if SPAN * reach < 1 << (SLOT_BITS - 2) else 1


def _wide_rows(base: DataFrame, spec: MatchSpec, n: int, m: int) -> DataFrame:
    """Trips, one row per key ``_k`` of cells ``n`` fine cells and slots ``m``
    fine slots wide.  A row serves both roles: its cells and slots hold all
    that either needs, and the key has the outbound trip's order."""
    df = _trip_cells(base, spec)
    lat0 = floor_div(F.col("_y0"), n)
    lats = numbered(lat0, floor_div(F.col("_y1"), n), CELL_BITS)
    own, first = floor_div(F.col("_s"), m), floor_div(F.col("_s0"), m)
    df = df.withColumns({"_own": own, "_from": first, "_many": numbered(first, floor_div(F.col("_s1"), m), SLOT_BITS)})
    other = F.pmod(F.col("_own") - F.col("_from"), F.lit(1 << SLOT_BITS).cast("long")) >= F.col("_many")
    df = range_clones(df, lat0, lats, F.col("_many") + other.cast("long"), n, polar_cell(spec.cells))
    slot = F.when(F.col("_j") < F.col("_many"), F.col("_from") + F.col("_j")).otherwise(F.col("_own"))
    key = _key(True, F.col("_y"), F.col("_x"), floor_div(F.col("_lat"), n), floor_div(F.col("_lon"), n), slot)
    return df.select(*CANONICAL, some(key).alias("_k"))


_END_BITS = 2 * CELL_BITS


def _ends(key: Column) -> tuple[Column, Column, Column]:
    """First end, other end and slot of a packed key."""
    return masked(F.shiftrightunsigned(key, SLOT_BITS + _END_BITS), _END_BITS), masked(F.shiftright(key, SLOT_BITS), _END_BITS), masked(key, SLOT_BITS)


def _swapped(key: Column) -> Column:
    """The key with its two ends exchanged: that of the other role."""
    one, two, slot = _ends(key)
    return F.shiftleft(two, SLOT_BITS + _END_BITS).bitwiseOR(F.shiftleft(one, SLOT_BITS)).bitwiseOR(slot)


def _place(key: Column) -> Column:
    """Hash of a wide key whichever end comes first, so that a row is where
    both of its roles are joined."""
    one, two, slot = _ends(key)
    return F.xxhash64(F.least(one, two), F.greatest(one, two), slot)


def _fine_rows(rows: DataFrame, spec: MatchSpec, n: int, m: int, outbound: bool) -> DataFrame:
    """Rows of ``_wide_rows`` in one role, cloned to the fine keys (``_t_f`` or
    ``_b_f``) inside their wide key (``_t_k`` or ``_b_k``), with what the
    residual needs of one trip.  The code has to stay below the size up to
    which the JVM compiles a method (tested)."""
    kept = [c for c in rows.columns if c not in CANONICAL and c != "_k"]
    df = _trip_cells(rows, spec)
    one, _, slot = _ends(F.col("_k"))
    df = df.withColumns({"_wy": F.shiftright(one, CELL_BITS), "_wx": masked(one, CELL_BITS), "_ws": slot})
    # names both times, or each role's exchange would be without the other's
    # and the two would not be one (always true)
    live = F.hash("pickup_ts", "dropoff_ts") <= F.lit(2**31 - 1)
    df = clones_within(df, ("_s", "_s") if outbound else ("_s0", "_s1"), n, m, polar_cell(spec.cells), live)
    fine = _key(outbound, F.col("_y"), F.col("_x"), F.col("_lat"), F.col("_lon"), F.col("_j"))
    role, r = ("to", "_t") if outbound else ("back", "_b")
    out = {
        "f": some(fine),
        "k": F.col("_k") if outbound else some(_swapped(F.col("_k"))),
        "sec": some(_epoch(df, "dropoff_ts" if outbound else "pickup_ts")),
        "pcos": cos_lat(F.col("pickup_lat")),
        "dcos": cos_lat(F.col("dropoff_lat")),
    }
    return df.select(*[F.col(c).alias(f"{role}_{c}") for c in CANONICAL], *kept, *[v.alias(f"{r}_{k}") for k, v in out.items()])


def _counted_rows(base: DataFrame, spec: MatchSpec, n: int, m: int, outbound: bool) -> DataFrame:
    """Keys of ``_fine_rows`` of all trips, without the exchange."""
    df = _trip_cells(base, spec)
    slots = F.lit(1).cast("long") if outbound else F.col("_s1") - F.col("_s0") + 1
    df = df.withColumn("_slot0", F.col("_s" if outbound else "_s0"))
    df = range_clones(df, F.col("_y0"), F.col("_y1") - F.col("_y0") + 1, slots, 1, polar_cell(spec.cells))
    cells = [floor_div(F.col(c), n) for c in ("_y", "_x", "_lat", "_lon")]
    wide = _key(outbound, *cells, floor_div(F.col("_slot0") + F.col("_j"), m))
    fine = _key(outbound, F.col("_y"), F.col("_x"), F.col("_lat"), F.col("_lon"), F.col("_slot0") + F.col("_j"))
    f, k = ("_t_f", "_t_k") if outbound else ("_b_f", "_b_k")
    return df.select(some(fine).alias(f), some(wide).alias(k))


def _match(base: DataFrame, spec: MatchSpec, layout: Layout) -> DataFrame:
    n = layout.partitions or join_partitions(base.sparkSession, _estimated_bytes(base))
    width, slots = layout.coarse * WIDE, _wide_slots(spec)
    roles = (True, False)
    rows = _wide_rows(base, spec, width, slots)
    found = wide_join(
        (rows, rows),
        [("_t_k", "_b_k")],
        tuple(lambda r, o=o: _fine_rows(r, spec, width, slots, o) for o in roles),
        [("_t_f", "_b_f")],
        _residual(spec),
        layout.pairs,
        n,
        counted=tuple(_counted_rows(base, spec, width, slots, o) for o in roles),
        grow=layout.partitions is None,
        dealt_by=(["_k"], ["_k"]),
        place=lambda names: _place(F.col(names[0])),
    )
    return found.select(*PAIR_COLUMNS)


def _residual(spec: MatchSpec, base: DataFrame | None = None) -> Column:
    """The exact predicates of a pair, on the columns of ``_fine_rows``; with
    ``base``, on the trips' columns alone."""
    if base is None:
        to_drop, back_pick = F.col("_t_sec"), F.col("_b_sec")
        cosines = {p: F.col(c) for p, c in (("to_pickup", "_t_pcos"), ("to_dropoff", "_t_dcos"), ("back_pickup", "_b_pcos"), ("back_dropoff", "_b_dcos"))}
    else:
        to_drop = epoch_seconds(F.col("to_dropoff_ts"), base.schema["dropoff_ts"].dataType)
        back_pick = epoch_seconds(F.col("back_pickup_ts"), base.schema["pickup_ts"].dataType)
        cosines = {p: cos_lat(F.col(f"{p}_lat")) for p in ("to_pickup", "to_dropoff", "back_pickup", "back_dropoff")}
    # cheap time test first, trigonometry last
    cond = to_drop < back_pick
    if spec.slot_mode != "adjacent":
        cond = cond & (to_drop + F.lit(spec.max_gap_s) > back_pick)
    else:  # keys hold slots modulo a power of two
        cond = cond & (time_slot(back_pick, spec.slot_width_s) - time_slot(to_drop, spec.slot_width_s) <= 1)
    # A great-circle distance of at most r needs a latitude difference of at
    # most r / R radians: two subtractions discard most candidates before
    # the trigonometry (widened as the neighbour keys are; the distance
    # itself decides).
    dlat = F.lit(math.degrees(spec.radius_m * REACH_MARGIN / EARTH_RADIUS_M))
    cond = cond & (F.abs(F.col("back_pickup_lat") - F.col("to_dropoff_lat")) <= dlat)
    cond = cond & (F.abs(F.col("to_pickup_lat") - F.col("back_dropoff_lat")) <= dlat)
    for a, b in (("back_pickup", "to_dropoff"), ("to_pickup", "back_dropoff")):
        cond = cond & within(spec.radius_m, *((f"{p}_lat", f"{p}_lon", cosines[p]) for p in (a, b)))
    if spec.neighbours == "fixed":
        # the classic design's own limit: the 3 x 3 block of fine cells
        for a, b in (("to_pickup", "back_dropoff"), ("back_pickup", "to_dropoff")):
            for one, other in zip(spec.cells.exact(F.col(a + "_lat"), F.col(a + "_lon")), spec.cells.exact(F.col(b + "_lat"), F.col(b + "_lon"))):
                cond = cond & (F.abs(one - other) <= 1)
    return cond


def _prepare(trips: DataFrame, cols: TripColumns, clean: bool, distinct: bool) -> DataFrame:
    if clean:
        trips = clean_input(trips, cols)
    base = matchable(trip_table(trips, cols))
    if distinct:
        base = base.dropDuplicates()  # shuffle of the narrow input, not of the result
    if clean or distinct:
        base = keep(base, "trips")  # read several times, de-duplicated once
    return spread(base)


def return_trip_candidates(
    trips: DataFrame, spec: MatchSpec = CANONICAL_SPEC, cols: TripColumns = YELLOW_CAB, pairs: int = PAIRS
) -> DataFrame:
    """Pairs sharing fine bucket keys, before the exact predicates (the
    candidate stage of the classic single-level join).  Keys of over
    ``pairs`` candidates are split (counted when called)."""
    to, back, keys = _sides(spread(matchable(trip_table(trips, cols))), spec)
    return balanced_join(to, back, keys, pairs=pairs)


def count_candidates(
    trips: DataFrame, spec: MatchSpec = CANONICAL_SPEC, cols: TripColumns = YELLOW_CAB
) -> DataFrame:
    """Number of candidate pairs of the single-level bucket join (one row,
    ``n``), without forming them: the sum over keys of outbound rows times
    return rows.  Each side is counted per key with map-side partial
    aggregation, so a hot key costs one row per task, and the two count
    tables hold each key once."""
    to, back, keys = _sides(spread(matchable(trip_table(trips, cols))), spec)
    a = to.groupBy(*[t for t, _ in keys]).agg(F.count(F.lit(1)).alias("_na"))
    b = back.groupBy(*[r for _, r in keys]).agg(F.count(F.lit(1)).alias("_nb"))
    product = F.col("_na").cast("decimal(38,0)") * F.col("_nb").cast("decimal(38,0)")
    total = keyed_join(a, b, keys).agg(F.sum(product).alias("_n"))
    return total.select(F.coalesce(F.col("_n"), F.lit(0)).cast("long").alias("n"))


def match_pairs(
    trips: DataFrame,
    spec: MatchSpec = CANONICAL_SPEC,
    cols: TripColumns = YELLOW_CAB,
    clean: bool = False,
    distinct: bool = False,
    layout: Layout = DEFAULT_LAYOUT,
) -> DataFrame:
    return _match(_prepare(trips, cols, clean, distinct), spec, layout)


def match_return_trips(
    trips: DataFrame,
    radius_m: float = 100.0,
    max_gap_s: int = 28800,
    *,
    grid: GridSpec | None = None,
    neighbours: str = "reach",
    slot_width_s: int = TIME_SLOT_S,
    clean: bool = False,
    distinct: bool = False,
    cols: TripColumns = YELLOW_CAB,
    layout: Layout = DEFAULT_LAYOUT,
) -> DataFrame:
    """Every (trip, return trip) pair: 12 columns ``to_*`` and ``back_*``.

    ``clean``: first drop rows equal in all columns and trips without
    positive duration (the cleaning variant).  ``distinct``: the result
    as a set of distinct pairs (computed by de-duplicating the six-column
    input, which gives the same set without shuffling the result).
    ``neighbours="fixed"`` reproduces the classic 3 x 3 block exactly,
    including its losses above the grid's latitude limit.
    """
    spec = MatchSpec(
        radius_m=radius_m,
        max_gap_s=max_gap_s,
        grid=grid,
        neighbours=neighbours,
        slot_width_s=slot_width_s,
        slot_mode="reach",
    )
    return match_pairs(trips, spec, cols, clean=clean, distinct=distinct, layout=layout)


def match_adjacent_slots(
    trips: DataFrame,
    radius_m: float = 100.0,
    *,
    grid: GridSpec | None = None,
    neighbours: str = "reach",
    slot_width_s: int = SCRIPT_TIME_SLOT_S,
    cols: TripColumns = YELLOW_CAB,
    layout: Layout = DEFAULT_LAYOUT,
) -> DataFrame:
    """The script variant: *b* picks up after *a*'s dropoff, in the same or
    the next epoch-aligned slot (no 8 h limit), both ends within
    ``radius_m``; 10 columns, every pair twice (the script clones the
    outbound trip into two slots that are not part of its key).

    The pair is matched once and then emitted twice: the duplication
    costs result rows only, not candidates or shuffle volume.
    """
    spec = replace(ADJACENT_SPEC, radius_m=radius_m, grid=grid, neighbours=neighbours, slot_width_s=slot_width_s)
    pairs = match_pairs(trips, spec, cols, layout=layout)
    twice = pairs.withColumn("_copy", F.explode(F.array(F.lit(0), F.lit(1))))
    return twice.select(*ADJACENT_COLUMNS)


def count_return_trips(
    trips: DataFrame,
    variant: str = "canonical",
    cols: TripColumns = YELLOW_CAB,
    **kwargs,
) -> DataFrame:
    """The count application: drop trips with zero coordinates, match,
    count (one row, column ``n``).  ``variant``: ``canonical``, ``clean``,
    ``distinct`` or ``adjacent``."""
    trips = nonzero_coordinates(trips, cols)
    if variant == "adjacent":
        pairs = match_adjacent_slots(trips, cols=cols, **kwargs)
    elif variant in ("canonical", "clean", "distinct"):
        pairs = match_return_trips(
            trips, cols=cols, clean=variant == "clean", distinct=variant == "distinct", **kwargs
        )
    else:
        raise ValueError(f"unknown variant {variant!r}")
    return count_rows(pairs)
