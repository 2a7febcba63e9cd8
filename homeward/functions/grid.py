"""Space and time buckets, and the neighbour sets that turn distance and
time-gap predicates into equi-join keys.

A *grid* maps a coordinate to an integer cell, ``floor((x + offset) *
scale)`` per axis.  Two points within ``radius`` metres lie in cells
that a *neighbour set* of one of them enumerates; the other point is
used with its own cell.  Joining on those keys yields every candidate
pair exactly once (the neighbour cells of a point are distinct), and
exact predicates decide.

Two neighbour modes:

``"fixed"``  the 3 x 3 block around the cell, as the classic design does.
    Complete only while a cell is at least ``radius`` wide, i.e. up to
    the latitude the grid was built for.

``"reach"``  only the cells the radius disc of the point actually
    touches, from its own latitude.  Never more cells than ``fixed``
    where ``fixed`` is complete (fewer rows to shuffle, fewer
    candidates), and still complete beyond it: at high latitude it
    takes more longitude cells, it wraps at the antimeridian, and it
    maps the polar caps (``|lat| >= POLAR_LAT_DEG``) onto one longitude
    key so that a pole-side point never needs every meridian's cell.
    Rows with invalid coordinates (NaN, ``|lat| > 90``, ``|lon| > 180``)
    fall back to ``fixed``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column
from pyspark.sql import functions as F

from .geo import EARTH_RADIUS_M

# Fixed values of the classic grids.
CELL_EDGE_M = 101  # cell edge: 100 m match radius plus 1 % margin
GRID_MAX_LAT_DEG = 60.908756256113516  # latitude up to which a metric longitude cell is CELL_EDGE_M wide
UNIFORM_CELLS_PER_DEG = 63710 // 360  # integer division: 176 cells per degree on both axes
UNIFORM_OFFSET_DEG = 180
TIME_SLOT_S = 29800  # time bucket of the space-time match
SCRIPT_TIME_SLOT_S = 28800  # time bucket of the adjacent-slot variant (8 h)

# Latitude from which longitude collapses to one polar key ("reach" mode).
POLAR_LAT_DEG = 89.0
POLAR_LON_KEY = -(2**62)
OUTERMOST_CELL = float(2**61)
# Bits of a packed key: four cell numbers and a slot in one long.  Numbers
# are taken modulo these powers of two, so places at least 8,192 cells apart
# (or times 4,096 slots apart) may share a key; no distance or gap within a
# match does, and the exact predicates part them.
CELL_BITS, SLOT_BITS = 13, 12
# Relative widening of the reach so that rounding never loses a pair.
REACH_MARGIN = 1.0001


@dataclass(frozen=True)
class GridSpec:
    """Cell of a coordinate: ``floor((x + offset) * scale)`` per axis."""

    name: str
    lat_scale: float  # cells per degree of latitude
    lon_scale: float  # cells per degree of longitude
    offset: float = 0.0

    def _cell(self, x: Column, scale: float) -> Column:
        shifted = x + F.lit(self.offset) if self.offset else x
        # far beyond any place on earth, cells stop: neighbours of the
        # outermost ones must still fit into a long
        inside = F.greatest(F.least(shifted * F.lit(scale), F.lit(OUTERMOST_CELL)), F.lit(-OUTERMOST_CELL))
        return F.floor(inside)

    def lat_cell(self, lat: Column) -> Column:
        return self._cell(lat, self.lat_scale)

    def lon_cell(self, lon: Column) -> Column:
        return self._cell(lon, self.lon_scale)

    def cell_height_m(self) -> float:
        return 2 * math.pi * EARTH_RADIUS_M / 360 / self.lat_scale

    def cell_width_m(self, lat_deg: float) -> float:
        return 2 * math.pi * EARTH_RADIUS_M * math.cos(math.radians(lat_deg)) / 360 / self.lon_scale

    def fixed_limit_lat_deg(self, radius_m: float) -> float:
        """Highest latitude at which the 3 x 3 block still covers ``radius_m``."""
        ratio = radius_m * self.lon_scale * 360 / (2 * math.pi * EARTH_RADIUS_M)
        return math.degrees(math.acos(min(1.0, ratio)))


def metric_grid(cell_edge_m: float = CELL_EDGE_M, max_lat_deg: float = GRID_MAX_LAT_DEG) -> GridSpec:
    """Cells ``cell_edge_m`` high everywhere and at least that wide up to
    ``max_lat_deg``."""
    earth = 2 * math.pi * 6371000
    return GridSpec(
        name=f"metric{cell_edge_m:g}",
        lat_scale=earth / (cell_edge_m * 360),
        lon_scale=earth * math.cos(math.radians(max_lat_deg)) / (cell_edge_m * 360),
    )


METRIC = metric_grid()
UNIFORM_176 = GridSpec(
    name="uniform176",
    lat_scale=float(UNIFORM_CELLS_PER_DEG),
    lon_scale=float(UNIFORM_CELLS_PER_DEG),
    offset=float(UNIFORM_OFFSET_DEG),
)


def time_slot(epoch_s: Column, width_s: int) -> Column:
    """Epoch-aligned time bucket ``floor(epoch_s / width_s)``."""
    return F.floor(epoch_s / F.lit(width_s))


def floor_div(x: Column, n: int) -> Column:
    """``floor(x / n)`` of a long in long arithmetic."""
    return x if n == 1 else F.call_function("div", x - F.pmod(x, F.lit(n)), F.lit(n))


def pack_key(cells: Sequence[Column], slot: Column) -> Column:
    """Four cell numbers and a slot as one long."""
    key = F.lit(0).cast("long")
    for cell in cells:
        key = F.shiftleft(key, CELL_BITS).bitwiseOR(cell.bitwiseAND(F.lit((1 << CELL_BITS) - 1).cast("long")))
    return F.shiftleft(key, SLOT_BITS).bitwiseOR(slot.bitwiseAND(F.lit((1 << SLOT_BITS) - 1).cast("long")))


def _valid(lat: Column, lon: Column) -> Column:
    return (F.abs(lat) <= 90) & (F.abs(lon) <= 180)


@dataclass(frozen=True)
class CellKeys:
    """Both sides of a distance equi-join: ``exact`` keys of a point and the
    ``reach`` (neighbour) keys of its partner."""

    grid: GridSpec = METRIC
    radius_m: float = 100.0
    mode: str = "reach"

    def __post_init__(self):
        if self.mode not in ("reach", "fixed"):
            raise ValueError(f"neighbour mode must be 'reach' or 'fixed', not {self.mode!r}")
        if self.mode == "fixed" and self.grid.cell_height_m() < self.radius_m:
            raise ValueError(
                f"grid {self.grid.name}: cells {self.grid.cell_height_m():.1f} m high cannot hold "
                f"a {self.radius_m} m radius with 3 x 3 neighbours; use mode='reach'"
            )

    @property
    def _delta_deg(self) -> float:
        return math.degrees(self.radius_m * REACH_MARGIN / EARTH_RADIUS_M)

    def exact(self, lat: Column, lon: Column) -> tuple[Column, Column]:
        lat_key = self.grid.lat_cell(lat)
        lon_key = self.grid.lon_cell(lon)
        if self.mode == "reach":
            polar = _valid(lat, lon) & (F.abs(lat) >= POLAR_LAT_DEG)
            lon_key = F.when(polar, F.lit(POLAR_LON_KEY)).otherwise(lon_key)
        return lat_key, lon_key

    @property
    def merge_factor(self) -> int:
        """Grid cells to a cell of packed keys: 1, or as many as keep a
        radius at 32 cells where the grid is much finer than the radius (so
        that a reach stays far below 2**CELL_BITS cells)."""
        return max(1, math.ceil(self.radius_m / self.grid.cell_height_m() / 32))

    @property
    def parts(self) -> CellKeys:
        """The keys that packed keys are made of: these, or in ``fixed`` mode
        cells of the grid cut into parts no narrower than the radius, so that
        a coarse grid does not make every point of a place a candidate."""
        n = max(1, math.floor(self.grid.cell_height_m() / self.radius_m)) if self.mode == "fixed" else 1
        g = self.grid
        return replace(self, grid=replace(g, lat_scale=g.lat_scale * n, lon_scale=g.lon_scale * n)) if n > 1 else self

    def span(self, lat: Column, lon: Column, half: Column) -> dict[str, Column]:
        """The cells of ``reach`` as ranges: first and last of each axis
        (``x1 < x0``: none), a second range of longitudes where the disc crosses
        the antimeridian (``w1 < w0``: none; the two may overlap), and whether
        it touches a polar cap (``pole``, 1 or 0: its one longitude key).  Plain
        arithmetic, so that it is compiled with the rest of a stage.  ``half``: a
        column of ``half_width``.

        In ``fixed`` mode, ranges of ``parts`` that hold every point of the
        3 x 3 block that is within the radius; the block itself is left to the
        join's condition.  Wherever the disc's half-width does not bound the
        longitude (polar caps, antimeridian, odd coordinates), the range is
        as wide as the block can be."""
        g, d = self.grid, F.lit(self._delta_deg)
        none, empty = F.lit(0).cast("long"), F.lit(-1).cast("long")
        if self.mode == "fixed":
            p = self.parts.grid
            inland = _valid(lat, lon) & (F.abs(lat) + d < POLAR_LAT_DEG) & (lon + half <= 180) & (lon - half >= -180)
            wide = F.when(inland, half).otherwise(F.lit(2.0 / g.lon_scale))
            return {
                "y0": p.lat_cell(lat - d),
                "y1": p.lat_cell(lat + d),
                "x0": p.lon_cell(lon - wide),
                "x1": p.lon_cell(lon + wide),
                "w0": none,
                "w1": empty,
                "pole": none,
            }
        valid = _valid(lat, lon)
        lat_c, lon_c = g.lat_cell(lat), g.lon_cell(lon)
        lo, hi = lon - half, lon + half
        west, east = F.lit(-180.0), F.lit(180.0)
        inner = valid & (F.abs(lat) - d < POLAR_LAT_DEG)
        over, under = inner & (hi > east), inner & (lo < west)
        return {
            "y0": F.when(valid, g.lat_cell(lat - d)).otherwise(lat_c - 1),
            "y1": F.when(valid, g.lat_cell(lat + d)).otherwise(lat_c + 1),
            "x0": F.when(inner, g.lon_cell(lo)).when(valid, none).otherwise(lon_c - 1),
            "x1": F.when(inner, g.lon_cell(hi)).when(valid, empty).otherwise(lon_c + 1),
            "w0": F.when(over, g.lon_cell(west)).when(under, g.lon_cell(lo + 360)).otherwise(none),
            "w1": F.when(over, g.lon_cell(hi - 360)).when(under, g.lon_cell(east)).otherwise(empty),
            "pole": F.when(valid & (F.abs(lat) + d >= POLAR_LAT_DEG), F.lit(1).cast("long")).otherwise(none),
        }

    def half_width(self, lat: Column) -> Column:
        """Largest longitude offset of a partner off the polar caps: the
        disc's half-width at the latitude nearest the pole it can touch."""
        d = self._delta_deg
        widest = F.least(F.abs(lat) + F.lit(d), F.lit(POLAR_LAT_DEG + 2 * d))
        return F.least(F.lit(d) / F.cos(F.radians(widest)), F.lit(180.0))

    def reach(self, lat: Column, lon: Column, half: Column | None = None) -> tuple[Column, Column]:
        """Arrays of latitude and longitude keys to explode (one row per pair)."""
        g = self.grid
        lat_c, lon_c = g.lat_cell(lat), g.lon_cell(lon)
        fixed_lat = F.sequence(lat_c - 1, lat_c + 1)
        fixed_lon = F.sequence(lon_c - 1, lon_c + 1)
        if self.mode == "fixed":
            return fixed_lat, fixed_lon

        d = self._delta_deg
        abs_lat = F.abs(lat)
        reach_lat = F.sequence(g.lat_cell(lat - F.lit(d)), g.lat_cell(lat + F.lit(d)))
        dlon = self.half_width(lat) if half is None else half
        lo, hi = lon - dlon, lon + dlon
        plain = F.sequence(g.lon_cell(lo), g.lon_cell(hi))
        empty = F.array().cast("array<bigint>")
        normal = F.concat(
            plain,
            F.when(hi > 180, F.sequence(g.lon_cell(F.lit(-180.0)), g.lon_cell(hi - 360))).otherwise(empty),
            F.when(lo < -180, F.sequence(g.lon_cell(lo + 360), g.lon_cell(F.lit(180.0)))).otherwise(empty),
        )
        edge = F.array_distinct(
            F.concat(
                F.when(abs_lat - F.lit(d) < POLAR_LAT_DEG, normal).otherwise(empty),
                F.when(abs_lat + F.lit(d) >= POLAR_LAT_DEG, F.array(F.lit(POLAR_LON_KEY))).otherwise(empty),
            )
        )
        # common case first: no antimeridian, no polar cap
        inland = (abs_lat + F.lit(d) < POLAR_LAT_DEG) & (hi <= 180) & (lo >= -180)
        reach_lon = F.when(inland, plain).otherwise(edge)
        valid = _valid(lat, lon)
        return (
            F.when(valid, reach_lat).otherwise(fixed_lat),
            F.when(valid, reach_lon).otherwise(fixed_lon),
        )


@dataclass(frozen=True)
class SlotKeys:
    """Both sides of a time-gap equi-join on epoch-aligned slots.

    Pairs are ``(early, late)`` with ``min_gap_s < late - early < max_gap_s``
    in whole seconds.  ``exact`` is the slot of ``early``; ``reach`` the
    slots of every ``early`` a ``late`` can pair with.  ``mode="adjacent"``
    instead pairs a slot with itself and the slot before, whatever the gap
    (the classic script's rule).
    """

    width_s: int = TIME_SLOT_S
    max_gap_s: int | None = 28800
    min_gap_s: int = 0
    mode: str = "reach"

    def __post_init__(self):
        if self.mode not in ("reach", "fixed", "adjacent"):
            raise ValueError(f"slot mode must be 'reach', 'fixed' or 'adjacent', not {self.mode!r}")
        if self.mode == "fixed" and (self.max_gap_s is None or self.width_s < self.max_gap_s):
            raise ValueError("mode='fixed' pairs only adjacent slots: width_s must be >= max_gap_s")
        if self.mode in ("reach", "fixed") and self.max_gap_s is None:
            raise ValueError("a gap-bounded slot join needs max_gap_s")

    def exact(self, early_s: Column) -> Column:
        return time_slot(early_s, self.width_s)

    def reach_span(self, late_s: Column) -> tuple[Column, Column]:
        """First and last slot of every ``early`` that ``late`` can pair with."""
        if self.mode == "reach":
            first = time_slot(late_s - F.lit(self.max_gap_s - 1), self.width_s)
            last = time_slot(late_s - F.lit(self.min_gap_s + 1), self.width_s)
            return first, F.greatest(first, last)
        slot = time_slot(late_s, self.width_s)
        return slot - 1, slot

    def reach(self, late_s: Column) -> Column:
        return F.sequence(*self.reach_span(late_s))
