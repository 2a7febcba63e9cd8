"""Bucket columns and key clones (row multiplication by ``explode``).

A clone is the same row with one key replaced by a neighbour key; the
other side of the later equi-join keeps its exact key.  Clones are made
on narrow rows (the six trip columns) right before the join's shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import epoch_seconds
from ..functions.grid import CELL_BITS, POLAR_LON_KEY, SLOT_BITS, CellKeys, GridSpec, SlotKeys, floor_div, time_slot


def explode_keys(df: DataFrame, keys: Mapping[str, Column]) -> DataFrame:
    """One output row per combination of the given key arrays.

    Arrays hold distinct values, so each combination occurs once.  A NULL
    array (NULL coordinate) yields no row: such a row cannot match.

    ``explode_outer`` plus a filter on the produced key gives the rows of
    ``explode``; it keeps Catalyst from inferring a non-empty-array filter
    that it would push below an earlier exchange and evaluate twice.
    """
    for name, values in keys.items():
        df = df.withColumn(name, F.explode_outer(values)).where(F.col(name).isNotNull())
    return df


def with_cells(df: DataFrame, grid: GridSpec, lat: str, lon: str, lat_out: str, lon_out: str) -> DataFrame:
    """Add the grid cell of a point (two bigint columns)."""
    return df.withColumns({lat_out: grid.lat_cell(F.col(lat)), lon_out: grid.lon_cell(F.col(lon))})


def with_time_slot(df: DataFrame, ts: str, width_s: int, out: str) -> DataFrame:
    """Add the epoch-aligned time bucket of a timestamp column."""
    dtype = df.schema[ts].dataType
    return df.withColumn(out, time_slot(epoch_seconds(F.col(ts), dtype), width_s))


def neighbour_clones(
    df: DataFrame, cells: CellKeys, lat: str, lon: str, lat_out: str, lon_out: str
) -> DataFrame:
    """One row per neighbour cell of the point (``lat``, ``lon``)."""
    lat_keys, lon_keys = cells.reach(F.col(lat), F.col(lon))
    return explode_keys(df, {lat_out: lat_keys, lon_out: lon_keys})


def time_clones(df: DataFrame, slots: SlotKeys, ts: str, out: str) -> DataFrame:
    """One row per time slot a later event at ``ts`` can be paired with."""
    dtype = df.schema[ts].dataType
    return explode_keys(df, {out: slots.reach(epoch_seconds(F.col(ts), dtype))})


# ---- clones of packed keys, by arithmetic that is compiled with its stage ----


def masked(x: Column, bits: int) -> Column:
    return x.bitwiseAND(F.lit((1 << bits) - 1).cast("long"))


def unmasked(masked: Column, least: Column, bits: int) -> Column:
    """The first number from ``least`` on that is ``masked`` in ``bits`` bits."""
    return least + F.pmod(masked - least, F.lit(1 << bits).cast("long"))


def numbered(first: Column, last: Column, bits: int) -> Column:
    """How many of the numbers from first to last differ modulo 2**bits."""
    return F.least(last - first + 1, F.lit(1 << bits).cast("long"))


def some(number: Column) -> Column:
    """A number that is never null, and says so: a condition on it adds no
    filter below the exchange, which would be one of one role only."""
    return F.coalesce(number, F.lit(0).cast("long"))


def polar_cell(cells: CellKeys) -> int:
    """Longitude number of the polar caps in packed keys."""
    return POLAR_LON_KEY // cells.merge_factor


def with_span(df: DataFrame, cells: CellKeys, lat: str, lon: str) -> DataFrame:
    """Adds the ranges of ``cells.span`` (``_y0`` ... ``_pole``), in cells of
    packed keys."""
    f = cells.merge_factor
    # small steps: a plan is analysed faster than one with copies of a tree
    df = df.withColumn("_half", cells.half_width(F.col(lat)))
    span = cells.span(F.col(lat), F.col(lon), F.col("_half"))
    out = {f"_{k}": v if k == "pole" else floor_div(v, f) for k, v in span.items()}
    if f > 1:  # an empty range stays empty
        for a, b in (("x0", "x1"), ("w0", "w1")):
            out[f"_{b}"] = F.when(span[b] >= span[a], out[f"_{b}"]).otherwise(out[f"_{a}"] - 1)
    return df.withColumns(out).drop("_half")


def range_clones(df: DataFrame, lat0: Column, lats: Column, slots: Column, n: int, pole: int) -> DataFrame:
    """One row for each latitude from ``lat0``, longitude key of cells ``n``
    fine cells wide, and slot number, with one generator: ``_y``, ``_x`` and
    ``_j``.  Longitude keys that are the same in a packed key are one row."""

    def size(a: str, b: str) -> Column:
        some = numbered(floor_div(F.col(a), n), floor_div(F.col(b), n), CELL_BITS)
        return F.when(F.col(b) >= F.col(a), some).otherwise(F.lit(0).cast("long"))

    of = {"_first": lat0, "_lats": lats, "_js": slots, "_a": floor_div(F.col("_x0"), n), "_b": floor_div(F.col("_w0"), n)}
    df = df.withColumns(of | {"_n1": size("_x0", "_x1"), "_n2": size("_w0", "_w1")})
    df = df.withColumn("_lons", F.col("_n1") + F.col("_n2") + F.col("_pole"))
    df = numbered_rows(df, F.col("_lats") * F.col("_lons") * F.col("_js"))
    i, n1, n2 = F.col("_i"), F.col("_n1"), F.col("_n2")
    df = df.withColumns({"_row": F.call_function("div", i, F.col("_js")), "_j": F.pmod(i, F.col("_js"))})
    df = df.withColumns({"_y": F.col("_first") + F.call_function("div", F.col("_row"), F.col("_lons")), "_l": F.pmod(F.col("_row"), F.col("_lons"))})
    at = F.col("_l")
    pole = F.lit(pole // n).cast("long")
    df = df.withColumn("_x", F.when(at < n1, F.col("_a") + at).when(at < n1 + n2, F.col("_b") + (at - n1)).otherwise(pole))

    def again(start: str, size: Column) -> Column:
        """Whether a range has the same packed key."""
        return F.pmod(F.col("_x") - F.col(start), F.lit(1 << CELL_BITS).cast("long")) < size

    return df.where((at < n1) | (~again("_a", n1) & ((at < n1 + n2) | ~again("_b", n2))))


def numbered_rows(df: DataFrame, count: Column, live: Column | None = None) -> DataFrame:
    """Each row ``count`` times, numbered from 0 (``_i``); not at all unless
    ``live``."""
    some = (count > 0) if live is None else live & (count > 0)
    # outer, as explode_keys says: no filter on the array below an exchange
    each = F.when(some, F.sequence(F.lit(0).cast("long"), count - 1))
    return df.withColumn("_i", F.explode_outer(each)).where("_i is not null")


def clones_within(df: DataFrame, slots: tuple[str, str], n: int, m: int, pole: int, live: Column) -> DataFrame:
    """One row for each fine cell (``_y``, ``_x``) and slot (``_j``, of the
    columns ``slots``, first and last) of a row's ranges within its wide cell
    ``_wy``, ``_wx`` of a packed key, ``n`` fine cells wide, and its wide slot
    ``_ws`` of ``m``.

    A fine cell is told by its number within the wide one: wide cells that are
    the same in a packed key have the same packed fine cells, number by number.
    So longitude keys from both sides of the antimeridian and a polar cap's are
    one range of numbers (with those between, which meet nobody near).  There is
    no filter on the clones: it would repeat their expressions, and beyond 8,000
    bytes the JVM does not compile a method."""

    def numbers(first: str, last: str, wide: str, n: int, bits: int) -> tuple[Column, Column]:
        """First and last number within the wide cell (or slot)."""
        start = unmasked(F.col(wide), floor_div(F.col(first), n), bits) * F.lit(n)
        return F.greatest(F.col(first) - start, F.lit(0).cast("long")), F.least(F.col(last) - start, F.lit(n - 1).cast("long"))

    at_pole = (F.col("_pole") > 0) & (F.col("_wx") == pole // n % (1 << CELL_BITS))
    spans = [numbers(*c, n, CELL_BITS) for c in (("_y0", "_y1", "_wy"), ("_x0", "_x1", "_wx"), ("_w0", "_w1", "_wx"))]
    spans.append(numbers(*slots, "_ws", m, SLOT_BITS))
    named = {f"_{c}{'ab'[i]}": span[i] for c, span in zip(("y", "x", "v", "s"), spans) for i in range(2)}
    df = df.withColumns(named | {"_polar": F.when(at_pole, F.lit(pole % n).cast("long"))})
    start, end = (f(*(F.when(F.col(f"_{c}a") <= F.col(f"_{c}b"), F.col(f"_{c}{e}")) for c in "xv"), "_polar") for f, e in ((F.least, "a"), (F.greatest, "b")))
    df = df.withColumns({"_xf": start, "_xs": end - start + 1, "_ys": F.col("_yb") - F.col("_ya") + 1, "_ss": F.col("_sb") - F.col("_sa") + 1})
    df = numbered_rows(df, F.col("_ys") * F.col("_xs") * F.col("_ss"), (F.col("_ss") > 0) & live)
    df = df.withColumns({"_row": F.call_function("div", F.col("_i"), F.col("_ss")), "_j": F.pmod(F.col("_i"), F.col("_ss"))})
    y = F.col("_wy") * n + F.col("_ya") + F.call_function("div", F.col("_row"), F.col("_xs"))
    x = F.col("_wx") * n + F.col("_xf") + F.pmod(F.col("_row"), F.col("_xs"))
    return df.withColumns({"_y": y, "_x": x, "_j": F.col("_ws") * m + F.col("_sa") + F.col("_j")})
