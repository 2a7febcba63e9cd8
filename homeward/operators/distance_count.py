"""Number of pairs within a radius, without forming the pairs.

Both sides are counted per distinct point and keyed as in ``distance_join``.
Keys of few candidates are joined.  In the others, points are summed up in
nested cells (a quarter of the edge at each level) with the box that their
points really fill, and pairs of cells are judged by bounds of the distance
between two boxes:

* wholly within the radius: the product of the two counts;
* wholly beyond it: nothing;
* else the pair goes to the next level, or, once it stands for few pairs of
  points, its points are compared.

So a place's cost follows the rim of the discs, not their area.  Every step
is an equi-join of cells that hold counts: a point that a third of all rows
share is one row from the first aggregation on, and the cells of a dense
place are separate join keys.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import EARTH_RADIUS_M, haversine_m
from ..functions.grid import METRIC, CellKeys, GridSpec, floor_div
from ..session import keep
from .balanced import balanced_join
from .expand import explode_keys

# pairs of points that a pair of cells (or a key) may leave to comparison
NEAR_PAIRS = 1024
# cells a side that a cell is cut into, and levels below the join's grid (of
# the metric grid, the last is finer than a hundredth of a millimetre)
SPLIT = 4
LEVELS = 12
# relative distance (of squared half chords) from the radius within which
# bounds decide nothing, far above the rounding of the exact distance
MARGIN = 1e-6

_KEY = ["_klat", "_klon"]


def _exact(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(38,0)")


def _points(df: DataFrame, point: tuple[str, str]) -> DataFrame:
    """Distinct finite points and how many rows have them."""
    lat, lon = (F.col(c).cast("double") for c in point)
    rows = df.select(lat.alias("_lat"), lon.alias("_lon"))
    finite = (F.abs("_lat") < float("inf")) & (F.abs("_lon") < float("inf"))
    return rows.where(finite).groupBy("_lat", "_lon").agg(F.count(F.lit(1)).alias("_n"))


def _with_finest(points: DataFrame, grid: GridSpec) -> DataFrame:
    fine = GridSpec("finest", grid.lat_scale * SPLIT**LEVELS, grid.lon_scale * SPLIT**LEVELS, grid.offset)
    return points.withColumns({"_y": fine.lat_cell(F.col("_lat")), "_x": fine.lon_cell(F.col("_lon"))})


def _cell(level: int) -> tuple[Column, Column]:
    size = SPLIT ** (LEVELS - level)
    return floor_div(F.col("_y"), size), floor_div(F.col("_x"), size)


def _nodes(points: DataFrame, level: int, side: str) -> DataFrame:
    """Occupied cells of a level (by key): rows, points and the box they fill."""
    y, x = _cell(level)
    box = [f("_" + c).alias(f"{side}_{c}_{n}") for c in ("lat", "lon") for n, f in (("lo", F.min), ("hi", F.max))]
    keyed = points.select(*_KEY, y.alias(f"{side}_y"), x.alias(f"{side}_x"), "_lat", "_lon", "_n")
    counts = F.sum("_n").alias(f"{side}_n"), F.count(F.lit(1)).alias(f"{side}_p")
    return keyed.groupBy(*_KEY, f"{side}_y", f"{side}_x").agg(*counts, *box)


def _half_chords(radius_m: float) -> tuple[Column, Column]:
    """(least, greatest) squared half chord of two boxes, in earth radii."""

    def between(c: str) -> tuple[Column, Column]:
        a0, a1, b0, b1 = (F.col(f"{s}_{c}_{n}") for s in "ab" for n in ("lo", "hi"))
        return F.greatest(a0 - b1, b0 - a1, F.lit(0.0)), F.greatest(a1 - b0, b1 - a0)

    def narrowing(side: str) -> tuple[Column, Column]:
        lo, hi = F.col(f"{side}_lat_lo"), F.col(f"{side}_lat_hi")
        far, near = F.greatest(F.abs(lo), F.abs(hi)), F.greatest(lo, -hi, F.lit(0.0))
        return F.cos(F.radians(far)), F.cos(F.radians(near))

    (a_min, a_max), (b_min, b_max) = narrowing("a"), narrowing("b")
    (lat_min, lat_max), (lon_min, lon_max) = between("lat"), between("lon")

    def chord(dlat: Column, dlon: Column, cosines: Column) -> Column:
        return F.pow(F.sin(F.radians(dlat) / 2), 2) + F.pow(F.sin(F.radians(dlon) / 2), 2) * cosines

    return chord(lat_min, lon_min, a_min * b_min), chord(lat_max, lon_max, a_max * b_max)


def _judged(pairs: DataFrame, radius_m: float) -> DataFrame:
    """``_in``: every pair within the radius; pairs of cells without any are
    left out.  Boxes that leave the earth's range, or more than half a turn
    apart, are never decided by bounds."""
    limit = math.sin(min(radius_m / (2 * EARTH_RADIUS_M), math.pi / 2)) ** 2
    least, greatest = _half_chords(radius_m)
    lats = [F.abs(F.col(f"{s}_lat_{n}")) <= 90 for s in "ab" for n in ("lo", "hi")]
    spans = [F.col("a_lon_hi") - F.col("b_lon_lo") <= 180, F.col("b_lon_hi") - F.col("a_lon_lo") <= 180]
    plain = reduce(lambda p, q: p & q, lats + spans)
    inside = plain & (greatest <= limit * (1 - MARGIN))
    beyond = plain & (least > limit * (1 + MARGIN))
    return pairs.where(~beyond).withColumn("_in", inside)


def _border_points(border: DataFrame, a: DataFrame, level: int) -> DataFrame:
    """Points of the left cells of border pairs, keyed by the right cell."""
    y, x = _cell(level)
    points = a.select(*_KEY, y.alias("a_y"), x.alias("a_x"), F.col("_lat").alias("_alat"), F.col("_lon").alias("_alon"), F.col("_n").alias("_an"))
    rows = border.select(*_KEY, "a_y", "a_x", "b_y", "b_x").join(points, [*_KEY, "a_y", "a_x"])
    return rows.drop("a_y", "a_x").withColumn("_level", F.lit(level))


def _right_points(border: DataFrame, b: DataFrame, level: int) -> DataFrame:
    """Points of the right cells of border pairs."""
    y, x = _cell(level)
    points = b.select(*_KEY, y.alias("b_y"), x.alias("b_x"), F.col("_lat").alias("_blat"), F.col("_lon").alias("_blon"), F.col("_n").alias("_bn"))
    rows = points.join(border.select(*_KEY, "b_y", "b_x"), [*_KEY, "b_y", "b_x"], "left_semi")
    return rows.withColumn("_level", F.lit(level)).toDF("_bklat", "_bklon", "_by", "_bx", "_blat", "_blon", "_bn", "_blevel")


def count_distance_pairs(
    left: DataFrame,
    right: DataFrame,
    left_point: tuple[str, str],
    right_point: tuple[str, str],
    radius_m: float = 100.0,
    grid: GridSpec = METRIC,
    mode: str = "reach",
    near: int = NEAR_PAIRS,
) -> DataFrame:
    """One row: ``n``, the number of pairs of ``distance_join``, and
    ``compared``, how many pairs of different points were compared for it.

    Rows with a null, NaN or infinite coordinate are in no pair.  Runs jobs
    when called: each level's undecided pairs of cells are written to the
    shared checkpoint folder.  ``near`` sets how many pairs of points a key
    or a pair of cells may leave to comparison; it never changes ``n``.
    """
    if radius_m < 0:
        raise ValueError(f"radius must not be negative: {radius_m}")
    cells = CellKeys(grid, radius_m, mode)
    lat, lon = F.col("_lat"), F.col("_lon")
    a = _points(left, left_point)
    a = _with_finest(a.withColumns(dict(zip(_KEY, cells.exact(lat, lon)))), grid)
    b = _with_finest(explode_keys(_points(right, right_point), dict(zip(_KEY, cells.reach(lat, lon)))), grid)

    sizes = a.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("_pa")).join(b.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("_pb")), _KEY)
    sizes = keep(sizes, "distance-keys")
    product = F.col("_pa").cast("double") * F.col("_pb")
    dense = sizes.where(product > near).select(*_KEY)
    within = haversine_m(F.col("_blat"), F.col("_alat"), F.col("_blon"), F.col("_alon")) <= radius_m

    # keys of few candidates: a join of points
    sparse = sizes.where(product <= near)
    a_few = a.join(sparse.select(*_KEY), _KEY).select(*_KEY, lat.alias("_alat"), lon.alias("_alon"), F.col("_n").alias("_an"))
    b_few = b.select(*_KEY, lat.alias("_blat"), lon.alias("_blon"), F.col("_n").alias("_bn"))
    parts = [a_few.join(b_few, _KEY).where(within).agg(F.sum(_exact("_an") * _exact("_bn")).alias("n"))]
    compared = [sparse.agg(F.sum(_exact(product)).alias("c"))]

    if not dense.isEmpty():
        a, b = keep(a.join(dense, _KEY), "distance-left"), keep(b.join(dense, _KEY), "distance-right")
        left_points, right_points = [], []
        pairs = _nodes(a, 0, "a").join(_nodes(b, 0, "b"), _KEY)
        for level in range(LEVELS + 1):
            judged = keep(_judged(pairs, radius_m), "distance-cells")
            parts.append(judged.where("_in").agg(F.sum(_exact("a_n") * _exact("b_n")).alias("n")))
            points = F.col("a_p").cast("double") * F.col("b_p")
            small = (points <= near) | F.lit(level == LEVELS)
            border = judged.where(~F.col("_in") & small)
            left_points.append(_border_points(border, a, level))
            right_points.append(_right_points(border, b, level))
            compared.append(border.agg(F.sum(_exact(points)).alias("c")))
            rest = judged.where(~F.col("_in") & ~small).select(*_KEY, *[F.col(c).alias(f"p{c}") for c in ("a_y", "a_x", "b_y", "b_x")])
            if rest.isEmpty():
                break
            pairs = rest
            for side, points_of in (("a", a), ("b", b)):
                parent = {f"p{side}_{c}": floor_div(F.col(f"{side}_{c}"), SPLIT) for c in "yx"}
                nodes = _nodes(points_of, level + 1, side).withColumns(parent)
                pairs = pairs.join(nodes, [*_KEY, *parent]).drop(*parent)
        keys = [*((k, f"_b{k[1:]}") for k in _KEY), ("b_y", "_by"), ("b_x", "_bx"), ("_level", "_blevel")]
        near_rim = balanced_join(reduce(DataFrame.unionByName, left_points), reduce(DataFrame.unionAll, right_points), keys, within)
        parts.append(near_rim.agg(F.sum(_exact("_an") * _exact("_bn")).alias("n")))
    total = reduce(DataFrame.unionAll, parts).agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n"))
    work = reduce(DataFrame.unionAll, compared).agg(F.coalesce(F.sum("c"), F.lit(0)).cast("long").alias("compared"))
    return total.withColumn("_one", F.lit(1)).join(work.withColumn("_one", F.lit(1)), "_one").drop("_one")
