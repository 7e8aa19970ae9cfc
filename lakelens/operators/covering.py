"""Adaptive cell coverings of polygons: quadtree cells inside the ring, and cells on its boundary.

Cells of level k are squares of 360 / 2 ** k degrees.  A covering starts with the few cells that
hold the ring's bounding box; cells that the ring passes through are split into sixteen (two
levels at once), cells outside are dropped, until the covering has enough cells.  A point in an
inside cell is within the polygon without a look at the ring; only points in boundary cells are
tested against it.  Large polygons thus get large inside cells and a rim of small ones, and the
number of cells does not follow the polygon's area.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

CELLS = "array<struct<level: int, ci: bigint, cj: bigint, shift: double, inside: boolean>>"
#: deepest level (cells of about 40 m), levels of one split, and cells at which splitting ends
MAX_LEVEL, STEP, MAX_CELLS = 20, 2, 128
#: a cell touches an edge that passes it by less (degrees): points are put into cells with rounding
_SLACK = 1e-9


def unrolled(lons: np.ndarray) -> np.ndarray:
    """Longitudes of a ring that takes the short way over the antimeridian, without jumps."""
    steps = np.diff(lons)
    steps = np.where(steps > 180, steps - 360, np.where(steps < -180, steps + 360, steps))
    return np.concatenate((lons[:1], lons[0] + np.cumsum(steps)))


def _touching(edges: np.ndarray, x: float, y: float, size: float) -> np.ndarray:
    """Which edges (x1, y1, x2, y2) meet the closed cell."""
    x1, y1, x2, y2 = edges
    lo_x, hi_x, lo_y, hi_y = x - _SLACK, x + size + _SLACK, y - _SLACK, y + size + _SLACK
    box = ((np.maximum(x1, x2) >= lo_x) & (np.minimum(x1, x2) <= hi_x)
           & (np.maximum(y1, y2) >= lo_y) & (np.minimum(y1, y2) <= hi_y))
    dx, dy = x2 - x1, y2 - y1
    sides = np.stack([dx * (cy - y1) - dy * (cx - x1) for cx in (lo_x, hi_x) for cy in (lo_y, hi_y)])
    return box & (sides.min(axis=0) <= 0) & (sides.max(axis=0) >= 0)


def _holds(edges: np.ndarray, x: float, y: float) -> bool:
    """Even-odd test of a point off the ring."""
    x1, y1, x2, y2 = edges
    up = (y1 > y) != (y2 > y)
    return bool(np.count_nonzero(x < (x2[up] - x1[up]) * (y - y1[up]) / (y2[up] - y1[up]) + x1[up]) % 2)


def cover(xs: np.ndarray, ys: np.ndarray, max_cells: int = MAX_CELLS) -> list[tuple[int, int, int, bool]]:
    """(level, row, column, inside) of disjoint cells that hold every point inside the ring."""
    if len(xs) < 2 or not (np.isfinite(xs).all() and np.isfinite(ys).all()):
        return []
    edges = np.stack([xs[:-1], ys[:-1], xs[1:], ys[1:]])
    extent = max(xs.max() - xs.min(), ys.max() - ys.min())
    level = 0
    while level < MAX_LEVEL and 360.0 / (1 << (level + STEP)) >= extent:
        level += STEP
    size = 360.0 / (1 << level)
    span = [(int(np.floor((v.min() + o) / size)), int(np.floor((v.max() + o) / size))) for v, o in ((ys, 90.0), (xs, 180.0))]
    fresh = [(i, j, np.arange(len(xs) - 1)) for i in range(span[0][0], span[0][1] + 1) for j in range(span[1][0], span[1][1] + 1)]
    inside: list[tuple[int, int, int, bool]] = []
    while True:
        rim = []
        for i, j, near in fresh:
            x, y = j * size - 180.0, i * size - 90.0
            hit = near[_touching(edges[:, near], x, y, size)]
            if len(hit):
                rim.append((i, j, hit))
            elif _holds(edges, x + size / 2, y + size / 2):
                inside.append((level, i, j, True))
        if level + STEP > MAX_LEVEL or len(inside) + 4 * len(rim) > max_cells:
            return inside + [(level, i, j, False) for i, j, _ in rim]
        level, size, n = level + STEP, size / (1 << STEP), 1 << STEP
        fresh = [(i * n + a, j * n + b, near) for i, j, near in rim for a in range(n) for b in range(n)]


def cover_column(ring: str | Column, antimeridian: bool = False, max_cells: int = MAX_CELLS) -> Column:
    """Arrow function over rings: their covering as an array of cells (empty for a null ring).

    ``shift`` is what takes a longitude of the cell's column in [-180, 180) to the ring's own
    (unrolled) longitudes; 0 unless ``antimeridian``.
    """
    def run(rings: pa.Array) -> pa.Array:
        out = {n: [] for n in ("level", "ci", "cj", "shift", "inside")}
        ends = [0]
        for ring in rings:
            if ring.is_valid and len(ring.values):
                points = ring.values
                xs, ys = (np.asarray(points.field(n).to_numpy(zero_copy_only=False), dtype=float) for n in ("lon", "lat"))
                for level, i, j, inside in cover(unrolled(xs) if antimeridian else xs, ys, max_cells):
                    turns = j // (1 << level) if antimeridian else 0
                    for name, value in zip(out, (level, i, j - turns * (1 << level), 360.0 * turns, inside), strict=True):
                        out[name].append(value)
            ends.append(len(out["level"]))
        cells = pa.StructArray.from_arrays(
            [pa.array(v, t) for v, t in zip(out.values(), (pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.bool_()), strict=True)],
            names=list(out))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), cells)
    return F.arrow_udf(run, CELLS)(ring)


def unrolled_ring(ring: Column) -> Column:
    """The ring with the longitudes of ``unrolled``, in the JVM."""
    def step(acc: Column, v: Column) -> Column:
        last = F.element_at(acc, -1).getField("lon")
        d = v.getField("lon") - F.pmod(last + 180.0, F.lit(360.0)) + 180.0
        d = F.when(d > 180, d - 360).when(d < -180, d + 360).otherwise(d)
        return F.concat(acc, F.array(F.struct((last + d).alias("lon"), v.getField("lat").alias("lat"))))
    return F.aggregate(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1), step)


def point_cells(point: Column, levels: list[int]) -> Column:
    """The cells of a point, one a level, as (level, ci, cj)."""
    lon, lat = point.getField("lon"), point.getField("lat")
    return F.array(*[F.struct(F.lit(k).alias("level"),
                              F.floor((lat + 90.0) / (360.0 / (1 << k))).cast("long").alias("ci"),
                              F.floor((lon + 180.0) / (360.0 / (1 << k))).cast("long").alias("cj")) for k in levels])
