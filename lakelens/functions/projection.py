"""Planar projections of WGS84 as Column expressions, and the buffer that is made in their plane.

A buffer of a geography point is a circle in a plane that suits the point: its UTM zone, or the
azimuthal equal-area plane of a pole beyond 70 degrees of latitude; the circle's vertices are
projected back.  All of it runs in the JVM; ``once`` keeps a shared value from being computed
for each vertex.

Transverse Mercator uses Krueger's series to the fourth power of the third flattening (under a
millimetre within a zone).
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The WGS84 ellipsoid, UTM's scale, the latitude and meridian of the polar planes.
A, FLAT = 6378137.0, 1 / 298.257223563
UTM_SCALE = 0.9996
POLAR_LATITUDE = 70.0
NORTH_MERIDIAN, SOUTH_MERIDIAN = -40.0, 0.0
QUARTER = 8

N = FLAT / (2 - FLAT)
E2 = FLAT * (2 - FLAT)
E = math.sqrt(E2)
RADIUS = A / (1 + N) * (1 + N**2 / 4 + N**4 / 64) * UTM_SCALE
# Krueger's series: to the plane, from the plane, and conformal to geodetic latitude.
ALPHA = (N / 2 - 2 * N**2 / 3 + 5 * N**3 / 16 + 41 * N**4 / 180, 13 * N**2 / 48 - 3 * N**3 / 5 + 557 * N**4 / 1440,
         61 * N**3 / 240 - 103 * N**4 / 140, 49561 * N**4 / 161280)
BETA = (N / 2 - 2 * N**2 / 3 + 37 * N**3 / 96 - N**4 / 360, N**2 / 48 + N**3 / 15 - 437 * N**4 / 1440,
        17 * N**3 / 480 - 37 * N**4 / 840, 4397 * N**4 / 161280)
DELTA = (2 * N - 2 * N**2 / 3 - 2 * N**3 + 116 * N**4 / 45, 7 * N**2 / 3 - 8 * N**3 / 5 - 227 * N**4 / 45,
         56 * N**3 / 15 - 136 * N**4 / 35, 4279 * N**4 / 630)
# Authalic to geodetic latitude.
AUTHALIC = (E2 / 3 + 31 * E2**2 / 180 + 517 * E2**3 / 5040, 23 * E2**2 / 360 + 251 * E2**3 / 3780, 761 * E2**3 / 45360)
Q_POLE = 1 + (1 - E2) / E * math.atanh(E)


def once(values: dict[str, Column], use: Callable[[Column], Column]) -> Column:
    """``use`` of a struct of ``values``, which are computed once however often it names them."""
    return F.transform(F.array(F.struct(*[v.alias(k) for k, v in values.items()])), use).getItem(0)


def _series(terms: tuple[float, ...], start: Column, part: Callable[[int], Column], sign: int = 1) -> Column:
    for j, c in enumerate(terms, 1):
        start = start + F.lit(sign * c) * part(2 * j)
    return start


def zone_meridian(lon: Column) -> Column:
    """Central meridian of the UTM zone."""
    return F.least(F.floor((lon + 180.0) / 6.0), F.lit(59)).cast("double") * 6.0 - 177.0


def mercator(lon: Column, lat: Column, meridian: Column) -> Column:
    """Struct (x, y) on the transverse Mercator plane of ``meridian``, metres."""
    phi, lam = F.radians(lat), F.radians(lon - meridian)
    t = F.sinh(F.atanh(F.sin(phi)) - F.lit(E) * F.atanh(F.lit(E) * F.sin(phi)))
    return once({"t": t, "lam": lam}, lambda v: once(
        {"xi": F.atan2(v["t"], F.cos(v["lam"])), "eta": F.atanh(F.sin(v["lam"]) / F.sqrt(1 + v["t"] * v["t"]))},
        lambda w: F.struct(
            (_series(ALPHA, w["eta"], lambda k: F.cos(w["xi"] * k) * F.sinh(w["eta"] * k)) * RADIUS).alias("x"),
            (_series(ALPHA, w["xi"], lambda k: F.sin(w["xi"] * k) * F.cosh(w["eta"] * k)) * RADIUS).alias("y"))))


def from_mercator(x: Column, y: Column, meridian: Column) -> Column:
    """Point (lon, lat) of a place on the transverse Mercator plane."""
    def angles(v: Column) -> dict[str, Column]:
        return {"xi": _series(BETA, v["xi"], lambda k: F.sin(v["xi"] * k) * F.cosh(v["eta"] * k), -1),
                "eta": _series(BETA, v["eta"], lambda k: F.cos(v["xi"] * k) * F.sinh(v["eta"] * k), -1)}
    return once({"xi": y / RADIUS, "eta": x / RADIUS}, lambda v: once(angles(v), lambda w: once(
        {"chi": F.asin(F.sin(w["xi"]) / F.cosh(w["eta"])), "lam": F.atan2(F.sinh(w["eta"]), F.cos(w["xi"]))},
        lambda u: F.struct(
            (F.pmod(meridian + F.degrees(u["lam"]) + 180.0, F.lit(360.0)) - 180.0).alias("lon"),
            F.degrees(_series(DELTA, u["chi"], lambda k: F.sin(u["chi"] * k))).alias("lat")))))


def polar(lon: Column, lat: Column, side: Column, meridian: Column) -> Column:
    """Struct (x, y) on the equal-area plane of a pole; ``side`` is 1 for the north, -1 for the south."""
    s = F.sin(F.radians(lat)) * side
    q = (1 - E2) * (s / (1 - E2 * s * s) + F.atanh(E * s) / E)
    return once({"rho": A * F.sqrt(F.greatest(F.lit(Q_POLE) - q, F.lit(0.0))), "lam": F.radians(lon - meridian)},
                lambda v: F.struct((v["rho"] * F.sin(v["lam"])).alias("x"), (-side * v["rho"] * F.cos(v["lam"])).alias("y")))


def from_polar(x: Column, y: Column, side: Column, meridian: Column) -> Column:
    """Point (lon, lat) of a place on a polar plane."""
    ratio = (F.lit(Q_POLE) - (x * x + y * y) / (A * A)) / Q_POLE
    return once({"beta": F.asin(F.greatest(F.least(ratio, F.lit(1.0)), F.lit(-1.0)))}, lambda v: F.struct(
        (F.pmod(meridian + F.degrees(F.atan2(x, -side * y)) + 180.0, F.lit(360.0)) - 180.0).alias("lon"),
        (side * F.degrees(_series(AUTHALIC, v["beta"], lambda k: F.sin(v["beta"] * k)))).alias("lat")))


def projected_buffer(point: Column, radius_m: float) -> Column:
    """Ring of 33 points: a circle of ``radius_m`` in the point's plane, from due east, clockwise.

    Null for a null point.
    """
    lon, lat = point.getField("lon"), point.getField("lat")
    near_pole = F.abs(lat) > POLAR_LATITUDE
    side = F.when(lat < 0, F.lit(-1.0)).otherwise(F.lit(1.0))
    meridian = F.when(~near_pole, zone_meridian(lon)).when(lat > 0, F.lit(NORTH_MERIDIAN)).otherwise(F.lit(SOUTH_MERIDIAN))

    def ring(p: Column) -> Column:
        center = F.when(p["near_pole"], polar(p["lon"], p["lat"], p["side"], p["meridian"])).otherwise(
            mercator(p["lon"], p["lat"], p["meridian"]))

        def vertex(c: Column, k: Column) -> Column:
            turn = (k % (4 * QUARTER)).cast("double") * (-math.pi / (2 * QUARTER))
            return once({"x": c["x"] + radius_m * F.cos(turn), "y": c["y"] + radius_m * F.sin(turn)}, lambda v: F.when(
                p["near_pole"], from_polar(v["x"], v["y"], p["side"], p["meridian"])).otherwise(
                from_mercator(v["x"], v["y"], p["meridian"])))
        return F.transform(F.array(center), lambda c: F.transform(
            F.sequence(F.lit(0), F.lit(4 * QUARTER)), lambda k: vertex(c, k))).getItem(0)
    made = once({"lon": lon, "lat": lat, "near_pole": near_pole, "side": side, "meridian": meridian}, ring)
    return F.when(lon.isNotNull() & lat.isNotNull(), made)
