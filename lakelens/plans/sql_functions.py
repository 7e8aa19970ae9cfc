"""Geo functions for ``spark.sql``: ``register_geo_functions(spark)``.

Planar functions are SQL-language functions (``CREATE TEMPORARY FUNCTION ... RETURN``):
Catalyst inlines them, so they stay JVM-side and are optimised like hand-written
expressions.  The ellipsoidal measures are the Arrow pandas UDFs of
``functions.geo``.  Points are ``STRUCT<lon, lat>``, polygon shells
``ARRAY<STRUCT<lon, lat>>``; geography semantics (metres on WGS84) are the default,
so the ``::geography`` casts of the original SQL are simply dropped.

Spark 4.1 ships its own ``st_setsrid``/``st_srid`` (for its geometry type), so the
SRID helpers are registered as ``geo_setsrid`` / ``geo_srid``; SQL functions cannot be
overloaded, so they take points (polygon shells are WGS84 by construction).
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from lakelens.functions import geo

PT = "STRUCT<lon: DOUBLE, lat: DOUBLE>"
RING = f"ARRAY<{PT}>"


def _fmt(x: str) -> str:
    """Coordinate text (shortest decimal, at most 15 decimals, no trailing .0) as inline SQL.

    Inlined rather than a helper function: SQL functions cannot take lambda variables."""
    s = f"CAST({x} AS STRING)"
    return (f"CASE WHEN {x} IS NULL THEN NULL "
            f"WHEN {s} RLIKE '[eE]' OR length(regexp_extract({s}, '\\\\.([0-9]*)$', 1)) > 15 "
            f"THEN regexp_replace(CAST(CAST({x} AS DECIMAL(38,15)) AS STRING), '\\\\.?0+$', '') "
            f"ELSE regexp_replace({s}, '\\\\.0$', '') END")


SQL_FUNCTIONS = [
    f"st_makepoint(x DOUBLE, y DOUBLE) RETURNS {PT} "
    "RETURN CASE WHEN x IS NULL OR y IS NULL THEN NULL ELSE named_struct('lon', x, 'lat', y) END",
    f"geo_setsrid(p {PT}, srid INT) RETURNS {PT} "
    "RETURN CASE WHEN srid = 4326 THEN p ELSE raise_error('only SRID 4326 is supported') END",
    f"geo_srid(p {PT}) RETURNS INT RETURN 4326",
    f"st_x(p {PT}) RETURNS DOUBLE RETURN p.lon",
    f"st_y(p {PT}) RETURNS DOUBLE RETURN p.lat",
    f"st_astext(p {PT}) RETURNS STRING "
    f"RETURN CASE WHEN p IS NULL THEN NULL ELSE concat('POINT(', {_fmt('p.lon')}, ' ', {_fmt('p.lat')}, ')') END",
    f"st_polygontext(r {RING}) RETURNS STRING "
    "RETURN CASE WHEN r IS NULL THEN NULL ELSE concat('POLYGON((', "
    f"array_join(transform(r, v -> concat({_fmt('v.lon')}, ' ', {_fmt('v.lat')})), ','), '))') END",
    f"st_snaptogrid(p {PT}, size DOUBLE) RETURNS {PT} "
    "RETURN CASE WHEN p IS NULL THEN NULL "
    "ELSE named_struct('lon', rint(p.lon / size) * size, 'lat', rint(p.lat / size) * size) END",
    f"st_geomfromtext(wkt STRING) RETURNS {RING} "
    "RETURN transform(split(trim(regexp_extract(wkt, '(?i)^\\\\s*LINESTRING\\\\s*\\\\((.*)\\\\)\\\\s*$', 1)), '\\\\s*,\\\\s*'), "
    "s -> named_struct('lon', CAST(split(trim(s), '\\\\s+')[0] AS DOUBLE), "
    "'lat', CAST(split(trim(s), '\\\\s+')[1] AS DOUBLE)))",
    f"st_makepolygon(r {RING}) RETURNS {RING} "
    "RETURN CASE WHEN r IS NULL THEN NULL WHEN size(r) >= 4 AND element_at(r, 1) = element_at(r, -1) THEN r "
    "ELSE raise_error('shell must be a closed linestring of at least 4 points') END",
    f"ll_crossings(x DOUBLE, y DOUBLE, r {RING}) RETURNS INT "
    "RETURN aggregate(sequence(1, size(r) - 1), 0, (acc, i) -> acc + CASE WHEN "
    "((element_at(r, i).lat > y) != (element_at(r, i + 1).lat > y)) AND "
    "x < (element_at(r, i + 1).lon - element_at(r, i).lon) * (y - element_at(r, i).lat) "
    "/ (element_at(r, i + 1).lat - element_at(r, i).lat) + element_at(r, i).lon THEN 1 ELSE 0 END)",
    f"ll_on_edge(x DOUBLE, y DOUBLE, r {RING}) RETURNS BOOLEAN "
    "RETURN exists(sequence(1, size(r) - 1), i -> "
    "(element_at(r, i + 1).lon - element_at(r, i).lon) * (y - element_at(r, i).lat) "
    "- (element_at(r, i + 1).lat - element_at(r, i).lat) * (x - element_at(r, i).lon) = 0 "
    "AND x BETWEEN least(element_at(r, i).lon, element_at(r, i + 1).lon) "
    "AND greatest(element_at(r, i).lon, element_at(r, i + 1).lon) "
    "AND y BETWEEN least(element_at(r, i).lat, element_at(r, i + 1).lat) "
    "AND greatest(element_at(r, i).lat, element_at(r, i + 1).lat))",
    f"st_within(p {PT}, r {RING}) RETURNS BOOLEAN "
    "RETURN CASE WHEN p IS NULL OR r IS NULL THEN NULL "
    "ELSE ll_crossings(p.lon, p.lat, r) % 2 = 1 AND NOT ll_on_edge(p.lon, p.lat, r) END",
    f"st_distance(a {PT}, b {PT}) RETURNS DOUBLE RETURN ll_geodesic_distance(a.lon, a.lat, b.lon, b.lat)",
    # the box test is plain SQL, so only candidates reach the geodesic UDF
    f"st_dwithin(a {PT}, b {PT}, d DOUBLE) RETURNS BOOLEAN "
    "RETURN abs(a.lat - b.lat) <= degrees(d / 6335439.327) * 1.000000001 "
    "AND ll_geodesic_distance(a.lon, a.lat, b.lon, b.lat) <= d",
    f"st_area(r {RING}) RETURNS DOUBLE RETURN ll_ring_area(r)",
    f"st_buffer(p {PT}, d DOUBLE) RETURNS {RING} "
    "RETURN CASE WHEN p IS NULL THEN NULL ELSE zip_with(ll_buffer(p.lon, p.lat, d).lons, "
    "ll_buffer(p.lon, p.lat, d).lats, (a, b) -> named_struct('lon', a, 'lat', b)) END",
]


def register_geo_functions(spark: SparkSession) -> list[str]:
    """Register the geo SQL functions in the session; returns their names."""
    spark.udf.register("ll_geodesic_distance", geo._geodesic_distance)
    spark.udf.register("ll_ring_area", geo._ring_area)
    spark.udf.register("ll_buffer", geo._buffer)
    names = []
    for body in SQL_FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {body}")
        names.append(body.split("(", 1)[0])
    return names
