"""The geo examples written as SQL run through the registered functions."""

import pytest

from lakelens.plans.sql_functions import register_geo_functions
from test_geo import CITIES, PAIRS


@pytest.fixture(scope="module")
def sql(spark):
    register_geo_functions(spark)
    spark.createDataFrame(CITIES, "id long, name string, lon double, lat double") \
        .selectExpr("id", "name", "geo_setsrid(st_makepoint(lon, lat), 4326) AS location") \
        .createOrReplaceTempView("locations")
    spark.sql("""SELECT 1L AS id, 'Europe' AS name,
                 st_makepolygon(st_geomfromtext('LINESTRING(-10 35, 40 35, 40 70, -10 70, -10 35)')) AS boundary""").createOrReplaceTempView("regions")
    return spark.sql


def test_points_as_text(sql):
    rows = sql("SELECT name, st_astext(location) AS coordinates, st_x(location) AS longitude, "
               "st_y(location) AS latitude FROM locations ORDER BY id").collect()
    assert rows[0]["coordinates"] == "POINT(-74.006 40.7128)" and rows[0]["longitude"] == -74.006


def test_pair_distances(sql):
    rows = sql("""SELECT l1.name AS from_city, l2.name AS to_city,
                  ROUND(st_distance(l1.location, l2.location) / 1000, 2) AS distance_km
                  FROM locations l1 JOIN locations l2 ON l1.id < l2.id ORDER BY distance_km""").collect()
    assert {(r[0], r[1]): r[2] for r in rows} == pytest.approx(PAIRS, abs=0.011)


def test_radius_search_with_scalar_subquery(sql):
    rows = sql("""SELECT name, ROUND(st_distance(location,
                    (SELECT location FROM locations WHERE name = 'New York')) / 1000, 2) AS distance_km
                  FROM locations
                  WHERE st_dwithin(location, (SELECT location FROM locations WHERE name = 'New York'), 5600000)
                    AND name != 'New York' ORDER BY distance_km""").collect()
    assert [(r[0], r[1]) for r in rows] == [("London", 5585.23)]


def test_within_area_snap_buffer(sql):
    assert [tuple(r) for r in sql("SELECT l.name, r.name AS region FROM locations l "
                                  "JOIN regions r ON st_within(l.location, r.boundary)").collect()] == [("London", "Europe")]
    area = sql("SELECT ROUND(st_area(boundary) / 1000000, 2) AS area_sq_km FROM regions").first()[0]
    assert area == pytest.approx(12_351_402.64, abs=0.05)
    cell = sql("SELECT st_astext(st_snaptogrid(location, 0.1)) FROM locations WHERE name = 'New York'").first()[0]
    assert cell == "POINT(-74 40.7)"
    ring = sql("SELECT st_buffer(location, 10000) AS r FROM locations WHERE name = 'Tokyo'").first()["r"]
    assert len(ring) == 33 and ring[0] == ring[-1]
    text = sql("SELECT st_polygontext(st_buffer(location, 10000)) FROM locations WHERE name = 'Tokyo'").first()[0]
    assert text.startswith("POLYGON((") and text.count(",") == 32
