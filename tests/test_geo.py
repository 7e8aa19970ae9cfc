"""Geo functions: golden values for the five sample cities and the Europe box, plus properties."""

import math
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakelens.functions import geo, geodesy
from lakelens.operators import spatial

# The sample rows of the original geo examples (lon, lat).
CITIES = [
    (1, "New York", -74.0060, 40.7128),
    (2, "London", -0.1278, 51.5074),
    (3, "Tokyo", 139.6917, 35.6895),
    (4, "Sydney", 151.2093, -33.8688),
    (5, "Rio", -43.1729, -22.9068),
]
# Expected pair distances (km, 2 decimals), derived independently (FIXTURES.md section 2).
PAIRS = {
    ("New York", "London"): 5585.23, ("New York", "Tokyo"): 10872.80, ("New York", "Rio"): 7732.48,
    ("Sydney", "Rio"): 13540.05, ("Tokyo", "Sydney"): 7792.96, ("New York", "Sydney"): 15988.01,
    ("London", "Rio"): 9252.20, ("London", "Sydney"): 16989.30, ("London", "Tokyo"): 9582.31,
    ("Tokyo", "Rio"): 18561.10,
}
EUROPE_WKT = "LINESTRING(-10 35, 40 35, 40 70, -10 70, -10 35)"


@pytest.fixture(scope="module")
def locations(spark):
    rows = spark.createDataFrame(CITIES, "id long, name string, lon double, lat double")
    return rows.select("id", "name", geo.set_srid(geo.make_point(F.col("lon"), F.col("lat")), 4326).alias("location"))


@pytest.fixture(scope="module")
def regions(spark):
    df = spark.createDataFrame([(1, "Europe", EUROPE_WKT)], "id long, name string, wkt string")
    return df.select("id", "name", geo.make_polygon(geo.line_from_text(F.col("wkt"))).alias("boundary"))


def test_points_text(locations):
    got = {r["name"]: (r["t"], r["x"], r["y"]) for r in locations.select(
        "name", geo.point_text(F.col("location")).alias("t"), geo.st_x(F.col("location")).alias("x"),
        geo.st_y(F.col("location")).alias("y")).collect()}
    assert got["New York"] == ("POINT(-74.006 40.7128)", -74.006, 40.7128)
    assert got["Rio"][0] == "POINT(-43.1729 -22.9068)"


def test_pair_distances(locations):
    l1, l2 = locations.alias("a"), locations.alias("b")
    rows = (l1.join(l2, F.col("a.id") < F.col("b.id"))
            .select(F.col("a.name").alias("f"), F.col("b.name").alias("t"),
                    F.round(geo.geodesic_distance_m(F.col("a.location"), F.col("b.location")) / 1000, 2).alias("km"))
            .collect())
    got = {(r["f"], r["t"]): r["km"] for r in rows}
    assert got == pytest.approx(PAIRS, abs=0.011)


def test_pairs_within_grid_join_matches_brute_force(locations):
    for radius in (6_000_000.0, 10_000_000.0, 16_000_000.0):
        got = {(r["l_id"], r["r_id"]) for r in spatial.pairs_within(locations, "id", "location", radius).collect()}
        ids = {c[0]: c for c in CITIES}
        want = set()
        for a in ids:
            for b in ids:
                if a < b:
                    s, _ = geodesy.inverse(ids[a][2], ids[a][3], ids[b][2], ids[b][3])
                    if float(s) <= radius:
                        want.add((a, b))
        assert got == want


def test_radius_search_from_new_york_is_empty(locations):
    center = locations.where(F.col("name") == "New York").select("location").scalar()
    near = spatial.within_radius(locations.where(F.col("name") != "New York"), "location", center, 5_000_000)
    assert near.count() == 0
    wider = spatial.within_radius(locations.where(F.col("name") != "New York"), "location", center, 5_600_000)
    assert [r["name"] for r in wider.collect()] == ["London"]


def test_cities_within_europe(locations, regions):
    rows = spatial.points_in_polygons(locations, "location", regions.withColumnRenamed("name", "region")
                                      .withColumnRenamed("id", "rid"), "boundary").collect()
    assert [(r["name"], r["region"]) for r in rows] == [("London", "Europe")]


def test_points_in_polygons_grid_path_matches_broadcast(spark, locations, regions):
    polys = regions.withColumnRenamed("name", "region").withColumnRenamed("id", "rid")
    small = spatial.points_in_polygons(locations, "location", polys, "boundary")
    grid = spatial.points_in_polygons(locations, "location", polys, "boundary", max_broadcast_bytes=0, max_cells=16)
    plan = grid._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert sorted(map(tuple, small.select("name", "region").collect())) == \
        sorted(map(tuple, grid.select("name", "region").collect()))


def test_boundary_points_are_not_within(spark, regions):
    pts = spark.createDataFrame([(1, -10.0, 50.0), (2, 0.0, 35.0), (3, 40.0, 70.0), (4, 0.0, 50.0), (5, 41.0, 50.0)],
                                "id long, lon double, lat double")
    ring = regions.select("boundary").first()[0]
    out = pts.select("id", geo.within(geo.make_point(F.col("lon"), F.col("lat")),
                                      F.lit(None).cast(geo.RING) if ring is None else
                                      F.array(*[F.struct(F.lit(v["lon"]).alias("lon"), F.lit(v["lat"]).alias("lat"))
                                                for v in ring])).alias("w"))
    assert {r["id"]: r["w"] for r in out.collect()} == {1: False, 2: False, 3: False, 4: True, 5: False}


def test_open_ring_is_rejected(spark):
    df = spark.createDataFrame([("LINESTRING(0 0, 1 0, 1 1, 0 1)",)], "wkt string")
    with pytest.raises(Exception):
        df.select(geo.make_polygon(geo.line_from_text(F.col("wkt")))).collect()


def test_europe_area(regions):
    area = regions.select((geo.geodesic_area_m2(F.col("boundary")) / 1e6).alias("a")).first()["a"]
    assert area == pytest.approx(12_351_402.64, abs=0.05)


def test_buffer_ring(locations):
    ring = locations.where(F.col("name") == "Tokyo").select(
        geo.geodesic_buffer(F.col("location"), 10_000).alias("r")).first()["r"]
    assert len(ring) == 33 and ring[0] == ring[-1]
    s, _ = geodesy.inverse([139.6917] * 33, [35.6895] * 33, [v["lon"] for v in ring], [v["lat"] for v in ring])
    assert max(abs(s - 10_000)) < 1e-3


def test_snap_and_text_formatting(spark):
    df = spark.createDataFrame([(0.1 * 3, 1e-5), (-74.006, 40.7128), (180.0, -0.0)], "x double, y double")
    got = [r[0] for r in df.select(geo.point_text(geo.make_point(F.col("x"), F.col("y")))).collect()]
    assert got[0] == "POINT(0.3 0.00001)"
    assert got[1] == "POINT(-74.006 40.7128)"
    assert got[2] in ("POINT(180 -0)", "POINT(180 0)")
    snapped = spark.createDataFrame([(-74.0061, 40.7128)], "x double, y double").select(
        geo.point_text(geo.snap_to_grid(geo.make_point(F.col("x"), F.col("y")), 0.1))).first()[0]
    assert snapped == "POINT(-74 40.7)"


coords = st.tuples(st.floats(-179.9, 179.9), st.floats(-80, 80))


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(coords, coords), min_size=1, max_size=30))
def test_distance_symmetric_and_zero_on_self(spark, pairs):
    rows = [(a[0], a[1], b[0], b[1]) for a, b in pairs]
    df = spark.createDataFrame(rows, "x1 double, y1 double, x2 double, y2 double")
    p, q = geo.make_point(F.col("x1"), F.col("y1")), geo.make_point(F.col("x2"), F.col("y2"))
    out = df.select(geo.geodesic_distance_m(p, q).alias("d"), geo.geodesic_distance_m(q, p).alias("e"),
                    geo.geodesic_distance_m(p, p).alias("z"), geo.haversine_m(p, q).alias("h")).collect()
    for r in out:
        assert r["d"] == pytest.approx(r["e"], rel=1e-9, abs=1e-6)
        assert r["z"] == 0.0
        assert r["d"] == pytest.approx(r["h"], rel=0.006, abs=1.0)


@settings(max_examples=10, deadline=None)
@given(st.lists(coords, min_size=1, max_size=40), coords, st.floats(1_000, 3_000_000))
def test_radius_box_keeps_every_point_in_range(spark, points, center, radius):
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(points)], "id long, x double, y double")
    pts = df.select("id", geo.make_point(F.col("x"), F.col("y")).alias("p"))
    c = geo.make_point(F.lit(center[0]), F.lit(center[1]))
    rows = pts.select("id", spatial.radius_box(F.col("p"), c, radius).alias("box"),
                      geo.geodesic_distance_m(F.col("p"), c).alias("d")).collect()
    for r in rows:
        if r["d"] <= radius:
            assert r["box"], r


@settings(max_examples=10, deadline=None)
@given(st.lists(coords, min_size=1, max_size=40), st.floats(-60, 60), st.floats(-60, 60),
       st.floats(0.5, 40), st.floats(0.5, 40))
def test_within_agrees_with_box_test(spark, points, x0, y0, w, h):
    ring = [(x0, y0), (x0 + w, y0), (x0 + w, y0 + h), (x0, y0 + h), (x0, y0)]
    arr = F.array(*[F.struct(F.lit(float(a)).alias("lon"), F.lit(float(b)).alias("lat")) for a, b in ring])
    df = spark.createDataFrame(points, "x double, y double")
    rows = df.select("x", "y", geo.within(geo.make_point(F.col("x"), F.col("y")), arr).alias("w")).collect()
    for r in rows:
        inside = x0 < r["x"] < x0 + w and y0 < r["y"] < y0 + h
        assert r["w"] == inside


def test_vincenty_matches_haversine_scale():
    s, _ = geodesy.inverse(0.0, 0.0, 1.0, 0.0)
    assert s == pytest.approx(111_319.49, abs=0.01)
    assert math.isfinite(float(geodesy.inverse(0.0, 0.0, 179.5, 0.5)[0]))


def test_nearly_antipodal_pairs():
    s, _ = geodesy.inverse(0.0, 0.0, 179.5, 0.5)
    assert float(s) == pytest.approx(19_936_288.579, abs=0.001)      # published reference value
    exact = geodesy.inverse([0.0, 10.0], [0.0, 30.0], [180.0, -170.0], [0.0, -30.0])[0]
    assert exact == pytest.approx([20_003_931.4586, 20_003_931.4586], abs=0.001)  # half meridian


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.floats(-180, 180), st.floats(-5, 5), st.floats(-1, 1), st.floats(-0.5, 0.5)),
                min_size=1, max_size=30))
def test_inverse_lands_on_target_near_antipodes(quads):
    import numpy as np
    lon1 = np.array([q[0] for q in quads]); lat1 = np.array([q[1] for q in quads])
    lon2 = lon1 + 180 + np.array([q[2] for q in quads]); lat2 = -lat1 + np.array([q[3] for q in quads])
    s, az = geodesy.inverse(lon1, lat1, lon2, lat2)
    x, y = geodesy.direct(lon1, lat1, az, s)
    assert np.abs(((x - lon2) + 180) % 360 - 180).max() < 1e-6 and np.abs(y - lat2).max() < 1e-6
    assert (s <= 20_003_931.46).all()


def test_areas_of_many_rings_at_once():
    from lakelens.functions import geodesy
    box = ([0, 1, 1, 0, 0], [0, 0, 1, 1, 0])
    dateline = ([170, -170, -170, 170, 170], [0, 0, 5, 5, 0])
    slanted = ([0, 3, 1, 0], [0, 1, 4, 0])
    pole = ([0, 90, 180, -90, 0], [80] * 5)
    rings = [box, pole, dateline, ([0, 1], [0, 1]), slanted]
    together = geodesy.ring_areas(rings, chunk_steps=700)
    assert together[0] == pytest.approx(12_308_778_361.469, rel=1e-6)  # published value of the 1 degree box
    assert 2.45e12 < together[1] < 2.55e12 and together[3] == 0  # a square in the cap of 3.9e12
    for i in (0, 2, 4):
        assert together[i] == pytest.approx(geodesy.ring_area(*rings[i]), rel=1e-12)


def test_null_ring_has_no_area(spark):
    ring = ", ".join(f"named_struct('lon', {x}D, 'lat', 80D)" for x in (0, 90, 180, -90, 0))
    rows = spark.sql(f"SELECT array({ring}) AS r UNION ALL SELECT NULL").select(geo.geodesic_area_m2(F.col("r")).alias("a")).collect()
    assert rows[0]["a"] == pytest.approx(2.507e12, rel=1e-3) and rows[1]["a"] is None


# ---------------------------------------------------------------- coverings and hot cells

def _inside(x, y, ring):
    """Strictly inside by even-odd, edge by edge."""
    odd = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
        if (x2 - x1) * (y - y1) == (y2 - y1) * (x - x1) and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
            return False
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            odd = not odd
    return odd


RINGS = {
    "triangle": [(0, 0), (10, 1), (3, 12), (0, 0)],
    "concave": [(-60, -40), (60, -40), (60, 50), (0, -30), (-60, 50), (-60, -40)],
    "world": [(-180, -90), (180, -90), (180, 90), (-180, 90), (-180, -90)],
    "wide": [(-170, -60), (170, -60), (170, 60), (-170, 60), (-170, -60)],
    "sliver": [(20, 20), (20.0001, 20), (20.0001, 60), (20, 60), (20, 20)],
    "star": [(100 + (30 if k % 2 else 8) * math.cos(k * math.pi / 8), (30 if k % 2 else 8) * math.sin(k * math.pi / 8))
             for k in range(17)],
    "dot": [(5, 5), (5, 5), (5, 5), (5, 5)],
}
RINGS["star"][-1] = RINGS["star"][0]


def _ring_rows(spark, rings):
    return spark.createDataFrame([(n, [(float(x), float(y)) for x, y in r]) for n, r in rings.items()] + [("none", None)],
                                 "poly string, ring array<struct<lon: double, lat: double>>")


def _points(spark, n, lons=(-180.0, 180.0), seed=1):
    rng = np.random.default_rng(seed)
    rows = [(i, (float(x), float(y))) for i, (x, y) in enumerate(zip(rng.uniform(*lons, n), rng.uniform(-90, 90, n)))]
    k = len(rows)
    # vertices, edge midpoints, poles and cell corners
    extra = [p for r in RINGS.values() for p in r] + [((a[0] + b[0]) / 2, (a[1] + b[1]) / 2) for r in RINGS.values() for a, b in zip(r, r[1:])]
    extra += [(0.0, 90.0), (-180.0, 0.0), (180.0, 0.0), (22.5, 22.5), (20.00005, 40.0)]
    rows += [(k + i, (float(x), float(y))) for i, (x, y) in enumerate(extra)] + [(-1, None)]
    return rows, spark.createDataFrame(rows, "id long, loc struct<lon: double, lat: double>")


@pytest.mark.parametrize("max_cells", [4, 128])
def test_containment_equals_brute_force(spark, max_cells):
    rows, pts = _points(spark, 1500)
    got = spatial.points_in_polygons(pts, "loc", _ring_rows(spark, RINGS), "ring", max_cells=max_cells)
    assert got.columns == ["id", "loc", "poly", "ring"]
    want = {(i, n) for i, p in rows if p for n, r in RINGS.items() if _inside(*p, r)}
    pairs = [(r.id, r.poly) for r in got.select("id", "poly").collect()]
    assert set(pairs) == want and len(pairs) == len(want) and len(want) > 2000


def test_containment_over_the_antimeridian(spark):
    rings = {"pacific": [(160, -30), (-150, -30), (-150, 40), (-175, 0), (160, 40), (160, -30)],
             "greenwich": [(-10, -10), (10, -10), (10, 10), (-10, 10), (-10, -10)],
             "fiji": [(-179, -20), (177, -20), (177, -15), (-179, -15), (-179, -20)]}
    rows, pts = _points(spark, 3000, seed=2)
    got = spatial.points_in_polygons(pts, "loc", _ring_rows(spark, rings), "ring", antimeridian=True)
    want = set()
    for name, ring in rings.items():
        flat = [ring[0]]
        for x, y in ring[1:]:
            d = (x - flat[-1][0] + 180) % 360 - 180
            flat.append((flat[-1][0] + d, y))
        want |= {(i, name) for i, p in rows if p and any(_inside(p[0] + t, p[1], flat) for t in (-360, 0, 360))}
    pairs = [(r.id, r.poly) for r in got.select("id", "poly").collect()]
    assert set(pairs) == want and len(pairs) == len(want) and {n for _, n in want} == set(rings)


def test_covering_is_adaptive():
    from lakelens.operators import covering
    for name, ring in RINGS.items():
        xs, ys = (np.array(v, float) for v in zip(*ring))
        cells = covering.cover(xs, ys)
        assert len(cells) <= 4 * covering.MAX_CELLS
        assert len(set(c[:3] for c in cells)) == len(cells)
    world = covering.cover(*(np.array(v, float) for v in zip(*RINGS["world"])))
    assert any(c[3] and c[0] <= 4 for c in world)  # large cells inside
    small = covering.cover(*(np.array(v, float) / 1000 for v in zip(*RINGS["triangle"])))
    assert min(c[0] for c in small) >= 10 and any(c[3] for c in small)


def test_rings_stay_out_of_the_cells(spark):
    _, pts = _points(spark, 50)
    plan = spatial.points_in_polygons(pts, "loc", _ring_rows(spark, RINGS), "ring", max_broadcast_bytes=0)
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    cells = [x for x in text.splitlines() if "_inside" in x and "LogicalRDD" in x or "Project" in x and "AS _inside" in x]
    assert cells and not any("ring" in x for x in cells)
    assert "Cartesian" not in text and "NestedLoop" not in plan._jdf.queryExecution().executedPlan().toString()


def test_hot_cell_is_dealt_out(spark):
    rng = np.random.default_rng(4)
    n = 3000
    # a third of all points in one cell
    xs = np.concatenate((rng.uniform(10, 10.02, n // 3), rng.uniform(-180, 180, n - n // 3)))
    ys = np.concatenate((rng.uniform(50, 50.02, n // 3), rng.uniform(-85, 85, n - n // 3)))
    pts = spark.createDataFrame([(i, (float(x), float(y))) for i, (x, y) in enumerate(zip(xs, ys))],
                                "id long, loc struct<lon: double, lat: double>").repartition(8).checkpoint()
    radius = 700.0
    plain = spatial.pairs_within(pts, "id", "loc", radius, hot_rows=10**9)
    tiled = spatial.pairs_within(pts, "id", "loc", radius, hot_rows=100)
    a, b = ({(r.l_id, r.r_id) for r in df.collect()} for df in (plain, tiled))
    assert a == b and len(a) > 10_000 and tiled.count() == len(a)
    left = pts.select(F.col("id").alias("l_id"), F.lit(1).alias("cell"))
    right = pts.select(F.col("id").alias("r_id"), F.lit(1).alias("cell"))
    one, two, keys = spatial.spread_hot_cells(left, right, "l_id", "r_id", 500)
    met = one.join(two, keys)
    assert met.count() == n * n and met.select("l_id", "r_id").distinct().count() == n * n
    assert max(r["count"] for r in one.groupBy(*keys).count().collect()) < 2 * 500


# ---------------------------------------------------------------- planes and poles

def _cap(lat, n, turn=1):
    lons = [(-180 + turn * k * 360 / n + 180) % 360 - 180 for k in range(n)]
    return [*lons, lons[0]], [float(lat)] * (n + 1)


@pytest.mark.parametrize("lat", [89.0, 80.0, 30.0, -75.0, -10.0])
def test_area_round_a_pole(lat):
    beta, radius = geodesy._authalic(np.array([abs(lat)]))
    want = 2 * math.pi * radius ** 2 * (1 - math.sin(beta[0]))
    for turn in (1, -1):
        got = geodesy.ring_area(*_cap(lat, 3600, turn))
        assert got == pytest.approx(want, rel=2e-6)
    # a triangle round the pole lies inside the cap: its edges are geodesics
    assert 0 < geodesy.ring_area(*_cap(lat, 3)) < want * (1 + 1e-9)


def test_area_of_polar_rings_in_a_query(spark):
    lons, lats = _cap(80, 360)
    df = spark.createDataFrame([([(x, y) for x, y in zip(lons, lats)],)], "ring array<struct<lon: double, lat: double>>")
    area = df.select(geo.geodesic_area_m2(F.col("ring"))).first()[0]
    assert area == pytest.approx(3.9e12, rel=0.01)


def test_projected_buffer(spark):
    from lakelens.functions import projection
    rows = [(i, (x, y)) for i, (_, _, x, y) in enumerate(CITIES)] + [
        (10, (3.0, 0.0)), (11, (179.99, 10.0)), (12, (-180.0, -45.0)), (13, (10.0, 75.0)), (14, (100.0, -89.99)), (15, (0.0, 90.0)),
        (16, None)]
    df = spark.createDataFrame(rows, "id int, p struct<lon: double, lat: double>")
    out = {r.id: r for r in df.select("*", projection.projected_buffer(F.col("p"), 10_000.0).alias("ring")).collect()}
    assert out[16].ring is None
    for i, p in rows[:-1]:
        ring = out[i].ring
        assert len(ring) == 33 and ring[0] == ring[-1]
        s, az = geodesy.inverse([p[0]] * 33, [p[1]] * 33, [v.lon for v in ring], [v.lat for v in ring])
        # the plane's scale is 0.9996 to 1.0010 within a zone; near a pole it is 1 at the pole and keeps areas
        low, high = (9_985, 10_005) if abs(p[1]) <= 70 else (9_800, 10_200)
        assert low < min(s) and max(s) < high, (i, min(s), max(s))
        if abs(p[1]) <= 70:
            assert (np.array([v.lat for v in ring[1:16]]) < p[1] + 1e-3).all()  # clockwise: first to the south
    # on the central meridian the scale is 0.9996 in every direction
    s, _ = geodesy.inverse([3.0] * 33, [0.0] * 33, [v.lon for v in out[10].ring], [v.lat for v in out[10].ring])
    assert max(abs(s - 10_000 / 0.9996)) < 0.02


def test_mercator_there_and_back(spark):
    from lakelens.functions import projection
    rng = np.random.default_rng(0)
    rows = [(float(m + d), float(y), float(m)) for m, d, y in zip(rng.integers(-29, 29, 200) * 6 + 3, rng.uniform(-4, 4, 200), rng.uniform(-70, 70, 200))]
    df = spark.createDataFrame(rows, "lon double, lat double, m double")
    df = df.withColumn("p", projection.mercator(F.col("lon"), F.col("lat"), F.col("m")))
    df = df.withColumn("b", projection.from_mercator(F.col("p.x"), F.col("p.y"), F.col("m")))
    worst = df.agg(F.max(F.abs(F.col("b.lat") - F.col("lat"))), F.max(F.abs(F.col("b.lon") - F.col("lon")))).first()
    assert max(worst) < 1e-9
    # New York in zone 18: known easting and northing
    e = df.limit(1).select(projection.mercator(F.lit(-74.0060), F.lit(40.7128), F.lit(-75.0)).alias("p")).first().p
    assert (e.x + 500_000, e.y) == (pytest.approx(583_959.4, abs=1), pytest.approx(4_507_350.9, abs=2))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


def test_pairs_are_measured_by_tile(spark):
    """Near pairs of a tile are told apart by their chord; null ids, null points and equal ids pair with nothing."""
    rng = np.random.default_rng(8)
    n, radius = 400, 300_000.0
    xs, ys = rng.uniform(-185, 185, n), np.concatenate((rng.uniform(-5, 5, n // 2), rng.uniform(84, 90, n - n // 2)))
    ids = [f"p{i % 350:03d}" for i in range(n)]
    rank = np.argsort(np.argsort(ids))
    i, j, metres = geodesy.pairs_within(xs, ys, rank, xs, ys, rank, radius, block=64)
    a, b = np.nonzero(np.ones((n, n), bool))
    every, _ = geodesy.inverse(xs[a], ys[a], xs[b], ys[b])
    order = np.argsort(np.argsort(ids))
    want = {(x, y): d for x, y, d in zip(a, b, every) if d <= radius and rank[x] < rank[y]}
    assert set(zip(i, j)) == set(want) and all(abs(want[x, y] - d) < 1e-9 for x, y, d in zip(i, j, metres))
    rows = [(k, (float(x), float(y))) for k, x, y in zip(ids, xs, ys)] + [(None, (0.0, 0.0)), ("none", None)]
    pts = spark.createDataFrame(rows, "id string, loc struct<lon: double, lat: double>")
    got = spatial.pairs_within(pts, "id", "loc", radius, columns=("l_id", "r_id", "distance_m"))
    assert got.columns == ["l_id", "r_id", "distance_m"]
    assert "FlatMapCoGroupsInArrow" in got._jdf.queryExecution().executedPlan().toString()
    pairs = sorted((ids[x], ids[y]) for x, y in zip(a, b) if ids[x] < ids[y] and every[x * n + y] <= radius)
    assert sorted((r.l_id, r.r_id) for r in got.collect()) == pairs and len(pairs) > 1000


def _pair_points():
    """Scattered points, many at one place, some round a pole, equal and null ids, null and infinite places, null names."""
    rng = np.random.default_rng(21)
    n = 2600
    xs = np.concatenate((rng.uniform(-185, 185, n - 700), np.full(300, 20.0), rng.uniform(-180, 180, 200), 20 + rng.uniform(-0.01, 0.01, 200)))
    ys = np.concatenate((rng.uniform(-88, 88, n - 700), np.full(300, 50.0), rng.uniform(88, 90, 200), 50 + rng.uniform(-0.01, 0.01, 200)))
    ids = [f"p{i % 2550:04d}" for i in range(n)]
    names = [None if i % 50 == 0 else f"n{i}" for i in range(n)]
    rows = [(k, m, (float(x), float(y))) for k, m, x, y in zip(ids, names, xs, ys)]
    odd = [(None, "null id", (20.0, 50.0)), ("z1", "no place", None), ("z2", "nan", (math.nan, 50.0)), ("z3", "inf", (20.0, math.inf))]
    return rows, rows + odd


def _measured_pairs(rows, radius):
    """(l_id, r_id, l_name, r_name, metres) of all pairs, each measured."""
    xs, ys = (np.array([r[2][k] for r in rows]) for k in (0, 1))
    a, b = np.triu_indices(len(rows), 1)
    close = np.abs(ys[a] - ys[b]) < radius / 110_000
    a, b = a[close], b[close]
    metres, _ = geodesy.inverse(xs[a], ys[a], xs[b], ys[b])
    out = []
    for i, j, m in zip(a[metres <= radius], b[metres <= radius], metres[metres <= radius]):
        i, j = (i, j) if rows[i][0] < rows[j][0] else (j, i)
        if rows[i][0] != rows[j][0]:
            out.append((rows[i][0], rows[j][0], rows[i][1], rows[j][1], m))
    return out


@pytest.mark.parametrize("result_pairs", [8 << 20, 4000, 1000])
def test_ordered_pairs_are_whole_and_in_order(spark, monkeypatch, result_pairs):
    """However many result tasks the pairs are dealt to, also where equal distances fill several of them."""
    monkeypatch.setattr(spatial, "RESULT_PAIRS", result_pairs)
    rows, table = _pair_points()
    pts = spark.createDataFrame(table, "id string, name string, loc struct<lon: double, lat: double>").repartition(5)
    radius = 500_000.0
    got = spatial.pairs_within(pts, "id", "loc", radius, "km", carry=("name",), km_decimals=2,
                               columns={"l_id": "a", "r_id": "b", "l_name": "m", "r_name": "n", "km": "km"})
    assert got.columns == ["a", "m", "b", "n", "km"]
    tasks = got.rdd.getNumPartitions()
    assert (tasks > 60) == (result_pairs == 1000)
    got = [tuple(r) for r in got.collect()]
    metres = _measured_pairs(rows, radius)
    steps = geodesy.km_steps([m for *_, m in metres], 2)
    want = [(a, m, b, n, k / 100) for (a, b, m, n, _), k in zip(metres, steps)]
    assert [r[-1] for r in got] == sorted(r[-1] for r in want)
    assert Counter(got) == Counter(want) and len(got) > 80_000


def test_ordered_pairs_beyond_the_bounds(spark, monkeypatch):
    """A longer radius, and points whose columns are too many bytes to be looked up."""
    rows, table = _pair_points()
    pts = spark.createDataFrame(table[::3] + table[-4:], "id string, name string, loc struct<lon: double, lat: double>")

    def pairs(radius):
        got = spatial.pairs_within(pts, "id", "loc", radius, "km", km_decimals=2, columns=("l_id", "r_id", "km")).collect()
        assert [r.km for r in got] == sorted(r.km for r in got)
        return Counter(map(tuple, got))
    placed = pts.where(~F.col("id").isin("z2", "z3"))
    plain = spatial.pairs_within(placed, "id", "loc", 1_500_000.0, columns=("l_id", "r_id", "distance_m"))
    plain = plain.select("l_id", "r_id", F.round(F.col("distance_m") / 1000, 2))
    assert pairs(1_500_000.0) == Counter(map(tuple, plain.collect()))
    looked_up = pairs(300_000.0)
    monkeypatch.setattr(spatial, "MAX_LOOKUP_BYTES", 1000)
    assert pairs(300_000.0) == looked_up and looked_up


def test_no_second_pass_over_the_pairs_for_their_order(spark):
    """The pairs were made twice, once for the bounds of the order, and shuffled as rows with both names."""
    from lakelens.plans import queries
    made = queries.geo_pair_distance(spark, "/root/testdata/sf0.001")
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "rangepartitioning" not in plan
    assert not any("_city" in x or "name" in x for x in plan.splitlines() if "Exchange" in x)
    km = [r.distance_km for r in made.collect()]
    assert km == sorted(km) and made.columns == ["from_city", "to_city", "distance_km"]


def test_steps_are_rounded_as_spark_rounds(spark):
    rng = np.random.default_rng(5)
    metres = np.concatenate((np.arange(0, 40_000) * 5.0, rng.uniform(0, 500_000, 20_000), np.nextafter(np.arange(1, 9_000) * 5.0, 0)))
    df = spark.createDataFrame([(float(m),) for m in metres], "m double").select("m", F.round(F.col("m") / 1000, 2).alias("km"))
    rows = df.collect()
    assert (geodesy.km_steps([r.m for r in rows], 2) / 100 == np.array([r.km for r in rows])).all()


@pytest.mark.parametrize("radius", [3_000.0, 500_000.0, 1_000_000.0])
def test_chord_arcs_are_nearer_than_their_margin(radius):
    rng = np.random.default_rng(6)
    n = 50_000
    x1, y1 = rng.uniform(-180, 180, n), rng.uniform(-90, 90, n)
    x2, y2 = geodesy.direct(x1, y1, rng.uniform(0, 360, n), np.maximum(1000.0, radius * np.sqrt(rng.random(n))))
    p, q = geodesy._unit_sphere(x1, y1), geodesy._unit_sphere(x2, y2)
    arcs = geodesy._arc_of_chord(2 - 2 * (p * q).sum(axis=1), p[:, 2], q[:, 2])
    off = np.abs(arcs - geodesy.inverse(x1, y1, x2, y2)[0])
    assert off.max() < geodesy._arc_margin(radius) / 4


def test_buffers_are_dealt_to_all_slots(spark):
    """However few row groups the points come in."""
    from lakelens.plans import queries
    made = queries.geo_buffer(spark, "/root/testdata/sf0.001")
    assert made.rdd.getNumPartitions() >= 4 * spark.sparkContext.defaultParallelism
