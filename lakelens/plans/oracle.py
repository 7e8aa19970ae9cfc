"""Independent DuckDB SQL for each registered query, over the driver tables as views.

The fixture mappings are re-stated in SQL (not generated from the Spark code) so
the oracle checks the Spark operators rather than repeating them.  Geodesic
distances use a recursive-CTE Vincenty iteration in plain SQL.
"""

from __future__ import annotations

# ---------------------------------------------------------------- shared fixture CTEs

_F = "(1.0::DOUBLE / 298.257223563::DOUBLE)"
_A = "6378137.0::DOUBLE"

_EXT = "lower(regexp_extract(filename, '^.+(\\.[^./]+)$', 1))"

DOCS = f"""
doc_files AS (
  SELECT doc_id, text,
         'doc_' || doc_id || (['.jpg','.jpeg','.png','.gif','.bmp','.tiff','.webp','.JPG','.txt'])[doc_id % 9 + 1] AS filename
  FROM documents),
doc_msgs AS (
  SELECT doc_id, filename, '/data/incoming/' || filename AS filepath,
         octet_length(encode(text))::BIGINT AS file_size,
         sha256(text) AS file_hash,
         CASE {_EXT} WHEN '.jpg' THEN 'image/jpeg' WHEN '.jpeg' THEN 'image/jpeg' WHEN '.png' THEN 'image/png'
              WHEN '.gif' THEN 'image/gif' WHEN '.bmp' THEN 'image/bmp' WHEN '.tiff' THEN 'image/tiff'
              WHEN '.webp' THEN 'image/webp' ELSE 'application/octet-stream' END AS mime_type,
         strftime(TIMESTAMP '2024-01-01 00:00:00' + to_minutes(doc_id), '%Y-%m-%dT%H:%M:%S') AS timestamp,
         to_base64(encode(text)) AS image_data,
         (doc_id % 3)::INTEGER AS kafka_partition,
         (doc_id // 3)::BIGINT AS kafka_offset,
         TIMESTAMP '2024-01-01 00:00:00' + to_minutes(doc_id) AS kafka_timestamp
  FROM doc_files
  WHERE {_EXT} IN ('.jpg','.jpeg','.png','.gif','.bmp','.tiff','.webp')),
t1 AS (
  SELECT doc_id::BIGINT AS id, filename, file_hash, file_size, mime_type,
         'images/' || strftime(kafka_timestamp, '%Y/%m/%d') || '/' || filename AS s3_path,
         kafka_timestamp AS uploaded_at, filepath AS source_path, kafka_offset, kafka_partition,
         kafka_timestamp AS processed_at
  FROM doc_msgs
  QUALIFY row_number() OVER (PARTITION BY file_hash ORDER BY kafka_timestamp, kafka_partition, kafka_offset) = 1),
ingested AS (
  SELECT d.doc_id::BIGINT AS id, sha256(d.text) AS file_hash
  FROM documents d WHERE d.doc_id IN (SELECT doc_id FROM labels))"""

EVENTS = """
ev AS (
  SELECT event_id, ts, user_id, event_type, value, props,
         event_type || '_' || event_id || '.jpg' AS filename,
         CASE WHEN event_id % 50 = 0 THEN '' WHEN event_id % 50 = 1 THEN NULL ELSE sha256(props) END AS msg_hash,
         CAST(round(value * 100) AS BIGINT) AS file_size,
         CASE event_type WHEN 'click' THEN 'image/jpg' WHEN 'view' THEN 'image/jpeg'
              WHEN 'purchase' THEN 'image/png' WHEN 'signup' THEN 'image/gif' END AS mime_type,
         event_id % 97 AS bad
  FROM events)"""

_LAKE_COLS = ("id, filename, file_hash, file_size, width, height, mime_type, s3_path, uploaded_at, "
              "kafka_offset, kafka_partition")
_LOG_COLS = _LAKE_COLS + ", uploaded_day, commit_id, committed_at, op"

LAKE = EVENTS + f""",
img AS (
  SELECT event_id::BIGINT AS id, filename, sha256(props) AS file_hash, file_size,
         NULL::INTEGER AS width, NULL::INTEGER AS height, mime_type,
         'images/' || strftime(ts, '%Y/%m/%d') || '/' || filename AS s3_path,
         ts AS uploaded_at, event_id::BIGINT AS kafka_offset, (user_id % 3)::INTEGER AS kafka_partition,
         CAST(ts AS DATE) AS uploaded_day
  FROM ev),
base AS (
  SELECT *, (date_diff('day', DATE '2024-01-01', uploaded_day) + 1)::BIGINT AS commit_id,
         CAST(uploaded_day + INTERVAL 1 DAY AS TIMESTAMP) AS committed_at, 'append' AS op
  FROM img),
upd AS (
  SELECT id, filename, file_hash, file_size, width, height, 'image/jpeg' AS mime_type, s3_path, uploaded_at,
         kafka_offset, kafka_partition, uploaded_day, 101::BIGINT AS commit_id,
         TIMESTAMP '2024-02-01 12:00:00' AS committed_at, 'update' AS op
  FROM base WHERE mime_type = 'image/jpg'),
log1 AS (SELECT {_LOG_COLS} FROM base UNION ALL SELECT {_LOG_COLS} FROM upd),
cur1 AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY commit_id DESC) AS rn FROM log1)
  WHERE rn = 1),
del AS (
  SELECT id, filename, file_hash, file_size, width, height, mime_type, s3_path, uploaded_at,
         kafka_offset, kafka_partition, uploaded_day, 102::BIGINT AS commit_id,
         TIMESTAMP '2024-02-02 00:00:00' AS committed_at, 'delete' AS op
  FROM cur1 WHERE uploaded_at < DATE '2024-01-05'),
log AS (SELECT {_LOG_COLS} FROM log1 UNION ALL SELECT {_LOG_COLS} FROM del),
cur AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY commit_id DESC, (op IN ('append','update')) DESC) AS rn
    FROM log) WHERE rn = 1 AND op IN ('append','update'))"""


def _state_at(ts: str) -> str:
    return f"""
  SELECT TIMESTAMP '{ts}' AS as_of_ts, {_LAKE_COLS} FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY commit_id DESC, (op IN ('append','update')) DESC) AS rn
    FROM log WHERE committed_at <= TIMESTAMP '{ts}') WHERE rn = 1 AND op IN ('append','update')"""


def _fmt(x: str) -> str:
    """Coordinate text as point WKT prints it: shortest decimal, at most 15 decimals, no trailing .0."""
    s = f"CAST({x} AS VARCHAR)"
    return (f"CASE WHEN length(regexp_extract({s}, '\\.([0-9]*)$', 1)) > 15 OR {s} LIKE '%e%' "
            f"THEN regexp_replace(CAST(CAST({s} AS DECIMAL(38,15)) AS VARCHAR), '\\.?0+$', '') "
            f"ELSE regexp_replace({s}, '\\.0$', '') END")


def _point_text(lon: str, lat: str) -> str:
    return f"'POINT(' || {_fmt(lon)} || ' ' || {_fmt(lat)} || ')'"


def _scatter(key: str) -> tuple[str, str]:
    lon = f"((({key}) * 7919) % 36000)::DOUBLE / 100.0::DOUBLE - 180.0::DOUBLE"
    lat = f"((({key}) * 104729) % 17000)::DOUBLE / 100.0::DOUBLE - 85.0::DOUBLE"
    return lon, lat


IMAGE_LOCATIONS = """
il AS (
  SELECT event_id::BIGINT AS id, (event_id % 1000)::BIGINT AS image_id, value AS altitude,
         CASE WHEN event_id % 199 <> 0 THEN -74.0060::DOUBLE + (((event_id * 7) % 401) - 200)::DOUBLE / 10000.0::DOUBLE END AS lon,
         CASE WHEN event_id % 199 <> 0 THEN 40.7128::DOUBLE + (((event_id * 11) % 401) - 200)::DOUBLE / 10000.0::DOUBLE END AS lat
  FROM events)"""


def vincenty(src: str, key: str, iterations: int = 40) -> str:
    """CTEs ending in ``vd(<key>, dist_m, az)``: WGS84 inverse distance and forward azimuth (deg) for rows of
    ``src(key, lon1, lat1, lon2, lat2)``."""
    f, a = _F, _A
    b = f"({a} * (1 - {f}))"

    def parts(rel: str) -> str:
        return f"""
      SELECT *, {f} / 16 * ca2 * (4 + {f} * (4 - 3 * ca2)) AS C FROM (
        SELECT *, CASE WHEN ca2 = 0 THEN 0.0::DOUBLE ELSE cs - 2 * sU1 * sU2 / ca2 END AS c2m FROM (
          SELECT *, 1 - sa * sa AS ca2 FROM (
            SELECT *, CASE WHEN ss = 0 THEN 0.0::DOUBLE ELSE cU1 * cU2 * sin(lam) / ss END AS sa,
                   atan2(ss, cs) AS sig FROM (
              SELECT {key}, L, sU1, cU1, sU2, cU2, lam, n,
                     sqrt(pow(cU2 * sin(lam), 2) + pow(cU1 * sU2 - sU1 * cU2 * cos(lam), 2)) AS ss,
                     sU1 * sU2 + cU1 * cU2 * cos(lam) AS cs
              FROM {rel}) p1) p2) p3) p4"""

    return f"""
vz AS (
  SELECT {key}, radians(((((lon2 - lon1) + 180.0::DOUBLE) % 360.0::DOUBLE) + 360.0::DOUBLE) % 360.0::DOUBLE - 180.0::DOUBLE) AS L,
         atan((1 - {f}) * tan(radians(lat1))) AS U1, atan((1 - {f}) * tan(radians(lat2))) AS U2
  FROM {src}),
vit AS (
  SELECT {key}, L, sin(U1) AS sU1, cos(U1) AS cU1, sin(U2) AS sU2, cos(U2) AS cU2, L AS lam, 0 AS n FROM vz
  UNION ALL
  SELECT {key}, L, sU1, cU1, sU2, cU2,
         L + (1 - C) * {f} * sa * (sig + C * ss * (c2m + C * cs * (-1 + 2 * c2m * c2m))) AS lam, n + 1 AS n
  FROM ({parts(f"(SELECT * FROM vit WHERE n < {iterations})")}) q),
vfin AS ({parts(f"(SELECT * FROM vit WHERE n = {iterations})")}),
vd AS (
  SELECT {key}, {b} * A_ * (sig - B_ * ss * (c2m + B_ / 4 * (cs * (-1 + 2 * c2m * c2m)
           - B_ / 6 * c2m * (-3 + 4 * ss * ss) * (-3 + 4 * c2m * c2m)))) AS dist_m,
         degrees(atan2(cU2 * sin(lam), cU1 * sU2 - sU1 * cU2 * cos(lam))) AS az
  FROM (
    SELECT *, 1 + u2 / 16384 * (4096 + u2 * (-768 + u2 * (320 - 175 * u2))) AS A_,
           u2 / 1024 * (256 + u2 * (-128 + u2 * (74 - 47 * u2))) AS B_
    FROM (SELECT *, ca2 * ({a} * {a} - {b} * {b}) / ({b} * {b}) AS u2 FROM vfin) r1) r2)"""


def vincenty_direct(src: str, name: str, iterations: int = 10) -> str:
    """CTE ``name``: the columns of ``src`` (lon1, lat1, az in degrees, s in metres and others) plus the end
    point (lon2, lat2) of each geodesic."""
    f, a = _F, _A
    b = f"({a} * (1 - {f}))"
    rel = f"""
      SELECT *, s / ({b} * A_) AS sig0, s / ({b} * A_) AS sig FROM (
        SELECT *, 1 + u2 / 16384 * (4096 + u2 * (-768 + u2 * (320 - 175 * u2))) AS A_,
               u2 / 1024 * (256 + u2 * (-128 + u2 * (74 - 47 * u2))) AS B_ FROM (
          SELECT *, (1 - sa * sa) * ({a} * {a} - {b} * {b}) / ({b} * {b}) AS u2, 1 - sa * sa AS ca2 FROM (
            SELECT *, cU * sin(a1) AS sa, tU * cU AS sU, atan2(tU, cos(a1)) AS sig1 FROM (
              SELECT *, 1 / sqrt(1 + tU * tU) AS cU FROM (
                SELECT *, radians(az) AS a1, (1 - {f}) * tan(radians(lat1)) AS tU FROM {src}) d0) d1) d2) d3) d4"""
    turn = ("(c2m + B_ / 4 * (cos(sig) * (-1 + 2 * c2m * c2m)"
            " - B_ / 6 * c2m * (-3 + 4 * sin(sig) * sin(sig)) * (-3 + 4 * c2m * c2m)))")
    for _ in range(iterations):
        rel = f"""
      SELECT * EXCLUDE (sig, c2m), sig0 + B_ * sin(sig) * {turn} AS sig FROM (
        SELECT *, cos(2 * sig1 + sig) AS c2m FROM ({rel}) i0) i1"""
    return f"""
{name} AS (
  SELECT * REPLACE ((((lon1 + degrees(lam - (1 - C) * {f} * sa * (sig + C * sin(sig) * (c2m + C * cos(sig) * (-1 + 2 * c2m * c2m))))
                       + 180.0::DOUBLE) % 360.0::DOUBLE) + 360.0::DOUBLE) % 360.0::DOUBLE - 180.0::DOUBLE AS lon2)
  FROM (
    SELECT *, 0.0::DOUBLE AS lon2, {f} / 16 * ca2 * (4 + {f} * (4 - 3 * ca2)) AS C, cos(2 * sig1 + sig) AS c2m,
           degrees(atan2(sU * cos(sig) + cU * sin(sig) * cos(a1),
                         (1 - {f}) * sqrt(sa * sa + pow(sU * sin(sig) - cU * cos(sig) * cos(a1), 2)))) AS lat2,
           atan2(sin(sig) * sin(a1), cU * cos(sig) - sU * sin(sig) * cos(a1)) AS lam
    FROM ({rel}) e0) e1)"""


def projected_buffers(src: str, name: str, radius_m: float) -> str:
    """CTEs up to ``name``: the columns of ``src`` (lon1, lat1 and others) plus vertex, lon2, lat2 of each point's
    circle of ``radius_m``, drawn in its UTM zone, or in the equal-area plane of a pole beyond 70 degrees."""
    f = 1 / 298.257223563
    n, e2 = f / (2 - f), f * (2 - f)

    def d(x: float) -> str:  # a double, not a decimal
        return f"{x:.17e}"

    def series(terms: tuple[float, ...], start: str, part: str, sign: str = "+") -> str:
        return start + "".join(f" {sign} {d(c)} * {part.replace('K', str(2 * j))}" for j, c in enumerate(terms, 1))
    to_plane = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180, 13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440,
                61 * n**3 / 240 - 103 * n**4 / 140, 49561 * n**4 / 161280)
    from_plane = (n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96 - n**4 / 360, n**2 / 48 + n**3 / 15 - 437 * n**4 / 1440,
                  17 * n**3 / 480 - 37 * n**4 / 840, 4397 * n**4 / 161280)
    to_lat = (2 * n - 2 * n**2 / 3 - 2 * n**3 + 116 * n**4 / 45, 7 * n**2 / 3 - 8 * n**3 / 5 - 227 * n**4 / 45,
              56 * n**3 / 15 - 136 * n**4 / 35, 4279 * n**4 / 630)
    authalic = (e2 / 3 + 31 * e2**2 / 180 + 517 * e2**3 / 5040, 23 * e2**2 / 360 + 251 * e2**3 / 3780, 761 * e2**3 / 45360)
    e, a, r = d(e2 ** 0.5), d(6378137.0), d(6378137.0 / (1 + n) * (1 + n**2 / 4 + n**4 / 64) * 0.9996)
    q = f"({d(1 - e2)} * (s / (1 - {d(e2)} * s * s) + atanh({e} * s) / {e}))"
    pole = f"(1 + {d(1 - e2)} / {e} * atanh({e}))"
    return f"""
plane AS (
  SELECT *, abs(lat1) > 70 AS near_pole, CASE WHEN lat1 < 0 THEN -1e0 ELSE 1e0 END AS side,
         CASE WHEN abs(lat1) <= 70 THEN least(floor((lon1 + 180e0) / 6e0), 59) * 6e0 - 177e0 WHEN lat1 > 0 THEN -40e0 ELSE 0e0 END AS m
  FROM {src}),
conformal AS (
  SELECT *, radians(lon1 - m) AS lam, sin(radians(lat1)) * side AS s,
         sinh(atanh(sin(radians(lat1))) - {e} * atanh({e} * sin(radians(lat1)))) AS t FROM plane),
polar_parts AS (
  SELECT *, {a} * sqrt(greatest({pole} - {q}, 0e0)) AS rho, atan2(t, cos(lam)) AS xi, atanh(sin(lam) / sqrt(1 + t * t)) AS eta
  FROM conformal),
centers AS (
  SELECT *, CASE WHEN near_pole THEN rho * sin(lam) ELSE ({series(to_plane, 'eta', 'cos(K * xi) * sinh(K * eta)')}) * {r} END AS x,
         CASE WHEN near_pole THEN -side * rho * cos(lam) ELSE ({series(to_plane, 'xi', 'sin(K * xi) * cosh(K * eta)')}) * {r} END AS y
  FROM polar_parts),
rim AS (
  SELECT * EXCLUDE (x, y, xi, eta, lam), x + {d(radius_m)} * cos((k % 32) * {d(-0.19634954084936207)}) AS x,
         y + {d(radius_m)} * sin((k % 32) * {d(-0.19634954084936207)}) AS y, k AS vertex
  FROM (SELECT *, unnest(range(0, 33)) AS k FROM centers)),
angles AS (
  SELECT *, {series(from_plane, f'y / {r}', f'sin(K * y / {r}) * cosh(K * x / {r})', '-')} AS xi,
         {series(from_plane, f'x / {r}', f'cos(K * y / {r}) * sinh(K * x / {r})', '-')} AS eta,
         asin(greatest(least(({pole} - (x * x + y * y) / ({a} * {a})) / {pole}, 1e0), -1e0)) AS beta FROM rim),
turned AS (
  SELECT *, asin(sin(xi) / cosh(eta)) AS chi, CASE WHEN near_pole THEN atan2(x, -side * y) ELSE atan2(sinh(eta), cos(xi)) END AS lam
  FROM angles),
{name} AS (
  SELECT *, (((m + degrees(lam) + 180e0) % 360e0) + 360e0) % 360e0 - 180e0 AS lon2,
         CASE WHEN near_pole THEN side * degrees({series(authalic, 'beta', 'sin(K * beta)')})
              ELSE degrees({series(to_lat, 'chi', 'sin(K * chi)')}) END AS lat2 FROM turned)"""


def _authalic_sine(lat: str) -> str:
    """q of the authalic latitude of ``lat`` degrees."""
    e2 = f"({_F} * (2 - {_F}))"
    sine = f"sin(radians({lat}))"
    return (f"((1 - {e2}) * ({sine} / (1 - {e2} * {sine} * {sine})"
            f" - (1 / (2 * sqrt({e2}))) * ln((1 - sqrt({e2}) * {sine}) / (1 + sqrt({e2}) * {sine}))))")


def _with(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",".join(c.strip().rstrip(",") for c in ctes) + "\n"


# ---------------------------------------------------------------- per-query SQL

def _lake_queries() -> dict[str, str]:
    w = _with(LAKE)
    as_of = " UNION ALL ".join(_state_at(ts) for ts in
                               ["2024-01-10 00:00:00", "2024-02-01 12:00:00", "2024-03-01 00:00:00"])
    return {
        "daily_volume": w + """
SELECT CAST(uploaded_at AS DATE) AS upload_date, count(*) AS image_count,
       sum(file_size) / 1024 / 1024 AS total_size_mb
FROM cur GROUP BY 1 ORDER BY 1 DESC""",
        "lake_row_count": w + "SELECT count(*) AS row_count FROM cur",
        "lake_limit_count": w + "SELECT least(10, count(*)) AS row_count FROM cur",
        "lake_files": """
SELECT 'orders.parquet' AS file_name, count(*) AS record_count, min(o_orderdate) AS lower_bound,
       max(o_orderdate) AS upper_bound FROM orders""",
        "daily_volume_ranked": w + """
SELECT row_number() OVER (ORDER BY CAST(uploaded_at AS DATE) DESC) AS rank, CAST(uploaded_at AS DATE) AS upload_date,
       count(*) AS image_count FROM cur GROUP BY 2""",
        "lake_latest_rows": w + """
SELECT uploaded_at, file_hash, filename, file_size, mime_type FROM cur
ORDER BY uploaded_at DESC, id DESC LIMIT 5""",
        "lake_as_of": w + as_of,
        "lake_snapshots": w + """
, per AS (
  SELECT commit_id, max(committed_at) AS committed_at,
         count(*) FILTER (WHERE op = 'append') AS na, count(*) FILTER (WHERE op = 'update') AS nu,
         count(*) FILTER (WHERE op = 'delete') AS nd
  FROM log GROUP BY commit_id)
SELECT committed_at, commit_id AS snapshot_id,
       lag(commit_id) OVER (ORDER BY committed_at, commit_id) AS parent_id,
       CASE WHEN nu = 0 AND nd = 0 THEN 'append' WHEN nu = 0 AND na = 0 THEN 'delete' ELSE 'overwrite' END AS operation,
       na + nu AS added_records, nu + nd AS deleted_records,
       CAST(sum(na - nd) OVER (ORDER BY committed_at, commit_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
            AS BIGINT) AS total_records
FROM per ORDER BY committed_at DESC""",
        "lake_partition_range": w + f"""
SELECT {_LAKE_COLS} FROM cur WHERE uploaded_at >= DATE '2024-01-11' AND uploaded_at < DATE '2024-01-12'""",
        "lake_update": w + f"SELECT {_LOG_COLS} FROM upd",
        "lake_delete": w + f"SELECT {_LOG_COLS} FROM del",
        "retention_delete": w + f"""
SELECT {_LAKE_COLS} FROM img
WHERE uploaded_at IS NULL OR uploaded_at >= CAST(DATE '2024-02-05' - INTERVAL 30 DAY AS TIMESTAMP)""",
        "lake_expire": w + f"""
, old AS (SELECT * FROM log WHERE committed_at <= TIMESTAMP '2024-02-01 00:00:00'),
b AS (SELECT commit_id AS cid, committed_at AS at FROM old ORDER BY committed_at DESC, commit_id DESC LIMIT 1),
live_old AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY commit_id DESC, (op IN ('append','update')) DESC) AS rn
    FROM old) WHERE rn = 1 AND op IN ('append','update'))
SELECT {_LAKE_COLS}, uploaded_day, b.cid AS commit_id, b.at AS committed_at, 'append' AS op FROM live_old, b
UNION ALL
SELECT {_LOG_COLS} FROM log WHERE committed_at > TIMESTAMP '2024-02-01 00:00:00'""",
        "lake_compact": w + f"SELECT {_LOG_COLS} FROM log",
    }


_VALUES = """
, env AS (
  SELECT doc_id, kafka_partition, kafka_offset,
         to_json({'filename': filename, 'filepath': filepath, 'file_size': file_size, 'file_hash': file_hash,
                  'mime_type': mime_type, 'timestamp': timestamp, 'image_data': image_data}) AS value
  FROM doc_msgs)"""


def document_values() -> str:
    """CTEs of the image documents' messages and their JSON values (``env``)."""
    return _with(DOCS) + _VALUES


def _ingest_queries() -> dict[str, str]:
    w = _with(DOCS)
    faulty = _VALUES + """,
faulty AS (
  SELECT kafka_partition, kafka_offset, CASE doc_id % 13
    WHEN 0 THEN regexp_replace(value, '"filename":"[^"]*",', '')
    WHEN 1 THEN regexp_replace(value, '"filename":"[^"]*"', '"filename":"' || repeat('f', 252) || '.jpg"')
    WHEN 2 THEN regexp_replace(value, '"file_hash":"([0-9a-f]*)"', '"file_hash":"\\1a"')
    WHEN 3 THEN regexp_replace(value, '"mime_type":"[^"]*"', '"mime_type":"' || repeat('m', 51) || '"')
    WHEN 4 THEN regexp_replace(value, '"timestamp":"[^"]*"', '"timestamp":"yesterday"')
    WHEN 6 THEN regexp_replace(value, '"timestamp":"([^"]*)"', '"timestamp":"\\1+02:00"')
    WHEN 7 THEN regexp_replace(value, '"image_data":"([^"]*)"', '"image_data":"\\1A"')
    WHEN 8 THEN regexp_replace(value, '"file_size":[0-9]+', '"file_size":"12"')
    WHEN 9 THEN regexp_replace(value, '"file_size":[0-9]+', '"file_size":"x"')
    WHEN 10 THEN regexp_replace(value, '"mime_type":"[^"]*",', '')
    WHEN 11 THEN regexp_replace(value, '"file_size":[0-9]+,', '')
    ELSE value END AS value
  FROM env),
parsed AS (
  SELECT kafka_partition, kafka_offset,
         json_extract_string(value, '$.filename') AS filename,
         json_extract_string(value, '$.file_hash') AS file_hash,
         json_extract_string(value, '$.mime_type') AS mime_type,
         json_extract_string(value, '$.timestamp') AS ts_text,
         json_extract_string(value, '$.image_data') AS image_data,
         regexp_replace(json_extract_string(value, '$.image_data'), '[^A-Za-z0-9+/=]', '', 'g') AS b64,
         json_exists(value, '$.file_size') AS has_fs,
         TRY_CAST(json_extract_string(value, '$.file_size') AS BIGINT) AS fs
  FROM faulty)"""
    return {
        "image_messages": w + "SELECT filename, filepath, file_size, file_hash, mime_type, timestamp, image_data FROM doc_msgs",
        "message_json_roundtrip": w + """
SELECT file_hash AS key, kafka_partition AS partition, kafka_offset AS offset,
       octet_length(encode(to_json({'filename': filename, 'filepath': filepath, 'file_size': file_size,
         'file_hash': file_hash, 'mime_type': mime_type, 'timestamp': timestamp, 'image_data': image_data})))::BIGINT
         AS payload_bytes,
       filename, filepath, file_size, file_hash, mime_type, timestamp,
       octet_length(from_base64(image_data))::BIGINT AS decoded_bytes
FROM doc_msgs""",
        "skip_already_ingested": w + """
SELECT filename, file_hash, file_size FROM doc_msgs m
WHERE NOT EXISTS (SELECT 1 FROM ingested i WHERE i.file_hash = m.file_hash)""",
        "metadata_first_wins": w + """
, firsts AS (
  SELECT * FROM doc_msgs
  QUALIFY row_number() OVER (PARTITION BY file_hash ORDER BY kafka_timestamp, kafka_partition, kafka_offset) = 1),
fresh AS (SELECT * FROM firsts f WHERE NOT EXISTS (SELECT 1 FROM ingested i WHERE i.file_hash = f.file_hash))
SELECT ((SELECT max(id) FROM ingested)
        + row_number() OVER (ORDER BY kafka_timestamp, kafka_partition, kafka_offset, file_hash))::BIGINT AS id,
       filename, file_hash, file_size, mime_type,
       'images/' || strftime(kafka_timestamp, '%Y/%m/%d') || '/' || filename AS s3_path,
       kafka_timestamp AS uploaded_at, filepath AS source_path, kafka_offset, kafka_partition,
       kafka_timestamp AS processed_at
FROM fresh""",
        "metadata_rejects": w + faulty + """
SELECT kafka_partition, kafka_offset, filename, reason FROM (
  SELECT *, CASE
    WHEN filename IS NULL THEN 'missing_filename'
    WHEN length(filename) > 255 THEN 'filename_too_long'
    WHEN file_hash IS NULL THEN 'missing_file_hash'
    WHEN length(file_hash) > 64 THEN 'file_hash_too_long'
    WHEN image_data IS NULL THEN 'missing_image_data'
    WHEN NOT (regexp_full_match(b64, '[A-Za-z0-9+/]*={0,2}') AND length(b64) % 4 = 0) THEN 'bad_image_data'
    WHEN length(coalesce(nullif(mime_type, ''), 'application/octet-stream')) > 50 THEN 'mime_type_too_long'
    WHEN has_fs AND fs IS NULL THEN 'bad_file_size'
    WHEN nullif(ts_text, '') IS NOT NULL AND TRY_CAST(ts_text AS TIMESTAMPTZ) IS NULL THEN 'bad_timestamp'
  END AS reason FROM parsed) WHERE reason IS NOT NULL""",
        "metadata_defaults": w + """
SELECT kafka_partition, kafka_offset,
       CASE WHEN doc_id % 13 = 10 THEN 'application/octet-stream' ELSE mime_type END AS mime_type,
       CASE WHEN doc_id % 13 = 8 THEN 12 ELSE file_size END AS file_size,
       CASE WHEN doc_id % 13 = 6 THEN kafka_timestamp - INTERVAL 2 HOUR ELSE kafka_timestamp END AS uploaded_at
FROM doc_msgs WHERE doc_id % 13 IN (5, 6, 8, 10, 11, 12)""",
        "object_keys_last_wins": w + """
, keyed AS (
  SELECT *, 'images/' || strftime(kafka_timestamp, '%Y/%m/%d') || '/' || filename AS object_key FROM doc_msgs)
SELECT object_key, file_hash, file_size, mime_type, n_writes FROM (
  SELECT *, row_number() OVER (PARTITION BY object_key
                               ORDER BY kafka_timestamp DESC, kafka_partition DESC, kafka_offset DESC) AS rn,
         count(*) OVER (PARTITION BY object_key) AS n_writes
  FROM keyed) WHERE rn = 1""",
        "fk_orphans": _with(DOCS) + """
SELECT event_id::BIGINT AS id, (event_id % 1000)::BIGINT AS image_id FROM events
WHERE (event_id % 1000) NOT IN (SELECT id FROM t1)""",
        "lake_load": w + """
SELECT id, filename, file_hash, file_size, NULL::INTEGER AS width, NULL::INTEGER AS height, mime_type, s3_path,
       uploaded_at, kafka_offset, kafka_partition, CAST(uploaded_at AS DATE) AS uploaded_day
FROM t1""",
    }


def _processed_queries() -> dict[str, str]:
    w = _with(EVENTS)
    append = """
SELECT msg_hash AS file_hash, filename, file_size, mime_type, TIMESTAMP '2024-03-01 00:00:00' AS processed_at,
       'image-uploads' AS kafka_topic, (user_id % 3)::INTEGER AS kafka_partition, event_id::BIGINT AS kafka_offset,
       ts AS kafka_timestamp
FROM ev WHERE bad NOT IN (0, 1, 2) AND msg_hash IS NOT NULL AND msg_hash <> ''"""
    cols = "file_hash, filename, file_size, mime_type, processed_at, kafka_topic, kafka_partition, kafka_offset"
    return {
        "processed_payload": w + """
SELECT (user_id % 3)::INTEGER AS kafka_partition, event_id::BIGINT AS kafka_offset,
       '2024-03-01T00:00:00+00:00' AS processed_at, filename, msg_hash AS file_hash, file_size, mime_type
FROM ev WHERE bad NOT IN (0, 1, 2)""",
        "processed_raw_passthrough": w + """
SELECT (user_id % 3)::INTEGER AS kafka_partition, event_id::BIGINT AS kafka_offset,
       '2024-03-01T00:00:00+00:00' AS processed_at,
       CASE bad WHEN 0 THEN '[1,2]' ELSE '"text"' END AS raw
FROM ev WHERE bad IN (0, 1)""",
        "processed_append": w + f", app AS ({append})\nSELECT {cols} FROM app",
        "processed_upsert": w + f""", app AS ({append})
SELECT {cols} FROM app
QUALIFY row_number() OVER (PARTITION BY file_hash ORDER BY kafka_timestamp, kafka_partition, kafka_offset) = 1""",
        "processed_row_count": w + f", app AS ({append})\nSELECT count(*) AS row_count FROM app",
        "processed_latest_rows": w + f""", app AS ({append})
SELECT processed_at, file_hash, filename, file_size, mime_type FROM app
ORDER BY processed_at DESC, kafka_partition DESC, kafka_offset DESC LIMIT 5""",
        "dedupe_by_offset": w + f", app AS ({append})\nSELECT {cols} FROM app",
        "dedupe_by_hash": w + f""", app AS ({append})
SELECT {cols} FROM app
QUALIFY row_number() OVER (PARTITION BY file_hash ORDER BY processed_at, kafka_partition, kafka_offset) = 1""",
    }


def _geo_queries() -> dict[str, str]:
    clon, clat = _scatter("c_custkey")
    cust = f"loc AS (SELECT c_custkey::BIGINT AS id, c_name AS name, {clon} AS lon, {clat} AS lat FROM customer)"
    boxes = """boxes(bname, xmin, ymin, xmax, ymax) AS (VALUES
  ('AFRICA', -20, -35, 52, 37), ('AMERICA', -170, -56, -34, 72), ('ASIA', 60, -10, 150, 70),
  ('EUROPE', -10, 35, 40, 70), ('MIDDLE EAST', 34, 12, 60, 42))"""
    # All pairs, kept when the spherical distance is within 510 km (the ellipsoid differs by
    # under 0.6 %), then the exact Vincenty distance decides.
    pairs_src = """src AS (
  SELECT a.id * 100000000 + b.id AS pid, a.name AS from_city, b.name AS to_city,
         a.lon AS lon1, a.lat AS lat1, b.lon AS lon2, b.lat AS lat2
  FROM loc a JOIN loc b ON a.id < b.id
  WHERE 2 * 6371008.8 * asin(least(1.0, sqrt(pow(sin(radians(b.lat - a.lat) / 2), 2)
        + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2)))) <= 510000)"""
    radius_src = """ctr AS (SELECT lon AS lon2, lat AS lat2 FROM loc WHERE name = 'Customer#000000001'),
src AS (SELECT l.id, l.name, l.lon AS lon1, l.lat AS lat1, c.lon2, c.lat2 FROM loc l, ctr c
        WHERE l.name <> 'Customer#000000001')"""
    near_src = """src AS (SELECT id, lon AS lon1, lat AS lat1, -74.0060::DOUBLE AS lon2, 40.7128::DOUBLE AS lat2
        FROM il WHERE lon IS NOT NULL)"""
    # Corners of each box in ring order; the geodesic edges are cut at most 500 m apart and summed as
    # spherical excesses on the authalic sphere.
    edge_src = """src AS (
  SELECT r_name || '/' || i AS eid, r_name AS region, xs[i] AS lon1, ys[i] AS lat1, xs[i + 1] AS lon2, ys[i + 1] AS lat2
  FROM (SELECT r_name, [xmin, xmax, xmax, xmin, xmin]::DOUBLE[] AS xs, [ymin, ymin, ymax, ymax, ymin]::DOUBLE[] AS ys,
               unnest([1, 2, 3, 4]) AS i
        FROM region JOIN boxes ON bname = r_name))"""
    cut_src = """steps AS (
  SELECT eid, region, src.lon1, src.lat1, src.lon2 AS end_lon, src.lat2 AS end_lat, az, dist_m,
         greatest(1, ceil(dist_m / 500))::BIGINT AS n
  FROM src JOIN vd USING (eid)),
cuts AS (SELECT *, dist_m * (k / n::DOUBLE) AS s FROM (SELECT *, unnest(range(0, n + 1)) AS k FROM steps))"""
    excess = f"""beta AS (
  SELECT region, eid, k, CASE WHEN k = n THEN end_lon ELSE lon2 END AS lon,
         tan(asin({_authalic_sine('CASE WHEN k = n THEN end_lat ELSE lat2 END')} / {_authalic_sine('90')}) / 2) AS t
  FROM cut_ends),
slices AS (
  SELECT region, t, lead(t) OVER e AS t2,
         radians(((lead(lon) OVER e - lon + 540.0::DOUBLE) % 360.0::DOUBLE) - 180.0::DOUBLE) AS dl
  FROM beta WINDOW e AS (PARTITION BY eid ORDER BY k))"""
    corner_src = f"""src AS (
  SELECT name, lon AS lon1, lat AS lat1, k AS vertex, 90 + (k % 32) * 11.25::DOUBLE AS az, 10000.0::DOUBLE AS s
  FROM (SELECT *, unnest(range(0, 33)) AS k FROM loc))"""
    snap_lon = "round_even(lon / 0.1::DOUBLE, 0) * 0.1::DOUBLE"
    snap_lat = "round_even(lat / 0.1::DOUBLE, 0) * 0.1::DOUBLE"
    return {
        "geo_points_text": _with(cust) + f"""
SELECT name, {_point_text('lon', 'lat')} AS coordinates, lon AS longitude, lat AS latitude FROM loc""",
        "geo_pair_distance": _with(cust, pairs_src, vincenty("src", "pid")) + """
SELECT from_city, to_city, round(dist_m / 1000, 2) AS distance_km
FROM vd JOIN src USING (pid) WHERE dist_m <= 500000 ORDER BY distance_km""",
        "geo_within_radius": _with(cust, radius_src, vincenty("src", "id")) + """
SELECT name, round(dist_m / 1000, 2) AS distance_km
FROM vd JOIN src USING (id) WHERE dist_m <= 5000000 ORDER BY distance_km""",
        "geo_points_in_region": _with(cust, boxes) + """
SELECT l.name, r.r_name AS region FROM loc l, region r JOIN boxes b ON b.bname = r.r_name
WHERE l.lon > b.xmin AND l.lon < b.xmax AND l.lat > b.ymin AND l.lat < b.ymax""",
        "geo_region_area": _with(cust, boxes, edge_src, vincenty("src", "eid"), cut_src,
                                 vincenty_direct("cuts", "cut_ends"), excess) + f"""
SELECT region AS name,
       round(abs(sum(2 * atan2(tan(dl / 2) * (t + t2), 1 + t * t2))) * {_A} * {_A} * {_authalic_sine('90')} / 2 / 1000000, 2)
         AS area_sq_km
FROM slices WHERE t2 IS NOT NULL GROUP BY region""",
        "geo_buffer": _with(cust, "src AS (SELECT name, lon AS lon1, lat AS lat1 FROM loc)",
                            projected_buffers("src", "circles", 10000.0)) + f"""
SELECT name, 'POLYGON((' || string_agg({_fmt('x6')} || ' ' || {_fmt('y6')}, ',' ORDER BY vertex) || '))' AS buffer_10km
FROM (SELECT *, CASE WHEN abs(lon2) < 5e-7 THEN 0e0 ELSE round(lon2, 6) END AS x6,
             CASE WHEN abs(lat2) < 5e-7 THEN 0e0 ELSE round(lat2, 6) END AS y6 FROM circles) GROUP BY name""",
        "geo_buffer_vertices": _with(cust, corner_src, vincenty_direct("src", "corners")) + """
SELECT name, vertex::INTEGER AS vertex, CASE WHEN abs(lon2) < 5e-7 THEN 0.0::DOUBLE ELSE round(lon2, 6) END AS longitude,
       CASE WHEN abs(lat2) < 5e-7 THEN 0.0::DOUBLE ELSE round(lat2, 6) END AS latitude
FROM corners""",
        "geo_images_near": _with(DOCS, IMAGE_LOCATIONS, near_src, vincenty("src", "id")) + f"""
SELECT t1.filename, il.altitude, {_point_text('il.lon', 'il.lat')} AS coordinates,
       round(vd.dist_m, 2) AS distance_meters
FROM t1 JOIN il ON t1.id = il.image_id JOIN vd ON vd.id = il.id
WHERE vd.dist_m <= 1000 ORDER BY distance_meters""",
        "geo_heatmap": _with(IMAGE_LOCATIONS) + f"""
SELECT CASE WHEN lon IS NULL OR lat IS NULL THEN NULL ELSE {_point_text(snap_lon, snap_lat)} END AS grid_cell,
       count(*) AS image_count
FROM il GROUP BY 1 ORDER BY image_count DESC""",
    }


def stored_queries() -> dict[str, str]:
    w = _with(LAKE)
    cutoff = "TIMESTAMP '2024-02-01 00:00:00'"
    return {
        "lake_stored_dml": w + f"SELECT {_LAKE_COLS} FROM cur",
        "lake_generations": w + f"SELECT {_LAKE_COLS} FROM cur",
        "lake_generation_days": w + """
, upto AS (SELECT * FROM log WHERE committed_at <= TIMESTAMP '2024-02-03 00:00:00'),
kept AS (
  SELECT uploaded_day FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY commit_id DESC, (op IN ('append','update')) DESC) AS rn
    FROM upto) WHERE rn = 1 AND op IN ('append','update')
  UNION ALL SELECT uploaded_day FROM log WHERE committed_at > TIMESTAMP '2024-02-03 00:00:00'),
n AS (SELECT uploaded_day, count(*) AS n FROM kept GROUP BY uploaded_day)
SELECT l.uploaded_day, count(*) AS rows_before,
       CASE WHEN bool_or(op <> 'append') THEN coalesce(any_value(n.n), 0) ELSE count(*) END AS rows_after,
       bool_or(op <> 'append') AS rewritten
FROM log l LEFT JOIN n ON l.uploaded_day IS NOT DISTINCT FROM n.uploaded_day GROUP BY l.uploaded_day""",
        "lake_file_bounds": w + """
SELECT uploaded_day, count(*) AS row_count, (count(*) - count(width))::BIGINT AS null_widths, min(id) AS id_low, max(id) AS id_high,
       min(file_size) AS file_size_low, max(file_size) AS file_size_high, min(filename) AS filename_low,
       max(filename) AS filename_high, min(uploaded_at) AS uploaded_at_low, max(uploaded_at) AS uploaded_at_high
FROM log GROUP BY uploaded_day""",
        "lake_stored_upkeep": w + f"""
, old AS (SELECT * FROM log WHERE committed_at <= {cutoff}),
late AS (SELECT commit_id FROM log WHERE committed_at > {cutoff})
SELECT (SELECT count(*) FROM log) AS rows_before,
       (SELECT count(DISTINCT id) FROM old WHERE op = 'append') + (SELECT count(*) FROM late) AS rows_after,
       (SELECT count(DISTINCT commit_id) FROM log) AS commits_before,
       1 + (SELECT count(DISTINCT commit_id) FROM late) AS commits_after, true AS fewer_files""",
    }


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for part in (_lake_queries(), _ingest_queries(), _processed_queries(), _geo_queries()):
        out.update(part)
    return out
