"""Registered query plans: each takes (spark, sf_dir) and returns a DataFrame over the driver tables.

Computed columns carry the same names as the SQL oracle in ``plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakelens.config import SNAPSHOT_RETENTION_DAYS
from lakelens.functions import binary, geo, projection
from lakelens.operators import changelog, ingest, metadata, processed, spatial
from lakelens.operators.frames import deal
from lakelens.schemas import LAKE_FIELDS, LAKE_LOG_FIELDS, PARTITION_COLUMN
from lakelens.session import pin_utc
from lakelens.sources import fixtures as fx
from lakelens.sources.tables import read_table

# Fixed values of the query parameters.
AS_OF_PROBES = ["2024-01-10 00:00:00", "2024-02-01 12:00:00", "2024-03-01 00:00:00"]
RANGE_DAY = ("2024-01-11", "2024-01-12")
RETENTION_AS_OF = "2024-02-05"
EXPIRE_NOW = "2024-02-08 00:00:00"
RADIUS_CENTER_NAME = "Customer#000000001"
RADIUS_M = 5_000_000.0
PAIR_RADIUS_M = 500_000.0
NEAR_RADIUS_M = 1_000.0
GRID_SIZE = 0.1
BUFFER_M = 10_000.0
LATEST_ROWS = 5
REDELIVERED_EVERY = (10, 3)  # offsets with offset % 10 = 3 arrive twice, one commit interval later


def _clock() -> F.Column:
    return F.lit(fx.PROCESSED_CLOCK).cast("timestamp_ntz")


# ---------------------------------------------------------------- lake (change log)

def daily_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    return changelog.daily_volume(changelog.current_state(fx.lake_change_log(spark, sf_dir),
                                                          fields=["uploaded_at", "file_size"]))


def lake_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    current = changelog.current_state(fx.lake_change_log(spark, sf_dir), fields=[])
    return current.agg(F.count(F.lit(1)).alias("row_count"))


def lake_latest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = ["uploaded_at", "file_hash", "filename", "file_size", "mime_type"]
    current = changelog.current_state(fx.lake_change_log(spark, sf_dir), fields=latest)
    return (current.orderBy(F.desc("uploaded_at"), F.desc("id")).limit(LATEST_ROWS)
            .select("uploaded_at", "file_hash", "filename", "file_size", "mime_type"))


def lake_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = fx.lake_change_log(spark, sf_dir)
    return changelog.as_of_many(log, AS_OF_PROBES, fields=LAKE_FIELDS).select("as_of_ts", *LAKE_FIELDS)


def lake_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog.snapshots(fx.lake_change_log(spark, sf_dir))


def lake_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Data files of ``orders`` by base name, with record counts and bounds of the order date."""
    files = changelog.file_listing(read_table(spark, sf_dir, "orders"), "o_orderdate")
    return files.select(F.element_at(F.split("file_path", "/"), -1).alias("file_name"), "record_count",
                        "lower_bound", "upper_bound")


def daily_volume_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order of the daily volumes, newest day first, as a rank (one row per day)."""
    newest = Window.orderBy(F.desc("upload_date"))
    return daily_volume(spark, sf_dir).select(F.row_number().over(newest).cast("long").alias("rank"), "upload_date", "image_count")


def lake_limit_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``SELECT * ... LIMIT 10`` without an order: any ten rows, so their number."""
    current = changelog.current_state(fx.lake_change_log(spark, sf_dir), fields=["filename"])
    return current.limit(10).agg(F.count(F.lit(1)).alias("row_count"))


def lake_partition_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = changelog.day_range(fx.lake_change_log(spark, sf_dir), *RANGE_DAY, fields=LAKE_FIELDS)
    return rows.select(*LAKE_FIELDS)


def _base_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = fx.lake_change_log(spark, sf_dir)
    return log.where(F.col("commit_id") < fx.UPDATE_COMMIT[0])


def lake_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = changelog.update_rows(_base_log(spark, sf_dir), F.col("mime_type") == "image/jpg",
                                 {"mime_type": F.lit("image/jpeg")}, *fx.UPDATE_COMMIT)
    return rows.select(*LAKE_LOG_FIELDS)


def lake_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = fx.lake_change_log(spark, sf_dir).where(F.col("commit_id") <= fx.UPDATE_COMMIT[0])
    before = F.lit(fx.DELETE_BEFORE).cast("date")
    rows = changelog.delete_rows(log, F.col("uploaded_at") < before, *fx.DELETE_COMMIT,
                                 days=F.col(PARTITION_COLUMN) < before)
    return rows.select(*LAKE_LOG_FIELDS)


def retention_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.retention_delete(fx.lake_images(spark, sf_dir), RETENTION_AS_OF).select(*LAKE_FIELDS)


def lake_expire(spark: SparkSession, sf_dir: str) -> DataFrame:
    cutoff = (datetime.fromisoformat(EXPIRE_NOW) - timedelta(days=SNAPSHOT_RETENTION_DAYS)).isoformat(" ")
    return changelog.expire(fx.lake_change_log(spark, sf_dir), cutoff).select(*LAKE_LOG_FIELDS)


def lake_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog.compact(fx.lake_change_log(spark, sf_dir)).select(*LAKE_LOG_FIELDS)


def lake_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """INSERT INTO images SELECT ... FROM image_metadata, with NULL width/height and the day partition."""
    t1 = fx.image_metadata(spark, sf_dir)
    rows = t1.select("id", "filename", "file_hash", "file_size",
                     F.lit(None).cast("int").alias("width"), F.lit(None).cast("int").alias("height"),
                     "mime_type", "s3_path", "uploaded_at", "kafka_offset", "kafka_partition")
    return changelog.with_partition(rows).select(*LAKE_FIELDS, PARTITION_COLUMN)


# ---------------------------------------------------------------- ingest and metadata

def image_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    msgs = fx.document_messages(spark, sf_dir)
    return msgs.select("filename", "filepath", "file_size", "file_hash", "mime_type", "timestamp", "image_data")


def message_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    env = fx.document_envelopes(spark, sf_dir)
    sendable, _ = ingest.split_by_size(env)
    parsed = ingest.parse_messages(sendable)
    return parsed.select(
        "key", "partition", "offset", "payload_bytes", "filename", "filepath", "file_size", "file_hash",
        "mime_type", F.col("msg_timestamp").alias("timestamp"),
        binary.decoded_length(F.col("image_data")).alias("decoded_bytes"))


def skip_already_ingested(spark: SparkSession, sf_dir: str) -> DataFrame:
    candidates = ingest.hash_files(fx.document_image_files(spark, sf_dir))
    return ingest.skip_already_ingested(candidates, fx.ingested_hashes(spark, sf_dir)).select(
        "filename", "file_hash", "file_size")


def metadata_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    msgs = fx.document_messages(spark, sf_dir)
    rows = metadata.metadata_rows(msgs, processed_at=F.col("kafka_timestamp"))
    added = metadata.insert_first_wins(rows, fx.ingested_hashes(spark, sf_dir))
    return added.select(*metadata.T1_COLUMNS)


# The malformed-field overlay by doc_id % 13 (regex on the JSON text, replacement).
FAULTS = {
    0: (r'"filename":"[^"]*",', ""),                                    # filename missing
    1: (r'"filename":"[^"]*"', '"filename":"' + "f" * 252 + '.jpg"'),   # 256-character filename
    2: (r'"file_hash":"([0-9a-f]*)"', '"file_hash":"$1a"'),             # 65-character hash
    3: (r'"mime_type":"[^"]*"', '"mime_type":"' + "m" * 51 + '"'),      # 51-character MIME type
    4: (r'"timestamp":"[^"]*"', '"timestamp":"yesterday"'),             # bad timestamp
    6: (r'"timestamp":"([^"]*)"', '"timestamp":"$1+02:00"'),            # timestamp with offset
    7: (r'"image_data":"([^"]*)"', '"image_data":"$1A"'),               # undecodable base64
    8: (r'"file_size":\d+', '"file_size":"12"'),                       # size as numeric text
    9: (r'"file_size":\d+', '"file_size":"x"'),                        # size as other text
    10: (r'"mime_type":"[^"]*",', ""),                                  # MIME type missing
    11: (r'"file_size":\d+,', ""),                                     # size missing
}


def _faulty_document_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document envelopes with malformed fields by doc_id % 13 (doc_id = offset * 3 + partition)."""
    env = fx.document_envelopes(spark, sf_dir)
    m = (F.col("offset") * 3 + F.col("partition")) % 13
    pattern, replacement = F.lit("^$"), F.lit("")
    for k in sorted(FAULTS, reverse=True):
        pattern = F.when(m == k, F.lit(FAULTS[k][0])).otherwise(pattern)
        replacement = F.when(m == k, F.lit(FAULTS[k][1])).otherwise(replacement)
    # "^$" never matches a JSON object, so unlisted residues keep their value.
    return env.withColumn("value", F.regexp_replace(F.col("value"), pattern, replacement))


def metadata_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = ingest.parse_messages(_faulty_document_envelopes(spark, sf_dir))
    checked = metadata.validate_messages(parsed, strict=False, now=F.col("timestamp"))
    return checked.where(F.col("reason").isNotNull()).select(
        F.col("partition").alias("kafka_partition"), F.col("offset").alias("kafka_offset"), "filename", "reason")


def metadata_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted messages with the batch consumer's defaults for missing fields."""
    parsed = ingest.parse_messages(_faulty_document_envelopes(spark, sf_dir))
    checked = metadata.validate_messages(parsed, strict=False, now=F.col("timestamp"))
    return checked.where(F.col("reason").isNull()).select(
        F.col("partition").alias("kafka_partition"), F.col("offset").alias("kafka_offset"), "mime_type", "file_size", "uploaded_at")


def object_keys_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    msgs = fx.document_messages(spark, sf_dir).select(
        "filename", "file_hash", "file_size", "mime_type", *metadata.ARRIVAL_ORDER)
    objects = metadata.object_writes(msgs, F.col("kafka_timestamp"))
    return objects.select("object_key", "file_hash", "file_size", "mime_type", "n_writes")


def fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    orphans = metadata.fk_orphans(fx.image_locations(spark, sf_dir), fx.image_metadata(spark, sf_dir), "image_id")
    return orphans.select("id", "image_id")


# ---------------------------------------------------------------- processed stream

def _transformed(spark: SparkSession, sf_dir: str, fields: tuple[str, ...] = processed.FOR_ROWS) -> DataFrame:
    pin_utc(spark)
    return processed.transform(fx.event_envelopes(spark, sf_dir), clock=_clock(), fields=fields)


def processed_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    return processed.payloads(_transformed(spark, sf_dir, processed.FOR_PAYLOADS))


def processed_raw_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    return processed.raw_passthrough(_transformed(spark, sf_dir, processed.FOR_RAW))


def processed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = processed.processed_rows(_transformed(spark, sf_dir), keep_arrival=True)
    return processed.upsert_rows(rows)


def processed_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    return processed.processed_rows(_transformed(spark, sf_dir))


def processed_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``SELECT COUNT(*)`` on the processed lake table."""
    return processed.processed_rows(_transformed(spark, sf_dir)).agg(F.count(F.lit(1)).alias("row_count"))


def processed_latest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest rows of the processed lake table (top-k, unique tie-breaker on the topic position)."""
    rows = processed.processed_rows(_transformed(spark, sf_dir))
    return (rows.orderBy(F.desc("processed_at"), F.desc("kafka_partition"), F.desc("kafka_offset"))
            .limit(LATEST_ROWS).select("processed_at", "file_hash", "filename", "file_size", "mime_type"))


def _redelivered_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = processed.processed_rows(_transformed(spark, sf_dir))
    every, hit = REDELIVERED_EVERY
    again = (rows.where(F.col("kafka_offset") % every == hit)
             .withColumn("processed_at", F.col("processed_at") + F.expr("INTERVAL 5 SECONDS")))
    return rows.unionByName(again)


def dedupe_by_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return processed.dedupe_by_offset(_redelivered_log(spark, sf_dir))


def dedupe_by_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return processed.dedupe_by_hash(_redelivered_log(spark, sf_dir))


# ---------------------------------------------------------------- geo

def geo_points_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    loc = fx.customer_locations(spark, sf_dir)
    return loc.select("name", geo.point_text(F.col("location")).alias("coordinates"),
                      geo.st_x(F.col("location")).alias("longitude"), geo.st_y(F.col("location")).alias("latitude"))


def geo_pair_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    pts = fx.customer_locations(spark, sf_dir)
    return spatial.pairs_within(pts, "id", "location", PAIR_RADIUS_M, distance_col="distance_km", carry=("name",), km_decimals=2,
                                columns={"l_name": "from_city", "r_name": "to_city", "distance_km": "distance_km"})


def geo_within_radius(spark: SparkSession, sf_dir: str) -> DataFrame:
    loc = fx.customer_locations(spark, sf_dir)
    center = loc.where(F.col("name") == RADIUS_CENTER_NAME).select("location").scalar()
    near = spatial.within_radius(loc.where(F.col("name") != RADIUS_CENTER_NAME), "location", center, RADIUS_M)
    return near.select("name", F.round(F.col("distance_m") / 1000, 2).alias("distance_km")).orderBy("distance_km")


def geo_points_in_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = spatial.points_in_polygons(fx.customer_locations(spark, sf_dir), "location",
                                        fx.region_polygons(spark, sf_dir).withColumnRenamed("name", "region")
                                        .withColumnRenamed("id", "region_id"), "boundary")
    return joined.select("name", "region")


def geo_region_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    regions = fx.region_polygons(spark, sf_dir)
    return regions.select("name", F.round(geo.geodesic_area_m2(F.col("boundary")) / 1_000_000, 2).alias("area_sq_km"))


def geo_images_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    center = geo.set_srid(geo.make_point(*fx.NEW_YORK), 4326)
    near = spatial.within_radius(fx.image_locations(spark, sf_dir), "location", center, NEAR_RADIUS_M)
    meta = fx.image_metadata(spark, sf_dir).select("id", "filename")
    joined = meta.join(near, meta["id"] == near["image_id"])
    return joined.select("filename", "altitude", geo.point_text(F.col("location")).alias("coordinates"),
                         F.round(F.col("distance_m"), 2).alias("distance_meters")).orderBy("distance_meters")


def geo_heatmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.heatmap(fx.image_locations(spark, sf_dir), "location", GRID_SIZE)


def _micro(value: Column) -> Column:
    """A coordinate to six decimals (about 0.1 m), no negative zero."""
    return F.when(F.abs(value) < 5e-7, 0.0).otherwise(F.round(value, 6))


def geo_buffer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text of the 10 km buffers, drawn in each point's plane, coordinates to six decimals."""
    pts = deal(fx.customer_locations(spark, sf_dir))
    ring = F.transform(projection.projected_buffer(F.col("location"), BUFFER_M), lambda v: F.struct(
        _micro(v.getField("lon")).alias("lon"), _micro(v.getField("lat")).alias("lat")))
    return pts.select("name", geo.polygon_text(ring).alias("buffer_10km"))


def geo_buffer_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rings at 10 km along geodesics vertex by vertex, coordinates to six decimals (about 0.1 m)."""
    pts = fx.customer_locations(spark, sf_dir)
    ring = pts.select("name", F.posexplode(geo.geodesic_buffer(F.col("location"), BUFFER_M)).alias("vertex", "point"))

    def coordinate(axis: str) -> Column:
        return _micro(F.col("point").getField(axis))
    return ring.select("name", "vertex", coordinate("lon").alias("longitude"), coordinate("lat").alias("latitude"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "daily_volume": daily_volume,
    "lake_row_count": lake_row_count,
    "lake_latest_rows": lake_latest_rows,
    "lake_as_of": lake_as_of,
    "lake_snapshots": lake_snapshots,
    "lake_files": lake_files,
    "daily_volume_ranked": daily_volume_ranked,
    "lake_limit_count": lake_limit_count,
    "lake_partition_range": lake_partition_range,
    "lake_update": lake_update,
    "lake_delete": lake_delete,
    "retention_delete": retention_delete,
    "lake_expire": lake_expire,
    "lake_compact": lake_compact,
    "lake_load": lake_load,
    "image_messages": image_messages,
    "message_json_roundtrip": message_json_roundtrip,
    "skip_already_ingested": skip_already_ingested,
    "metadata_first_wins": metadata_first_wins,
    "metadata_rejects": metadata_rejects,
    "metadata_defaults": metadata_defaults,
    "object_keys_last_wins": object_keys_last_wins,
    "fk_orphans": fk_orphans,
    "processed_payload": processed_payload,
    "processed_raw_passthrough": processed_raw_passthrough,
    "processed_upsert": processed_upsert,
    "processed_append": processed_append,
    "processed_row_count": processed_row_count,
    "processed_latest_rows": processed_latest_rows,
    "dedupe_by_offset": dedupe_by_offset,
    "dedupe_by_hash": dedupe_by_hash,
    "geo_points_text": geo_points_text,
    "geo_pair_distance": geo_pair_distance,
    "geo_within_radius": geo_within_radius,
    "geo_points_in_region": geo_points_in_region,
    "geo_region_area": geo_region_area,
    "geo_images_near": geo_images_near,
    "geo_heatmap": geo_heatmap,
    "geo_buffer": geo_buffer,
    "geo_buffer_vertices": geo_buffer_vertices,
}
