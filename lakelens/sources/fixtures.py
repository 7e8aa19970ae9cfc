"""Stand-ins: the driver tables mapped onto the pipeline's data model (see FIXTURES.md section 4).

Every frame here is derived by Spark from the given tables, so its size grows with them.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakelens.functions import geo, paths, timefmt
from lakelens.functions.jsonval import to_json_text
from lakelens.operators import changelog, ingest
from lakelens.operators.frames import spread
from lakelens.sources.tables import read_table as _read_table


def read_table(spark: SparkSession, sf_dir: str, name: str, rebalance: bool = True) -> DataFrame:
    """Driver table; tables with per-row work are rebalanced when they scan as fewer tasks than cores."""
    df = _read_table(spark, sf_dir, name)
    return spread(df) if rebalance else df

# Fixed values of the stand-in mappings.
FIXTURE_EPOCH = "2024-01-01 00:00:00"
WATCH_DIR = "/data/incoming"
INPUT_TOPIC = "image-uploads"
DOC_EXTENSIONS = [".jpg", ".jpeg", ".png", ".gif", ".bmp", ".tiff", ".webp", ".JPG", ".txt"]  # by doc_id % 9
EVENT_MIME = {"click": "image/jpg", "view": "image/jpeg", "purchase": "image/png", "signup": "image/gif"}
MALFORMED_VALUES = ["[1,2]", '"text"', "not json"]  # event_id % 97 = 0, 1, 2
REGION_BOXES = {  # name: (lon_min, lat_min, lon_max, lat_max)
    "AFRICA": (-20, -35, 52, 37),
    "AMERICA": (-170, -56, -34, 72),
    "ASIA": (60, -10, 150, 70),
    "EUROPE": (-10, 35, 40, 70),
    "MIDDLE EAST": (34, 12, 60, 42),
}
NEW_YORK = (-74.0060, 40.7128)
UPDATE_COMMIT = (101, "2024-02-01 12:00:00")   # mime image/jpg -> image/jpeg
DELETE_COMMIT = (102, "2024-02-02 00:00:00")   # uploaded_at < 2024-01-05
DELETE_BEFORE = "2024-01-05"
PROCESSED_CLOCK = "2024-03-01 00:00:00"        # fixed processing clock (UTC)


def _epoch_plus_minutes(col: str) -> F.Column:
    return F.expr(f"timestampadd(MINUTE, {col}, TIMESTAMP_NTZ '{FIXTURE_EPOCH}')")


# ---------------------------------------------------------------- A: documents -> image files

def document_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a file (binaryFile columns plus doc_id); ``.txt`` ones are not images."""
    docs = read_table(spark, sf_dir, "documents")
    ext = F.element_at(F.array(*[F.lit(e) for e in DOC_EXTENSIONS]), (F.col("doc_id") % 9 + 1).cast("int"))
    name = F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), ext)
    return docs.select(
        F.concat(F.lit(f"file:{WATCH_DIR}/"), name).alias("path"),
        _epoch_plus_minutes("doc_id").alias("modificationTime"),
        F.octet_length("text").cast("long").alias("length"),
        F.encode("text", "UTF-8").alias("content"),
        "doc_id",
    )


def document_image_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = document_files(spark, sf_dir)
    return files.where(paths.is_image_name(paths.file_name(F.col("path"))))


def document_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1 messages of the image documents with their topic position.

    partition = doc_id % 3, offset = doc_id div 3, message time = epoch + doc_id minutes.
    """
    files = document_image_files(spark, sf_dir)
    msgs = ingest.build_messages(files, clock=F.col("modificationTime"), keep=("doc_id", "modificationTime"))
    return (msgs
            .withColumn("kafka_partition", (F.col("doc_id") % 3).cast("int"))
            .withColumn("kafka_offset", F.expr("doc_id div 3").cast("long"))
            .withColumnRenamed("modificationTime", "kafka_timestamp"))


def document_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    msgs = document_messages(spark, sf_dir)
    return ingest.to_envelopes(msgs, INPUT_TOPIC, partition=F.col("kafka_partition"),
                               offset=F.col("kafka_offset"), timestamp=F.col("kafka_timestamp"))


def ingested_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B: the metadata table already holds the labelled documents (id = doc_id)."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels", rebalance=False).select("doc_id")
    return docs.join(labels, "doc_id", "left_semi").select(
        F.col("doc_id").alias("id"), F.sha2(F.col("text"), 256).alias("file_hash"))


def image_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 as the stream would have filled it from the image documents: first message per hash, id = doc_id."""
    from lakelens.operators import metadata
    msgs = document_messages(spark, sf_dir)
    rows = metadata.metadata_rows(msgs, processed_at=F.col("kafka_timestamp"))
    first = metadata.first_wins(rows, "file_hash", ["kafka_timestamp", "kafka_partition", "kafka_offset"])
    return first.withColumn("id", F.col("doc_id").cast("long")).select(*metadata.T1_COLUMNS)


# ---------------------------------------------------------------- C: events -> messages

def _event_hash() -> F.Column:
    m = F.col("event_id") % 50
    return F.when(m == 0, F.lit("")).when(m == 1, F.lit(None).cast("string")).otherwise(F.sha2("props", 256))


def _event_mime() -> F.Column:
    mapping = F.create_map(*[F.lit(x) for x in chain.from_iterable(EVENT_MIME.items())])
    return mapping[F.col("event_type")]


def _event_filename() -> F.Column:
    return F.concat(F.col("event_type"), F.lit("_"), F.col("event_id").cast("string"), F.lit(".jpg"))


def event_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic records from events; some values are replaced by malformed JSON."""
    ev = read_table(spark, sf_dir, "events")
    name = _event_filename()
    payload = to_json_text(F.struct(
        name.alias("filename"),
        F.concat(F.lit(WATCH_DIR + "/"), name).alias("filepath"),
        F.round(F.col("value") * 100).cast("long").alias("file_size"),
        _event_hash().alias("file_hash"),
        _event_mime().alias("mime_type"),
        timefmt.iso_naive(F.col("ts")).alias("timestamp"),
    ))
    bad = F.col("event_id") % 97
    value = (F.when(bad == 0, F.lit(MALFORMED_VALUES[0])).when(bad == 1, F.lit(MALFORMED_VALUES[1]))
             .when(bad == 2, F.lit(MALFORMED_VALUES[2])).otherwise(payload))
    return ev.select(
        _event_hash().alias("key"),
        value.alias("value"),
        F.lit(INPUT_TOPIC).alias("topic"),
        (F.col("user_id") % 3).cast("int").alias("partition"),
        F.col("event_id").cast("long").alias("offset"),
        F.col("ts").cast("timestamp_ntz").alias("timestamp"),
    )


# ---------------------------------------------------------------- F: events -> lake images and change log

def lake_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4 rows: one image per event, uploaded at the event time."""
    ev = read_table(spark, sf_dir, "events")
    name = _event_filename()
    return ev.select(
        F.col("event_id").cast("long").alias("id"),
        name.alias("filename"),
        F.sha2("props", 256).alias("file_hash"),
        F.round(F.col("value") * 100).cast("long").alias("file_size"),
        F.lit(None).cast("int").alias("width"),
        F.lit(None).cast("int").alias("height"),
        _event_mime().alias("mime_type"),
        paths.object_key(F.col("ts"), name).alias("s3_path"),
        F.col("ts").cast("timestamp_ntz").alias("uploaded_at"),
        F.col("event_id").cast("long").alias("kafka_offset"),
        (F.col("user_id") % 3).cast("int").alias("kafka_partition"),
    )


def _base_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    images = changelog.with_partition(lake_images(spark, sf_dir))
    day = F.col(changelog.PARTITION)
    return images.select(
        "*",
        (F.datediff(day, F.lit("2024-01-01").cast("date")) + 1).cast("long").alias("commit_id"),
        F.date_add(day, 1).cast("timestamp_ntz").alias("committed_at"),
        F.lit(changelog.APPEND).alias("op"),
    )


def _stamp(rows: DataFrame, commit: tuple[int, str], op: str) -> DataFrame:
    return (rows.withColumn("commit_id", F.lit(commit[0]).cast("long"))
            .withColumn("committed_at", F.lit(commit[1]).cast("timestamp_ntz"))
            .withColumn("op", F.lit(op)))


def lake_change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored change log: one append commit per calendar day, an update (101) and a delete (102).

    Written out directly (no shuffle): the update rewrites the rows whose MIME type was
    ``image/jpg``, the delete tombstones the rows older than the cutoff as they stood after
    the update.  ``lake_change_log_via_operators`` builds the same rows with the UPDATE and
    DELETE operators; a test keeps the two equal.
    """
    base = _base_commits(spark, sf_dir)
    jpg = F.col("mime_type") == "image/jpg"
    updated = _stamp(base.where(jpg).withColumn("mime_type", F.lit("image/jpeg")), UPDATE_COMMIT, changelog.UPDATE)
    after = base.withColumn("mime_type", F.when(jpg, F.lit("image/jpeg")).otherwise(F.col("mime_type")))
    deleted = _stamp(after.where(F.col("uploaded_at") < F.lit(DELETE_BEFORE).cast("date")), DELETE_COMMIT,
                     changelog.DELETE)
    return base.unionByName(updated).unionByName(deleted)


def lake_change_log_via_operators(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _base_commits(spark, sf_dir)
    updated = changelog.update_rows(base, F.col("mime_type") == "image/jpg", {"mime_type": F.lit("image/jpeg")},
                                    *UPDATE_COMMIT)
    log = base.unionByName(updated)
    deleted = changelog.delete_rows(log, F.col("uploaded_at") < F.lit(DELETE_BEFORE).cast("date"), *DELETE_COMMIT)
    return log.unionByName(deleted)


# ---------------------------------------------------------------- D, E: points and regions

def _scatter_point(key: F.Column) -> F.Column:
    lon = (key * 7919 % 36000).cast("double") / 100.0 - 180.0
    lat = (key * 104729 % 17000).cast("double") / 100.0 - 85.0
    return geo.make_point(lon, lat)


def customer_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").cast("long").alias("id"), F.col("c_name").alias("name"),
                    _scatter_point(F.col("c_custkey").cast("long")).alias("location"))


def nation_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read_table(spark, sf_dir, "nation", rebalance=False)
    return n.select(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("name"),
                    _scatter_point(F.col("n_nationkey").cast("long") + 1).alias("location"))


def _box_wkt(box) -> str:
    x1, y1, x2, y2 = box
    return f"LINESTRING({x1} {y1}, {x2} {y1}, {x2} {y2}, {x1} {y2}, {x1} {y1})"


def region_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions with a box boundary built from WKT text (ST_MakePolygon(ST_GeomFromText(...)))."""
    r = read_table(spark, sf_dir, "region", rebalance=False)
    wkt = F.create_map(*[F.lit(x) for x in chain.from_iterable((k, _box_wkt(v)) for k, v in REGION_BOXES.items())])
    return r.select(
        F.col("r_regionkey").cast("long").alias("id"),
        F.col("r_name").alias("name"),
        geo.set_srid(geo.make_polygon(geo.line_from_text(wkt[F.col("r_name")])), 4326).alias("boundary"),
    ).where(F.col("boundary").isNotNull())


def image_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G3 rows from events: scattered around New York, no location when event_id % 199 = 0."""
    ev = read_table(spark, sf_dir, "events")
    lon = F.lit(NEW_YORK[0]) + ((F.col("event_id") * 7) % 401 - 200).cast("double") / 10000.0
    lat = F.lit(NEW_YORK[1]) + ((F.col("event_id") * 11) % 401 - 200).cast("double") / 10000.0
    point = F.when(F.col("event_id") % 199 != 0, geo.make_point(lon, lat))
    return ev.select(
        F.col("event_id").cast("long").alias("id"),
        (F.col("event_id") % 1000).cast("long").alias("image_id"),
        point.alias("location"),
        F.col("value").alias("altitude"),
        F.lit(None).cast("double").alias("direction"),
        F.col("ts").cast("timestamp_ntz").alias("captured_at"),
    )
