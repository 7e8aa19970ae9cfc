"""Explicit schemas for every message and table the jobs read or write."""

from __future__ import annotations

from pyspark.sql import types as T

POINT = T.StructType([
    T.StructField("lon", T.DoubleType()),
    T.StructField("lat", T.DoubleType()),
])
RING = T.ArrayType(POINT)

# Folder of image files, as the binaryFile source returns it.
IMAGE_FILE = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()),
    T.StructField("content", T.BinaryType()),
])

# M1: the image message (JSON value on the input topic).
IMAGE_MESSAGE = T.StructType([
    T.StructField("filename", T.StringType()),
    T.StructField("filepath", T.StringType()),
    T.StructField("file_size", T.LongType()),
    T.StructField("file_hash", T.StringType()),
    T.StructField("mime_type", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("image_data", T.StringType()),
])
IMAGE_MESSAGE_FIELDS = [f.name for f in IMAGE_MESSAGE.fields]

# Topic record envelope (same columns as Spark's Kafka source, value as text for file-backed topics).
ENVELOPE = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampNTZType()),
])

# M2: processed payload.
PROCESSED_MESSAGE = T.StructType([
    T.StructField("processed_at", T.StringType()),
    T.StructField("filename", T.StringType()),
    T.StructField("file_hash", T.StringType()),
    T.StructField("file_size", T.LongType()),
    T.StructField("mime_type", T.StringType()),
])

# T1 image_metadata.
IMAGE_METADATA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("filename", T.StringType(), False),
    T.StructField("file_hash", T.StringType(), False),
    T.StructField("file_size", T.LongType(), False),
    T.StructField("mime_type", T.StringType()),
    T.StructField("s3_path", T.StringType(), False),
    T.StructField("uploaded_at", T.TimestampNTZType()),
    T.StructField("source_path", T.StringType()),
    T.StructField("kafka_offset", T.LongType()),
    T.StructField("kafka_partition", T.IntegerType()),
    T.StructField("processed_at", T.TimestampNTZType()),
])
IMAGE_METADATA_FIELDS = [f.name for f in IMAGE_METADATA.fields]

# Column length limits of the relational tables.
T1_LIMITS = {"filename": 255, "file_hash": 64, "mime_type": 50, "s3_path": 500}
T2_LIMITS = {"file_hash": 64, "filename": 255, "mime_type": 100}

# T2/T3 image_uploads_processed (processed_at is an instant, kept in UTC).
PROCESSED_ROW = T.StructType([
    T.StructField("file_hash", T.StringType(), False),
    T.StructField("filename", T.StringType()),
    T.StructField("file_size", T.LongType()),
    T.StructField("mime_type", T.StringType()),
    T.StructField("processed_at", T.TimestampNTZType()),
    T.StructField("kafka_topic", T.StringType()),
    T.StructField("kafka_partition", T.IntegerType()),
    T.StructField("kafka_offset", T.LongType()),
])
PROCESSED_FIELDS = [f.name for f in PROCESSED_ROW.fields]

# T4 lake images table, plus the change-log columns of our versioned layout.
LAKE_IMAGE = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("filename", T.StringType()),
    T.StructField("file_hash", T.StringType()),
    T.StructField("file_size", T.LongType()),
    T.StructField("width", T.IntegerType()),
    T.StructField("height", T.IntegerType()),
    T.StructField("mime_type", T.StringType()),
    T.StructField("s3_path", T.StringType()),
    T.StructField("uploaded_at", T.TimestampNTZType()),
    T.StructField("kafka_offset", T.LongType()),
    T.StructField("kafka_partition", T.IntegerType()),
])
LAKE_FIELDS = [f.name for f in LAKE_IMAGE.fields]
PARTITION_COLUMN = "uploaded_day"
CHANGE_FIELDS = ["commit_id", "committed_at", "op"]
LAKE_LOG_FIELDS = LAKE_FIELDS + [PARTITION_COLUMN] + CHANGE_FIELDS

# Spatial tables.
LOCATION = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("location", POINT),
    T.StructField("created_at", T.TimestampNTZType()),
])
REGION = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("boundary", RING),
])
IMAGE_LOCATION = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("image_id", T.LongType()),
    T.StructField("location", POINT),
    T.StructField("altitude", T.DoubleType()),
    T.StructField("direction", T.DoubleType()),
    T.StructField("captured_at", T.TimestampNTZType()),
])

DEAD_LETTER = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("reason", T.StringType()),
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
])
