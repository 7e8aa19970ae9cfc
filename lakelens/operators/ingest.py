"""Image ingest: files -> hashed base64 messages -> keyed envelopes, with size limit and re-ingest skip."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakelens.config import MAX_MESSAGE_BYTES
from lakelens.functions import binary, jsonval, paths, timefmt
from lakelens.operators.frames import select_once
from lakelens.operators.joins import anti_join_keys
from lakelens.schemas import IMAGE_MESSAGE_FIELDS


def hash_files(files: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Narrow projection of a file DataFrame: name, path, size and SHA-256 (content is not carried)."""
    return files.select(
        paths.file_name(F.col("path")).alias("filename"),
        paths.local_path(F.col("path")).alias("filepath"),
        F.coalesce(F.col("length"), binary.byte_length(F.col("content"))).cast("long").alias("file_size"),
        binary.sha256_hex(F.col("content")).alias("file_hash"),
        *keep,
    )


def build_messages(files: DataFrame, clock: Column | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """M1 image messages from image files (path, length, content).

    ``clock`` is the message time; by default the local wall clock at processing,
    as a naive ISO-8601 text.
    """
    clock = F.localtimestamp() if clock is None else clock
    name = paths.file_name(F.col("path"))
    return files.select(
        name.alias("filename"),
        paths.local_path(F.col("path")).alias("filepath"),
        F.coalesce(F.col("length"), binary.byte_length(F.col("content"))).cast("long").alias("file_size"),
        binary.sha256_hex(F.col("content")).alias("file_hash"),
        paths.mime_from_extension(paths.extension(name)).alias("mime_type"),
        timefmt.iso_naive(clock).alias("timestamp"),
        binary.base64_text(F.col("content")).alias("image_data"),
        *keep,
    )


def skip_already_ingested(candidates: DataFrame, ingested_hashes: DataFrame) -> DataFrame:
    """Candidates whose ``file_hash`` is not yet in the metadata table.

    Duplicates inside one scan are kept (the first-wins insert resolves them).  The
    ingested side is reduced to distinct hashes; AQE picks the join from measured sizes.
    """
    return anti_join_keys(candidates, ingested_hashes, "file_hash")


def to_envelopes(messages: DataFrame, topic: str, num_partitions: int = 3,
                 partition: Column | None = None, offset: Column | None = None,
                 timestamp: Column | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Keyed topic records: key = file hash, value = the message as JSON text.

    Without an explicit partition the key is hashed over ``num_partitions`` (like a
    keyed producer); offsets are then assigned by the topic, here a unique
    increasing id per writer task.
    """
    part = partition if partition is not None else F.pmod(F.xxhash64("file_hash"), F.lit(num_partitions))
    return messages.select(
        F.col("file_hash").alias("key"),
        jsonval.to_json_text(F.struct(*[F.col(c) for c in IMAGE_MESSAGE_FIELDS])).alias("value"),
        F.lit(topic).alias("topic"),
        part.cast("int").alias("partition"),
        (offset if offset is not None else F.monotonically_increasing_id()).cast("long").alias("offset"),
        (timestamp if timestamp is not None else F.localtimestamp()).cast("timestamp_ntz").alias("timestamp"),
        *keep,
    )


def with_size(envelopes: DataFrame) -> DataFrame:
    """Envelopes plus ``value_bytes``, the payload's UTF-8 bytes.

    The size is measured behind a Generate: a filter on the value itself would be pushed
    below the projection that builds it and serialise every payload a second time.
    """
    return select_once(envelopes, list(envelopes.columns), [F.octet_length(F.col("value")).alias("value_bytes")])


def split_by_size(envelopes: DataFrame, max_bytes: int = MAX_MESSAGE_BYTES) -> tuple[DataFrame, DataFrame]:
    """(sendable, too_large): payloads over ``max_bytes`` UTF-8 bytes are refused."""
    cols, sized, size = list(envelopes.columns), with_size(envelopes), F.col("value_bytes")
    return sized.where(size <= max_bytes).select(*cols), sized.where(size > max_bytes).select(*cols)


def parse_messages(envelopes: DataFrame) -> DataFrame:
    """Envelope + the M1 fields read from the JSON value with dynamic typing.

    ``is_json`` is false for text that is not JSON; ``is_object`` tells objects
    apart from other JSON values.  The value is parsed once per row.
    """
    v = F.col("_v")
    parsed = envelopes.withColumn("_v", jsonval.parse(F.col("value")))
    return select_once(parsed, list(envelopes.columns), [
        v.isNotNull().alias("is_json"),
        jsonval.is_object(v).alias("is_object"),
        jsonval.get_string(v, "filename").alias("filename"),
        jsonval.get_string(v, "filepath").alias("filepath"),
        jsonval.get_long(v, "file_size").alias("file_size"),
        jsonval.has_field(v, "file_size").alias("has_file_size"),
        jsonval.get_string(v, "file_hash").alias("file_hash"),
        jsonval.get_string(v, "mime_type").alias("mime_type"),
        jsonval.has_field(v, "mime_type").alias("has_mime_type"),
        jsonval.get_string(v, "timestamp").alias("msg_timestamp"),
        jsonval.has_field(v, "timestamp").alias("has_timestamp"),
        jsonval.get_string(v, "image_data").alias("image_data"),
        F.octet_length(F.col("value")).cast("long").alias("payload_bytes"),
    ])
