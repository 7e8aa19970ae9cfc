"""Stream processing: messages -> trimmed processed payload -> topic, keyed table (T2), lake append (T3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakelens.functions import jsonval, timefmt
from lakelens.operators.frames import select_once
from lakelens.operators.joins import anti_join_keys
from lakelens.operators.metadata import first_wins
from lakelens.schemas import PROCESSED_FIELDS, T2_LIMITS

# Fields of the processed payload.
PAYLOAD_FIELDS = ["filename", "file_hash", "file_size", "mime_type"]
ARRIVAL_ORDER = ["kafka_timestamp", "kafka_partition", "kafka_offset"]
#: what ``transform`` computes for the payloads, the passed-through values and the table rows
FOR_PAYLOADS = ("kind", "processed_at", *PAYLOAD_FIELDS)
FOR_RAW = ("kind", "processed_at", "raw")
FOR_ROWS = (*FOR_PAYLOADS, "hash_truthy", "size_unbound")


def transform(envelopes: DataFrame, clock: Column | None = None, fields: tuple[str, ...] | None = None) -> DataFrame:
    """Parse each record and build its processed payload.

    ``fields`` names the computed columns that the caller reads (default: all): they come out of
    a Generate, which column pruning does not cross.

    ``kind`` is ``object`` (payload fields set), ``other`` (a JSON value that is not an
    object; passed through as ``raw``) or ``invalid`` (not JSON: dead letter).
    ``clock`` is the processing time in UTC (default: now).
    """
    now = (F.current_timestamp() if clock is None else clock).cast("timestamp_ntz")
    v, obj, size = F.col("_v"), F.col("_is_object"), F.col("_size")
    base = envelopes.withColumn("_v", jsonval.parse(F.col("value")))
    keyed = base.select(
        F.col("key"), F.col("value"), F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"), F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"), "_v")
    # what several fields read: a Generate would compute it for each of them
    keyed = keyed.select("*", jsonval.is_object(v).alias("_is_object"), jsonval.get_long(v, "file_size").alias("_size"),
                         *[jsonval.field_text(v, c).alias(f"_{c}_text") for c in ("file_hash", "file_size")])
    made = {
        "kind": F.when(v.isNull(), F.lit("invalid")).when(obj, F.lit("object")).otherwise(F.lit("other")),
        "processed_at": timefmt.iso_utc(now),
        "filename": F.when(obj, jsonval.get_string(v, "filename")),
        "file_hash": F.when(obj, jsonval.get_string(v, "file_hash")),
        "file_size": F.when(obj, size),
        "mime_type": F.when(obj, jsonval.get_string(v, "mime_type")),
        "hash_truthy": F.when(obj, jsonval.truthy_text(F.col("_file_hash_text"))).otherwise(F.lit(False)),
        # a size that is there but does not bind to the tables' bigint column
        "size_unbound": obj & size.isNull() & ~F.coalesce(F.col("_file_size_text"), F.lit("null")).isin("null"),
        # the payload's values as they came, for the topic
        **{f"_{c}": F.when(obj, F.try_variant_get(v, f"$.{c}", "variant")) for c in PAYLOAD_FIELDS},
        "raw": F.when(~obj, v),
    }
    return select_once(keyed, ["key", "value", "kafka_topic", "kafka_partition", "kafka_offset", "kafka_timestamp"],
                       [c.alias(n) for n, c in made.items() if fields is None or n in fields])


def payloads(transformed: DataFrame) -> DataFrame:
    """Object records as the M2 payload, with their topic position."""
    return transformed.where(F.col("kind") == "object").select(
        "kafka_partition", "kafka_offset", "processed_at", "filename", "file_hash", "file_size", "mime_type")


def raw_passthrough(transformed: DataFrame) -> DataFrame:
    """Non-object JSON values, wrapped as ``{processed_at, raw}``."""
    return transformed.where(F.col("kind") == "other").select(
        "kafka_partition", "kafka_offset", "processed_at", F.to_json(F.col("raw")).alias("raw"))


def dead_letters(transformed: DataFrame, source: str = "processed") -> DataFrame:
    return transformed.where(F.col("kind") == "invalid").select(
        F.lit(source).alias("source"), F.lit("invalid_json").alias("reason"), "key", "value",
        F.col("kafka_partition").alias("partition"), F.col("kafka_offset").alias("offset"))


def output_records(transformed: DataFrame, topic: str) -> DataFrame:
    """Records for the processed topic: every JSON record (objects and passthrough), key kept.

    The payload's fields keep the JSON type and value they had in the message.
    """
    obj_json = jsonval.to_json_text(F.struct("processed_at", *[F.col(f"_{c}").alias(c) for c in PAYLOAD_FIELDS]))
    raw_json = F.to_json(F.struct(F.col("processed_at"), F.col("raw")))
    return transformed.where(F.col("kind") != "invalid").select(
        F.col("key"),
        F.when(F.col("kind") == "object", obj_json).otherwise(raw_json).alias("value"),
        F.lit(topic).alias("topic"),
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        F.col("kafka_timestamp").alias("timestamp"),
    )


def processed_rows(transformed: DataFrame, keep_arrival: bool = False) -> DataFrame:
    """T2/T3 rows: object records with a truthy ``file_hash`` and a ``file_size`` that binds;
    ``processed_at`` parsed to UTC.  ``unbound_sizes`` has the others."""
    rows = transformed.where((F.col("kind") == "object") & F.col("hash_truthy") & ~F.col("size_unbound")).select(
        "file_hash", "filename", "file_size", "mime_type",
        timefmt.parse_iso_utc(F.col("processed_at")).alias("processed_at"),
        "kafka_topic", F.col("kafka_partition").cast("int").alias("kafka_partition"),
        F.col("kafka_offset").cast("long").alias("kafka_offset"), "kafka_timestamp")
    return rows if keep_arrival else rows.drop("kafka_timestamp")


def unbound_sizes(transformed: DataFrame, source: str = "processed") -> DataFrame:
    """Records for the dead letter that T2/T3 cannot hold: their ``file_size`` is no whole number."""
    return transformed.where((F.col("kind") == "object") & F.col("hash_truthy") & F.col("size_unbound")).select(
        F.lit(source).alias("source"), F.lit("bad_file_size").alias("reason"), "key", "value",
        F.col("kafka_partition").alias("partition"), F.col("kafka_offset").alias("offset"))


def split_t2_limits(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(fits, too_long) against the keyed table's column lengths; too-long rows are quarantined."""
    bad = F.lit(False)
    for col, limit in T2_LIMITS.items():
        bad = bad | F.coalesce(F.length(col) > limit, F.lit(False))
    return rows.where(~bad), rows.where(bad)


def upsert_rows(rows: DataFrame, existing: DataFrame | None = None, probe: bool = False) -> DataFrame:
    """Rows the keyed table gains: first per ``file_hash`` in arrival order, existing keys skipped."""
    first = first_wins(rows, "file_hash", ARRIVAL_ORDER)
    if existing is not None:
        first = anti_join_keys(first, existing, "file_hash", probe=probe)
    return first.select(*PROCESSED_FIELDS)


def dedupe_by_offset(rows: DataFrame) -> DataFrame:
    """Collapse redelivered copies: one row per (partition, offset), the earliest processed."""
    cols = [c for c in rows.columns]
    first = F.min_by(F.struct(*[F.col(c) for c in cols]), F.struct("processed_at", "kafka_topic"))
    return (rows.groupBy("kafka_topic", "kafka_partition", "kafka_offset").agg(first.alias("_r"))
            .select("_r.*"))


def dedupe_by_hash(rows: DataFrame) -> DataFrame:
    """One row per content hash, the earliest by (processed_at, partition, offset)."""
    return first_wins(rows, "file_hash", ["processed_at", "kafka_partition", "kafka_offset"])
