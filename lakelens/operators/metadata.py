"""Image metadata (T1): validation with a dead letter, first-wins insert, object keys, retention, FK check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakelens.config import MAX_MESSAGE_BYTES, RETENTION_DAYS
from lakelens.functions import binary, paths, timefmt
from lakelens.operators.ids import assign_serial_ids
from lakelens.operators.frames import select_once
from lakelens.operators.joins import anti_join_keys
from lakelens.schemas import IMAGE_METADATA_FIELDS, T1_LIMITS

T1_COLUMNS = IMAGE_METADATA_FIELDS
ARRIVAL_ORDER = ["kafka_timestamp", "kafka_partition", "kafka_offset"]


def first_wins(df: DataFrame, key: str, order_cols: list[str]) -> DataFrame:
    """The earliest row per key in the stated order (``INSERT ... ON CONFLICT DO NOTHING``).

    ``min_by`` is a declarative aggregate: each map task keeps one candidate per key
    before the shuffle, so a key holding a third of all rows costs one row per task.
    """
    order = F.struct(*[F.col(c) for c in order_cols])
    return (df.groupBy(key)
            .agg(F.min_by(F.struct(*[F.col(c) for c in df.columns]), order).alias("_first"))
            .select("_first.*"))


def metadata_rows(msgs: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """T1 columns from typed M1 messages with topic position (``kafka_partition``/``kafka_offset``).

    The object path uses the processing date; ``uploaded_at`` is the message time.
    Extra input columns are carried along.
    """
    processed = (F.localtimestamp() if processed_at is None else processed_at).cast("timestamp_ntz")
    made = {
        "filename": F.col("filename"),
        "file_hash": F.col("file_hash"),
        "file_size": F.col("file_size").cast("long"),
        "mime_type": F.col("mime_type"),
        "s3_path": paths.object_key(processed, F.col("filename")),
        "uploaded_at": timefmt.parse_iso_utc(F.col("timestamp")),
        "source_path": F.col("filepath"),
        "kafka_offset": F.col("kafka_offset").cast("long"),
        "kafka_partition": F.col("kafka_partition").cast("int"),
        "processed_at": processed,
    }
    extra = [c for c in msgs.columns if c not in made and c not in ("timestamp", "filepath", "image_data")]
    return msgs.select(*[v.alias(k) for k, v in made.items()], *extra)


def insert_first_wins(batch: DataFrame, target: DataFrame, order_cols: list[str] = ARRIVAL_ORDER,
                      key: str = "file_hash", probe: bool = False) -> DataFrame:
    """Rows a first-wins insert adds to ``target``: first per key in the batch, keys already present
    skipped, new serial ids after the target's largest id, in arrival order.  ``probe`` marks a
    persisted micro-batch (see ``joins.anti_join_keys``)."""
    top = target.select(F.max("id")).scalar()
    return assign_serial_ids(new_rows(batch, target, order_cols, key, probe), order_cols + [key], top)


def new_rows(batch: DataFrame, target: DataFrame, order_cols: list[str] = ARRIVAL_ORDER, key: str = "file_hash",
             probe: bool = False) -> DataFrame:
    """First row per key of ``batch`` whose key ``target`` lacks, without an id."""
    new = anti_join_keys(first_wins(batch, key, order_cols), target, key, probe=probe)
    return new.drop("id") if "id" in new.columns else new


def validate_messages(parsed: DataFrame, strict: bool = False, now: Column | None = None,
                      max_bytes: int = MAX_MESSAGE_BYTES) -> DataFrame:
    """Typed message columns plus ``reason`` (NULL for a valid row; the first failed rule otherwise).

    ``parsed`` comes from ``operators.ingest.parse_messages``.  ``strict`` is the
    continuous consumer (every field required); otherwise the batch consumer's
    defaults apply: MIME -> application/octet-stream, missing size -> decoded length,
    missing time -> now.
    """
    now = (F.localtimestamp() if now is None else now).cast("timestamp_ntz")
    # the base64 check reads the whole payload: evaluate it once, behind a Generate, so the
    # filters callers put on ``reason`` do not repeat it
    parsed = select_once(parsed, list(parsed.columns),
                         [binary.decoded_length(F.col("image_data")).alias("_decoded_len")])
    decoded_len = F.col("_decoded_len")
    if strict:
        mime = F.col("mime_type")
        size = F.col("file_size")
        ts_text = F.col("msg_timestamp")
        uploaded = timefmt.parse_iso_utc(ts_text)
    else:
        mime = F.coalesce(F.nullif(F.col("mime_type"), F.lit("")), F.lit(paths.DEFAULT_MIME))
        size = F.when(F.col("has_file_size"), F.col("file_size")).otherwise(decoded_len)
        ts_text = F.nullif(F.col("msg_timestamp"), F.lit(""))
        uploaded = F.when(ts_text.isNull(), now).otherwise(timefmt.parse_iso_utc(ts_text))

    rules = [
        (~F.col("is_json"), "invalid_json"),
        (~F.col("is_object"), "not_object"),
        (F.col("payload_bytes") > max_bytes, "payload_too_large"),
        (F.col("filename").isNull(), "missing_filename"),
        (F.length("filename") > T1_LIMITS["filename"], "filename_too_long"),
        (F.col("file_hash").isNull(), "missing_file_hash"),
        (F.length("file_hash") > T1_LIMITS["file_hash"], "file_hash_too_long"),
        (F.col("image_data").isNull(), "missing_image_data"),
        (decoded_len.isNull(), "bad_image_data"),
    ]
    if strict:
        rules.append((~F.col("has_mime_type"), "missing_mime_type"))
    rules += [
        (F.length(mime) > T1_LIMITS["mime_type"], "mime_type_too_long"),
        (size.isNull() & F.col("has_file_size"), "bad_file_size"),
        (size.isNull(), "missing_file_size"),
        (F.length(paths.object_key(now, F.col("filename"))) > T1_LIMITS["s3_path"], "s3_path_too_long"),
    ]
    if strict:
        rules.append((~F.col("has_timestamp"), "missing_timestamp"))
    rules.append((ts_text.isNotNull() & uploaded.isNull(), "bad_timestamp"))

    reason = F.lit(None).cast("string")
    for cond, label in reversed(rules):
        reason = F.when(F.coalesce(cond, F.lit(False)), F.lit(label)).otherwise(reason)

    return parsed.select(
        *[c for c in parsed.columns if c not in ("mime_type", "file_size", "_decoded_len")],
        mime.alias("mime_type"),
        size.cast("long").alias("file_size"),
        uploaded.alias("uploaded_at"),
        reason.alias("reason"),
    )


def object_writes(valid: DataFrame, processed_at: Column, order_cols: list[str] = ARRIVAL_ORDER) -> DataFrame:
    """Objects as stored: key ``images/<processing day>/<filename>``; a key written again keeps the
    last write.  ``n_writes`` counts the writes to each key (overwrites = n_writes - 1)."""
    keyed = valid.withColumn("object_key", paths.object_key(processed_at.cast("timestamp_ntz"), F.col("filename")))
    cols = [c for c in keyed.columns if c != "object_key"]
    last = F.max_by(F.struct(*[F.col(c) for c in cols]), F.struct(*[F.col(c) for c in order_cols]))
    return (keyed.groupBy("object_key")
            .agg(last.alias("_last"), F.count(F.lit(1)).alias("n_writes"))
            .select("object_key", "_last.*", "n_writes"))


def retention_delete(rows: DataFrame, as_of: str, days: int = RETENTION_DAYS) -> DataFrame:
    """Rows kept by ``DELETE WHERE uploaded_at < as_of_date - days``; NULL times are kept."""
    cutoff = F.date_sub(F.lit(as_of).cast("date"), days).cast("timestamp_ntz")
    return rows.where(F.col("uploaded_at").isNull() | (F.col("uploaded_at") >= cutoff))


def orphan_objects(objects: DataFrame, metadata_rows: DataFrame) -> DataFrame:
    """Stored objects that no metadata row points to (retention deletes rows, not objects)."""
    return anti_join_keys(objects, metadata_rows.select(F.col("s3_path").alias("object_key")), "object_key")


def fk_orphans(child: DataFrame, parent: DataFrame, fk: str, pk: str = "id") -> DataFrame:
    """Child rows whose non-NULL foreign key has no parent row (NULL keys are allowed)."""
    keys = parent.select(F.col(pk).alias(fk)).distinct()
    return child.where(F.col(fk).isNotNull()).join(keys, fk, "left_anti")
