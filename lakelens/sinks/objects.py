"""Object store as a Parquet dataset: one row per object write, keyed by a date path.

Writes append (object_key, content, content_type, write order); reading an object
returns the last write of its key, like a put that overwrites.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakelens.functions import binary, paths
from lakelens.sinks.batches import BatchRef


def object_rows(valid: DataFrame, processed_at: Column) -> DataFrame:
    """Object writes for valid messages: bytes decoded from base64, key from the processing date."""
    processed = processed_at.cast("timestamp_ntz")
    return valid.select(
        paths.object_key(processed, F.col("filename")).alias("object_key"),
        binary.decode_base64(F.col("image_data")).alias("content"),
        F.col("mime_type").alias("content_type"),
        F.to_date(processed).alias("object_day"),
        processed.alias("written_at"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
    )


def write_objects(objects: DataFrame, root: str, batch: BatchRef | int) -> None:
    """Append one batch of object writes; a replayed batch overwrites its own folder."""
    (objects.write.mode("overwrite").partitionBy("object_day")
     .parquet(f"{root.rstrip('/')}/{BatchRef.of(batch).folder}"))


def read_objects(spark: SparkSession, root: str) -> DataFrame:
    """Current objects: the last write per key, plus how many times the key was written.

    Writes of several writers are ordered by their processing time, then by batch and position.
    """
    rows = spark.read.parquet(root)
    last = F.max_by(F.struct("content", "content_type", "object_day"),
                    F.struct("written_at", "writer", "run", "batch", "kafka_partition", "kafka_offset"))
    return (rows.groupBy("object_key").agg(last.alias("_o"), F.count(F.lit(1)).alias("n_writes"))
            .select("object_key", "_o.*", "n_writes"))
