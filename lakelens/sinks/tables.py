"""Table writers on plain Parquet: create-if-absent, first-wins insert, exactly-once append, lake commits.

A job that dies while it commits can leave some of its files.  Writers that a stream replays
are safe against that: an append owns the folder of its batch and a replay overwrites it whole;
a first-wins insert adds the keys that are still missing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelens.operators import changelog, metadata
from lakelens.operators.ids import assign_serial_ids
from lakelens.schemas import LAKE_LOG_FIELDS, PARTITION_COLUMN
from lakelens.session import file_system
from lakelens.sinks import keyed
from lakelens.sinks.batches import BatchRef, markers, reserve_ids


def table_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = file_system(spark, path)
    return fs.exists(hadoop_path)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    if table_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def create_if_absent(spark: SparkSession, path: str, schema: T.StructType,
                     partition_by: list[str] | None = None) -> bool:
    """``CREATE TABLE IF NOT EXISTS``: writes an empty table with the schema; True when created."""
    if table_exists(spark, path):
        return False
    writer = spark.createDataFrame([], schema).write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return True


def insert_first_wins(spark: SparkSession, batch: DataFrame, path: str, schema: T.StructType,
                      order_cols: list[str] = metadata.ARRIVAL_ORDER, key: str = "file_hash",
                      partition_by: dict | None = None) -> int:
    """Append the rows of ``batch`` whose key is new (``ON CONFLICT (key) DO NOTHING``).

    New rows get serial ids after the table's high-water mark, which retention does not lower.
    Returns how many were added; replaying the same batch adds none, since its keys now exist.  ``partition_by``
    maps partition column names to the Columns that derive them.
    """
    existing = read_or_empty(spark, path, schema)
    new = metadata.new_rows(batch, existing, order_cols, key, probe=True).persist()
    try:
        n = new.count()
        if n:
            top = existing.agg(F.max("id")).first()[0] if not markers(spark, f"{path}/_serial") else 0
            start = reserve_ids(spark, path, n, top or 0)
            added = assign_serial_ids(new, order_cols + [key], start).select(*schema.fieldNames())
            for name, expr in (partition_by or {}).items():
                added = added.withColumn(name, expr)
            writer = added.write.mode("append")
            if partition_by:
                writer = writer.partitionBy(*partition_by)
            writer.parquet(path)
        return n
    finally:
        new.unpersist()


def upsert_first_wins(spark: SparkSession, rows: DataFrame, path: str, schema: T.StructType,
                      order_cols: list[str], key: str = "file_hash") -> None:
    """Keyed table without serial ids (``ON CONFLICT (key) DO NOTHING``): the first row per key in
    the stated order is appended unless the key is already stored (``sinks.keyed``)."""
    keyed.insert_first_wins(spark, rows, path, schema, order_cols, key)


def append_batch(rows: DataFrame, path: str, batch: BatchRef | int, partition_by: list[str] | None = None,
                 fmt: str = "parquet") -> None:
    """Append a micro-batch exactly once: it owns a folder, which a replay overwrites whole."""
    writer = rows.write.mode("overwrite").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(f"{path.rstrip('/')}/{BatchRef.of(batch).folder}")


# ---------------------------------------------------------------- lake table (change log)

def commit_lake(spark: SparkSession, change_rows: DataFrame, path: str, max_records_per_file: int | None = None
                ) -> None:
    """Append one commit's change rows, partitioned by day.

    Rows are gathered by day first: without that every task would write a file into every day.
    """
    writer = changelog.compact(change_rows.select(*LAKE_LOG_FIELDS)).write.mode("append").partitionBy(PARTITION_COLUMN)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.parquet(path)


def next_commit_id(spark: SparkSession, path: str) -> int:
    if not table_exists(spark, path):
        return 1
    top = spark.read.parquet(path).agg(F.max("commit_id")).first()[0]
    return int(top or 0) + 1


def append_lake(spark: SparkSession, rows: DataFrame, path: str, committed_at: str) -> int:
    """``INSERT INTO images ...``: rows become one append commit; returns its id."""
    cid = next_commit_id(spark, path)
    commit_lake(spark, changelog.commit(rows, cid, committed_at), path)
    return cid


def update_lake(spark: SparkSession, path: str, predicate, assignments: dict, committed_at: str) -> int:
    log = spark.read.parquet(path)
    cid = next_commit_id(spark, path)
    commit_lake(spark, changelog.update_rows_by_day(log, predicate, assignments, cid, committed_at), path)
    return cid


def delete_lake(spark: SparkSession, path: str, predicate, committed_at: str, days=None) -> int:
    """``DELETE``; ``days`` is what the predicate implies for the day partition (only those are read)."""
    log = spark.read.parquet(path)
    cid = next_commit_id(spark, path)
    commit_lake(spark, changelog.delete_rows(log, predicate, cid, committed_at, days=days), path)
    return cid


def rewrite_lake(spark: SparkSession, path: str, out_path: str, cutoff: str | None = None,
                 max_records_per_file: int | None = None) -> None:
    """Compaction (and expiry when ``cutoff`` is given) into a new path.

    Spark cannot overwrite a path it is reading, so the result goes to ``out_path``;
    switching readers to it is the caller's catalog step.
    """
    log = spark.read.parquet(path)
    if cutoff:
        log = changelog.expire(log, cutoff)
    commit_lake(spark, log, out_path, max_records_per_file)


def write_jdbc(rows: DataFrame, url: str, table: str, properties: dict | None = None,
               batch_rows: int = 1000) -> None:
    """Relational append in pages of ``batch_rows`` (one transaction per task)."""
    writer = (rows.write.format("jdbc").option("url", url).option("dbtable", table)
              .option("batchsize", batch_rows).option("isolationLevel", "READ_COMMITTED").mode("append"))
    for key, value in (properties or {}).items():
        writer = writer.option(key, value)
    writer.save()


# ---------------------------------------------------------------- catalog lake table, bucketed by key

def commit_lake_table(spark: SparkSession, change_rows: DataFrame, table: str, buckets: int,
                      key: str = "id") -> None:
    """Append change rows to a catalog table partitioned by day and bucketed by ``key``.

    Bucketing keeps every version of a key in the same bucket file of each day, so
    version resolution (``groupBy(key)``) and joins on the key read the buckets in
    place instead of shuffling the table.
    """
    (change_rows.select(*LAKE_LOG_FIELDS).write.mode("append").format("parquet")
     .partitionBy(PARTITION_COLUMN).bucketBy(buckets, key).sortBy(key).saveAsTable(table))
