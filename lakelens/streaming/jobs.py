"""Structured Streaming jobs: image producer, image consumer, stream processor, and the batch ingest job.

Each stream reads with a checkpoint (the committed consumer-group offsets) and
writes in ``foreachBatch``; the micro-batch is persisted once and every sink in
it is idempotent on (writer, run of the checkpoint, batch number), so a batch replayed
after a failure is not stored twice, and neither a new checkpoint nor another writer
meets its folders.  The batch job runs the same functions with ``availableNow``.
"""

from __future__ import annotations

import logging
import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelens.config import MAX_FETCH_BYTES, JobConfig
from lakelens.functions import jsonval, paths
from lakelens.operators import ingest, metadata, processed
from lakelens.operators.frames import counted
from lakelens.operators.ids import assign_serial_ids
from lakelens.operators.joins import broadcast_if_bounded
from lakelens.schemas import IMAGE_METADATA, PROCESSED_FIELDS, PROCESSED_ROW
from lakelens.session import adaptive, file_system, pin_utc
from lakelens.sinks import datasource, objects, tables, topics
from lakelens.sinks.batches import BatchRef, reserve_offsets, run_of
from lakelens.sources import files as file_sources
from lakelens.sources import topics as topic_sources
from lakelens.streaming import dedup

log = logging.getLogger(__name__)
METADATA_PARTITION = "uploaded_day"
METADATA_TABLE_SCHEMA = T.StructType(IMAGE_METADATA.fields + [T.StructField(METADATA_PARTITION, T.DateType())])


def _clock_col(clock: str | None) -> Column:
    """The processing time (UTC) of a micro-batch as a literal (one value for the whole batch)."""
    if clock is not None:
        return F.lit(clock).cast("timestamp_ntz")
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    return F.lit(now.isoformat(" ")).cast("timestamp_ntz")


@dataclass
class Counters:
    """Run counters (A6)."""
    produced: int = 0
    too_large: int = 0
    processed: int = 0
    rejected: int = 0
    inserted: int = 0
    expired_partitions: int = 0

    def add(self, other: "Counters") -> None:
        for f in self.__dataclass_fields__:
            setattr(self, f, getattr(self, f) + getattr(other, f))


# ---------------------------------------------------------------- producer (files -> topic)

def produce_batch(files: DataFrame, batch: BatchRef | int, cfg: JobConfig, clock: str | None = None,
                  skip_hashes: DataFrame | None = None) -> Counters:
    """Hash, encode and send one set of image files; files over the size limit go to the dead letter.

    Files are hashed first, and the narrow rows (name, path, hash) decide what is sent and get
    their place: keys hash to ``cfg.topic_partitions``, and on a file topic the offsets are
    dense by partition, in name order, from the topic's stored end.  The survivors' contents
    are then read again and encoded; they meet their narrow rows in a broadcast join while
    those are proven small, so payloads are not shuffled.
    """
    spark, ref = files.sparkSession, BatchRef.of(batch, "producer")
    hashed = ingest.hash_files(files, keep=("path",))
    if skip_hashes is not None:
        hashed = ingest.skip_already_ingested(hashed, skip_hashes)
    placed = hashed.select("path", "filename", "filepath",
                           F.pmod(F.xxhash64("file_hash"), F.lit(cfg.topic_partitions)).cast("int").alias("topic_part"))
    numbered = assign_serial_ids(placed, ["topic_part", "filename", "filepath", "path"], id_col="serial").checkpoint()
    ranges = numbered.groupBy("topic_part").agg(F.min("serial").alias("low"), F.count(F.lit(1)).alias("n")).collect()
    starts = {r["topic_part"]: 0 for r in ranges}
    if not cfg.bootstrap_servers and cfg.topic_root:
        starts = reserve_offsets(spark, topic_sources.topic_path(cfg.topic_root, cfg.input_topic), ref,
                                 {r["topic_part"]: r["n"] for r in ranges})
    offset = F.lit(None).cast("long")
    for r in ranges:  # one for each topic partition
        offset = F.when(F.col("topic_part") == r["topic_part"], F.col("serial") - r["low"] + starts[r["topic_part"]]).otherwise(offset)
    place = broadcast_if_bounded(numbered.select("path", "topic_part", offset.alias("topic_offset")), F.octet_length("path") + 32)
    msgs = ingest.build_messages(files.join(place, "path"), _clock_col(clock) if clock else None, keep=("topic_part", "topic_offset"))
    env = ingest.to_envelopes(msgs, cfg.input_topic, partition=F.col("topic_part"), offset=F.col("topic_offset"), keep=("filepath",))
    large = F.col("value_bytes") > cfg.max_message_bytes
    env, seen = counted(ingest.with_size(env), n=F.count(F.lit(1)), large=F.count_if(large))
    env = env.persist()
    try:
        topics.write_topic(env.where(~large), cfg.input_topic, cfg.topic_root, cfg.bootstrap_servers, ref)
        n, n_large = seen.get["n"], seen.get["large"]
        if n_large:
            # the payload is too large to keep: its file's path stands for it
            tables.append_batch(env.where(large).select(
                F.lit("producer").alias("source"), F.lit("payload_too_large").alias("reason"),
                "key", F.col("filepath").alias("value"), "partition", "offset"),
                f"{cfg.dead_letter_root()}/producer", ref)
        return Counters(produced=n - n_large, too_large=n_large)
    finally:
        env.unpersist()


#: counters of the running process by job, summed over its micro-batches (A6)
TOTALS: dict[str, Counters] = {}


def _count(job: str, counters: Counters) -> None:
    TOTALS.setdefault(job, Counters()).add(counters)
    log.info("%s: %s", job, TOTALS[job])


def _named(writer, name: str | None):
    return writer.queryName(name) if name else writer


def start_producer(spark: SparkSession, cfg: JobConfig, checkpoint: str, available_now: bool = False,
                   clock: str | None = None, name: str | None = None):
    """Watched folder -> input topic (S1, R1, R7): each new file is sent once."""
    cfg.dead_letter_root()
    stream = file_sources.image_folder_stream(spark, cfg.watch_path, max_bytes_per_trigger=cfg.max_bytes_per_trigger or MAX_FETCH_BYTES)
    own = run_of(spark, checkpoint)

    def run(batch: DataFrame, batch_id: int) -> None:
        _count("producer", produce_batch(batch, BatchRef("producer", own.id, batch_id), cfg, clock))

    writer = _named(stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint), name)
    writer = writer.trigger(availableNow=True) if available_now else \
        writer.trigger(processingTime=f"{cfg.poll_interval_seconds} seconds")
    return writer.start()


# ---------------------------------------------------------------- consumer (topic -> objects + metadata)

def decode_values(batch: DataFrame, decoder=None) -> DataFrame:
    """Apply a value decoder (a Column -> Column function, e.g. decompression) to the record values."""
    return batch if decoder is None else batch.withColumn("value", decoder(F.col("value")))


def consume_batch(spark: SparkSession, batch: DataFrame, batch_id: BatchRef | int, cfg: JobConfig, strict: bool = True,
                  clock: str | None = None, decoder=None) -> Counters:
    """Store one micro-batch of image messages: objects, first-wins metadata rows, dead letters."""
    pin_utc(spark)
    ref = BatchRef.of(batch_id, "consumer")
    batch = decode_values(batch, decoder)
    now = _clock_col(clock)
    checked = metadata.validate_messages(ingest.parse_messages(batch), strict=strict, now=now,
                                         max_bytes=cfg.max_message_bytes)
    # The raw value (up to 25 MiB) is kept only for rows bound for the dead letter.
    checked = checked.withColumn("value", F.when(F.col("reason").isNotNull(), F.col("value")))
    checked, seen = counted(checked, n=F.count(F.lit(1)), rejected=F.count("reason"))
    checked = checked.persist()
    try:
        valid = checked.where(F.col("reason").isNull())
        letters = checked.where(F.col("reason").isNotNull()).select(
            F.lit("consumer").alias("source"), "reason", "key", "value", "partition", "offset")
        # the first write over the batch counts it; without any other sink that is the dead letter's
        first = not cfg.object_root and not cfg.metadata_table
        if first:
            tables.append_batch(letters, f"{cfg.dead_letter_root()}/consumer", ref)
        if cfg.object_root:
            objects.write_objects(objects.object_rows(valid, now), cfg.object_root, ref)
        rows = valid.select(
            "filename", "file_hash", "file_size", "mime_type",
            paths.object_key(now, F.col("filename")).alias("s3_path"),
            "uploaded_at", F.col("filepath").alias("source_path"),
            F.col("offset").cast("long").alias("kafka_offset"), F.col("partition").cast("int").alias("kafka_partition"),
            now.alias("processed_at"), F.col("timestamp").alias("kafka_timestamp"))
        inserted = 0
        if cfg.metadata_table:
            inserted = insert_metadata(spark, rows, cfg.metadata_table)
        n_rejected = seen.get["rejected"]
        if n_rejected and not first:
            tables.append_batch(letters, f"{cfg.dead_letter_root()}/consumer", ref)
        return Counters(processed=seen.get["n"] - n_rejected, rejected=n_rejected, inserted=inserted)
    finally:
        checked.unpersist()


def insert_metadata(spark: SparkSession, rows: DataFrame, path: str) -> int:
    """First-wins insert into T1 (partitioned by upload day); returns the number of rows added."""
    return tables.insert_first_wins(spark, rows, path, IMAGE_METADATA,
                                    partition_by={METADATA_PARTITION: F.to_date("uploaded_at")})


def start_consumer(spark: SparkSession, cfg: JobConfig, checkpoint: str, strict: bool = True,
                   available_now: bool = False, clock: str | None = None, decoder=None, name: str | None = None):
    """Input topic -> objects + T1 (S3/S4, R2-R5, R8, R10-R12)."""
    cfg.dead_letter_root()
    own = run_of(spark, checkpoint)
    stream = topic_sources.read_topic_stream(spark, cfg.input_topic, cfg.topic_root, cfg.bootstrap_servers,
                                             cfg.starting_offsets, cfg.max_bytes_per_trigger,
                                             cfg.max_offsets_per_trigger, own.checkpoint)

    def run(batch: DataFrame, batch_id: int) -> None:
        with adaptive(batch):
            _count("consumer", consume_batch(spark, batch, BatchRef("consumer", own.id, batch_id), cfg, strict, clock, decoder))

    writer = _named(stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint), name)
    writer = writer.trigger(availableNow=True) if available_now else \
        writer.trigger(processingTime=f"{cfg.poll_interval_seconds} seconds")
    return writer.start()


# ---------------------------------------------------------------- stream processor (fan-out)

def process_batch(spark: SparkSession, batch: DataFrame, batch_id: BatchRef | int, cfg: JobConfig,
                  clock: str | None = None, decoder=None) -> Counters:
    """One micro-batch of the processor: output topic, keyed table (T2), lake append (T3), dead letters."""
    pin_utc(spark)
    ref = BatchRef.of(batch_id, "processor")
    batch = decode_values(batch, decoder)
    t = processed.transform(batch, _clock_col(clock))
    # The raw value is only needed for the dead letter.
    bound_for_it = (F.col("kind") == "invalid") | F.col("size_unbound")
    t = t.withColumn("value", F.when(bound_for_it, F.col("value")))
    t, seen = counted(t, n=F.count(F.lit(1)), bad=F.count_if(F.col("kind") == "invalid"))
    t = t.persist()
    try:
        topics.write_topic(processed.output_records(t, cfg.output_topic), cfg.output_topic, cfg.topic_root,
                           cfg.bootstrap_servers, ref)
        rows = processed.processed_rows(t, keep_arrival=True)
        letters = processed.dead_letters(t).unionByName(processed.unbound_sizes(t))
        if cfg.enable_postgres_sink and cfg.processed_table:
            fits, too_long = processed.split_t2_limits(rows)
            tables.upsert_first_wins(spark, fits, cfg.processed_table, PROCESSED_ROW, processed.ARRIVAL_ORDER)
            letters = letters.unionByName(too_long.select(
                F.lit("processed_table").alias("source"), F.lit("value_too_long").alias("reason"),
                F.col("file_hash").alias("key"), jsonval.to_json_text(F.struct(*processed.PAYLOAD_FIELDS)).alias("value"),
                F.col("kafka_partition").alias("partition"), F.col("kafka_offset").alias("offset")))
        if cfg.enable_iceberg_sink and cfg.lake_table:
            tables.append_batch(rows.select(*PROCESSED_FIELDS), cfg.lake_table, ref)
        tables.append_batch(letters, f"{cfg.dead_letter_root()}/processor", ref)
        n, bad = seen.get["n"], seen.get["bad"]
        return Counters(processed=n - bad, rejected=bad)
    finally:
        t.unpersist()


def start_processor(spark: SparkSession, cfg: JobConfig, checkpoint: str, available_now: bool = False,
                    clock: str | None = None, decoder=None, name: str | None = None):
    """Input topic -> processed topic + T2 + T3 (S5, R2, R6, K2, K5, K6, K9); commit every 5 s."""
    cfg.dead_letter_root()
    own = run_of(spark, checkpoint)
    stream = topic_sources.read_topic_stream(spark, cfg.input_topic, cfg.topic_root, cfg.bootstrap_servers,
                                             cfg.processor_starting_offsets, cfg.max_bytes_per_trigger,
                                             cfg.max_offsets_per_trigger, own.checkpoint)

    def run(batch: DataFrame, batch_id: int) -> None:
        with adaptive(batch):
            _count("processor", process_batch(spark, batch, BatchRef("processor", own.id, batch_id), cfg, clock, decoder))

    writer = _named(stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint), name)
    writer = writer.trigger(availableNow=True) if available_now else \
        writer.trigger(processingTime=f"{cfg.commit_interval_seconds} seconds")
    return writer.start()


def start_deduped_append(spark: SparkSession, cfg: JobConfig, checkpoint: str, available_now: bool = False,
                         clock: str | None = None, remember: str = "30 days", name: str | None = None):
    """Input topic -> T3, each ``file_hash`` once (R8 by state): the first record that arrives.

    A restart on the same checkpoint knows the keys of the runs before.
    """
    own = run_of(spark, checkpoint)
    stream = topic_sources.read_topic_stream(spark, cfg.input_topic, cfg.topic_root, cfg.bootstrap_servers,
                                             cfg.processor_starting_offsets, cfg.max_bytes_per_trigger,
                                             cfg.max_offsets_per_trigger, own.checkpoint)
    rows = processed.processed_rows(processed.transform(stream, _clock_col(clock), processed.FOR_ROWS), keep_arrival=True)
    firsts = dedup.first_seen(rows, "file_hash", processed.ARRIVAL_ORDER, remember)

    def run(batch: DataFrame, batch_id: int) -> None:
        tables.append_batch(batch.select(*PROCESSED_FIELDS), cfg.lake_table, BatchRef("dedup", own.id, batch_id))

    writer = _named(firsts.writeStream.foreachBatch(run).outputMode("append")
                    .option("checkpointLocation", checkpoint), name)
    writer = writer.trigger(availableNow=True) if available_now else \
        writer.trigger(processingTime=f"{cfg.commit_interval_seconds} seconds")
    return writer.start()


def start_source_append(spark: SparkSession, cfg: JobConfig, checkpoint: str, available_now: bool = False,
                        clock: str | None = None, name: str | None = None):
    """Input topic -> T3 through the append data source (U2): no ``foreachBatch``, Spark commits each batch."""
    spark.dataSource.register(datasource.AppendSource)
    own = run_of(spark, checkpoint)
    stream = topic_sources.read_topic_stream(spark, cfg.input_topic, cfg.topic_root, cfg.bootstrap_servers,
                                             cfg.processor_starting_offsets, cfg.max_bytes_per_trigger,
                                             cfg.max_offsets_per_trigger, own.checkpoint)
    rows = processed.processed_rows(processed.transform(stream, _clock_col(clock), processed.FOR_ROWS))
    writer = _named(rows.writeStream.format(datasource.AppendSource.name()).option("checkpointLocation", checkpoint)
                    .option("commit_id", own.id), name)
    writer = writer.trigger(availableNow=True) if available_now else \
        writer.trigger(processingTime=f"{cfg.commit_interval_seconds} seconds")
    return writer.start(cfg.lake_table)


def map_records(stream: DataFrame, fn, schema: str) -> DataFrame:
    """User hook (U1): apply a pandas function to each Arrow batch of records."""
    return stream.mapInPandas(fn, schema)


# ---------------------------------------------------------------- batch ingest job (U5)

def drop_partitions_before(spark: SparkSession, path: str, column: str, cutoff_day: str) -> int:
    """Delete whole day partitions older than ``cutoff_day`` (metadata-only delete; NULL days stay)."""
    if not tables.table_exists(spark, path):
        return 0
    fs, root = file_system(spark, path)
    dropped = 0
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith(f"{column}="):
            day = name.split("=", 1)[1]
            if day != "__HIVE_DEFAULT_PARTITION__" and day < cutoff_day:
                fs.delete(status.getPath(), True)
                dropped += 1
    return dropped


def run_batch_ingest(spark: SparkSession, cfg: JobConfig, checkpoint: str, files: DataFrame | None = None,
                     clock: str | None = None, as_of: str | None = None) -> Counters:
    """ensure table -> scan and produce (skipping ingested hashes) -> drain and store -> retention.

    Both branches of the original's check step run, so a backlog in the topic is
    drained even when this scan produced nothing.
    """
    pin_utc(spark)
    cfg.dead_letter_root()
    tables.create_if_absent(spark, cfg.metadata_table, METADATA_TABLE_SCHEMA, [METADATA_PARTITION])
    counters = Counters()
    scan = files if files is not None else file_sources.image_folder(spark, cfg.watch_path)
    known = tables.read_or_empty(spark, cfg.metadata_table, IMAGE_METADATA).select("file_hash")
    # every call is a run of its own as a producer; its consumer continues the checkpoint's
    sent = BatchRef("batch-producer", f"r{uuid.uuid4().hex[:12]}", 0)
    counters.add(produce_batch(scan, sent, cfg, clock, skip_hashes=known))
    results: list[Counters] = []
    own = run_of(spark, checkpoint)

    def run(batch: DataFrame, batch_id: int) -> None:
        with adaptive(batch):
            results.append(consume_batch(spark, batch, BatchRef("batch-consumer", own.id, batch_id), cfg, strict=False, clock=clock))

    stream = topic_sources.read_topic_stream(spark, cfg.input_topic, cfg.topic_root, cfg.bootstrap_servers,
                                             "earliest", cfg.max_bytes_per_trigger, cfg.max_offsets_per_trigger)
    query = (stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    for r in results:
        counters.add(r)
    day = (datetime.fromisoformat(as_of) if as_of else datetime.now(timezone.utc))
    cutoff = (day.date().toordinal() - cfg.retention_days)
    counters.expired_partitions = drop_partitions_before(
        spark, cfg.metadata_table, METADATA_PARTITION, datetime.fromordinal(cutoff).date().isoformat())
    return counters
