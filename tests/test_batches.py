"""Batch identity, offsets, id reservation, bounded batches, start positions, values that pass through."""

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from lakelens.config import MAX_FETCH_BYTES, JobConfig
from lakelens.functions import geo
from lakelens.operators import changelog, processed, spatial
from lakelens.schemas import ENVELOPE, PROCESSED_FIELDS, PROCESSED_ROW
from lakelens.sinks import batches, keyed, topics
from lakelens.sinks.objects import read_objects
from lakelens.sources import fixtures as fx
from lakelens.sources.files import image_folder
from lakelens.sources import topics as topic_sources
from lakelens.sources.topics import read_topic
from lakelens.streaming import jobs
from conftest import SF_SMALL

CLOCK = "2024-03-01 00:00:00"


def _cfg(base, **kw):
    return JobConfig(topic_root=f"{base}/topics", object_root=f"{base}/objects", metadata_table=f"{base}/t1",
                     processed_table=f"{base}/t2", lake_table=f"{base}/t3", dead_letter_table=f"{base}/dlq",
                     **{"processor_starting_offsets": "earliest", **kw})


def _files(spark, n, salt=""):
    rows = [(f"file:/in/f{i:05d}{salt}.jpg", f"content {i} {salt}".encode()) for i in range(n)]
    return spark.createDataFrame(rows, "path string, content binary").withColumn("length", F.octet_length("content").cast("long"))


def test_run_belongs_to_the_checkpoint(spark, scratch):
    a, b = batches.run_of(spark, f"{scratch}/a"), batches.run_of(spark, f"{scratch}/b")
    assert batches.run_of(spark, f"{scratch}/a") == a and a.id != b.id
    assert batches.BatchRef("w", a.id, 3).folder != batches.BatchRef("w", b.id, 3).folder


def test_offsets_are_dense_over_many_partitions_and_batches(spark, scratch):
    cfg = _cfg(scratch)
    for batch in (0, 1):
        jobs.produce_batch(_files(spark, 900, f"b{batch}").repartition(300), batch, cfg, clock=CLOCK)
    first = read_topic(spark, cfg.input_topic, cfg.topic_root)
    places = sorted((r["partition"], r["offset"]) for r in first.collect())
    assert len(places) == len(set(places)) == 1800
    for p in range(3):
        own = [o for q, o in places if q == p]
        assert own == list(range(len(own)))
    # a replay of the last batch keeps its offsets
    jobs.produce_batch(_files(spark, 900, "b1"), 1, cfg, clock=CLOCK)
    again = read_topic(spark, cfg.input_topic, cfg.topic_root)
    assert sorted((r["partition"], r["offset"]) for r in again.collect()) == places


def test_producer_does_not_shuffle_payloads(spark, scratch):
    cfg = _cfg(scratch)
    jobs.produce_batch(_files(spark, 20), 0, cfg, clock=CLOCK)
    names = [json.loads(r["value"])["filename"] for r in
             read_topic(spark, cfg.input_topic, cfg.topic_root).orderBy("partition", "offset").where("partition = 0").collect()]
    assert names == sorted(names)


def test_ids_are_reserved_once(spark, scratch):
    table = f"{scratch}/t"
    assert [batches.reserve_ids(spark, table, 5), batches.reserve_ids(spark, table, 0), batches.reserve_ids(spark, table, 2)] == [0, 5, 5]
    assert batches.reserve_ids(spark, table, 1) == 7
    assert batches.reserve_ids(spark, f"{scratch}/other", 1, at_least=40) == 40


def test_two_writers_keep_each_others_objects(spark, scratch):
    cfg = _cfg(scratch)
    topics.write_topic(fx.document_envelopes(spark, SF_SMALL), cfg.input_topic, cfg.topic_root, batch=0)
    for name in ("a", "b"):
        jobs.start_consumer(spark, cfg, f"{scratch}/ck_{name}", available_now=True, clock=CLOCK).awaitTermination()
    stored = read_objects(spark, cfg.object_root)
    t1 = spark.read.parquet(cfg.metadata_table)
    assert t1.join(stored, t1["s3_path"] == stored["object_key"], "left_anti").count() == 0
    assert stored.where("n_writes != 2").count() == 0


def test_backlog_is_drained_in_bounded_batches(spark, scratch):
    cfg = _cfg(scratch, max_bytes_per_trigger=20_000)
    events = fx.event_envelopes(spark, SF_SMALL)
    topics.write_topic(events.repartition(12), cfg.input_topic, cfg.topic_root, batch=0)
    jobs.start_processor(spark, cfg, f"{scratch}/ck", available_now=True, clock=fx.PROCESSED_CLOCK).awaitTermination()
    t3 = spark.read.parquet(cfg.lake_table)
    assert t3.select("batch").distinct().count() > 1
    want = processed.processed_rows(processed.transform(events, F.lit(fx.PROCESSED_CLOCK).cast("timestamp_ntz")))
    assert sorted(map(repr, t3.select(*PROCESSED_FIELDS).collect())) == sorted(map(repr, want.select(*PROCESSED_FIELDS).collect()))


def test_processor_starts_at_the_latest_record_by_default(spark, scratch):
    """Latest is by offset: an old record in a file that is written late is old."""
    cfg = _cfg(scratch, processor_starting_offsets=JobConfig.processor_starting_offsets)
    events = fx.event_envelopes(spark, SF_SMALL)
    half = events.agg(F.max("offset")).first()[0] // 2
    run = lambda ck: jobs.start_processor(spark, cfg, ck, available_now=True, clock=fx.PROCESSED_CLOCK).awaitTermination()
    topics.write_topic(events.where(F.col("offset") <= half), cfg.input_topic, cfg.topic_root, batch=0)
    run(f"{scratch}/ck")
    late = events.where((F.col("offset") > half) | (F.col("offset") % 10 == 0))
    topics.write_topic(late, cfg.input_topic, cfg.topic_root, batch=1)
    run(f"{scratch}/ck")
    t3 = spark.read.parquet(cfg.lake_table).select("kafka_partition", "kafka_offset")
    ends = {r[0]: r[1] for r in events.where(F.col("offset") <= half).groupBy("partition").agg(F.max("offset")).collect()}
    want = processed.processed_rows(processed.transform(events, F.lit(CLOCK).cast("timestamp_ntz"))).select("kafka_partition", "kafka_offset")
    assert sorted(map(tuple, t3.collect())) == sorted(tuple(r) for r in want.collect() if r[1] > ends.get(r[0], -1))
    # a topic that does not exist yet: all that comes is new
    empty = _cfg(f"{scratch}/none", processor_starting_offsets="latest")
    assert topic_sources.ends_at_start(spark, f"{scratch}/none/ck", empty.input_topic, empty.topic_root) == {}


def test_values_pass_through_and_unbound_sizes_are_kept_aside(spark, scratch):
    cfg = _cfg(scratch)
    values = ['{"filename": 5, "file_hash": "h1", "file_size": "12", "mime_type": [1]}',
              '{"filename": "a", "file_hash": "h2", "file_size": "x"}',
              '{"filename": "b", "file_hash": "h3", "file_size": 1.5, "mime_type": null}',
              '{"filename": "c", "file_hash": "h4", "file_size": [1]}', '{"file_hash": "h5"}']
    rows = [(f"k{i}", v, "image-uploads", 0, i, None) for i, v in enumerate(values)]
    jobs.process_batch(spark, spark.createDataFrame(rows, ENVELOPE), 0, cfg, clock=CLOCK)
    out = {r["key"]: json.loads(r["value"]) for r in read_topic(spark, cfg.output_topic, cfg.topic_root).collect()}
    for i, v in enumerate(values):
        sent = json.loads(v)
        assert {k: x for k, x in out[f"k{i}"].items() if k != "processed_at"} == {
            k: sent.get(k) for k in ("filename", "file_hash", "file_size", "mime_type")}
    letters = spark.read.parquet(f"{cfg.dead_letter_table}/processor").where("reason = 'bad_file_size'")
    assert {r["key"] for r in letters.collect()} >= {"k1", "k3"}
    assert {"h1", "h5"} <= {r["file_hash"] for r in spark.read.parquet(cfg.lake_table).collect()}


def test_refused_records_need_a_place(spark, scratch):
    cfg = _cfg(scratch)
    files = _files(spark, 3).withColumn("content", F.expr("cast(repeat('x', 3000) as binary)"))
    counters = jobs.produce_batch(files, 0, JobConfig(**{**cfg.__dict__, "max_message_bytes": 1000}), clock=CLOCK)
    assert (counters.produced, counters.too_large) == (0, 3)
    letters = spark.read.parquet(f"{cfg.dead_letter_table}/producer")
    assert all(r["value"].endswith(".jpg") for r in letters.collect())
    with pytest.raises(ValueError):
        jobs.start_processor(spark, JobConfig(topic_root=scratch), f"{scratch}/ck")


def test_as_of_reads_dates_and_iso_times(spark):
    log = fx.lake_change_log(spark, SF_SMALL)
    day = log.agg(F.min("committed_at")).first()[0]
    for ts in (day.date().isoformat(), day.isoformat(), day.isoformat(" ")):
        assert changelog.as_of(log, ts, fields=[]).count() > 0
    with pytest.raises(ValueError):
        changelog.as_of(log, "1999-01-01")


def test_missing_folder_is_an_empty_scan(spark, scratch):
    assert image_folder(spark, f"{scratch}/nowhere").count() == 0
    os.makedirs(f"{scratch}/in")
    with open(f"{scratch}/in/a.jpg", "wb") as fh:
        fh.write(b"x")
    assert image_folder(spark, f"file://{scratch}/in").count() == 1


@pytest.mark.parametrize("radius", [10.0, 5_000.0])
def test_pairs_round_the_pole(spark, radius):
    rows = [(i, 45.0 * i, 89.99999) for i in range(8)] + [(8, 10.0, -90.0), (9, 170.0, -89.99998), (10, 0.0, 0.0), (11, 0.00005, 0.0)]
    pts = spark.createDataFrame(rows, "id int, lon double, lat double").select("id", geo.make_point(F.col("lon"), F.col("lat")).alias("loc"))
    got = {(r["l_id"], r["r_id"]) for r in spatial.pairs_within(pts, "id", "loc", radius).collect()}
    assert got == {(i, j) for i in range(8) for j in range(i + 1, 8)} | {(8, 9), (10, 11)}


@pytest.fixture()
def many_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def _data_files(folder):
    return glob.glob(f"{folder}/**/*.parquet", recursive=True)


def test_a_small_insert_writes_few_files(spark, scratch, many_partitions):
    rows = spark.range(500).select(F.concat(F.lit("h"), "id").alias("file_hash"), F.lit("f").alias("filename"),
                                   *[F.lit(None).cast(t.dataType).alias(t.name) for t in PROCESSED_ROW if t.name not in ("file_hash", "filename")],
                                   F.lit(None).cast("timestamp_ntz").alias("kafka_timestamp"))
    kept = {k: spark.conf.get(k, None) for k in ("spark.sql.adaptive.enabled", "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning")}
    assert keyed.insert_first_wins(spark, rows, f"{scratch}/t", PROCESSED_ROW, processed.ARRIVAL_ORDER) == 500
    assert 1 <= len(_data_files(f"{scratch}/t")) < 16
    assert kept == {k: spark.conf.get(k, None) for k in kept}


def test_a_micro_batch_is_planned_by_its_size(spark, scratch, many_partitions):
    """A backlog is taken a fetch limit for each slot; the shuffles of a small batch have few partitions."""
    assert JobConfig().max_bytes_per_trigger is None
    assert topic_sources.fetch_bytes(spark) == MAX_FETCH_BYTES * spark.sparkContext.defaultParallelism
    cfg = _cfg(scratch)
    topics.write_topic(fx.event_envelopes(spark, SF_SMALL).repartition(3), cfg.input_topic, cfg.topic_root, batch=0)
    jobs.start_processor(spark, cfg, f"{scratch}/ck", available_now=True, clock=fx.PROCESSED_CLOCK).awaitTermination()
    assert spark.read.parquet(cfg.lake_table).select("batch").distinct().count() == 1
    assert 1 <= len(_data_files(cfg.processed_table)) < 16
