"""Streaming jobs: equal to the batch operators, restart-safe, fan-out idempotent on replay."""

import os
import time

import pytest

from pyspark.sql import functions as F

from lakelens.config import JobConfig
from lakelens.operators import processed
from lakelens.schemas import PROCESSED_FIELDS
from lakelens.sinks.batches import BatchRef, run_of
from lakelens.sinks import topics as topic_sinks
from lakelens.sources import fixtures as fx
from lakelens.sources.topics import read_topic
from lakelens.streaming import jobs
from conftest import SF_SMALL

CLOCK = "2024-03-01 00:00:00"


def _cfg(base, **kw):
    return JobConfig(topic_root=f"{base}/topics", object_root=f"{base}/objects",
                     metadata_table=f"{base}/t1", processed_table=f"{base}/t2", lake_table=f"{base}/t3",
                     dead_letter_table=f"{base}/dlq", **{"processor_starting_offsets": "earliest", **kw})


def _sorted(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_folder_producer_consumer_end_to_end(spark, scratch):
    watch = os.path.join(scratch, "incoming")
    os.makedirs(watch)
    payloads = {"a.jpg": b"one", "b.png": b"two", "c.gif": b"one", "d.txt": b"skip"}
    for name, data in payloads.items():
        with open(os.path.join(watch, name), "wb") as fh:
            fh.write(data)
    cfg = _cfg(scratch, watch_path=watch)
    jobs.start_producer(spark, cfg, f"{scratch}/ck_prod", available_now=True, clock=CLOCK).awaitTermination()
    topic = read_topic(spark, cfg.input_topic, cfg.topic_root)
    assert topic.count() == 3
    # a second file arrives; only it is sent (the checkpoint remembers the seen files)
    with open(os.path.join(watch, "e.webp"), "wb") as fh:
        fh.write(b"three")
    jobs.start_producer(spark, cfg, f"{scratch}/ck_prod", available_now=True, clock=CLOCK).awaitTermination()
    assert read_topic(spark, cfg.input_topic, cfg.topic_root).count() == 4
    jobs.start_consumer(spark, cfg, f"{scratch}/ck_cons", available_now=True, clock=CLOCK).awaitTermination()
    t1 = spark.read.parquet(cfg.metadata_table)
    assert sorted(r["filename"] for r in t1.collect()) == ["a.jpg", "b.png", "e.webp"]   # c.gif repeats a.jpg
    assert sorted(r["id"] for r in t1.collect()) == [1, 2, 3]
    from lakelens.sinks.objects import read_objects
    objs = {r["object_key"]: bytes(r["content"]) for r in read_objects(spark, cfg.object_root).collect()}
    assert objs["images/2024/03/01/c.gif"] == b"one" and len(objs) == 4


def test_consumer_restart_equals_one_run(spark, scratch):
    """Stop the consumer part-way, start it again on the same checkpoint: no loss, no duplicates."""
    cfg = _cfg(scratch)
    env = fx.document_envelopes(spark, SF_SMALL)
    # three topic folders, consumed one file per micro-batch
    for i, part in enumerate(env.randomSplit([1.0, 1.0, 1.0], seed=7)):
        topic_sinks.write_topic(part.coalesce(1), cfg.input_topic, cfg.topic_root, batch=i)
    stream = spark.readStream.schema(env.schema).option("recursiveFileLookup", "true") \
        .option("maxFilesPerTrigger", 1).json(f"{cfg.topic_root}/{cfg.input_topic}")
    seen = []

    def run(batch, batch_id):
        seen.append(batch_id)
        jobs.consume_batch(spark, batch, batch_id, cfg, strict=True, clock=CLOCK)

    ck = f"{scratch}/ck"
    q = stream.writeStream.foreachBatch(run).option("checkpointLocation", ck).trigger(processingTime="1 second").start()
    deadline = time.time() + 120
    while not seen and time.time() < deadline:
        time.sleep(0.5)
    q.stop()
    q2 = stream.writeStream.foreachBatch(run).option("checkpointLocation", ck).trigger(availableNow=True).start()
    q2.awaitTermination()
    # replay the last batch by hand: an idempotent sink must not add rows
    last = max(seen)
    jobs.consume_batch(spark, spark.read.schema(env.schema).json(
        f"{cfg.topic_root}/{cfg.input_topic}/{BatchRef.of(min(last, 2)).folder}"), last, cfg, strict=True, clock=CLOCK)
    t1 = spark.read.parquet(cfg.metadata_table)
    msgs = fx.document_messages(spark, SF_SMALL)
    assert t1.count() == msgs.select("file_hash").distinct().count()
    assert t1.select("file_hash").distinct().count() == t1.count()
    assert sorted(r["id"] for r in t1.collect()) == list(range(1, t1.count() + 1))


def test_processor_equals_batch_and_replay_is_idempotent(spark, scratch):
    cfg = _cfg(scratch)
    env = fx.event_envelopes(spark, SF_SMALL)
    topic_sinks.write_topic(env, cfg.input_topic, cfg.topic_root, batch=0)
    jobs.start_processor(spark, cfg, f"{scratch}/ck", available_now=True, clock=fx.PROCESSED_CLOCK).awaitTermination()
    batch = processed.processed_rows(processed.transform(env, F.lit(fx.PROCESSED_CLOCK).cast("timestamp_ntz")),
                                     keep_arrival=True)
    t3 = spark.read.parquet(cfg.lake_table)
    assert _sorted(t3, PROCESSED_FIELDS) == _sorted(batch, PROCESSED_FIELDS)
    t2 = spark.read.parquet(cfg.processed_table)
    assert _sorted(t2, PROCESSED_FIELDS) == _sorted(processed.upsert_rows(batch), PROCESSED_FIELDS)
    # replay batch 0: its T3 and topic folders are overwritten, T2 adds nothing
    n2, n3 = t2.count(), t3.count()
    ref = BatchRef("processor", run_of(spark, f"{scratch}/ck").id, 0)
    jobs.process_batch(spark, read_topic(spark, cfg.input_topic, cfg.topic_root), ref, cfg, clock=fx.PROCESSED_CLOCK)
    assert spark.read.parquet(cfg.lake_table).count() == n3
    assert spark.read.parquet(cfg.processed_table).count() == n2
    out = read_topic(spark, cfg.output_topic, cfg.topic_root)
    assert out.count() == env.where(F.col("value") != "not json").count()


def test_sinks_can_be_disabled(spark, scratch):
    cfg = _cfg(scratch, enable_postgres_sink=False, enable_iceberg_sink=False)
    topic_sinks.write_topic(fx.event_envelopes(spark, SF_SMALL), cfg.input_topic, cfg.topic_root, batch=0)
    jobs.start_processor(spark, cfg, f"{scratch}/ck", available_now=True, clock=fx.PROCESSED_CLOCK).awaitTermination()
    from lakelens.sinks.tables import table_exists
    assert not table_exists(spark, cfg.lake_table) and not table_exists(spark, cfg.processed_table)
    assert read_topic(spark, cfg.output_topic, cfg.topic_root).count() > 0


def test_batch_ingest_skips_known_and_counts(spark, scratch):
    from lakelens.schemas import IMAGE_METADATA
    cfg = _cfg(scratch)
    t1 = lambda: spark.read.schema(IMAGE_METADATA).parquet(cfg.metadata_table)
    files = fx.document_image_files(spark, SF_SMALL)
    first = jobs.run_batch_ingest(spark, cfg, f"{scratch}/ck", files=files, clock=CLOCK, as_of="2024-03-10")
    n = t1().count()
    assert first.inserted == n and first.produced == files.count()
    second = jobs.run_batch_ingest(spark, cfg, f"{scratch}/ck", files=files, clock=CLOCK, as_of="2024-03-10")
    assert second.produced == 0 and second.inserted == 0
    assert t1().count() == n
    third = jobs.run_batch_ingest(spark, cfg, f"{scratch}/ck", files=files.limit(0), clock=CLOCK, as_of="2024-05-01")
    assert third.expired_partitions >= 1
    assert t1().count() == 0


def test_value_decoder_and_record_hook(spark, scratch):
    """U3: a decoder Column function runs before parsing; U1: a pandas function maps record batches."""
    cfg = _cfg(scratch)
    env = fx.event_envelopes(spark, SF_SMALL).withColumn("value", F.base64(F.encode("value", "UTF-8")))
    jobs.process_batch(spark, env, 0, cfg, clock=fx.PROCESSED_CLOCK,
                       decoder=lambda v: F.decode(F.unbase64(v), "UTF-8"))
    plain = fx.event_envelopes(spark, SF_SMALL)
    t = processed.processed_rows(processed.transform(plain, F.lit(fx.PROCESSED_CLOCK).cast("timestamp_ntz")))
    assert spark.read.parquet(cfg.lake_table).count() == t.count()

    def upper(batches):
        for pdf in batches:
            yield pdf.assign(key=pdf["key"].str.upper())

    mapped = jobs.map_records(plain.select("key", "value"), upper, "key string, value string")
    assert mapped.where(F.col("key").rlike("[a-f]")).count() == 0


# ---------------------------------------------------------------- counters, state, append source

def test_counters_come_from_the_first_pass(spark):
    from lakelens.operators.frames import counted
    df, seen = counted(spark.range(100), n=F.count(F.lit(1)), odd=F.count_if(F.col("id") % 2 == 1))
    df = df.persist()
    try:
        assert df.where("id < 10").count() == 10  # fills the cache: the counts are those of all rows
        assert seen.get == {"n": 100, "odd": 50}
        assert df.count() == 100 and seen.get == {"n": 100, "odd": 50}
    finally:
        df.unpersist()


def test_counters_of_an_empty_batch(spark):
    from lakelens.operators.frames import counted
    df, seen = counted(spark.range(0), n=F.count(F.lit(1)))
    df = df.persist()
    assert df.count() == 0 and (seen.get.get("n") or 0) == 0
    df.unpersist()


def _arrivals(spark, rows):
    return spark.createDataFrame(rows, "k string, at int, v string").repartition(4)


def test_first_of_a_batch_in_arrival_order(spark):
    from lakelens.streaming import dedup
    rows = [(f"k{i % 37}", 1000 - i, str(i)) for i in range(500)] + [(None, 1, "a"), (None, 1, "a")]
    got = {(r.k, r.at, r.v) for r in dedup.first_seen(_arrivals(spark, rows), "k", ["at"]).collect()}
    want = {}
    for k, at, v in rows:
        if k and (k not in want or at < want[k][0]):
            want[k] = (at, v)
    assert got - {(None, 1, "a")} == {(k, *x) for k, x in want.items()}
    assert dedup.first_seen(_arrivals(spark, rows), "k", ["at"]).where("k IS NULL").count() == 2


def test_state_survives_a_restart(spark, scratch):
    from lakelens.streaming import dedup
    schema, source, out = "k string, at int, v string", f"{scratch}/in", f"{scratch}/out"
    batches = [[("a", 2, "second"), ("a", 1, "first"), ("b", 1, "b1")],
               [("a", 0, "late"), ("c", 5, "c5"), (None, 1, "n")],
               [("b", 9, "b9"), ("c", 1, "c1"), (None, 1, "n"), ("d", 1, "d1")]]
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(source)
        stream = dedup.first_seen(spark.readStream.schema(schema).json(source), "k", ["at"])
        assert stream.columns == ["k", "at", "v"]
        (stream.writeStream.format("parquet").option("checkpointLocation", f"{scratch}/ckpt").option("path", out)
         .outputMode("append").trigger(availableNow=True).start().awaitTermination())
        got = sorted(r.v for r in spark.read.parquet(out).collect())
        assert got == [["b1", "first"], ["b1", "c5", "first", "n"], ["b1", "c5", "d1", "first", "n", "n"]][n]


def _rows(spark, n, parts=3):
    return spark.range(n).repartition(parts).selectExpr(
        "concat('h', id) file_hash", "concat('f', id) filename", "id file_size", "'image/png' mime_type",
        "timestamp_ntz'2024-03-01 00:00:00' processed_at", "'t' kafka_topic", "cast(id % 3 AS int) kafka_partition",
        "id kafka_offset")


def test_append_source_commits_whole(spark, scratch):
    from lakelens.sinks import datasource
    table = f"{scratch}/t3"
    datasource.append(_rows(spark, 100), table)
    datasource.append(_rows(spark, 50), table, commit_id="c2")
    datasource.append(_rows(spark, 60), table, commit_id="c2")  # the same commit once more
    datasource.append(_rows(spark, 0), table, commit_id="none")
    assert datasource.committed(spark, table).count() == 160
    assert spark.read.parquet(table).where("commit = 'c2'").count() == 60
    held = datasource.manifests(table)
    assert held["commit=c2"]["rows"] == 60 == sum(held["commit=c2"]["files"].values())
    assert held["commit=none"] == {"files": {}, "rows": 0}
    assert datasource.committed(spark, table).schema.fieldNames() == _rows(spark, 1).columns


def test_append_source_leaves_no_rows_of_a_failed_write(spark, scratch):
    import os

    from lakelens.sinks import datasource
    table = f"{scratch}/t3"
    datasource.append(_rows(spark, 10), table)
    broken = _rows(spark, 1000, 8).withColumn("file_size", F.when(
        F.col("file_size") == 999, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("file_size")))
    with pytest.raises(Exception, match="lost"):
        datasource.append(broken, table)
    assert datasource.committed(spark, table).count() == 10
    assert len(datasource.manifests(table)) == 1
    assert not [f for _, _, files in os.walk(f"{table}/{datasource.STAGING}") for f in files]
    datasource.append(_rows(spark, 1000, 8), table)
    assert datasource.committed(spark, table).count() == 1010


def test_a_task_that_ends_after_the_abort_leaves_nothing(scratch):
    import os

    import pyarrow as pa

    from lakelens.sinks import datasource
    writer = datasource.AppendWriter({"path": f"{scratch}/s"})
    batch = pa.RecordBatch.from_pydict({"x": [1, 2]})
    writer.write(iter([batch]))

    def late():
        yield batch
        writer.abort([None])
        yield batch
    with pytest.raises(Exception):
        writer.write(late())
    with pytest.raises(RuntimeError, match="aborted"):
        writer.write(iter([batch]))
    assert not [f for _, _, files in os.walk(scratch) for f in files]


def test_staged_files_without_a_message_are_left_out(spark, scratch):
    """What a lost attempt staged is no part of the commit; a replayed batch replaces its folder."""
    import pyarrow as pa

    from lakelens.sinks import datasource
    batch = pa.RecordBatch.from_pydict({"x": [1, 2]})
    for _ in range(2):
        writer = datasource.AppendStreamWriter({"path": f"{scratch}/s", "commit_id": "run"})
        writer.write(iter([batch]))  # an attempt whose message never arrives
        good, empty = writer.write(iter([batch, batch])), writer.write(iter([]))
        again = datasource.AppendStreamWriter({"path": f"{scratch}/s", "commit_id": "run"})
        again.commit([good, None, empty], 7)
    assert datasource.manifests(f"{scratch}/s")["commit=run-000000000007"]["rows"] == 4
    assert spark.read.parquet(f"{scratch}/s").count() == 4
    writer.write(iter([batch]))
    writer.abort([None], 8)
    assert spark.read.parquet(f"{scratch}/s").count() == 4
