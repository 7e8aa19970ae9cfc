"""Change-log lake table: state, time travel, snapshots, DML, expiry, compaction, and written tables."""

import pathlib
import re

import pytest
from pyspark.sql import functions as F

from lakelens.operators import changelog
from lakelens.schemas import LAKE_FIELDS
from lakelens.sinks import tables
from lakelens.sinks.batches import BatchRef
from lakelens.sources import fixtures as fx
from conftest import SF_CHECK, SF_SMALL


def _rows(df, cols=("id", "mime_type", "uploaded_at")):
    return sorted(tuple(r) for r in df.select(*cols).collect())


@pytest.fixture(scope="module")
def log(spark):
    return fx.lake_change_log(spark, SF_SMALL).persist()


def test_stored_log_equals_operator_built_log(spark, log):
    cols = LAKE_FIELDS + ["uploaded_day", "commit_id", "committed_at", "op"]
    assert _rows(log, cols) == _rows(fx.lake_change_log_via_operators(spark, SF_SMALL), cols)


def test_as_of_latest_equals_current(log):
    assert _rows(changelog.as_of(log, "2030-01-01 00:00:00")) == _rows(changelog.current_state(log))


def test_as_of_many_equals_single_probes(log):
    probes = ["2024-01-10 00:00:00", "2024-02-01 12:00:00"]
    many = changelog.as_of_many(log, probes)
    for ts in probes:
        one = changelog.as_of(log, ts)
        assert _rows(many.where(F.col("as_of_ts") == F.lit(ts).cast("timestamp_ntz"))) == _rows(one)
    with pytest.raises(ValueError):
        changelog.as_of_many(log, ["2023-01-01 00:00:00"] + probes)


def test_as_of_before_first_commit_fails(log):
    with pytest.raises(Exception, match="no snapshot"):
        changelog.as_of(log, "2023-12-31 00:00:00")


def test_update_then_delete_semantics(log):
    cur = changelog.current_state(log)
    assert cur.where(F.col("mime_type") == "image/jpg").count() == 0
    assert cur.where(F.col("uploaded_at") < "2024-01-05").count() == 0
    before = changelog.as_of(log, "2024-02-01 11:59:59")
    assert before.where(F.col("mime_type") == "image/jpg").count() > 0


def test_compact_keeps_row_set(log):
    assert _rows(changelog.compact(log), LAKE_FIELDS + ["commit_id", "op"]) == _rows(log, LAKE_FIELDS + ["commit_id", "op"])


def test_expire_keeps_reads_after_cutoff(log):
    cutoff = "2024-01-20 00:00:00"
    expired = changelog.expire(log, cutoff)
    n_commits = lambda df: df.select("commit_id").distinct().count()
    assert n_commits(expired) < n_commits(log)
    later = changelog.expire(log, "2024-02-01 13:00:00")
    assert later.count() < log.count()
    assert _rows(changelog.current_state(later)) == _rows(changelog.current_state(log))
    for ts in ("2024-01-25 00:00:00", "2024-02-01 12:00:00", "2030-01-01 00:00:00"):
        assert _rows(changelog.as_of(expired, ts)) == _rows(changelog.as_of(log, ts))
    with pytest.raises(Exception, match="no snapshot"):
        changelog.as_of(expired, "2024-01-10 00:00:00")


def test_moving_update_keeps_day_pruned_reads_right(spark, log):
    cur = changelog.current_state(log)
    one = cur.where(F.col("uploaded_at") >= "2024-01-11").orderBy("id").limit(1).select("id").first()[0]
    moved = changelog.update_rows(log, F.col("id") == one, {"uploaded_at": F.lit("2024-01-25 10:00:00").cast("timestamp_ntz")},
                                  200, "2024-02-03 00:00:00")
    assert sorted(r["op"] for r in moved.collect()) == ["unlink", "update"]
    log2 = log.unionByName(moved)
    old_day = cur.where(F.col("id") == one).select(F.to_date("uploaded_at")).first()[0].isoformat()
    nxt = changelog.day_range(log2, old_day, "2024-01-31")
    full = changelog.current_state(log2).where(F.col("uploaded_at") >= old_day)
    assert _rows(nxt) == _rows(full)


def test_written_table_roundtrip(spark, scratch):
    path = f"{scratch}/images"
    images = fx.lake_images(spark, SF_SMALL)
    first = tables.append_lake(spark, images, path, "2024-02-01 00:00:00")
    second = tables.update_lake(spark, path, F.col("mime_type") == "image/jpg", {"mime_type": F.lit("image/jpeg")},
                                "2024-02-01 12:00:00")
    third = tables.delete_lake(spark, path, F.col("uploaded_at") < F.lit("2024-01-05").cast("date"),
                               "2024-02-02 00:00:00")
    assert (first, second, third) == (1, 2, 3)
    log = spark.read.parquet(path)
    cur = changelog.current_state(log)
    assert cur.where(F.col("mime_type") == "image/jpg").count() == 0
    snaps = changelog.snapshots(log).collect()
    assert [s["operation"] for s in snaps] == ["delete", "overwrite", "append"]
    day = changelog.day_range(log, "2024-01-11", "2024-01-12")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*uploaded_day[^\]]*>= 2024-01-11", plan), plan
    assert day.count() == log.where("uploaded_day = '2024-01-11'").select("id").distinct().count()
    out = f"{scratch}/images_compact"
    tables.rewrite_lake(spark, path, out, max_records_per_file=200)
    assert _rows(changelog.current_state(spark.read.parquet(out))) == _rows(cur)
    files = changelog.file_listing(spark.read.parquet(out), "uploaded_at")
    assert files.agg(F.max("record_count")).first()[0] <= 200


def test_append_batch_is_idempotent(spark, scratch):
    path = f"{scratch}/t3"
    rows = spark.range(10).select(F.col("id").alias("x"))
    for batch in (7, 7, 8, BatchRef("other", "r1", 7)):
        tables.append_batch(rows, path, batch)
    assert spark.read.parquet(path).count() == 30


def test_append_batch_replaces_a_half_committed_batch(spark, scratch):
    """A batch that died after part of its files is whole after its replay."""
    path, ref = f"{scratch}/t3", BatchRef("processor", "r1", 3)
    rows = spark.range(100).repartition(4).select(F.col("id").alias("x"))
    tables.append_batch(rows, path, ref)
    parts = sorted(pathlib.Path(f"{path}/{ref.folder}").glob("part-*"))
    for part in parts[1:]:
        part.unlink()
    assert spark.read.parquet(path).count() < 100
    tables.append_batch(rows, path, ref)
    assert sorted(r["x"] for r in spark.read.parquet(path).collect()) == list(range(100))


def test_bucketed_lake_table_resolves_without_shuffle(spark):
    name = "lake_bucketed_test"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    log = fx.lake_change_log(spark, SF_SMALL)
    tables.commit_lake_table(spark, log, name, buckets=8)
    table = spark.table(name)
    cur = changelog.current_state(table)
    plan = cur._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan, plan
    assert _rows(cur) == _rows(changelog.current_state(log))
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_sql_views_run_lake_queries(spark, scratch):
    from lakelens.plans import queries as q
    from lakelens.plans.sql_views import register_as_of_view, register_lake_views
    path = f"{scratch}/lake"
    tables.commit_lake(spark, fx.lake_change_log(spark, SF_SMALL), path)
    log = spark.read.parquet(path)
    views = register_lake_views(spark, log, "images")
    assert "images_files" in views
    daily = spark.sql("""
        SELECT DATE(uploaded_at) AS upload_date, COUNT(*) AS image_count,
               SUM(file_size) / 1024 / 1024 AS total_size_mb
        FROM images GROUP BY DATE(uploaded_at) ORDER BY upload_date DESC""")
    assert sorted(map(tuple, daily.collect())) == sorted(map(tuple, q.daily_volume(spark, SF_SMALL).collect()))
    rng = spark.sql("SELECT * FROM images WHERE uploaded_at >= DATE '2024-01-11' AND uploaded_at < DATE '2024-01-12'")
    assert rng.count() == q.lake_partition_range(spark, SF_SMALL).count()
    snaps = spark.sql("SELECT * FROM images_snapshots ORDER BY committed_at DESC").first()
    assert snaps["snapshot_id"] == 102 and snaps["operation"] == "delete"
    register_as_of_view(spark, log, "2024-01-10 00:00:00", "images_at")
    assert spark.sql("SELECT COUNT(*) FROM images_at").first()[0] == \
        changelog.as_of(log, "2024-01-10 00:00:00").count()
    assert spark.sql("SELECT SUM(record_count) FROM images_files").first()[0] == log.count()


def test_named_fields_prune_scan_and_shuffle(spark, log):
    """Resolving only the fields a query reads keeps unread columns out of the scan and the shuffle."""
    from lakelens.plans import queries
    # sf0.01: the module's cached sf0.001 log would replace the scan in this plan
    plan = queries.daily_volume(spark, SF_CHECK)._jdf.queryExecution().executedPlan().toString()
    assert "props" not in plan and "sha2" not in plan and "s3_path" not in plan
    narrow = changelog.current_state(log, fields=["uploaded_at", "file_size"])
    assert narrow.columns == ["id", "file_size", "uploaded_at", "op"]
    assert _rows(narrow, ("id", "uploaded_at", "file_size")) == _rows(
        changelog.current_state(log), ("id", "uploaded_at", "file_size"))


def test_stored_table_reads_and_deletes_prune_days(spark, scratch):
    from lakelens.plans import stored_queries
    day = stored_queries.lake_stored_range(spark, SF_SMALL)
    assert re.search(r"PartitionFilters: \[[^\]]*uploaded_day[^\]]*>= 2024-01-11", day._jdf.queryExecution().executedPlan().toString())
    path = f"{scratch}/images"
    tables.commit_lake(spark, fx.lake_change_log(spark, SF_SMALL), path)
    before = F.lit("2024-01-05").cast("date")
    gone = changelog.delete_rows(spark.read.parquet(path), F.col("uploaded_at") < before, 300, "2024-02-09 00:00:00",
                                 days=F.col("uploaded_day") < before)
    assert re.search(r"PartitionFilters: \[[^\]]*uploaded_day[^\]]*< 2024-01-05", gone._jdf.queryExecution().executedPlan().toString())
    files = [p for p in pathlib.Path(path).rglob("*.parquet")]
    assert len(files) <= 2 * len({p.parent for p in files})  # a commit does not write a file per task and day


# ---------------------------------------------------------------- stored table: DML, footers, generations

def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_update_reads_whole_rows_of_hit_days_only(spark, log, scratch):
    path, cols = f"{scratch}/images", LAKE_FIELDS + ["uploaded_day", "commit_id", "committed_at", "op"]
    tables.commit_lake(spark, log, path)
    stored = spark.read.parquet(path)
    day = F.lit("2024-01-11").cast("date")
    predicate = (F.col("mime_type") == "image/png") & (F.to_date("uploaded_at") == day)
    assign = {"file_size": F.col("file_size") + 1, "uploaded_at": F.col("uploaded_at") + F.expr("INTERVAL 1 DAY")}
    want = changelog.update_rows(stored, predicate, assign, 300, "2024-02-04 00:00:00")
    got = changelog.update_rows_by_day(stored, predicate, assign, 300, "2024-02-04 00:00:00")
    assert _rows(got, cols) == _rows(want, cols) and got.count() > 0
    plan = _plan(got)
    assert re.search(r"PartitionFilters: \[[^\]]*uploaded_day[^\]]*2024-01-11", plan), plan
    narrow = _plan(changelog.matching_versions(stored, F.col("mime_type") == "image/png"))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", narrow)
    assert schemas and all({c.split(":")[0] for c in x.split(",")} <= {"id", "commit_id", "op", "mime_type"} for x in schemas), narrow
    # no hit, and hits only among superseded versions
    none = changelog.update_rows_by_day(stored, F.col("mime_type") == "nothing", assign, 301, "2024-02-04 00:00:00")
    assert none.count() == 0
    old = changelog.update_rows_by_day(stored, F.col("mime_type") == "image/jpg", assign, 301, "2024-02-04 00:00:00")
    assert old.count() == 0


def test_matching_versions_takes_the_newest(spark, log):
    predicate = F.col("file_size") % 3 == 0
    want = changelog.current_state(log).where(predicate)
    got = changelog.matching_versions(log, predicate)
    assert _rows(got, ("id", "commit_id")) == _rows(want, ("id", "commit_id"))


def test_footer_listing_equals_scan(spark, log, scratch):
    from lakelens.sources import footers
    path = f"{scratch}/images"
    odd = log.limit(1).withColumn("uploaded_at", F.lit(None).cast("timestamp_ntz")).withColumn("uploaded_day", F.lit(None).cast("date"))
    tables.commit_lake(spark, log.unionByName(odd), path, max_records_per_file=50)
    listing = footers.file_listing(spark, path)
    plan = _plan(spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length"))
    assert "content" not in plan
    rows = {"/".join(r.file_path.split("/")[-2:]): r for r in listing.collect()}
    scan = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("size")).agg(
        F.count(F.lit(1)).alias("n"), F.min("id").alias("id_low"), F.max("id").alias("id_high"),
        F.min("uploaded_at").alias("at_low"), F.max("op").alias("op_high"), F.first("uploaded_day").alias("day")).collect()
    assert len(scan) == len(rows) > 30
    for s in scan:
        r = rows["/".join(s.f.split("/")[-2:])]
        assert (r.record_count, r.file_size_in_bytes) == (s.n, s["size"])
        assert (int(r.lower_bounds["id"]), int(r.upper_bounds["id"]), r.upper_bounds["op"]) == (s.id_low, s.id_high, s.op_high)
        assert r.partition == {"uploaded_day": None if s.day is None else s.day.isoformat()}
        assert r.null_counts["width"] == s.n and "width" not in r.lower_bounds
        assert r.lower_bounds.get("uploaded_at") == (None if s.at_low is None else s.at_low.isoformat(" "))
    empty = f"{scratch}/none"
    pathlib.Path(empty).mkdir()
    assert footers.file_listing(spark, empty).count() == 0


def _files_by_day(path):
    out = {}
    for f in pathlib.Path(path).rglob("*.parquet"):
        out.setdefault(f.parent.name, set()).add(str(f))
    return out


@pytest.fixture()
def by_generation(spark, log, scratch):
    from lakelens.sinks import generations
    path = f"{scratch}/gens"
    generations.commit(spark, log.where("commit_id < 101"), path)
    generations.commit(spark, log.where("commit_id >= 101"), path)
    return path


def test_rewrite_touches_the_chosen_days_only(spark, log, by_generation):
    from lakelens.sinks import generations
    path, cols = by_generation, LAKE_FIELDS + ["uploaded_day", "commit_id", "committed_at", "op"]
    assert _rows(generations.read(spark, path), cols) == _rows(log, cols)
    before = _files_by_day(path)
    days = generations.choose_days(spark, path, stale_share=0.0, spare_files=1000)
    stale = {r[0] for r in log.where("op <> 'append'").select("uploaded_day").distinct().collect()}
    assert set(days) == stale
    chosen = sorted(days)[:5]
    n = generations.rewrite_days(spark, path, chosen)
    assert n == 1 and _rows(generations.read(spark, path), cols) == _rows(log, cols)
    generations.vacuum(spark, path)
    after = _files_by_day(path)
    rewritten = {f"uploaded_day={d}" for d in chosen}
    for day, files in before.items():
        assert (after[day] & files == set() and all("gen=1" in f for f in after[day])) if day in rewritten else after[day] == files
    assert _rows(generations.read(spark, path), cols) == _rows(log, cols)
    assert generations.rewrite_days(spark, path, []) == 0


def test_rewrite_with_expiry_and_later_commits(spark, log, by_generation):
    from lakelens.sinks import generations
    path = by_generation
    days = generations.choose_days(spark, path, stale_share=0.0, spare_files=1000)
    generations.rewrite_days(spark, path, days, cutoff="2024-02-03 00:00:00")
    left = generations.read(spark, path)
    assert _rows(changelog.current_state(left)) == _rows(changelog.current_state(log)) and left.count() < log.count()
    # a commit after the rewrite is seen, rewritten again, and the older generation goes
    more = changelog.update_rows(left, F.col("mime_type") == "image/png", {"mime_type": F.lit("image/x")}, 400, "2024-03-01 00:00:00")
    want = _rows(changelog.current_state(left.unionByName(more)))
    generations.commit(spark, more, path)
    assert _rows(changelog.current_state(generations.read(spark, path))) == want
    assert generations.rewrite_days(spark, path, days) == 2
    assert generations.vacuum(spark, path) > 0
    assert _rows(changelog.current_state(generations.read(spark, path))) == want
    assert not [f for files in _files_by_day(path).values() for f in files if "gen=1/" in f]


def test_driver_lost_before_the_switch(spark, log, by_generation):
    from datetime import datetime, timedelta, timezone

    from lakelens.sinks import generations
    path, cols = by_generation, LAKE_FIELDS + ["commit_id", "op"]
    days = generations.choose_days(spark, path, stale_share=0.0, spare_files=1000)
    assert generations.rewrite_days(spark, path, days, switch=False) == 1
    assert _rows(generations.read(spark, path), cols) == _rows(log, cols)
    generations.vacuum(spark, path)  # may be a rewrite that still runs
    assert any("gen=1/" in f for files in _files_by_day(path).values() for f in files)
    later = datetime.now(timezone.utc).replace(tzinfo=None) + timedelta(hours=1)
    generations.vacuum(spark, path, orphans_before=later)
    assert not any("gen=1/" in f for files in _files_by_day(path).values() for f in files)
    assert generations.rewrite_days(spark, path, days) == 2
    assert _rows(generations.read(spark, path), cols) == _rows(log, cols)


def test_second_of_two_rewrites_of_a_day_is_void(spark, log, by_generation):
    from lakelens.sinks import generations
    path, cols = by_generation, LAKE_FIELDS + ["commit_id", "op"]
    day = sorted(r[0] for r in log.select("uploaded_day").distinct().collect())[0]
    for _ in (1, 2):  # both start from generation 0
        generations.rewrite_days(spark, path, [day], switch=False)
    for n in (1, 2):
        generations.write_text(spark, f"{path}/{generations.FOLDER}", f"{n:012d}.json", f'{{"{day}": [0, 102]}}')
    assert generations.current(spark, path)[day.isoformat()].gen == 1
    assert _rows(generations.read(spark, path), cols) == _rows(log, cols)


# ---------------------------------------------------------------- keyed table

def _keyed_rows(spark, ids, tag):
    return spark.createDataFrame([(f"h{i}", f"{tag}{i}", i) for i in ids], "file_hash string, filename string, file_size long")


def _keyed_schema(spark):
    return _keyed_rows(spark, [], "").schema


def test_probe_follows_the_batch(spark, scratch):
    from lakelens.sinks import keyed
    path, schema = f"{scratch}/t2", _keyed_schema(spark)
    insert = lambda rows: keyed.insert_first_wins(spark, rows, path, schema, ["filename"], buckets=64)
    assert insert(_keyed_rows(spark, range(3000), "a")) == 3000
    assert insert(_keyed_rows(spark, range(2900, 3100), "b")) == 100
    assert keyed.merge(spark, path, schema) == 2 and keyed.merge(spark, path, schema) == 0
    assert insert(_keyed_rows(spark, range(10), "c")) == 0
    few = _keyed_rows(spark, [5, 9999], "d")
    mine = [r[0] for r in few.select(keyed.bucket_of("file_hash", 64)).distinct().collect()]
    probe = keyed.probe(spark, path, schema, "file_hash", mine)
    files = {f.rsplit("/", 2)[1] for f in probe.select(F.input_file_name()).distinct().toPandas().iloc[:, 0]}
    assert files == {f"key_bucket={b}" for b in mine}
    assert re.search(r"PartitionFilters: \[[^\]]*key_bucket", _plan(probe))
    assert insert(few) == 1
    got = keyed.read(spark, path, schema)
    assert got.count() == 3101 == got.select("file_hash").distinct().count()
    assert got.where("filename LIKE 'b%'").count() == 100 and got.where("filename LIKE 'd%'").count() == 1
    assert spark.read.parquet(path).count() == 3101  # without the module as well


def test_number_of_a_dropped_claim_is_not_taken_again(spark, scratch, monkeypatch):
    from lakelens.sinks import keyed
    path, commits, others = f"{scratch}/t", keyed._commits, [1, 2]

    def meanwhile(*args):
        while others:  # claimed and closed between this writer's two listings
            n = others.pop(0)
            assert keyed.create_marker(spark, keyed._log(path), f"{n:012d}.claim")
            keyed._close(spark, path, n)
        return commits(*args)
    monkeypatch.setattr(keyed, "_commits", meanwhile)
    assert keyed._claim(spark, path) == 3


def test_two_writers_insert_each_key_once(spark, scratch):
    from concurrent.futures import ThreadPoolExecutor

    from lakelens.sinks import keyed
    path, schema = f"{scratch}/t2", _keyed_schema(spark)
    batches = [(w, b) for b in range(3) for w in ("x", "y")]

    def insert(job):
        w, b = job
        return keyed.insert_first_wins(spark, _keyed_rows(spark, range(b * 40, b * 40 + 60), w), path, schema, ["filename"])
    with ThreadPoolExecutor(4) as pool:
        added = sum(pool.map(insert, batches))
    got = keyed.read(spark, path, schema)
    assert added == 140 == got.count() == got.select("file_hash").distinct().count()


def test_claim_of_a_dead_writer(spark, scratch):
    from lakelens.sinks import keyed
    from lakelens.sinks.batches import create_marker
    path, schema = f"{scratch}/t2", _keyed_schema(spark)
    dead = keyed._claim(spark, path)
    assert keyed.insert_first_wins(spark, _keyed_rows(spark, range(5), "a"), path, schema, ["filename"], lease_seconds=0.5) == 5
    with pytest.raises(keyed.ClaimLost):
        create_marker(spark, f"{path}/{keyed.LOG}", f"{dead:012d}.done")
        keyed._publish(spark, path, dead, f"{path}/_staging/none", 0)
    assert keyed.insert_first_wins(spark, _keyed_rows(spark, range(7), "b"), path, schema, ["filename"]) == 2


def test_merge_that_died_after_its_rename(spark, scratch):
    import shutil

    from lakelens.sinks import keyed
    path, schema = f"{scratch}/t2", _keyed_schema(spark)
    for n in (3, 6):
        keyed.insert_first_wins(spark, _keyed_rows(spark, range(n), "a"), path, schema, ["filename"])
    shutil.copytree(f"{path}/level=0", f"{scratch}/saved")
    keyed.merge(spark, path, schema)
    shutil.copytree(f"{scratch}/saved", f"{path}/level=0", dirs_exist_ok=True)  # the commits are still there
    assert keyed.read(spark, path, schema).count() == 6
    assert keyed.insert_first_wins(spark, _keyed_rows(spark, range(8), "b"), path, schema, ["filename"]) == 2
    assert keyed.merge(spark, path, schema) == 1
    assert keyed.read(spark, path, schema).count() == 8
