"""Keyed table with first-wins inserts whose probe follows the batch, not the table.

Two levels, both plain Parquet below the table's path:

* ``level=0/commit=<n>``: the rows of one insert, as they came;
* ``level=1/commit=<n>/key_bucket=<k>``: the rows of all inserts up to ``n`` since the last merge,
  by a hash of the key.

An insert looks its keys up in the few recent commits of level 0 and in its own keys' buckets of
level 1, which partition pruning picks; ``merge`` moves level 0 to level 1 once it has many
commits.  Readers leave out the commits of level 0 that level 1 contains.

Inserts are serialised by numbered claims (exclusively created files): a writer takes the next
number, waits until the claims before it are done, and only then probes and writes; its rows
appear by one rename.  So two writers cannot both insert a key.  The claim of a writer that
died is closed after ``lease_seconds``; a writer whose claim was closed does not commit.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelens.operators import metadata
from lakelens.operators.joins import anti_join_keys
from lakelens.session import adaptive, file_system
from lakelens.sinks.batches import create_marker, delete_marker, markers

LOG, STAGING = "_log", "_staging"
LEVEL, COMMIT, BUCKET = "level", "commit", "key_bucket"
BUCKETS = 256
#: commits of level 0 that a merge gathers
MERGE_COMMITS = 32
LEASE_SECONDS, POLL_SECONDS = 600.0, 0.2


class ClaimLost(RuntimeError):
    """The claim was closed by another writer before this one committed."""


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _log(path: str) -> str:
    return f"{path.rstrip('/')}/{LOG}"


def _bucket_count(spark: SparkSession, path: str, wanted: int) -> int:
    """The table's number of buckets, fixed by its first insert."""
    while True:
        for name in markers(spark, _log(path)):
            if name.startswith("buckets="):
                return int(name.split("=")[1])
        create_marker(spark, _log(path), f"buckets={wanted}")


def _commits(spark: SparkSession, path: str, level: int) -> list[int]:
    """Commit numbers of a level."""
    return [int(m.split("=")[1]) for m in markers(spark, f"{path.rstrip('/')}/{LEVEL}={level}") if m.startswith(f"{COMMIT}=")]


def _claim(spark: SparkSession, path: str) -> int:
    while True:
        taken = [int(m.split(".")[0]) for m in markers(spark, _log(path)) if m[0].isdigit()]
        n = 1 + max([0, *taken, *_commits(spark, path, 0), *_commits(spark, path, 1)])
        if create_marker(spark, _log(path), f"{n:012d}.claim"):
            # a later claim may have been closed since the listing, and the mark of this number dropped with it
            if not any(m.endswith(".done") and int(m[:12]) >= n for m in markers(spark, _log(path))):
                return n
            delete_marker(spark, _log(path), f"{n:012d}.claim")


def _open_claims(spark: SparkSession, path: str, before: int) -> list[int]:
    held = markers(spark, _log(path))
    done = {m[:12] for m in held if m.endswith(".done")}
    return [int(m[:12]) for m in held if m.endswith(".claim") and m[:12] not in done and int(m[:12]) < before]


def _wait_turn(spark: SparkSession, path: str, n: int, lease_seconds: float) -> None:
    """Until every earlier claim is done; those older than the lease are closed."""
    while True:
        pending = _open_claims(spark, path, n)
        if not pending:
            return
        for m in pending:
            fs, claim = file_system(spark, f"{_log(path)}/{m:012d}.claim")
            if fs.exists(claim) and time.time() * 1000 - fs.getFileStatus(claim).getModificationTime() > lease_seconds * 1000:
                create_marker(spark, _log(path), f"{m:012d}.done")
        time.sleep(POLL_SECONDS)


def _close(spark: SparkSession, path: str, n: int) -> None:
    """Mark claim ``n`` as done and drop the marks of the claims before it."""
    create_marker(spark, _log(path), f"{n:012d}.done")
    for name in markers(spark, _log(path)):
        if name[0].isdigit() and int(name[:12]) < n:
            delete_marker(spark, _log(path), name)


def _publish(spark: SparkSession, path: str, n: int, staged: str, level: int) -> None:
    """Rename ``staged`` to commit ``n`` of ``level``, unless the claim was closed."""
    if f"{n:012d}.done" in markers(spark, _log(path)):
        raise ClaimLost(f"claim {n} of {path}")
    fs, place = file_system(spark, f"{path.rstrip('/')}/{LEVEL}={level}/{COMMIT}={n}")
    fs.mkdirs(place.getParent())
    if not fs.rename(file_system(spark, staged)[1], place):
        raise RuntimeError(f"could not rename {staged}")


def read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows of the table (columns of ``schema``); no rows while it does not exist."""
    return _stored(spark, path, schema).select(*schema.fieldNames())


def _stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    marks = T.StructType([T.StructField(LEVEL, T.IntegerType()), T.StructField(COMMIT, T.LongType()),
                          T.StructField(BUCKET, T.IntegerType())])
    full = T.StructType(schema.fields + marks.fields)
    if not _commits(spark, path, 0) and not _commits(spark, path, 1):
        return spark.createDataFrame([], full)
    merged = max(_commits(spark, path, 1), default=0)
    return spark.read.schema(full).parquet(path).where((F.col(LEVEL) == 1) | (F.col(COMMIT) > merged))


def probe(spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: list[int]) -> DataFrame:
    """The stored keys among which those of ``buckets`` are: recent commits, and these buckets of level 1."""
    stored = _stored(spark, path, schema)
    return stored.where((F.col(LEVEL) == 0) | F.col(BUCKET).isin(buckets)).select(key)


def insert_first_wins(spark: SparkSession, rows: DataFrame, path: str, schema: T.StructType, order_cols: list[str],
                      key: str = "file_hash", buckets: int = BUCKETS, lease_seconds: float = LEASE_SECONDS) -> int:
    """``INSERT ... ON CONFLICT (key) DO NOTHING`` of one batch in one commit; rows added.

    Of the batch's rows of one key the first in ``order_cols`` counts.  Rows of null key conflict
    with nothing but each other.  Replaying a batch adds nothing.
    """
    with adaptive(rows):  # the cache of a small batch gets few partitions, and its commit few files
        return _insert(spark, rows, path, schema, order_cols, key, buckets, lease_seconds)


def _insert(spark: SparkSession, rows: DataFrame, path: str, schema: T.StructType, order_cols: list[str],
            key: str, buckets: int, lease_seconds: float) -> int:
    first = metadata.first_wins(rows, key, order_cols).persist()
    n = 0
    try:
        buckets = _bucket_count(spark, path, buckets)
        mine = [r[0] for r in first.select(bucket_of(key, buckets)).distinct().collect()]  # a number a bucket at most
        if not mine:
            return 0
        n = _claim(spark, path)
        _wait_turn(spark, path, n, lease_seconds)
        new = anti_join_keys(first, probe(spark, path, schema, key, mine), key, probe=True)
        staged = f"{path.rstrip('/')}/{STAGING}/{uuid.uuid4().hex}"
        new.select(*schema.fieldNames()).write.parquet(f"{staged}/{BUCKET}=-1")
        added = spark.read.schema(schema).parquet(f"{staged}/{BUCKET}=-1").count()
        if added:
            _publish(spark, path, n, staged, 0)
    finally:
        if n:
            _close(spark, path, n)
        first.unpersist()
    if len(_commits(spark, path, 0)) >= MERGE_COMMITS:
        merge(spark, path, schema, key, lease_seconds)
    return added


def merge(spark: SparkSession, path: str, schema: T.StructType, key: str = "file_hash",
          lease_seconds: float = LEASE_SECONDS) -> int:
    """Move level 0 to level 1; returns the number of commits moved.

    Rows of level 1 are not read.  A reader sees the new run instead of the commits that it
    contains from the rename on; these are removed afterwards, by the next merge if this one dies.
    """
    n = _claim(spark, path)
    try:
        _wait_turn(spark, path, n, lease_seconds)
        merged = max(_commits(spark, path, 1), default=0)
        moved = [c for c in _commits(spark, path, 0) if c > merged]
        if moved:
            buckets = _bucket_count(spark, path, BUCKETS)
            staged = f"{path.rstrip('/')}/{STAGING}/{uuid.uuid4().hex}"
            (_stored(spark, path, schema).where(F.col(LEVEL) == 0).select(*schema.fieldNames())
             .withColumn(BUCKET, bucket_of(key, buckets)).repartition(BUCKET).sortWithinPartitions(BUCKET, key)
             .write.partitionBy(BUCKET).parquet(staged))
            _publish(spark, path, n, staged, 1)
        for c in [c for c in _commits(spark, path, 0) if c < n]:
            fs, folder = file_system(spark, f"{path.rstrip('/')}/{LEVEL}=0/{COMMIT}={c}")
            fs.delete(folder, True)
        return len(moved)
    finally:
        _close(spark, path, n)
