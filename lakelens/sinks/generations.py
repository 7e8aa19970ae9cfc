"""Upkeep of a lake table in place, by day: rewritten days go to a new generation, one marker switches to it.

Layout: ``<table>/gen=0/<day>/`` takes every commit.  A rewrite of some days (compaction, with
expiry if a cutoff is given) writes them to ``gen=<n>``, where no reader looks yet.  The marker
``_generations/<n>.json`` then names the days, the generation each was read from and the last
commit it contains; it appears by a rename, so the switch is whole or has not happened, and a
driver that dies before leaves nothing but an unread folder.  Readers take a day's current
generation, plus the commits after it from ``gen=0``.  Two rewrites of one day: the marker whose
starting generation is no longer the day's is void for that day.

Files of days that are not rewritten stay as they are.  ``vacuum`` removes what no reader needs.
"""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakelens.operators import changelog
from lakelens.schemas import LAKE_LOG_FIELDS, PARTITION_COLUMN
from lakelens.session import file_system
from lakelens.sinks.batches import create_marker, markers, read_text, write_text

GEN, FOLDER = "gen", "_generations"
#: bytes of a data file that a rewrite aims at
TARGET_BYTES = 128 << 20
NO_DAY = "none"


@dataclass(frozen=True)
class Current:
    """A day's generation and the last commit in it."""

    gen: int
    upto: int


def _day_text(day: dt.date | None) -> str:
    return NO_DAY if day is None else day.isoformat()


def current(spark: SparkSession, path: str) -> dict[str, Current]:
    """Day (text) -> generation of the rewritten days, from the markers in their order."""
    out: dict[str, Current] = {}
    for name in markers(spark, f"{path}/{FOLDER}"):
        if not name.endswith(".json"):
            continue
        for day, (base, upto) in json.loads(read_text(spark, f"{path}/{FOLDER}/{name}")).items():
            if out.get(day, Current(0, 0)).gen == base:
                out[day] = Current(int(name[:-5]), upto)
    return out


def commit(spark: SparkSession, change_rows: DataFrame, path: str) -> None:
    """Append one commit's change rows."""
    rows = changelog.compact(change_rows.select(*LAKE_LOG_FIELDS)).withColumn(GEN, F.lit(0))
    rows.write.mode("append").partitionBy(GEN, PARTITION_COLUMN).parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The table's change log as it stands."""
    stored = spark.read.parquet(path)
    return _visible(stored, current(spark, path)).select(*LAKE_LOG_FIELDS)


def _visible(stored: DataFrame, days: dict[str, Current]) -> DataFrame:
    """Rows of each day's generation, and of rewritten days the later commits in ``gen=0``."""
    if not days:
        return stored.where(F.col(GEN) == 0)
    day = F.coalesce(F.col(PARTITION_COLUMN).cast("string"), F.lit(NO_DAY))
    gens = F.create_map(*[F.lit(x) for d, c in days.items() for x in (d, c.gen)])
    upto = F.create_map(*[F.lit(x) for d, c in days.items() for x in (d, c.upto)])
    own = stored.where(F.col(GEN) == F.coalesce(gens[day], F.lit(0)))  # partition columns only: prunes folders
    later = stored.where((F.col(GEN) == 0) & day.isin(list(days)) & (F.col("commit_id") > min(c.upto for c in days.values()))
                         & (F.col("commit_id") > upto[day]))
    return own.unionByName(later)


def day_layout(spark: SparkSession, path: str) -> DataFrame:
    """(day, ``files``, ``bytes``, ``rows``, ``stale``): a day's files, and its rows that no append wrote.

    Reads the op column only.
    """
    stored = spark.read.parquet(path).select("*", F.col("_metadata.file_path").alias("_file"),
                                             F.col("_metadata.file_size").alias("_size"))
    by_file = (_visible(stored, current(spark, path)).groupBy(PARTITION_COLUMN, "_file", "_size")
               .agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("op") != changelog.APPEND).alias("stale")))
    return by_file.groupBy(PARTITION_COLUMN).agg(
        F.count(F.lit(1)).alias("files"), F.sum("_size").alias("bytes"), F.sum("rows").alias("rows"), F.sum("stale").alias("stale"))


def choose_days(spark: SparkSession, path: str, target_bytes: int = TARGET_BYTES, stale_share: float = 0.1,
                spare_files: int = 4) -> list[dt.date | None]:
    """Days worth rewriting: more files than ``target_bytes`` calls for by ``spare_files`` or more, or over
    ``stale_share`` of updates and tombstones."""
    layout = day_layout(spark, path)
    wanted = F.ceil(F.col("bytes") / target_bytes)
    chosen = layout.where((F.col("files") >= wanted + spare_files) | (F.col("stale") > F.col("rows") * stale_share))
    return [r[0] for r in chosen.select(PARTITION_COLUMN).collect()]  # one row a day


def _reserve(spark: SparkSession, path: str) -> int:
    """A generation number that no other rewrite has."""
    while True:
        n = 1 + max([0, *(int(m.split(".")[0]) for m in markers(spark, f"{path}/{FOLDER}") if m[0] != ".")])
        if create_marker(spark, f"{path}/{FOLDER}", f"{n:012d}.reserved"):
            return n


def rewrite_days(spark: SparkSession, path: str, days: list[dt.date | None], cutoff: str | None = None,
                 target_bytes: int = TARGET_BYTES, switch: bool = True) -> int:
    """Rewrite ``days`` to a new generation and switch to it; returns its number (0: no days).

    ``cutoff`` expires versions as ``changelog.expire`` does, with the whole table's base
    snapshot.  A day is packed into files of about ``target_bytes``: its rows are dealt to as
    many tasks as its bytes call for.  ``switch=False`` stops before the marker, as a driver
    that dies there.
    """
    if not days:
        return 0
    n, before = _reserve(spark, path), current(spark, path)
    log = read(spark, path)
    part = log.where(changelog.in_days(days))
    upto = {_day_text(r[0]): r[1] for r in part.groupBy(PARTITION_COLUMN).agg(F.max("commit_id")).collect()}
    # commits that arrive from here on are above each day's mark and stay in gen=0
    marks = F.create_map(*[F.lit(x) for pair in upto.items() for x in pair])
    part = part.where(F.col("commit_id") <= marks[F.coalesce(F.col(PARTITION_COLUMN).cast("string"), F.lit(NO_DAY))])
    rows = part if cutoff is None else changelog.expire(part, cutoff, whole=log)
    files = {_day_text(r[0]): max(1, -(-r["bytes"] // target_bytes)) for r in day_layout(spark, path).collect()}
    packs = F.create_map(*[F.lit(x) for d in upto for x in (d, files[d])])
    pack = F.pmod(F.xxhash64(changelog.KEY), packs[F.coalesce(F.col(PARTITION_COLUMN).cast("string"), F.lit(NO_DAY))])
    (rows.select(*LAKE_LOG_FIELDS, F.lit(n).alias(GEN), pack.alias("_pack")).repartition(PARTITION_COLUMN, "_pack")
     .sortWithinPartitions(PARTITION_COLUMN, "uploaded_at", changelog.KEY).drop("_pack")
     .write.mode("append").partitionBy(GEN, PARTITION_COLUMN).parquet(path))
    if switch:
        write_text(spark, f"{path}/{FOLDER}", f"{n:012d}.json",
                    json.dumps({d: [before.get(d, Current(0, 0)).gen, mark] for d, mark in upto.items()}))
    return n


def vacuum(spark: SparkSession, path: str, orphans_before: dt.datetime | None = None) -> int:
    """Remove folders of generations that are no day's any more and ``gen=0`` files that a rewrite contains.

    To be run when no reader uses an older state.  Generations without a marker, which a rewrite
    may be writing just now, go only if they were last changed before ``orphans_before``
    (UTC).  Returns the number of files and folders removed.
    """
    days, removed = current(spark, path), 0
    switched = {int(m[:-5]) for m in markers(spark, f"{path}/{FOLDER}") if m.endswith(".json")}
    fs, root = file_system(spark, path)
    for top in fs.listStatus(root):
        name = top.getPath().getName()
        if not name.startswith(f"{GEN}=") or name == f"{GEN}=0":
            continue
        n = int(name.split("=")[1])
        if n not in switched and (orphans_before is None or top.getModificationTime() >= orphans_before.replace(
                tzinfo=dt.timezone.utc).timestamp() * 1000):
            continue
        for folder in fs.listStatus(top.getPath()):
            value = folder.getPath().getName().partition("=")[2]
            day = NO_DAY if value == "__HIVE_DEFAULT_PARTITION__" else value
            if value and days.get(day, Current(0, 0)).gen != n:
                removed += bool(fs.delete(folder.getPath(), True))
        if not len(fs.listStatus(top.getPath())):
            fs.delete(top.getPath(), True)
    if days:
        day = F.coalesce(F.col(PARTITION_COLUMN).cast("string"), F.lit(NO_DAY))
        upto = F.create_map(*[F.lit(x) for d, c in days.items() for x in (d, c.upto)])
        held = (spark.read.parquet(path).where((F.col(GEN) == 0) & day.isin(list(days)))
                .groupBy(F.col("_metadata.file_path").alias("file"), day.alias("day")).agg(F.max("commit_id").alias("last")))
        for row in held.where(F.col("last") <= upto[F.col("day")]).toLocalIterator():
            removed += bool(fs.delete(file_system(spark, row["file"])[1], False))
    return removed
