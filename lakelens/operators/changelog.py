"""Versioned lake table kept as a change log in plain partitioned Parquet.

Each row is a version of the keyed record plus ``commit_id``, ``committed_at`` and
``op``.  Live ops are ``append`` and ``update``; ``delete`` and ``unlink`` are
tombstones (``unlink`` marks the old day of a row an update moved to another day,
so that day-pruned reads stay correct).  The newest version per key wins.

Resolution uses ``groupBy(key).agg(max_by(...))``: a declarative aggregate with a
map-side partial step, so a key with many versions is combined before the
shuffle instead of being sorted in one task.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakelens.operators.joins import broadcast_if_bounded
from lakelens.schemas import LAKE_FIELDS, PARTITION_COLUMN
from lakelens.session import shared_dir

PARTITION = PARTITION_COLUMN
APPEND, UPDATE, DELETE, UNLINK = "append", "update", "delete", "unlink"
LIVE_OPS = (APPEND, UPDATE)
KEY = "id"


def with_partition(rows: DataFrame) -> DataFrame:
    """Add the day partition column derived from ``uploaded_at`` (``day(uploaded_at)``)."""
    return rows.withColumn(PARTITION, F.to_date("uploaded_at"))


def commit(rows: DataFrame, commit_id: int, committed_at: str, op: str = APPEND) -> DataFrame:
    """Change rows for one commit of new table rows."""
    return with_partition(rows.select(*LAKE_FIELDS)).select(
        "*", F.lit(commit_id).cast("long").alias("commit_id"),
        F.lit(committed_at).cast("timestamp_ntz").alias("committed_at"), F.lit(op).alias("op"))


def _is_live() -> Column:
    return F.col("op").isin(*LIVE_OPS)


def _carried(log: DataFrame, key: str, fields: list[str] | None) -> list[str]:
    """Columns the resolution carries: all of them, or the key, ``op`` and the fields asked for.

    The aggregate takes one struct of the carried columns, and Catalyst does not prune
    struct fields through an aggregate; naming the fields keeps the scan, the per-row
    work below it and the shuffle to the columns the query reads.
    """
    if fields is None:
        return list(log.columns)
    wanted = {key, "op", *fields}
    return [c for c in log.columns if c in wanted]


def latest_versions(log: DataFrame, key: str = KEY, fields: list[str] | None = None) -> DataFrame:
    """Newest version of every key (tombstones included)."""
    order = F.struct(F.col("commit_id"), _is_live())
    return (log.groupBy(key)
            .agg(F.max_by(F.struct(*[F.col(c) for c in _carried(log, key, fields)]), order).alias("_v"))
            .select("_v.*"))


def current_state(log: DataFrame, key: str = KEY, fields: list[str] | None = None) -> DataFrame:
    """Live rows of the table (newest version per key, tombstones dropped).

    ``fields`` names the columns the caller reads (default: all)."""
    return latest_versions(log, key, fields).where(_is_live())


def as_of(log: DataFrame, ts: str, key: str = KEY, fields: list[str] | None = None) -> DataFrame:
    """Table state as of ``ts`` (inclusive); asking for a time before the first commit is an error.

    The check is one aggregate over the ``committed_at`` column only.
    """
    at = F.lit(ts).cast("timestamp_ntz")
    first = log.agg(F.min("committed_at")).first()[0]
    if first is None or datetime.fromisoformat(ts) < first:
        raise ValueError(f"no snapshot at or before {ts} (first commit: {first})")
    return current_state(log.where(F.col("committed_at") <= at), key, fields)


def as_of_many(log: DataFrame, timestamps: list[str], key: str = KEY, ts_col: str = "as_of_ts",
               fields: list[str] | None = None) -> DataFrame:
    """Table states at several times in one pass: rows are repeated once per probe time they
    precede (a literal array, so the fan-out is the number of probes) and resolved by one
    aggregation on (probe, key).  One check against the first commit covers all probes."""
    first = log.agg(F.min("committed_at")).first()[0]
    early = [t for t in timestamps if first is None or datetime.fromisoformat(t) < first]
    if early:
        raise ValueError(f"no snapshot at or before {early[0]} (first commit: {first})")
    probes = F.array(*[F.lit(t).cast("timestamp_ntz") for t in timestamps])
    tagged = log.withColumn(ts_col, F.explode(probes)).where(F.col("committed_at") <= F.col(ts_col))
    order = F.struct(F.col("commit_id"), _is_live())
    latest = (tagged.groupBy(ts_col, key)
              .agg(F.max_by(F.struct(*[F.col(c) for c in _carried(log, key, fields)]), order).alias("_v"))
              .select(ts_col, "_v.*"))
    return latest.where(_is_live())


def snapshots(log: DataFrame) -> DataFrame:
    """One row per commit: time, id, parent, operation and record counts, newest first.

    The window runs over the per-commit aggregate (one row per commit), not over table rows.
    """
    per_commit = log.groupBy("commit_id").agg(
        F.max("committed_at").alias("committed_at"),
        F.count(F.when(F.col("op") == APPEND, 1)).alias("_n_append"),
        F.count(F.when(F.col("op") == UPDATE, 1)).alias("_n_update"),
        F.count(F.when(F.col("op") == DELETE, 1)).alias("_n_delete"),
    )
    ordered = Window.orderBy("committed_at", "commit_id")
    added = F.col("_n_append") + F.col("_n_update")
    deleted = F.col("_n_update") + F.col("_n_delete")
    operation = (F.when((F.col("_n_update") == 0) & (F.col("_n_delete") == 0), F.lit("append"))
                 .when((F.col("_n_update") == 0) & (F.col("_n_append") == 0), F.lit("delete"))
                 .otherwise(F.lit("overwrite")))
    return per_commit.select(
        "committed_at",
        F.col("commit_id").alias("snapshot_id"),
        F.lag("commit_id").over(ordered).alias("parent_id"),
        operation.alias("operation"),
        added.alias("added_records"),
        deleted.alias("deleted_records"),
        F.sum(added - deleted).over(ordered.rowsBetween(Window.unboundedPreceding, 0)).alias("total_records"),
    ).orderBy(F.desc("committed_at"), F.desc("snapshot_id"))


def _stamp(rows: DataFrame, commit_id: int, committed_at: str, op: str) -> DataFrame:
    return (rows.withColumn("commit_id", F.lit(commit_id).cast("long"))
            .withColumn("committed_at", F.lit(committed_at).cast("timestamp_ntz"))
            .withColumn("op", F.lit(op)))


def update_rows(log: DataFrame, predicate: Column, assignments: dict[str, Column],
                commit_id: int, committed_at: str, key: str = KEY) -> DataFrame:
    """Change rows of ``UPDATE t SET ... WHERE predicate`` against the current state.

    Rows whose day changes also get an ``unlink`` tombstone in their old day.
    """
    hits = current_state(log, key).where(predicate)
    new = hits.withColumn("old_day", F.col(PARTITION)).withColumns(assignments).drop(PARTITION, "op")
    written = F.struct(F.to_date("uploaded_at").alias(PARTITION), F.lit(UPDATE).alias("op"))
    unlinked = F.struct(F.col("old_day").alias(PARTITION), F.lit(UNLINK).alias("op"))
    moved = ~F.to_date("uploaded_at").eqNullSafe(F.col("old_day"))
    rows = new.select("*", F.inline(F.when(moved, F.array(written, unlinked)).otherwise(F.array(written))))
    return (rows.withColumn("commit_id", F.lit(commit_id).cast("long"))
            .withColumn("committed_at", F.lit(committed_at).cast("timestamp_ntz")).select(*log.columns))


def matching_versions(log: DataFrame, predicate: Column, key: str = KEY) -> DataFrame:
    """(day, key, ``commit_id``) of the current rows that ``predicate`` holds for.

    Two narrow steps, so that a stored log is read in few columns: the keys with any live version
    that matches, then the versions of those keys only, of which the newest decides.  Both
    read the key, the version columns and what the predicate names.
    """
    shared_dir(log.sparkSession)
    keys = log.where(predicate & _is_live()).select(key).distinct().checkpoint()
    keys = broadcast_if_bounded(keys, F.octet_length(F.col(key).cast("string")) + 16)
    versions = (log.select(PARTITION, key, "commit_id", "op", F.coalesce(predicate, F.lit(False)).alias("_match"))
                .join(keys, key, "left_semi"))
    order = F.struct(F.col("commit_id"), _is_live())
    newest = versions.groupBy(key).agg(F.max_by(F.struct(PARTITION, "commit_id", "op", "_match"), order).alias("_v"))
    return newest.select(F.col(f"_v.{PARTITION}").alias(PARTITION), key, "_v.commit_id", "_v.op", "_v._match").where(
        _is_live() & F.col("_match")).select(PARTITION, key, "commit_id")


def in_days(days: list) -> Column:
    """The day partition is one of ``days`` (None: the rows without a day)."""
    known = [d for d in days if d is not None]
    hit = F.col(PARTITION).isin(known) if known else F.lit(False)
    return hit | F.col(PARTITION).isNull() if None in days else hit


def update_rows_by_day(log: DataFrame, predicate: Column, assignments: dict[str, Column],
                       commit_id: int, committed_at: str, key: str = KEY) -> DataFrame:
    """``update_rows`` of a log stored by day: whole rows are read from the days with hits only.

    The hits (``matching_versions``) are found first; their days, at most one a partition of
    the table, prune the read of all columns.
    """
    hits = matching_versions(log, predicate, key).checkpoint()
    days = [r[0] for r in hits.select(PARTITION).distinct().collect()]
    hits = broadcast_if_bounded(hits.select(key, "commit_id"), F.octet_length(F.col(key).cast("string")) + 24)
    rows = log.where(in_days(days)).where(_is_live()).join(hits, [key, "commit_id"], "left_semi")
    return update_rows(rows.select(*log.columns), F.lit(True), assignments, commit_id, committed_at, key)


def delete_rows(log: DataFrame, predicate: Column, commit_id: int, committed_at: str,
                key: str = KEY, days: Column | None = None) -> DataFrame:
    """Tombstones of ``DELETE FROM t WHERE predicate``; rows where the predicate is NULL stay.

    ``days``: what the predicate implies for the day partition, so that only those days are
    read.  A row that moved to another day left a tombstone in its old one, so a day resolves
    by itself.
    """
    read = log if days is None else log.where(days)
    return _stamp(current_state(read, key).where(predicate), commit_id, committed_at, DELETE).select(*log.columns)


def expire(log: DataFrame, cutoff: str, key: str = KEY, whole: DataFrame | None = None) -> DataFrame:
    """Drop versions no longer needed for reads at or after ``cutoff``.

    ``log`` may be some days of ``whole``, whose base snapshot they then get.

    Versions committed at or before the cutoff collapse into one base snapshot (the
    newest such commit) holding the rows live at that point; later versions stay.
    Reads before the base snapshot then fail like reads before the first commit.
    """
    at = F.lit(cutoff).cast("timestamp_ntz")
    old = log.where(F.col("committed_at") <= at)
    commits = old if whole is None else whole.where(F.col("committed_at") <= at)
    base_id = commits.select(F.max_by("commit_id", F.struct("committed_at", "commit_id"))).scalar()
    base_at = commits.select(F.max("committed_at")).scalar()
    base = (current_state(old, key)
            .withColumn("commit_id", base_id)
            .withColumn("committed_at", base_at)
            .withColumn("op", F.lit(APPEND)))
    return base.select(*log.columns).unionByName(log.where(F.col("committed_at") > at))


def compact(log: DataFrame) -> DataFrame:
    """Rows laid out for rewriting: gathered by day, small days joined and large ones split to about
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` a task, sorted inside each file so Parquet
    min/max statistics on ``uploaded_at`` prune well."""
    return log.hint("rebalance", PARTITION).sortWithinPartitions(PARTITION, "uploaded_at", KEY)


def day_range(log: DataFrame, start_date: str, end_date: str, key: str = KEY,
              fields: list[str] | None = None) -> DataFrame:
    """Current rows with ``start <= uploaded_at < end``; the day predicate prunes partitions first."""
    lo, hi = F.lit(start_date).cast("date"), F.lit(end_date).cast("date")
    pruned = log.where((F.col(PARTITION) >= lo) & (F.col(PARTITION) < hi))
    if fields is not None:
        fields = [*fields, "uploaded_at"]
    current = current_state(pruned, key, fields)
    return current.where((F.col("uploaded_at") >= lo.cast("timestamp_ntz"))
                         & (F.col("uploaded_at") < hi.cast("timestamp_ntz")))


def daily_volume(rows: DataFrame) -> DataFrame:
    """Uploads per day: count and total size in MiB (floating division), newest day first."""
    return (rows.groupBy(F.to_date("uploaded_at").alias("upload_date"))
            .agg(F.count(F.lit(1)).alias("image_count"),
                 (F.sum("file_size") / 1024 / 1024).alias("total_size_mb"))
            .orderBy(F.desc("upload_date")))


def file_listing(scan: DataFrame, stats_column: str) -> DataFrame:
    """Data files behind a file-source scan with record counts and min/max of one column."""
    return (scan.groupBy(F.col("_metadata.file_path").alias("file_path"),
                         F.col("_metadata.file_size").alias("file_size_in_bytes"))
            .agg(F.count(F.lit(1)).alias("record_count"),
                 F.min(stats_column).alias("lower_bound"),
                 F.max(stats_column).alias("upper_bound")))
