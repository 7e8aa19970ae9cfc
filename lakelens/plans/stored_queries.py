"""Queries over a stored lake table: a change log written by day under the shared folder, then read back.

Each call writes its own table, so that reads prune its day folders and DML and upkeep
run through the table writers.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakelens.config import SNAPSHOT_RETENTION_DAYS
from lakelens.operators import changelog
from lakelens.plans import oracle
from lakelens.plans import queries as plain
from lakelens.schemas import LAKE_FIELDS, PARTITION_COLUMN
from lakelens.session import work_path
from lakelens.sinks import generations, tables
from lakelens.sources import fixtures as fx
from lakelens.sources import footers
from lakelens.sources.tables import read_lake

UPKEEP_CUTOFF = "2024-02-03 00:00:00"  # after the update and the delete


def _stored(spark: SparkSession, log: DataFrame, name: str) -> str:
    path = work_path(spark, name)
    tables.commit_lake(spark, log, path)
    return path


def lake_stored_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One day of a stored table; only that day's folder is read."""
    path = _stored(spark, fx.lake_change_log(spark, sf_dir), "lake-range")
    return changelog.day_range(read_lake(spark, path), *plain.RANGE_DAY, fields=LAKE_FIELDS).select(*LAKE_FIELDS)


def _changed(spark: SparkSession, sf_dir: str, name: str) -> str:
    """A stored table after an UPDATE and a DELETE, each one more commit of change rows."""
    path = _stored(spark, fx.lake_change_log(spark, sf_dir).where(F.col("commit_id") < fx.UPDATE_COMMIT[0]), name)
    tables.update_lake(spark, path, F.col("mime_type") == "image/jpg", {"mime_type": F.lit("image/jpeg")},
                       fx.UPDATE_COMMIT[1])
    before = F.lit(fx.DELETE_BEFORE).cast("date")
    tables.delete_lake(spark, path, F.col("uploaded_at") < before, fx.DELETE_COMMIT[1],
                       days=F.col(PARTITION_COLUMN) < before)
    return path


def lake_stored_dml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current rows of a stored table after an UPDATE and a DELETE."""
    path = _changed(spark, sf_dir, "lake-dml")
    return changelog.current_state(read_lake(spark, path), fields=LAKE_FIELDS).select(*LAKE_FIELDS)


def lake_stored_upkeep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and commits of a stored table before and after expiry and compaction, and whether its files are fewer."""
    cutoff = (datetime.fromisoformat(plain.EXPIRE_NOW) - timedelta(days=SNAPSHOT_RETENTION_DAYS)).isoformat(" ")
    path, out = _changed(spark, sf_dir, "lake-upkeep"), work_path(spark, "lake-upkept")
    tables.rewrite_lake(spark, path, out, cutoff)

    def side(at: str, old: bool) -> DataFrame:
        return read_lake(spark, at).select(F.lit(old).alias("old"), "commit_id", F.col("_metadata.file_path").alias("file"))

    def old(column: Column) -> Column:
        return F.when(F.col("old"), column)

    def new(column: Column) -> Column:
        return F.when(~F.col("old"), column)
    one, commit, file = F.lit(1), F.col("commit_id"), F.col("file")
    return side(path, True).unionByName(side(out, False)).agg(
        F.count(old(one)).alias("rows_before"), F.count(new(one)).alias("rows_after"),
        F.count_distinct(old(commit)).alias("commits_before"), F.count_distinct(new(commit)).alias("commits_after"),
        (F.count_distinct(new(file)) < F.count_distinct(old(file))).alias("fewer_files"))


def _upkept(spark: SparkSession, sf_dir: str, name: str) -> tuple[str, DataFrame]:
    """A table with generations after a rewrite of the days that hold updates or tombstones; its days before."""
    path, log = work_path(spark, name), fx.lake_change_log(spark, sf_dir)
    for last in (False, True):  # the appends, then the update and the delete
        generations.commit(spark, log.where((F.col("commit_id") >= fx.UPDATE_COMMIT[0]) == last), path)
    before = generations.day_layout(spark, path).select(PARTITION_COLUMN, "rows", "stale").checkpoint()
    days = generations.choose_days(spark, path, stale_share=0.0, spare_files=10**6)
    generations.rewrite_days(spark, path, days, cutoff=UPKEEP_CUTOFF)
    generations.vacuum(spark, path)
    return path, before


def lake_generations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current rows of a table some days of which were rewritten in place."""
    path, _ = _upkept(spark, sf_dir, "lake-generations")
    return changelog.current_state(generations.read(spark, path), fields=LAKE_FIELDS).select(*LAKE_FIELDS)


def lake_generation_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions stored by day before and after that rewrite, and whether the day was rewritten."""
    path, before = _upkept(spark, sf_dir, "lake-generation-days")
    after = generations.read(spark, path).groupBy(PARTITION_COLUMN).agg(F.count(F.lit(1)).alias("rows_after"))
    return before.join(after, PARTITION_COLUMN, "left").select(
        PARTITION_COLUMN, F.col("rows").alias("rows_before"), F.coalesce("rows_after", F.lit(0)).alias("rows_after"),
        (F.col("stale") > 0).alias("rewritten"))


def lake_file_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, nulls and bounds of several columns by day of a stored table, from its files' footers."""
    files = footers.file_listing(spark, _stored(spark, fx.lake_change_log(spark, sf_dir), "lake-footers"))
    bounds = {"id": "long", "file_size": "long", "filename": "string", "uploaded_at": "timestamp_ntz"}
    out = [F.sum("record_count").alias("row_count"), F.sum(F.col("null_counts")["width"]).alias("null_widths")]
    for name, kind in bounds.items():
        low, high = footers.column_bounds(files, name, kind)
        out += [low.alias(f"{name}_low"), high.alias(f"{name}_high")]
    return files.groupBy(F.col("partition")[PARTITION_COLUMN].cast("date").alias(PARTITION_COLUMN)).agg(*out)


QUERIES = {
    "lake_generations": lake_generations,
    "lake_generation_days": lake_generation_days,
    "lake_file_bounds": lake_file_bounds,
    "lake_stored_range": lake_stored_range,
    "lake_stored_dml": lake_stored_dml,
    "lake_stored_upkeep": lake_stored_upkeep,
}


def oracle_sql() -> dict[str, str]:
    """The stored range is the plain one's; the others have SQL of their own in ``plans.oracle``."""
    sql = oracle.oracle_sql()
    return {"lake_stored_range": sql["lake_partition_range"], **oracle.stored_queries()}
