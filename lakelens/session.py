"""Session helpers: building a session, pinning UTC and finding the shared work folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

UTC = "UTC"
#: applications whose executors have the package
_SHIPPED: set[str] = set()


def build_session(
    app_name: str = "lakelens",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session with UTC clock, AQE on and the UI off.

    ``master`` and ``shuffle_partitions`` are only set when given, so a cluster
    submit keeps its own values.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": UTC,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.parquet.compression.codec": "zstd",
        # checkpoint files of the serial-id step are removed once their data is unreachable
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    pin_utc(spark)
    ship_package(spark)
    return spark


def pin_utc(spark: SparkSession) -> None:
    """Jobs interpret naive times as UTC (the processed stream does, and lake times are UTC)."""
    if spark.conf.get("spark.sql.session.timeZone", None) != UTC:
        spark.conf.set("spark.sql.session.timeZone", UTC)


@contextmanager
def adaptive(batch: DataFrame) -> Iterator[None]:
    """Adaptive execution for what is done with a batch, caches included.

    Spark plans streams without it, and a micro-batch's session keeps that; a cache over a shuffle
    keeps its partitions in any session.  Each would have all of Spark's partitions, however few
    its rows.
    """
    conf = batch.sparkSession.conf
    wanted = {"spark.sql.adaptive.enabled": "true", "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true"}
    before = {key: conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            conf.unset(key) if value is None else conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set (HDFS/object store); an unset one is an error there. In a
    local session, as in tests, a folder is made and registered as the checkpoint dir.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not in_one_process(spark):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    local = tempfile.mkdtemp(prefix="lakelens-")
    spark.sparkContext.setCheckpointDir(local)
    return local


def in_one_process(spark: SparkSession) -> bool:
    """Whether driver and executors are one local process."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors of a cluster, whose Python functions import it."""
    if in_one_process(spark) or spark.sparkContext.applicationId in _SHIPPED:
        return
    _SHIPPED.add(spark.sparkContext.applicationId)
    root = os.path.dirname(os.path.abspath(__file__))
    archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(), "lakelens"), "zip", os.path.dirname(root), "lakelens")
    spark.sparkContext.addPyFile(archive)


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, Hadoop path) of a path on any store."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder for one job's outputs."""
    return f"{shared_dir(spark)}/lakelens/{name}-{uuid.uuid4().hex[:12]}"
