"""SQL access to the versioned lake table through temporary views.

``register_lake_views(spark, log, "images")`` creates

* ``images``            the current state (live rows, newest version per key),
* ``images_snapshots``  one row per commit (``committed_at, snapshot_id, parent_id, operation, ...``),
* ``images_changes``    the raw change log,

and ``register_as_of_view`` adds a view of the state at a given time, so that
``SELECT ... FROM images`` style queries run unchanged in ``spark.sql``.
When the log is a Parquet scan, ``images_files`` lists its data files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakelens.operators import changelog
from lakelens.schemas import LAKE_FIELDS, PARTITION_COLUMN


def register_lake_views(spark: SparkSession, log: DataFrame, name: str = "images",
                        files_stats_column: str | None = "uploaded_at") -> list[str]:
    views = {
        name: changelog.current_state(log).select(*LAKE_FIELDS, PARTITION_COLUMN),
        f"{name}_snapshots": changelog.snapshots(log),
        f"{name}_changes": log,
    }
    if files_stats_column and _is_file_scan(log):
        views[f"{name}_files"] = changelog.file_listing(log, files_stats_column)
    for view, df in views.items():
        df.createOrReplaceTempView(view)
    return list(views)


def register_as_of_view(spark: SparkSession, log: DataFrame, ts: str, view: str) -> str:
    """``SELECT * FROM images FOR TIMESTAMP AS OF ts`` as a view named ``view``."""
    changelog.as_of(log, ts).select(*LAKE_FIELDS, PARTITION_COLUMN).createOrReplaceTempView(view)
    return view


def _is_file_scan(df: DataFrame) -> bool:
    try:
        return bool(df.inputFiles())
    except Exception:  # noqa: BLE001 - derived frames have no input files
        return False
