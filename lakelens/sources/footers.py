"""File listing of a Parquet table from its footers: counts and bounds of every column, no row read.

Spark lists the files (the ``binaryFile`` source without its content column, so nothing of a
file is loaded) and deals them out; each task opens the footers of its files and sums up their
row groups.  Bounds are texts, as a catalog shows them; a column some row group of which has no
statistics has none.

Footers are opened through ``pyarrow.fs``.  For a store that only Spark reads,
``changelog.file_listing`` scans instead.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
LISTING = ("file_path string, file_size_in_bytes long, partition map<string,string>, record_count long, "
           "null_counts map<string,long>, lower_bounds map<string,string>, upper_bounds map<string,string>")


def bound_text(value) -> str:
    """A bound as text: numbers plainly, times as ``YYYY-MM-DD HH:MM:SS[.ffffff]``, bytes as UTF-8 or hex."""
    if isinstance(value, bytes):
        try:
            return value.decode()
        except UnicodeDecodeError:
            return value.hex()
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat(" ")
    if isinstance(value, bool):
        return str(value).lower()
    return str(value)


def partition_values(path: str) -> list[tuple[str, str | None]]:
    """``name=value`` folders of a file's path."""
    pairs = [p.split("=", 1) for p in path.split("/")[:-1] if "=" in p]
    return [(unquote(k), None if v == NO_VALUE else unquote(v)) for k, v in pairs]


def footer(path: str) -> tuple[int, dict[str, int], dict[str, str], dict[str, str]]:
    """Rows, and by column null counts, lower and upper bounds of one file."""
    store, inner = pafs.FileSystem.from_uri("file://" + path[5:] if path.startswith("file:/") and path[5:7] != "//" else path)
    with store.open_input_file(inner) as source:
        meta = pq.ParquetFile(source).metadata
    nulls: dict[str, int] = {}
    low: dict[str, object] = {}
    high: dict[str, object] = {}
    unknown = set()
    for g in range(meta.num_row_groups):
        group = meta.row_group(g)
        for c in range(group.num_columns):
            column = group.column(c)
            name, stats = column.path_in_schema, column.statistics
            if stats is None or not stats.has_null_count:
                unknown.add(name)
                continue
            nulls[name] = nulls.get(name, 0) + stats.null_count
            if stats.has_min_max:
                low[name] = min(low.get(name, stats.min), stats.min)
                high[name] = max(high.get(name, stats.max), stats.max)
            elif stats.null_count < column.num_values:
                unknown.add(name)
    for name in unknown:
        for known in (nulls, low, high):
            known.pop(name, None)
    return (meta.num_rows, nulls, {k: bound_text(v) for k, v in low.items()}, {k: bound_text(v) for k, v in high.items()})


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [part.split(" ")[0] for part in LISTING.split(", ")]
    texts = pa.map_(pa.string(), pa.string())
    types = (pa.string(), pa.int64(), texts, pa.int64(), pa.map_(pa.string(), pa.int64()), texts, texts)
    for batch in batches:
        for path, size in zip(batch.column("path").to_pylist(), batch.column("length").to_pylist(), strict=True):
            rows, nulls, low, high = footer(path)
            values = (path, size, partition_values(path), rows, list(nulls.items()), list(low.items()), list(high.items()))
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names=names)


def file_listing(spark: SparkSession, path: str) -> DataFrame:
    """One row a data file under ``path``: size, partition values, rows, null counts and bounds by column.

    An empty folder gives no rows.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
             .load(path).select("path", "length"))
    return files.mapInArrow(_read, LISTING)


def column_bounds(listing: DataFrame, column: str, kind: str) -> tuple:
    """(lower, upper) aggregates of one column over the files of a group, as values of type ``kind``."""
    low, high = (F.col(c)[column].cast(kind) for c in ("lower_bounds", "upper_bounds"))
    return F.min(low), F.max(high)
