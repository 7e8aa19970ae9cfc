"""Content deduplication by state: the first record of every key, remembered in the stream's state store.

The consumer's insert compares each batch with the stored table; this operator needs no table.
Keys seen within ``remember`` are held in the state store (RocksDB when the session names it),
so a redelivered record is dropped in the stream, before anything is written.  State lives in
the checkpoint: a restart goes on with the keys seen before.

Which record of a key is the first is fixed: a batch's rows are dealt out by key, and each task
hands them on in arrival order, one a key, to the store.  That reduction is one Arrow pass over
a task's rows; the store itself is Spark's.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: columns that this operator adds on the way and takes away again
SEEN_AT, DEDUP_KEY = "_seen_at", "_dedup_key"


def use_rocksdb(spark) -> None:
    """State on local disk with change logs in the checkpoint, for more keys than fit into memory.

    For streams that start afterwards; the state of an existing checkpoint keeps its kind.
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def _first_in_order(order: list[str]):
    """Map function: a partition's rows in arrival order, the first of each key."""
    def firsts(table: pa.Table) -> pa.Table:
        at = pc.sort_indices(table, sort_keys=[(c, "ascending") for c in order], null_placement="at_start")
        table = table.take(at).append_column("_at", pa.array(range(table.num_rows), pa.int64()))
        first = table.select([DEDUP_KEY, "_at"]).group_by(DEDUP_KEY).aggregate([("_at", "min")])
        return table.take(first["_at_min"].sort()).drop_columns(["_at"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        waiting: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            waiting.append(batch)
            rows += batch.num_rows
            if held is None or rows >= held.num_rows:  # reduced whenever it has doubled: one row a key is held
                held = firsts(pa.Table.from_batches(waiting if held is None else [*held.to_batches(), *waiting]))
                waiting, rows = [], 0
        if waiting:
            held = firsts(pa.Table.from_batches([*held.to_batches(), *waiting]))
        if held is not None:
            yield from held.to_batches()
    return run


def first_seen(stream: DataFrame, key: str, order: list[str], remember: str = "30 days") -> DataFrame:
    """Rows of ``stream`` whose ``key`` was not seen in the last ``remember`` of processing time.

    Of a batch's rows of one key the first in ``order`` (nulls first) is taken.  Rows of null
    key are all kept.  No row is ever late: the store forgets by processing time.  All columns
    are kept; the state holds keys only.  A batch DataFrame is reduced by the same rule.
    """
    unique = F.concat(F.lit("row:"), F.xxhash64(*stream.columns).cast("string"), F.lit(":"), F.uuid())
    keyed = (stream.withColumn(DEDUP_KEY, F.coalesce(F.concat(F.lit("key:"), F.col(key).cast("string")), unique))
             .repartition(DEDUP_KEY))
    reduced = keyed.mapInArrow(_first_in_order(order), keyed.schema)
    if not stream.isStreaming:
        return reduced.drop(DEDUP_KEY)
    return (reduced.withColumn(SEEN_AT, F.current_timestamp()).withWatermark(SEEN_AT, remember)
            .dropDuplicatesWithinWatermark([DEDUP_KEY]).drop(DEDUP_KEY, SEEN_AT))
