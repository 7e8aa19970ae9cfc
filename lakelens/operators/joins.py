"""Join helpers: broadcast only behind a check of the bytes, with a shuffle join beyond it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: bytes of a side that is broadcast
MAX_BROADCAST_BYTES = 32 << 20


def bounded_bytes(df: DataFrame, row_bytes: Column, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """True when the rows of ``df``, of ``row_bytes`` each, take at most ``max_bytes`` (one aggregate)."""
    return (df.agg(F.sum(row_bytes.cast("long"))).first()[0] or 0) <= max_bytes


def broadcast_if_bounded(df: DataFrame, row_bytes: Column, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` when the byte bound holds, else ``df``."""
    return F.broadcast(df) if bounded_bytes(df, row_bytes, max_bytes) else df


def anti_join_keys(rows: DataFrame, target: DataFrame, key: str, probe: bool = False,
                   max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Rows whose ``key`` is not present in ``target`` (rows with a NULL key are kept).

    ``probe=True`` is for a persisted micro-batch against a growing table: when the batch's
    distinct keys are proven small (in bytes) they are broadcast and semi-joined against the target's
    key column, so the table is scanned (one column) but never shuffled, and the keys found
    are broadcast back for the anti join.  Otherwise (and beyond the bound) it is a plain
    anti join whose strategy AQE picks from measured sizes; the bound check would cost a
    second evaluation of a lazily computed input.
    """
    keys = rows.select(key).where(F.col(key).isNotNull()).distinct()
    if probe and bounded_bytes(keys, F.octet_length(F.col(key).cast("string")) + 16, max_broadcast_bytes):
        present = target.select(key).join(F.broadcast(keys), key, "left_semi").distinct()
        return rows.join(F.broadcast(present), key, "left_anti")
    return rows.join(target.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")
