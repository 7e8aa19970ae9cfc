"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakelens.session import shared_dir, work_path

#: lower-cases A-Z and nothing else
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: rows and bytes of one Arrow batch handed to a Python worker; long texts stay within its memory
BATCH_ROWS, BATCH_BYTES = 2000, 8 << 20


def prepare(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session and make sure a shared checkpoint folder is set."""
    shared_dir(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not use yet (Spark compares names without case)."""
    used = {c.lower() for c in df.columns}
    while base.lower() in used:
        base = "_" + base
    return base


def quoted(name: str) -> Column:
    """The column of this very name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def with_row_id(df: DataFrame, name: str, extra: dict[str, Column] | None = None,
                label: str = "rows") -> DataFrame:
    """``df`` plus a unique row number and ``extra`` columns, written once to the shared folder.

    The written table fixes the numbers, so that later joins on them see the same rows
    however often (or after whatever executor loss) they are planned again.
    """
    spark = df.sparkSession
    path = work_path(spark, label)
    df.withColumns({name: F.monotonically_increasing_id(), **(extra or {})}).write.parquet(path)
    return spark.read.parquet(path)


def word_blocks(data: bytes, size: int = 1 << 20, carry: int = 0) -> Iterator[list[bytes]]:
    """White-space separated words of ``data`` in lists from about ``size`` bytes each.

    Every list after the first begins with the last ``carry`` words before it, so that
    windows of ``carry + 1`` words are seen once each.  ``bytes.split()`` splits at
    exactly 0x20 and 0x09-0x0D.
    """
    if len(data) <= size:
        yield data.split()
        return
    at, kept, end = 0, [], len(data)
    while at < end:
        cut = min(end, at + size)
        while cut < end and data[cut] not in b" \t\n\x0b\x0c\r":
            cut += 1
        words = kept + data[at:cut].split()
        yield words
        kept = words[-carry:] if carry else []
        at = cut
