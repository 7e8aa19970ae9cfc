"""Dense serial ids (``SERIAL``) assigned in a stated order without funnelling rows into one task.

Rows are range-partitioned and sorted by the order; ``monotonically_increasing_id``
then carries (partition index, position in partition).  Per-partition counts
(one row per partition) give each partition its starting id; that small table is
broadcast back.

The tagged rows are checkpointed (reliable storage under ``spark.checkpoint.dir``)
before they are used twice: a range shuffle's bounds and adaptive coalescing can
differ between two executions, and the counts must describe exactly the rows
that get the ids, also after an executor is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakelens.session import shared_dir

_POS_BITS = 33


def assign_serial_ids(df: DataFrame, order_cols: list, start_after: Column | int | None = 0,
                      id_col: str = "id") -> DataFrame:
    shared_dir(df.sparkSession)
    ordered = df.orderBy(*order_cols)
    tagged = (ordered.withColumn("_mid", F.monotonically_increasing_id())
              .withColumn("_part", F.shiftright(F.col("_mid"), _POS_BITS))
              .withColumn("_pos", F.col("_mid").bitwiseAND((1 << _POS_BITS) - 1))
              .checkpoint(eager=True))
    counts = tagged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    base = start_after if isinstance(start_after, Column) else F.lit(start_after)
    out = tagged.join(F.broadcast(starts), "_part")
    return (out.withColumn(id_col, (F.coalesce(base, F.lit(0)) + F.col("_before") + F.col("_pos") + 1).cast("long"))
            .drop("_mid", "_part", "_pos", "_before"))
