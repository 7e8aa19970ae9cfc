"""DataFrame shaping helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lakelens.session import in_one_process


def select_once(df: DataFrame, keep: list[str], fields: list[Column]) -> DataFrame:
    """``df.select(*keep, *fields)`` with ``fields`` evaluated once per row.

    Predicate pushdown substitutes projected expressions into a filter above, and
    projection collapsing inlines them into every consumer; for parsed payloads
    (JSON of up to 25 MiB) that would parse the same value once per reference.
    The fields are emitted through ``inline(array(struct(...)))``, a Generate
    node that neither rule crosses.
    """
    return df.select(*[F.col(c) for c in keep], F.inline(F.array(F.struct(*fields))))


def counted(df: DataFrame, **counts: Column) -> tuple[DataFrame, Observation]:
    """``df`` with aggregates that Spark fills in while the first action runs over it.

    ``observation.get`` (after that action) has them by name, so counting costs no job of its
    own.  The action must read ``df`` whole; below a ``persist()`` the metrics are those of the
    pass that fills the cache.
    """
    observation = Observation()
    return df.observe(observation, *[c.alias(name) for name, c in counts.items()]), observation


def spread(df: DataFrame) -> DataFrame:
    """In a local session, deal an input of one scan task (a small test file) to all threads.

    On a cluster the plan is left as it is: no shuffle is added there.
    """
    if not in_one_process(df.sparkSession):
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def deal(df: DataFrame, per_slot: int = 4) -> DataFrame:
    """Narrow rows of costly work dealt to all task slots, a few tasks each.

    A compressed table of few bytes comes in as few tasks as it has row groups, on any cluster.
    The number is fixed: adaptive execution would join tasks of few bytes again.
    """
    return df.repartition(per_slot * df.sparkSession.sparkContext.defaultParallelism)
