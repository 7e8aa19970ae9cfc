"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source starts with the same expected number of copies, target words over
source words.  Equal rows are one unit, with the sum of their expected copies.  The whole part
is taken; the fraction is rounded by the pivotal method: two units that are still fractional meet, words move at random from one to the other until one
of them is whole, and the other goes on to the next.  Words, not units, are what moves, so a
source's expected words stay exactly its target until the last fractional unit is drawn.

Units meet in groups of about ``GROUP`` (source, salt), from large documents to small; each
group leaves at most one fractional unit, and the left-over units of up to ``GROUP`` groups
meet on the next level: a reduction tree over Spark groups, of depth log_GROUP(units).
Randomness is seeded by source, salt and level, so reruns agree under any partitioning.
"""

from __future__ import annotations

import hashlib
from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakelens.llm.common import fresh, prepare, with_row_id, word_blocks
from lakelens.operators.ids import assign_serial_ids

#: units that meet in one group, and left-over units on each level of the tree
GROUP = 256
_EPS = 1e-9


def word_count(text: str | Column) -> Column:
    """Arrow function: number of ``[^\\x20\\x09-\\x0D]+`` in the text, 0 for null."""
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([sum(map(len, word_blocks((t or "").encode("utf-8", "surrogatepass"))))
                         for t in texts.to_pylist()], pa.int64())
    return F.arrow_udf(run, "long")(text)


def source_targets(units: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), cap: float = 3.0) -> DataFrame:
    """(source, source_size, target) of ``units`` (source, size, n: rows of that size).

    Sources by code point, null last, get the weights in turn.  They share all words by weight;
    a target stops at ``cap`` times its source's size and the excess is shared anew by weight
    among the rest until none is above.  A round is one aggregate to a single row.
    """
    sizes = units.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    numbered = assign_serial_ids(sizes, [F.col("source").asc_nulls_last()], id_col="rank")
    turn = F.array(*[F.lit(float(w)) for w in weights])
    table = numbered.select("source", "source_size", (F.col("source_size") * cap).alias("most"),
                            F.element_at(turn, (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int")).alias("w"))
    table = table.checkpoint()
    total = float(table.agg(F.sum("source_size")).first()[0] or 0)
    level = 0.0  # words for each unit of weight
    while total:
        full = F.col("w") * level >= F.col("most") if level else F.col("most") <= 0
        held = table.agg(F.sum(F.when(full, F.col("most"))).alias("held"), F.sum(F.when(~full, F.col("w"))).alias("w")).first()
        if not held["w"]:
            break
        share = (total - (held["held"] or 0.0)) / held["w"]
        if share <= level * (1 + 1e-12):
            break
        level = share
    return table.select("source", "source_size", F.least(F.col("w") * F.lit(float(level)), F.col("most")).alias("target"))


def _seed(*parts) -> np.random.Generator:
    digest = hashlib.sha256(repr(parts).encode()).digest()
    return np.random.Generator(np.random.Philox(int.from_bytes(digest[:8], "big")))


def pivotal(words: np.ndarray, part: np.ndarray, rng: np.random.Generator, last: bool = False) -> np.ndarray:
    """Round the fractions ``part`` of units of ``words`` words, in order; at most one stays fractional.

    Two fractional units a, b exchange words: either a gains what b can give or b gains what a
    can give, with the odds that keep both expectations; one of them becomes 0 or 1.  Units
    of no words are drawn alone, and with ``last`` so is the remaining one.
    """
    out = part.astype(float).copy()
    draws = rng.random(len(out) + 1)
    carry = -1
    for i in range(len(out)):
        if out[i] <= _EPS or out[i] >= 1 - _EPS:
            out[i] = round(out[i])
            continue
        if words[i] <= 0:
            out[i] = float(draws[i] < out[i])
            continue
        if carry < 0:
            carry = i
            continue
        a, b = carry, i
        up = min((1 - out[a]) * words[a], out[b] * words[b])  # words a can gain
        down = min(out[a] * words[a], (1 - out[b]) * words[b])  # words b can gain
        move = up if draws[i] * (up + down) < down else -down
        out[a] += move / words[a]
        out[b] -= move / words[b]
        left = [k for k in (a, b) if _EPS < out[k] < 1 - _EPS]
        for k in (a, b):
            if k not in left:
                out[k] = round(out[k])
        carry = left[0] if left else -1
    if last and carry >= 0:
        out[carry] = float(draws[-1] < out[carry])
    return out


_LEVEL = "key long, h long, source string, words double, salt long, part double"


def _round_level(level: int, last: bool):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["words", "h", "key"], ascending=[False, True, True], kind="stable")
        source, salt = frame["source"].iloc[0], int(frame["salt"].iloc[0])
        rng = _seed(None if pd.isna(source) else source, salt, level)
        frame = frame.assign(part=pivotal(frame["words"].to_numpy(float), frame["part"].to_numpy(float), rng, last))
        return frame[["key", "h", "source", "words", "salt", "part"]]
    return run


def _spread(rows: int) -> int:
    return max(1, -(-rows // GROUP))


def round_units(units: DataFrame) -> DataFrame:
    """(key, extra): 0 or 1 for every unit of ``units`` (key, h, source, words, part).

    ``key`` is unique; ``h``, a hash of the unit's content, deals and orders the units.  Groups
    of a level are dealt by (source, salt); a hot source has as many salts as its units fill groups.  The salt of the next level is the salt divided by ``GROUP``.
    """
    counts = units.groupBy("source").agg(F.count(F.lit(1)).alias("units"))
    top = counts.agg(F.max("units")).first()[0] or 0
    sized = units.join(counts.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
    salts = F.ceil(F.col("units") / GROUP).cast("long")
    frame = sized.select("key", "h", "source", "words", F.pmod(F.xxhash64("h"), salts).alias("salt"), "part")
    done, level, groups = None, 0, _spread(top)
    while True:
        last = groups == 1
        met = (frame.groupBy("source", "salt").applyInPandas(_round_level(level, last), _LEVEL).checkpoint())
        whole = met.filter((F.col("part") == 0) | (F.col("part") == 1))
        done = whole if done is None else done.unionByName(whole)
        if last:
            break
        frame = (met.filter((F.col("part") != 0) & (F.col("part") != 1))
                 .withColumn("salt", F.floor(F.col("salt") / GROUP).cast("long")))
        level, groups = level + 1, -(-groups // GROUP)
    return done.select("key", F.col("part").cast("long").alias("extra"))


def copies(units: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), cap: float = 3.0) -> DataFrame:
    """(key, source_size, target, copies) of ``units`` (key, h, source, size, n), read from stored data.

    ``copies`` is what the ``n`` equal rows of a unit take together: the whole part of n times
    the source's rate, and one more if the remainder, which moves the words of one row, is drawn.
    """
    targets = source_targets(units, weights, cap).withColumnRenamed("source", "s")
    # a null-safe join whose small side is one row for each source
    joined = units.join(targets, F.col("source").eqNullSafe(F.col("s")))
    rate = F.coalesce(F.try_divide(F.col("target"), F.col("source_size").cast("double")), F.lit(0.0))
    joined = joined.select("key", "h", "source", F.col("size").cast("double").alias("words"),
                           "source_size", "target", (rate * F.col("n")).alias("all"))
    extra = round_units(joined.select("key", "h", "source", "words", (F.col("all") - F.floor("all")).alias("part")))
    return (joined.join(extra, "key")
            .select("key", "source_size", "target", (F.floor("all").cast("long") + F.col("extra")).alias("copies")))


def _dealt(copies: str, n: str, rank: str) -> Column:
    """Copies of the row of rank 1 to ``n`` among equal rows that take ``copies`` together."""
    each = F.floor(F.col(copies) / F.col(n)).cast("long")
    return each + (F.col(rank) <= F.col(copies) - each * F.col(n)).cast("long")


def mix_plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             weights: tuple[float, ...] = (1.0, 2.0, 3.0), cap: float = 3.0) -> DataFrame:
    """id, size, source_size, target and taken (words, repeats counted) of every row of ``docs``.

    Null and empty texts have size 0 and take 0.  A null source is a source of its own, last
    in order.  Copies of rows that agree in id, source and text (repeated rows) are dealt out
    among them evenly.  An empty table gives an empty result; other columns are not read.
    """
    prepare(docs.sparkSession)
    narrow = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
                         word_count(text_col).alias("size"), F.xxhash64(id_col, source_col, text_col).alias("h"))
    units = (narrow.groupBy("h", "id", "source", "size").agg(F.count(F.lit(1)).alias("n"))
             .withColumn("key", F.monotonically_increasing_id()).checkpoint())
    planned = copies(units, weights, cap)
    return (units.join(planned, "key")
            .select("*", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("row"))
            .select(F.col("id").alias(id_col), "size", "source_size", "target",
                    (F.col("size") * _dealt("copies", "n", "row")).alias("taken")))


def mix(docs: DataFrame, text_col: str = "text", source_col: str = "source",
        weights: tuple[float, ...] = (1.0, 2.0, 3.0), cap: float = 3.0) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as its copies, all columns kept.

    Rows are numbered in a table written once to the shared folder.  Rows equal in source and
    text are one unit, whose copies are dealt out by rank: the place of the row's part of
    the table among the parts with such rows, then the row's place in its part, so that
    no task has to see all rows of a large group of copies.
    """
    prepare(docs.sparkSession)
    rid, size, h = fresh(docs, "row_id"), fresh(docs, "size"), fresh(docs, "h")
    tagged = with_row_id(docs, rid, {size: word_count(text_col), h: F.xxhash64(source_col, text_col)}, "mix")
    rows = tagged.select(F.col(rid).alias("rid"), F.col(h).alias("h"), F.col(source_col).cast("string").alias("source"),
                         F.col(size).alias("size"), F.shiftright(F.col(rid), 33).alias("part"))
    equal = ["h", "source", "size"]
    parts = rows.groupBy(*equal, "part").agg(F.count(F.lit(1)).alias("here")).checkpoint()
    units = (parts.groupBy(*equal).agg(F.sum("here").alias("n"))
             .withColumn("key", F.monotonically_increasing_id()).checkpoint())
    planned = units.join(copies(units, weights, cap).filter("copies > 0"), "key").select(*equal, "n", "copies")
    before = Window.partitionBy(*equal).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("before", F.coalesce(F.sum("here").over(before), F.lit(0))).drop("here")
    parts = _join_equal(parts, planned, equal)
    place = F.row_number().over(Window.partitionBy(*equal, "part").orderBy("rid"))
    ranked = _join_equal(rows.withColumn("place", place), parts, [*equal, "part"])
    times = ranked.select("rid", (F.col("before") + F.col("place")).alias("rank"), "n", "copies").select(
        F.col("rid").alias(rid), _dealt("copies", "n", "rank").alias(h)).filter(F.col(h) > 0)
    taken = tagged.drop(size, h).join(times, rid)
    return taken.select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col(h).cast("int"))).alias(rid)).drop(rid)


def _join_equal(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``left`` with the columns that ``right`` adds, nulls in ``keys`` being equal."""
    other = right.select(*[F.col(c).alias(f"r_{c}") if c in keys else F.col(c) for c in right.columns])
    joined = left.join(other, reduce(and_, [F.col(k).eqNullSafe(F.col(f"r_{k}")) for k in keys]))
    return joined.drop(*[f"r_{k}" for k in keys])
