"""Merkle manifest of a table: a content-addressed DAG, proofs by descent, folding and checking.

Rows become leaves (SHA-256 of their encoded columns).  The leaves of one group, in order, are
hashed in runs of ``ARITY`` until one node is left, the group's subroot; the subroots, ordered
by group, are hashed likewise to the root.  Every inner node is one record ``digest ->
children`` of the store; a node that occurs twice is stored once.

A proof is found by descent.  A leaf's place is a path of digits (base ``ARITY``): those of its
group's rank among the groups, then those of its own rank in the group.  Requests that share a
prefix share one row on the way down: from the root, each level looks its digests up in the
store, picks the child under the next digit and keeps the unselected ones as a path segment.
Only runs of leaves come down as rows, a sixteenth of the leaves; the leaves join their run by
path, and the segments, reversed, are the proof from leaf to root.  So no join has a key that
grows with a group.

Ranks come from one range partitioning written to the shared folder: a row's rank is its place
in its partition plus the group's rows in earlier partitions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakelens.llm.common import prepare, quoted, with_row_id
from lakelens.session import work_path

ARITY = 16
#: digests that one broadcast lookup holds at most
LOOKUP = 4096
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEGMENT = "array<struct<left:string,right:string>>"


def sha(text: Column) -> Column:
    """Lower-case hex SHA-256 of a string's UTF-8."""
    return F.sha2(text.cast("binary"), 256)


def encoded(column: Column) -> Column:
    """``-`` for null, else the value's UTF-8 byte count, a colon and the value."""
    value = column.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaf_digest(columns: list[Column]) -> Column:
    """The leaf of a row: SHA-256 of its encoded columns, one after the other."""
    return sha(F.concat(*[encoded(c) for c in columns]))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, _UPPER, _LOWER)


def _place(rows: DataFrame, group: str, order: list[str], label: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` sorted into partitions and written, and (part, group, ``n``, ``first``, ``before``) of them.

    Range partitioning by group and order spreads a large group over many partitions.  The
    written places (partition number and position) are fixed, whatever is computed again later.
    ``before`` sums a group's rows in earlier partitions.
    """
    spark = rows.sparkSession
    path = work_path(spark, label)
    (rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
     .withColumn("place", F.monotonically_increasing_id()).write.parquet(path))
    placed = spark.read.parquet(path).withColumn("part", F.shiftright("place", 33))
    earlier = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = (placed.groupBy("part", group).agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))
              .withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))))
    return placed, counts.checkpoint()


def _ranked(placed: DataFrame, counts: DataFrame, group: str) -> DataFrame:
    """Rows with their 0-based ``rank`` in the group, and what else ``counts`` carries."""
    return (placed.join(counts.drop("n"), ["part", group])
            .withColumn("rank", F.col("place") - F.col("first") + F.col("before"))
            .drop("part", "place", "first", "before"))


def height(size: int, arity: int = ARITY) -> int:
    """Levels of hashing until ``size`` nodes are one."""
    levels = 0
    while size > 1:
        size, levels = -(-size // arity), levels + 1
    return levels


def _height(size: Column, most: int, arity: int) -> Column:
    """``height`` of a column whose values have ``most`` levels at most."""
    return sum(((size > F.lit(arity ** k)).cast("int") for k in range(most)), F.lit(0))


def _digits(rank: Column, levels: Column, arity: int) -> Column:
    """The ``levels`` digits of ``rank``, most significant first, as one string."""
    return F.lpad(F.lower(F.conv(rank.cast("string"), 10, arity)), levels, F.lit("0"))


@dataclass
class Manifest:
    """A built tree: its leaf rows, its store and its root."""

    #: order column, ``leaf``, ``path`` (digits from the root) and the kept columns
    leaves: DataFrame
    #: ``digest`` and ``children`` of every inner node
    store: DataFrame
    #: digest of all; None for an empty table
    root: str | None
    #: levels above the subroots, and in all
    group_levels: int
    depth: int
    arity: int


def _hash_up(nodes: DataFrame, most: int, arity: int, label: str) -> tuple[list[DataFrame], DataFrame]:
    """Records of every level over ``nodes`` (grp, idx, size, digest), and each grp's last node (grp, digest).

    A level is one aggregation of at most ``arity`` digests a node; it is written, as store and
    as the next level's input.
    """
    spark, records = nodes.sparkSession, []
    last = nodes.filter("size = 1").select("grp", "digest")
    for _ in range(height(most, arity)):
        runs = (nodes.filter("size > 1")
                .groupBy("grp", F.floor(F.col("idx") / arity).alias("idx"), F.ceil(F.col("size") / arity).alias("size"))
                .agg(F.sort_array(F.collect_list(F.struct("idx", "digest"))).alias("run"))
                .select("grp", "idx", "size", F.col("run.digest").alias("children")))
        path = work_path(spark, label)
        runs.withColumn("digest", sha(F.array_join("children", ""))).write.parquet(path)
        nodes = spark.read.parquet(path)
        records.append(nodes.select("digest", "children"))
        last = last.unionByName(nodes.filter("size = 1").select("grp", "digest"))
    return records, last


def build(rows: DataFrame, leaf: Column, group_col: str = "source", order_col: str = "doc_id",
          arity: int = ARITY, keep: dict[str, Column] | None = None) -> Manifest:
    """The tree of ``rows``, ``leaf`` being the digest of a row and ``keep`` what else its leaf row carries.

    Groups are ordered by value, null first and bytewise; the leaves of a group by ``order_col``,
    null first, those of equal value by digest (repeated rows are leaves of their own).  An empty
    table has no leaf, no record and root None.  Column names of ``rows`` do not matter.
    """
    if not 2 <= arity <= 36:
        raise ValueError("a node has 2 to 36 children")
    spark = rows.sparkSession
    prepare(spark)
    # the group as a string that sorts null first
    grp = F.when(quoted(group_col).isNull(), "").otherwise(F.concat(F.lit("="), quoted(group_col).cast("string")))
    wanted = with_row_id(
        rows.select(grp.alias("grp"), quoted(order_col).alias("ord"), leaf.alias("leaf"),
                    *[c.alias(f"keep_{n}") for n, c in (keep or {}).items()]), "rid", label="merkle-rows")
    # equal leaves are told apart by row number, so that a partition need not hold all of them
    placed, counts = _place(wanted, "grp", ["ord", "leaf", "rid"], "merkle-leaves")
    sizes = counts.groupBy("grp").agg(F.sum("n").alias("size")).withColumn("all", F.lit(0))
    groups = _ranked(*_place(sizes, "all", ["grp"], "merkle-groups"), "all").withColumnRenamed("rank", "nth").drop("all")
    groups = groups.checkpoint()
    total, largest = groups.agg(F.count(F.lit(1)), F.coalesce(F.max("size"), F.lit(0))).first()
    leaves = _ranked(placed, counts.join(groups, "grp"), "grp")

    nodes = leaves.select("grp", F.col("rank").alias("idx"), "size", F.col("leaf").alias("digest"))
    records, subroots = _hash_up(nodes, largest, arity, "merkle-nodes")
    upper = subroots.join(groups, "grp").select(
        F.lit(0).alias("grp"), F.col("nth").alias("idx"), F.lit(total).alias("size"), "digest")
    more, top = _hash_up(upper, total, arity, "merkle-nodes")
    root = top.first()

    store = spark.createDataFrame([], "digest string, children array<string>")
    for record in records + more:
        store = store.unionByName(record)
    above, below = height(total, arity), height(largest, arity)
    path = F.concat(_digits(F.col("nth"), F.lit(above), arity),
                    _digits(F.col("rank"), _height(F.col("size"), below, arity), arity))
    out = leaves.select(F.col("ord").alias(order_col), "leaf", path.alias("path"),
                        *[F.col(f"keep_{n}").alias(n) for n in keep or {}])
    return Manifest(out, store.dropDuplicates(["digest"]).checkpoint(), root["digest"] if root else None,
                    above, above + below, arity)


def _segment(children: Column, digit: Column, arity: int) -> Column:
    """The unselected children before and after ``digit``."""
    return F.struct(F.array_join(F.slice(children, F.lit(1), digit), "").alias("left"),
                    F.array_join(F.slice(children, digit + 2, F.lit(arity)), "").alias("right"))


def prove(tree: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """``requests`` (rows of ``tree.leaves``; None: all) with ``subroot`` and ``proof``.

    ``proof``: one segment a level from the leaf up, the concatenated digests of the run's
    other nodes before (``left``) and after (``right``) the path.  A tree of one leaf has an
    empty proof.  No requests give no rows.
    """
    requests = tree.leaves if requests is None else requests
    spark = requests.sparkSession
    parent = F.expr("substring(path, 1, length(path) - 1)")
    digit = F.conv(F.substring("path", -1, 1), tree.arity, 10).cast("int")

    # the nodes on the way to any requested leaf's run: all prefixes of the runs' paths
    path = work_path(spark, "merkle-way")
    (requests.filter("path <> ''").select(parent.alias("path")).distinct()
     .select(F.explode(F.expr("transform(sequence(0, length(path)), n -> substring(path, 1, n))")).alias("path"))
     .distinct().write.parquet(path))
    way = spark.read.parquet(path)

    opened = spark.createDataFrame([], f"path string, children array<string>, above {SEGMENT}, subroot string")
    top = spark.createDataFrame([("", tree.root)] if tree.root else [], "path string, digest string")
    subroot = F.col("digest") if tree.group_levels == 0 else F.lit(None).cast("string")
    at = top.select("path", "digest", F.array().cast(SEGMENT).alias("above"), subroot.alias("subroot"))
    for level in range(tree.depth):
        # at most arity ** level digests: small levels are looked up by broadcast
        few = tree.arity ** level <= LOOKUP
        path = work_path(spark, "merkle-opened")
        ((F.broadcast(at) if few else at).join(tree.store, "digest")
         .select("path", "children", "above", "subroot").write.parquet(path))
        here = spark.read.parquet(path)
        opened = opened.unionByName(here)
        child = F.get("children", F.col("digit"))
        wanted = way.filter(F.length("path") == level + 1).select(
            F.col("path").alias("next"), digit.alias("digit"), parent.alias("path"))
        at = wanted.join(here, "path").select(
            F.col("next").alias("path"), child.alias("digest"),
            F.concat("above", F.array(_segment(F.col("children"), F.col("digit"), tree.arity))).alias("above"),
            (child if level + 1 == tree.group_levels else F.col("subroot")).alias("subroot"))

    run = opened.withColumnRenamed("path", "run")
    segments = F.concat("above", F.array(_segment(F.col("children"), F.col("digit"), tree.arity)))
    found = requests.withColumns({"run": F.when(F.col("path") != "", parent), "digit": digit}).join(run, "run", "left")
    return found.withColumns({
        # a lone leaf is its group's subroot
        "subroot": F.coalesce("subroot", "leaf"),
        "proof": F.when(F.col("children").isNull(), F.array().cast(SEGMENT)).otherwise(F.reverse(segments)),
    }).drop("run", "digit", "children", "above")


def siblings(proof: Column) -> Column:
    """All digests of a proof, level by level, left to right, as one string."""
    return F.array_join(F.transform(proof, lambda s: F.concat(s.left, s.right)), "")


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, leaf, lambda acc, s: sha(F.concat(s.left, acc, s.right)))


def audit(docs: DataFrame, columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
          tampered: dict[str, Column] | None = None, group_col: str = "source", order_col: str = "doc_id",
          arity: int = ARITY) -> DataFrame:
    """Every row's leaf, subroot, root and proof digest, and whether its present content verifies.

    ``columns`` are hashed in this order; ``tampered`` maps column names to their present values
    where these differ from the recorded ones.  ``folded_root`` is the fold of the present leaf
    with the recorded siblings, ``verified`` whether it is the root.  One row per row of
    ``docs``; null values are hashed as ``-``.  An empty table gives no rows.
    """
    now = [(tampered or {}).get(c, quoted(c)) for c in columns]
    tree = build(docs, leaf_digest([quoted(c) for c in columns]), group_col, order_col, arity,
                 {"present": leaf_digest(now)})
    folded = fold(F.col("present"), F.col("proof"))
    return (prove(tree).select(order_col, "leaf", "subroot", F.lit(tree.root).alias("root"),
                               sha(siblings(F.col("proof"))).alias("proof_sha256"), folded.alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))


def lowered_every_fifth(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The text, its A-Z in lower case where 5 divides the CRC-32 of the decimal id."""
    hit = F.crc32(quoted(id_col).cast("string").cast("binary")) % 5 == 0
    return F.when(hit, lower_ascii(quoted(text_col))).otherwise(quoted(text_col))
