"""Ranked lexical search: a document FP-tree searched depth first with bounds.

One pass turns every text into its term vector, restricted to the terms of the items, and
counts all its terms; the vectors are written.  Document frequencies come from the vectors.
Each task then builds FP-trees of some thousand documents: a vector's terms are ordered by
document frequency, the most frequent first, and vectors that begin alike share a path of the
trie.  A node knows the largest tf of every term below it, the smallest m and the smallest id.
As a term's part of the score rises with tf and falls with m, the score at these is a bound of
all documents below; at a leaf (equal vectors, equal m) it is their score.  The search walks
down, best child first, with the items that are still open; an item leaves at a node whose
bound is below the ``top``-th score that the task has for it so far.  The items share the walk,
but each has its own bounds and its own cut.

Scores are exact: every document is either scored or below a bound.  A task's memory is one
tree and ``top`` documents an item; its result rows meet in a reduction of fixed fan-in.
"""

from __future__ import annotations

import math
from bisect import insort
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakelens.llm.common import fresh, prepare, quoted, word_blocks
from lakelens.session import work_path

TOP = 50
#: documents and postings of one tree
TREE_DOCS, TREE_POSTINGS = 4096, 1 << 19
#: item text searched for in one pass over the vectors; more items take more passes
BLOCK_BYTES = 1 << 20
#: items that walk a tree together
GROUP = 256
#: partial results merged by one task
FAN_IN = 64

#: A-Z in lower case; every ASCII character that is no letter or digit becomes a blank
TERMS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
              for b in range(256))
VECTOR = "struct<n: bigint, terms: array<int>, tfs: array<int>>"


def terms_of(text: str | None) -> set[bytes]:
    """Distinct terms of a text; null has none."""
    return set((text or "").encode("utf-8", "surrogatepass").translate(TERMS).split())


def weight(n_docs: int, df: int) -> int:
    """floor(1000 ln((2 N + 2) / (2 df + 1)))"""
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def vector_column(text: str | Column, vocabulary: dict[bytes, int]) -> Column:
    """Arrow function: number of all terms, and numbers and tf of those in ``vocabulary``."""
    number = vocabulary.get

    def run(texts: pa.Array) -> pa.Array:
        sizes, terms, tfs, ends = [], [], [], [0]
        for text in texts.to_pylist():
            n, counts = 0, Counter()
            if text:
                for words in word_blocks(text.encode("utf-8", "surrogatepass").translate(TERMS)):
                    n += len(words)
                    counts.update(map(number, words))
            counts.pop(None, None)
            sizes.append(n)
            terms += counts.keys()
            tfs += counts.values()
            ends.append(len(terms))
        ends = pa.array(ends, pa.int32())
        return pa.StructArray.from_arrays(
            [pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(ends, pa.array(terms, pa.int32())),
             pa.ListArray.from_arrays(ends, pa.array(tfs, pa.int32()))], names=["n", "terms", "tfs"])
    return F.arrow_udf(run, VECTOR)(text)


class Node:
    """A subtree: largest tf of each of its terms, smallest m and id; children or the ids of a leaf."""

    __slots__ = ("terms", "tfs", "m", "low", "children", "ids")

    def __init__(self, terms, tfs, m, low, children=(), ids=()):
        self.terms, self.tfs, self.m, self.low, self.children, self.ids = terms, tfs, m, low, children, ids

    def parts(self) -> np.ndarray:
        """The score's factor of each term at the largest tf and smallest m."""
        tf = self.tfs.astype(np.int64)
        return 1_000_000_000 * tf // (1000 * tf + 20 * self.m)


def _join(children: list[Node]) -> Node:
    """The node above ``children``."""
    if len(children) == 1:
        return children[0]
    terms = np.concatenate([c.terms for c in children])
    order = np.argsort(terms, kind="stable")
    terms = terms[order]
    first = np.nonzero(np.concatenate(([True], terms[1:] != terms[:-1])))[0]
    tfs = np.maximum.reduceat(np.concatenate([c.tfs for c in children])[order], first)
    return Node(terms[first], tfs, min(c.m for c in children), min(c.low for c in children), children)


def grow(ids: list, ms: list[int], terms: np.ndarray, tfs: np.ndarray, ends: np.ndarray) -> Node:
    """The FP-tree of vectors whose term numbers (ascending) are frequency ranks.

    ``ends``: row i has the terms from ``ends[i]`` to ``ends[i + 1]``; every row has some.
    Ids are sort keys (null flag, id).
    """
    wide = terms.astype(">u4").tobytes()
    many = tfs.astype(">u4").tobytes()
    at = ends.tolist()
    keyed: dict[tuple, list] = {}
    for i, key in enumerate(ids):
        a, b = 4 * at[i], 4 * at[i + 1]
        keyed.setdefault((wide[a:b], many[a:b], ms[i]), []).append((key, i))
    leaves, paths = [], []
    for path, _, m in sorted(keyed):
        same = sorted(keyed[path, _, m], key=lambda x: x[0])
        i = same[0][1]
        leaves.append(Node(terms[at[i]:at[i + 1]], tfs[at[i]:at[i + 1]], m, same[0][0], (), [k for k, _ in same]))
        paths.append(path)
    # neighbours in sorted order share the path down to where they part; a stack holds the open nodes
    open_nodes: list[tuple[int, list[Node]]] = [(0, [])]
    for i in range(1, len(leaves)):
        a, b = leaves[i - 1].terms, leaves[i].terms
        k = min(len(a), len(b))
        differ = np.nonzero(a[:k] != b[:k])[0]
        shared = int(differ[0]) if len(differ) else k
        done = leaves[i - 1]
        while open_nodes[-1][0] > shared:
            done = _join([*open_nodes.pop()[1], done])
        if open_nodes[-1][0] == shared:
            open_nodes[-1][1].append(done)
        else:
            open_nodes.append((shared, [done]))
    done = leaves[-1]
    while open_nodes:
        done = _join([*open_nodes.pop()[1], done])
    return done


@dataclass
class Items:
    """A group of items that walk together: their weights by term, and their best documents so far."""

    numbers: list[int]
    #: term number -> row of ``weights``, -1 for terms of no item here
    row: np.ndarray
    #: terms x items
    weights: np.ndarray
    top: int
    best: list[list[tuple]] = field(default_factory=list)
    floor: np.ndarray = field(default=None)

    def __post_init__(self):
        self.best = [[] for _ in self.numbers]
        self.floor = np.zeros(len(self.numbers), self.weights.dtype)

    def bounds(self, node: Node, items: np.ndarray) -> np.ndarray:
        """Bound (at a leaf: score) of ``items`` at ``node``."""
        rows = self.row[node.terms]
        held = rows >= 0
        rows, parts = rows[held], node.parts()[held].astype(self.weights.dtype)
        if 2 * len(items) >= len(self.numbers):
            return (parts @ self.weights[rows])[items]
        return parts @ self.weights[np.ix_(rows, items)]

    def add(self, item: int, score: int, ids: list) -> None:
        """Documents ``ids`` (ascending) of one score."""
        best = self.best[item]
        for key in ids:
            entry = (-score, key)
            if len(best) == self.top:
                if entry >= best[-1]:
                    break
                best.pop()
            insort(best, entry)
        if len(best) == self.top:
            self.floor[item] = -best[-1][0]

    def search(self, root: Node) -> None:
        """Depth first from ``root``, best child first, each item as far as its bound allows."""
        everyone = np.arange(len(self.numbers))
        stack = [(root, everyone, self.bounds(root, everyone))]
        while stack:
            node, items, bounds = stack.pop()
            floor = self.floor[items]
            keep = bounds > floor
            for j in np.nonzero((bounds == floor) & (floor > 0))[0].tolist():  # a tie goes to the smaller id
                best = self.best[items[j]]
                keep[j] = len(best) < self.top or node.low < best[-1][1]
            items, bounds = items[keep], bounds[keep]
            if not len(items):
                continue
            if node.ids:
                for item, score in zip(items.tolist(), bounds.tolist(), strict=True):
                    self.add(item, int(score), node.ids)
                continue
            below = [(child, items, self.bounds(child, items)) for child in node.children]
            stack += sorted(below, key=lambda x: x[2].max())


def item_groups(items: list[set[int]], weights: list[int], top: int, size: int = GROUP) -> list[Items]:
    """Items as sets of term numbers, in groups of ``size``."""
    out = []
    for a in range(0, len(items), size):
        part = items[a:a + size]
        used = sorted(set().union(*part))
        row = np.full(len(weights), -1, np.int32)
        row[used] = np.arange(len(used))
        # sums of whole numbers are exact in doubles below 2 ** 53
        most = max((sum(weights[t] for t in terms) for terms in part), default=0) * 1_000_000
        table = np.zeros((len(used), len(part)), np.float64 if most < 1 << 53 else np.int64)
        for j, terms in enumerate(part):
            for t in terms:
                table[row[t], j] = weights[t]
        out.append(Items(list(range(a, a + len(part))), row, table, top))
    return out


def _finder(items: list[set[int]], weights: list[int], rank: np.ndarray, n_docs: int, length: int, top: int):
    """Map function over vectors: a partition's best documents of every item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = item_groups(items, weights, top)
        held: list[tuple] = []
        docs = postings = 0

        def walk() -> None:
            ids = [k for part in held for k in part[0]]
            sizes = np.concatenate([part[1] for part in held])
            counts = np.concatenate([part[2] for part in held])
            terms = rank[np.concatenate([part[3] for part in held])]
            tfs = np.concatenate([part[4] for part in held])
            order = np.lexsort((terms, np.repeat(np.arange(len(ids)), counts)))
            ms = [50 + 50 * n * n_docs // length for n in sizes.tolist()]
            root = grow(ids, ms, terms[order], tfs[order], np.concatenate(([0], np.cumsum(counts))))
            for group in groups:
                group.search(root)

        kind = pa.null()
        for batch in batches:
            kind = batch.schema.field("id").type
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                lists = [part.column(c) for c in ("terms", "tfs")]
                counts = lists[0].value_lengths().to_numpy(zero_copy_only=False)
                held.append(([(k is None, 0 if k is None else k) for k in part.column("id").to_pylist()],
                             part.column("n").to_numpy(), counts, *[x.flatten().to_numpy() for x in lists]))
                docs, postings = docs + len(counts), postings + int(counts.sum())
                if docs >= TREE_DOCS or postings >= TREE_POSTINGS:
                    walk()
                    held, docs, postings = [], 0, 0
        if held:
            walk()
        for group in groups:
            rows = [(number, None if key[0] else key[1], -score)
                    for number, best in zip(group.numbers, group.best, strict=True) for score, key in best]
            if rows:
                item, ids, scores = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(item, pa.int32()), pa.array(ids, kind), pa.array(scores, pa.int64())],
                    names=["item", "id", "score"])
    return run


def _best(found: DataFrame, by: list[str], top: int) -> DataFrame:
    """The ``top`` rows of each group, with ``rank``."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def _merge(found: DataFrame, top: int) -> DataFrame:
    """The ``top`` rows of each item, out of those of every ``part``, at most ``FAN_IN`` parts at a time."""
    parts = (found.agg(F.max("part")).first()[0] or 0) + 1
    while parts > FAN_IN:
        found = _best(found.withColumn("part", F.floor(F.col("part") / FAN_IN)), ["item", "part"], top).drop("rank")
        parts = -(-parts // FAN_IN)
    return _best(found, ["item"], top)


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", top: int = TOP,
           block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item, ``rank``, id, ``score``): the ``top`` documents of every item with a score above 0.

    Rows of one item id are one item with the terms of all its texts; a null item id is an id
    like any other.  Null or termless items and documents match nothing.  Every row of ``docs``
    is a document, repeated rows too.  Equal scores are ranked by ascending id, null ids last;
    equal ids are interchangeable.  Empty tables give an empty result.  Other columns are not
    read.

    The items are searched in blocks of at most ``block_bytes`` of text (or one longer item);
    only a block's terms are shipped.
    """
    spark = docs.sparkSession
    prepare(spark)
    entry = items.select(quoted(item_col).alias("item"), quoted(item_text_col).alias("text")).filter("text is not null")
    total = entry.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    out_id, out_item = id_col, (item_col if item_col.lower() != id_col.lower() else fresh(docs, item_col))
    result = None
    for block in range(blocks):
        mine: dict = {}
        part = entry if blocks == 1 else entry.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block)
        for item, text in part.toLocalIterator():
            mine.setdefault(item, set()).update(terms_of(text))
        found = _search_block(docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text")), mine, top)
        names = spark.createDataFrame(list(enumerate(mine)), f"item int, name {items.schema[item_col].dataType.simpleString()}")
        named = found.join(F.broadcast(names), "item").select(
            F.col("name").alias(out_item), F.col("rank").cast("int").alias("rank"), F.col("id").alias(out_id), "score")
        result = named if result is None else result.unionByName(named)
    return result


def _search_block(docs: DataFrame, items: dict, top: int) -> DataFrame:
    """(item, rank, id, score) of a block of items, numbered in their order; ``docs`` has id and text."""
    spark = docs.sparkSession
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*items.values())))}
    path = work_path(spark, "lexical-vectors")
    docs.select("id", vector_column("text", vocabulary).alias("v")).select("id", "v.*").write.parquet(path)
    vectors = spark.read.parquet(path)
    n_docs, length = vectors.agg(F.count(F.expr("CASE WHEN n > 0 THEN 1 END")), F.coalesce(F.sum("n"), F.lit(0))).first()
    counted = vectors.select(F.explode("terms").alias("t")).groupBy("t").count()
    df = np.zeros(len(vocabulary), np.int64)
    for t, n in counted.toLocalIterator():  # one row a term of the block
        df[t] = n
    # terms are numbered anew by frequency, the most frequent first
    order = np.lexsort((np.arange(len(df)), -df))
    rank = np.empty(len(df), np.int32)
    rank[order] = np.arange(len(df), dtype=np.int32)
    weights = [weight(n_docs, int(df[t])) for t in order.tolist()]
    wanted = [{int(rank[vocabulary[t]]) for t in terms} for terms in items.values()]
    path = work_path(spark, "lexical-found")
    (vectors.filter(F.size("terms") > 0)
     .mapInArrow(_finder(wanted, weights, rank, n_docs, length, top),
                 f"item int, id {docs.schema['id'].dataType.simpleString()}, score long")
     .withColumn("part", F.spark_partition_id().cast("long")).write.parquet(path))
    return _merge(spark.read.parquet(path), top)
