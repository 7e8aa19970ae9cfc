"""SimHash near-duplicates: fingerprints, exact linking in tiles, connected components.

Linking is exact.  Two 64-bit fingerprints at most ``radius`` bits apart agree on at least
``blocks - radius`` of ``blocks`` bit blocks, so every such pair meets under a mask that
keeps some ``blocks - radius`` blocks.  Fingerprints meeting under a mask form a bucket;
buckets are compared in tiles with numpy exclusive-or and bit counts, and tile pairs whose
population counts differ by more than the radius are skipped.  The number of blocks follows
the number of distinct fingerprints so that random buckets stay small at every size; it
changes the cost, never the links.

A bucket beyond ``TILE`` rows (a large group of near copies) is cut into tiles of one
population count each, and every tile pair is a group of its own, dealt over all tasks.
A tile pair emits a spanning forest of its links (fewer edges than rows), which keeps
connectivity without emitting all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakelens.llm.common import LOWER, fresh, prepare, with_row_id, word_blocks

SEED = 42
TILE = 1024
#: wanted rows in a bucket of unrelated fingerprints
BUCKET_ROWS = 256
_STEP = 256


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """SimHash of the lower-cased (A-Z) words of ``text`` as an unsigned 64-bit number.

    A bit is 1 if it is set in over half of the XXH64 hashes of all word shingles, repeats
    included.  Fewer words than a shingle: the whole sequence is the only shingle.  Null
    or no words: 0.
    """
    if not text:
        return 0
    votes, total, short = np.zeros(64, dtype=np.int64), 0, []
    data = text.encode("utf-8", "surrogatepass").translate(LOWER)
    for words in word_blocks(data, carry=shingle - 1):
        n = len(words)
        if n < shingle:  # with the words carried here, the whole sequence so far unless a shingle was seen
            short = words
            continue
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        spans = zip(starts[: n - shingle + 1].tolist(), ends[shingle - 1:].tolist(), strict=True)
        joined = b" ".join(words)
        hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans], dtype=np.uint64)
        total += len(hashes)
        for at in range(0, len(hashes), 1 << 16):
            octets = hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8)
            votes += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    if not total:
        return xxhash.xxh64_intdigest(b" ".join(short), SEED) if short else 0
    bits = np.packbits(votes * 2 > total, bitorder="little")
    return int(bits.view(np.uint64)[0])


def fingerprint_column(text: str | Column, shingle: int = 4) -> Column:
    """Arrow function: the fingerprint as a (signed) long."""
    def run(texts: pa.Array) -> pa.Array:
        out = np.array([fingerprint(t, shingle) for t in texts.to_pylist()], dtype=np.uint64)
        return pa.array(out.view(np.int64))
    return F.arrow_udf(run, "long")(text)


def block_masks(n: int, radius: int) -> list[int]:
    """Bit masks of which any two words within ``radius`` bits agree under at least one.

    The fewest blocks whose masks leave about ``BUCKET_ROWS`` of ``n`` random words together.
    """
    for blocks in range(radius + 1, 65):
        kept = blocks - radius
        if n <= BUCKET_ROWS * 2 ** (64 * kept // blocks) or blocks >= 2 * radius + 2:
            break
    edges = [64 * i // blocks for i in range(blocks + 1)]
    parts = [((1 << b) - (1 << a)) for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(c) for c in combinations(parts, blocks - radius)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def _forest(left: np.ndarray, right: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (values) of a spanning forest of the links left[a]-right[b]."""
    u, v = left[a], right[b]
    if len(u) <= 4 * (len(left) + len(right)):
        return u, v
    nodes, flat = np.unique(np.concatenate((u, v)), return_inverse=True)
    i, j = flat[: len(u)], flat[len(u):]
    label = np.arange(len(nodes))
    while True:
        before = label.copy()
        low = np.minimum(label[i], label[j])
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[label]
        if np.array_equal(before, label):
            break
    return nodes, nodes[label]


def link(left: np.ndarray, right: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within ``left`` (``right`` None) or between both, thinned to a spanning forest.

    Rows are cut into steps ordered by population count; a pair of steps whose counts lie
    further apart than the radius cannot hold a link and is skipped.
    """
    same = right is None
    left = left[np.argsort(np.bitwise_count(left), kind="stable")]
    right = left if same else right[np.argsort(np.bitwise_count(right), kind="stable")]
    pop_l, pop_r = np.bitwise_count(left).astype(int), np.bitwise_count(right).astype(int)
    us, vs = [], []
    for i in range(0, len(left), _STEP):
        x = left[i:i + _STEP]
        for j in range(i if same else 0, len(right), _STEP):
            y = right[j:j + _STEP]
            if pop_r[j] - pop_l[i + len(x) - 1] > radius or pop_l[i] - pop_r[j + len(y) - 1] > radius:
                continue
            near = np.bitwise_count(x[:, None] ^ y[None, :]) <= radius
            if same and i == j:
                near = np.triu(near, 1)
            a, b = np.nonzero(near)
            if len(a):
                u, v = _forest(x, y, a, b)
                us.append(u)
                vs.append(v)
    if not us:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return np.concatenate(us), np.concatenate(vs)


def _compare(radius: int):
    """Map function over rows sorted by group: links of every group."""
    def edges(fps: np.ndarray, first: np.ndarray) -> pa.RecordBatch:
        if first.all():
            u, v = link(fps, None, radius)
        else:
            u, v = link(fps[first], fps[~first], radius)
        a, b = u.view(np.int64), v.view(np.int64)
        low, high = np.minimum(a, b), np.maximum(a, b)
        keep = low != high
        return pa.RecordBatch.from_arrays([pa.array(low[keep]), pa.array(high[keep])], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        key = None
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(n).to_numpy(zero_copy_only=False) for n in ("tbl", "bits", "a", "b")]
            fps = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            first = batch.column("first").to_numpy(zero_copy_only=False).astype(bool)
            change = np.zeros(len(fps), dtype=bool)
            for c in cols:
                change[1:] |= c[1:] != c[:-1]
            cuts = [0, *np.nonzero(change)[0].tolist(), len(fps)]
            for s, e in zip(cuts, cuts[1:], strict=False):
                k = tuple(int(c[s]) for c in cols)
                if k != key and held:
                    out = edges(*map(np.concatenate, zip(*held, strict=True)))
                    held = []
                    if out.num_rows:
                        yield out
                key = k
                held.append((fps[s:e], first[s:e]))
        if held:
            out = edges(*map(np.concatenate, zip(*held, strict=True)))
            if out.num_rows:
                yield out
    return run


def near_links(fps: DataFrame, radius: int, tile: int = TILE) -> DataFrame:
    """Edges (u, v), u < v, whose components are those of all links between the distinct ``fp``.

    ``fps``: one column ``fp`` (long), no duplicates.
    """
    masks = block_masks(fps.count(), radius)
    keys = F.array(*[F.struct(F.lit(i).alias("tbl"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("bits"))
                     for i, m in enumerate(masks)])
    keyed = fps.select("fp", F.bit_count("fp").alias("pop"), F.inline(keys))
    # tiles of the large buckets: at most 65 population counts each, with their number of tiles
    pops = keyed.groupBy("tbl", "bits", "pop").agg(F.count(F.lit(1)).alias("n"))
    large = (pops.groupBy("tbl", "bits")
             .agg(F.sum("n").alias("rows"),
                  F.map_from_entries(F.collect_list(F.struct("pop", F.ceil(F.col("n") / tile).cast("int")))).alias("tiles"))
             .filter(F.col("rows") > tile).drop("rows"))
    # a tile is numbered pop << 32 | salt; a row goes to every pair of its tile with one in reach
    own = F.col("pop").cast("long") * (1 << 32) + F.pmod(F.xxhash64("fp"), F.col("tiles")[F.col("pop")]).cast("long")
    reach = F.flatten(F.transform(
        F.filter(F.map_keys("tiles"), lambda p: F.abs(p - F.col("pop")) <= radius),
        lambda p: F.transform(F.sequence(F.lit(0), F.col("tiles")[p] - 1),
                              lambda s: p.cast("long") * (1 << 32) + s.cast("long"))))
    joined = keyed.join(large, ["tbl", "bits"], "left")
    whole = F.array(F.struct(F.lit(-1).cast("long").alias("a"), F.lit(-1).cast("long").alias("b"),
                             F.lit(True).alias("first")))
    pairs = F.when(F.col("tiles").isNull(), whole).otherwise(F.transform(reach, lambda t: F.struct(
        F.least(F.col("own"), t).alias("a"), F.greatest(F.col("own"), t).alias("b"),
        (F.col("own") <= t).alias("first"))))
    dealt = joined.withColumn("own", own).select("tbl", "bits", "fp", F.inline(pairs))
    sorted_rows = dealt.repartition("tbl", "bits", "a", "b").sortWithinPartitions("tbl", "bits", "a", "b")
    return sorted_rows.mapInArrow(_compare(radius), "u long, v long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): for every node of ``edges`` (u, v) the smallest node of its component.

    Alternating large-star and small-star rounds: each node hands its larger (then its
    smaller) neighbours to its smallest one, until nothing changes.  A round is two
    aggregations with a map-side minimum and two equi-joins, whose skewed keys AQE splits.
    """
    def star(e: DataFrame, larger: bool) -> DataFrame:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v"))) if larger else \
            e.select(F.col("v").alias("u"), F.col("u").alias("v"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        out = both.join(low, "u")
        if larger:
            out = out.filter("v > u").select(F.col("m").alias("u"), "v")
        else:
            out = out.select(F.inline(F.array(F.struct(F.col("m").alias("u"), F.col("v").alias("v")),
                                              F.struct(F.col("m").alias("u"), F.col("u").alias("v")))))
        return out.filter("u < v").distinct()

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    edges = edges.checkpoint()
    seen = state(edges)
    while seen[0]:
        edges = star(star(edges, True), False).checkpoint()
        now = state(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("v").alias("node"), F.col("u").alias("root"))


def classes(fps: DataFrame, radius: int) -> DataFrame:
    """(fp, class): each distinct fingerprint of ``fps`` with the smallest one linked to it, by any path."""
    distinct = fps.select("fp").distinct()
    roots = components(near_links(distinct, radius))
    return (distinct.join(roots, F.col("fp") == F.col("node"), "left")
            .select("fp", F.coalesce("root", "fp").alias("class")))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle: int = 4, radius: int = 4) -> DataFrame:
    """One row per row of ``docs``: id, fingerprint (long ``fp``) and ``component_id``.

    ``component_id`` is the smallest id reachable over links of at most ``radius`` bits.
    Null or wordless texts have fingerprint 0 and link like any other.  Null ids are never
    the smallest one (a component of null ids only has null).  Repeated rows stay.  Other
    columns of ``docs`` are not read.  An empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias(id_col), fingerprint_column(text_col, shingle).alias("fp")).checkpoint()
    known = rows.groupBy("fp").agg(F.min(id_col).alias("low"))
    of = known.join(classes(rows, radius), "fp")
    smallest = of.groupBy("class").agg(F.min("low").alias("component_id"))
    labels = of.select("fp", "class").join(smallest, "class").select("fp", "component_id")
    return rows.join(labels, "fp").select(id_col, "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             shingle: int = 4, radius: int = 4) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id (null ids last).

    Of rows with that id (repeated rows) the first stays.  All columns are kept.
    """
    prepare(docs.sparkSession)
    rid, fp = fresh(docs, "row_id"), fresh(docs, "fp")
    tagged = with_row_id(docs, rid, {fp: fingerprint_column(text_col, shingle)}, "simhash")
    rows = tagged.select(F.col(id_col).alias("id"), F.col(rid).alias("rid"), F.col(fp).alias("fp"))
    first = rows.groupBy("fp").agg(F.min(F.struct(F.col("id").isNull(), "id", "rid")).alias("low"))
    winners = (first.join(classes(rows, radius), "fp").groupBy("class")
               .agg(F.min("low").alias("low")).select(F.col("low.rid").alias(rid)))
    return tagged.join(winners, rid, "left_semi").select(*docs.columns)
