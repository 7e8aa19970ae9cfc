"""Near-duplicates by min-max hashing: banded signatures, exact confirmation, connected components.

A text is the set of its distinct word shingles, as 64-bit hashes.  Under each permutation both
the smallest and the largest value are kept, so ``2 P`` signature values cost ``P`` hash
evaluations a shingle; each of them agrees between two sets with probability J.  Bands take
``rows`` values each, the minima and the maxima in bands of their own.  Two sets at similarity t
share no band with probability ``(1 - t ** rows) ** bands``: 3e-7 at 0.8 with the constants here,
less above; a lower similarity than that of the contract is never linked, as every link is
confirmed on the full sets.

Equal sets are one node (a hash of the set) from the start, so a group of copies costs one row
a band.  Sets that share a band form a bucket.  Buckets are not expanded into pairs: in a round,
every member of a bucket is compared with the bucket's pivot only, and what is confirmed is
joined into components.  Rounds with new pivots go on while they link much.  What is left, pairs
in one bucket but in different components, is then compared whole: the members outside the
largest component with all others, pair by pair in small buckets, in tiles of bit rows in large
ones.  So no link between sets that share a band is lost, and a large group of near copies costs
a few comparisons a member.

The sets are needed only for members of buckets.  They are computed in a second pass over the
texts, which a Bloom filter of fixed size keeps to the texts in question.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakelens.llm.common import LOWER, fresh, prepare, quoted, with_row_id, word_blocks
from lakelens.llm.simhash import _forest, components
from lakelens.session import work_path

#: values in a band, and bands (half of them minima)
ROWS, BANDS = 7, 64
#: largest accepted probability of missing a pair at the threshold
MISS = 1e-6
SEED = 12
#: word hashes kept by a worker
CACHE = 1 << 18
#: most bits of the Bloom filter, and bits an entry
BLOOM_BITS, BLOOM_EACH = 1 << 27, 16
#: partners of a node compared by one task
CHUNK = 256
#: share of a round's comparisons that must be links for another round
PRODUCTIVE = 0.1
#: members of a bucket whose open pairs are listed; those of larger ones are compared in tiles
SMALL = 64
#: sets and shingles of a tile
TILE, TILE_SHINGLES = 1024, 1 << 20

_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15))
SIGNATURE = "struct<n: bigint, node: bigint, bands: array<bigint>>"


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = x + _MIX[2]
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    """XXH64 of words, for the words met last."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word, SEED)
        return value


_words = _WordHashes()


def shingle_set(text: str | None, shingle: int = 2) -> np.ndarray:
    """Sorted distinct hashes of the shingles of the lower-cased (A-Z) words.

    Fewer words than a shingle: the whole sequence is the only one.  Null or wordless: empty.
    """
    parts, short = [], []
    if text:
        for words in word_blocks(text.encode("utf-8", "surrogatepass").translate(LOWER), carry=shingle - 1):
            if len(words) < shingle:  # with the words carried here, the whole sequence unless a shingle was seen
                short = words
                continue
            parts.append(np.unique(_folded(words, shingle)))
    if parts:
        return parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))
    return _folded(short, len(short)) if short else np.zeros(0, np.uint64)


def _folded(words: list[bytes], width: int) -> np.ndarray:
    """Hash of every run of ``width`` words."""
    n = len(words) - width + 1
    hashes = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    out = np.full(n, width, np.uint64)
    for j in range(width):
        out = _mixed(out ^ hashes[j:j + n])
    return out


def node_of(values: np.ndarray) -> int | None:
    """64-bit name of a set (signed); the empty set has none."""
    if not len(values):
        return None
    return int(np.uint64(xxhash.xxh3_64_intdigest(values.tobytes(), SEED)).view(np.int64))


def multipliers(rows: int, bands: int) -> np.ndarray:
    """One odd multiplier a permutation (multiplication is a bijection of the 64-bit values)."""
    return np.random.default_rng(SEED).integers(0, 1 << 64, rows * bands // 2, dtype=np.uint64) | np.uint64(1)


def min_max(values: np.ndarray, factors: np.ndarray, step: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest value of the set under every permutation, each evaluated once."""
    low = high = None
    for a in range(0, len(values), step):
        v = factors[:, None] * values[None, a:a + step]
        lo, hi = v.min(axis=1), v.max(axis=1)
        low, high = (lo, hi) if low is None else (np.minimum(low, lo), np.maximum(high, hi))
    return low, high


def band_keys(values: np.ndarray, factors: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key a band: the bands of the minima, then those of the maxima."""
    table = np.concatenate(min_max(values, factors)).reshape(-1, rows)
    keys = np.arange(len(table), dtype=np.uint64)
    for j in range(rows):
        keys = _mixed(keys ^ table[:, j])
    return keys


def signature_column(text: str | Column, shingle: int, rows: int, bands: int) -> Column:
    """Arrow function: size of the shingle set, its node and its band keys."""
    factors = multipliers(rows, bands)

    def run(texts: pa.Array) -> pa.Array:
        sizes, nodes, keys, ends = [], [], [], [0]
        for text in texts.to_pylist():
            values = shingle_set(text, shingle)
            sizes.append(len(values))
            nodes.append(node_of(values))
            if len(values):
                keys.append(band_keys(values, factors, rows))
            ends.append(bands * len(keys))
        flat = np.concatenate(keys).view(np.int64) if keys else np.zeros(0, np.int64)
        return pa.StructArray.from_arrays(
            [pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()),
             pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))], names=["n", "node", "bands"])
    return F.arrow_udf(run, SIGNATURE)(text)


def _written(df: DataFrame, label: str) -> DataFrame:
    path = work_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


_SHIFTS = (0, 18, 36)


def bloom(nodes: DataFrame) -> np.ndarray:
    """Bloom filter of ``node`` (a hash itself) as 64-bit words.

    Its size follows the number of nodes up to ``BLOOM_BITS``; beyond that more other sets pass,
    which a join takes out again.
    """
    bits, wanted = 1 << 10, BLOOM_EACH * nodes.count()
    while bits < min(wanted, BLOOM_BITS):
        bits *= 2
    places = F.array(*[F.shiftrightunsigned("node", s).bitwiseAND(F.lit(bits - 1).cast("long")) for s in _SHIFTS])
    words = (nodes.select(F.explode(places).alias("p")).groupBy(F.shiftright("p", 6).alias("w"))
             .agg(F.expr("bit_or(shiftleft(1L, cast(p & 63L AS int)))").alias("v")))
    out = np.zeros(bits // 64, np.uint64)
    for w, v in words.toLocalIterator():
        out[w] = np.int64(v).view(np.uint64)
    return out


def _in_bloom(node: int, words: np.ndarray) -> bool:
    value, last = node & ((1 << 64) - 1), 64 * len(words) - 1
    for s in _SHIFTS:
        p = (value >> s) & last
        if not (int(words[p >> 6]) >> (p & 63)) & 1:
            return False
    return True


def shingle_sets(docs: DataFrame, text_col: str, nodes: DataFrame, shingle: int) -> DataFrame:
    """(node, ``members``: the sorted hashes as bytes) of the texts whose set is one of ``nodes``."""
    spark = docs.sparkSession
    shipped = spark.sparkContext.broadcast(bloom(nodes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()  # copies within a task are sent once, as far as this set reaches
        for batch in batches:
            found, members = [], []
            for text in batch.column(0).to_pylist():
                values = shingle_set(text, shingle)
                node = node_of(values)
                if node is None or node in sent or not _in_bloom(node, shipped.value):
                    continue
                if len(sent) < CACHE:
                    sent.add(node)
                found.append(node)
                members.append(values.tobytes())
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(members, pa.binary())],
                                                 names=["node", "members"])

    sets = docs.select(quoted(text_col).alias("text")).mapInArrow(run, "node long, members binary")
    return _written(sets.join(nodes, "node", "left_semi").groupBy("node").agg(F.first("members").alias("members")),
                    "minmax-sets")


def _confirm(percent: int):
    """Map function over rows sorted by (p, chunk), the pivot's own set first: the pairs that are similar."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivot, mine = None, None
        for batch in batches:
            us, vs = [], []
            for p, x, members in zip(*[batch.column(c).to_pylist() for c in ("p", "x", "members")], strict=True):
                values = np.frombuffer(members, np.uint64)
                if x is None:
                    pivot, mine = p, values
                    continue
                assert p == pivot
                both = np.concatenate((mine, values))
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                if 100 * common >= percent * (len(both) - common):
                    us.append(min(p, x))
                    vs.append(max(p, x))
            if us:
                yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])
    return run


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (u, v), u < v: those of ``pairs`` (p, x) whose full sets are similar.

    The partners of a node are dealt out in chunks, to each of which its own set goes once.
    """
    chunks = pairs.groupBy("p").agg(F.ceil(F.count(F.lit(1)) / CHUNK).alias("chunks"))
    dealt = pairs.join(chunks, "p").select(
        "p", "x", F.pmod(F.xxhash64("x"), F.col("chunks")).alias("chunk")).checkpoint()
    partners = dealt.join(sets.withColumnRenamed("node", "x"), "x").select("p", "chunk", "x", "members")
    pivots = dealt.select("p", "chunk").distinct().join(sets.withColumnRenamed("node", "p"), "p").select(
        "p", "chunk", F.lit(None).cast("long").alias("x"), "members")
    rows = partners.unionByName(pivots).repartition("p", "chunk").sortWithinPartitions("p", "chunk", "x")
    return rows.mapInArrow(_confirm(percent), "u long, v long")


def _buckets(rows: DataFrame) -> DataFrame:
    """(key, node, n): the members of every band key that two different nodes share."""
    keys = rows.filter("node IS NOT NULL").select("node", "n", F.explode("bands").alias("key"))
    shared = keys.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo <> hi")
    return _written(keys.join(shared, "key", "left_semi").dropDuplicates(["key", "node"]), "minmax-buckets")


def _near(percent: int) -> Column:
    """Sizes that allow the similarity."""
    return 100 * F.least("n", "m") >= percent * F.greatest("n", "m")


def _pivot_pairs(members: DataFrame, turn: int, percent: int) -> DataFrame:
    """(p, x): each bucket's pivot with the members of other components.

    The pivot is the first in an order of all nodes that changes with ``turn``, so that
    neighbouring buckets mostly share it.
    """
    order = F.xxhash64(F.col("node"), F.lit(turn))
    pivots = (members.groupBy("key")
              .agg(F.min(F.struct(order.alias("o"), "node", "n", "label")).alias("top"),
                   F.min("label").alias("lo"), F.max("label").alias("hi"))
              .filter("lo <> hi").select("key", F.col("top.node").alias("p"), F.col("top.n").alias("m"),
                                         F.col("top.label").alias("other")))
    return (members.join(pivots, "key").filter(F.col("label") != F.col("other")).filter(_near(percent))
            .select("p", F.col("node").alias("x")).distinct())


def _outsiders(members: DataFrame) -> DataFrame:
    """(key, total, major): of buckets with several components, their size and largest component."""
    return (members.groupBy("key", "label").agg(F.count(F.lit(1)).alias("c")).groupBy("key")
            .agg(F.sum("c").alias("total"), F.max(F.struct("c", "label")).alias("top"), F.count(F.lit(1)).alias("labels"))
            .filter("labels > 1").select("key", "total", F.col("top.label").alias("major"),
                                         (F.col("total") - F.col("top.c")).alias("others")))


def _rest_pairs(members: DataFrame, outside: DataFrame, percent: int) -> DataFrame:
    """(p, x): in buckets of ``SMALL`` members or fewer, those outside the largest component with all of others."""
    small = outside.filter(F.col("total") <= SMALL).select("key", "major")
    minor = (members.join(small, "key").filter(F.col("label") != F.col("major"))
             .select("key", "major", F.col("node").alias("p"), F.col("n").alias("m"), F.col("label").alias("other")))
    met = members.join(minor, "key").filter(F.col("label") != F.col("other")).filter(_near(percent))
    # two outsiders meet once
    once = met.filter((F.col("label") == F.col("major")) | (F.col("node") > F.col("p")))
    return once.select("p", F.col("node").alias("x")).distinct()


def _clusters(members: DataFrame, outside: DataFrame) -> DataFrame:
    """(cluster, node, n, outsider): members of larger buckets; buckets that share a member are one cluster.

    An outsider is not in the component that most of its cluster is in.
    """
    held = members.join(outside.filter(F.col("total") > SMALL).select("key"), "key").select(
        "key", "node", "n", "label").checkpoint()
    low = held.groupBy("key").agg(F.min("node").alias("u"))
    edges = held.join(low, "key").filter("u < node").select("u", F.col("node").alias("v")).distinct()
    nodes = held.select("node", "n", "label").distinct().join(components(edges), "node", "left").select(
        F.coalesce("root", "node").alias("cluster"), "node", "n", "label")
    major = (nodes.groupBy("cluster", "label").agg(F.count(F.lit(1)).alias("c")).groupBy("cluster")
             .agg(F.max(F.struct("c", "label")).alias("top")).select("cluster", F.col("top.label").alias("major")))
    return nodes.join(major, "cluster").select("cluster", "node", "n", (F.col("label") != F.col("major")).alias("outsider"))


def _tiles(clusters: DataFrame, percent: int) -> DataFrame:
    """(cluster, a, b, outsider side or not, node): outsiders and all members of a cluster, dealt to pairs of tiles.

    A cluster is cut by size of the sets, in steps by which the similarity falls below the
    threshold, so that only neighbouring steps can hold a link; a step is cut further into tiles
    of about ``TILE`` sets and ``TILE_SHINGLES`` shingles.  Outsider tiles are ``a``, tiles of all
    members ``b``.
    """
    step = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / percent)) + 1e-9).cast("int")
    rows = clusters.withColumn("step", step).checkpoint()

    def cut(part: DataFrame, name: str) -> DataFrame:
        n = F.ceil(F.greatest(F.count(F.lit(1)) / TILE, F.sum("n") / TILE_SHINGLES)).cast("int")
        return (part.groupBy("cluster", "step").agg(n.alias("t")).groupBy("cluster")
                .agg(F.map_from_entries(F.collect_list(F.struct("step", "t"))).alias(name)))  # an entry a step

    rows = rows.join(cut(rows, "all_tiles").join(cut(rows.filter("outsider"), "out_tiles"), "cluster"), "cluster")

    def dealt(part: DataFrame, own: str, other: str, first: bool) -> DataFrame:
        def number(at: Column, salt: Column) -> Column:
            return at.cast("long") * (1 << 32) + salt.cast("long")
        mine = number(F.col("step"), F.pmod(F.xxhash64("node"), F.col(own)[F.col("step")]))
        met = F.flatten(F.transform(
            F.filter(F.map_keys(other), lambda s: F.abs(s - F.col("step")) <= 1),
            lambda s: F.transform(F.sequence(F.lit(0), F.col(other)[s] - 1), lambda k: number(s, k))))
        return part.select("cluster", "node", F.lit(first).alias("first"), mine.alias("own"), F.explode(met).alias("met")).select(
            "cluster", F.col("own" if first else "met").alias("a"), F.col("met" if first else "own").alias("b"), "first", "node")

    return dealt(rows.filter("outsider"), "out_tiles", "all_tiles", True).unionByName(
        dealt(rows, "all_tiles", "out_tiles", False))


def tile_links(left: list[tuple[int, np.ndarray]], right: list[tuple[int, np.ndarray]],
               percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between two lists of (node, set), thinned to a spanning forest of them.

    Sets become bit rows over the shingles that both lists have; an intersection is a bit count.
    """
    def flat(rows):
        return np.concatenate([s for _, s in rows]), np.repeat(np.arange(len(rows)), [len(s) for _, s in rows])

    (lv, li), (rv, ri) = flat(left), flat(right)
    shared = np.intersect1d(lv, rv)
    if not len(shared):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)

    def bits(values, rows, n):
        at = np.searchsorted(shared, values)
        held = shared[np.minimum(at, len(shared) - 1)] == values
        at, rows = at[held], rows[held]
        table = np.zeros((n, -(-len(shared) // 64)), np.uint64)
        np.add.at(table, (rows, at >> 6), np.uint64(1) << (at & 63).astype(np.uint64))  # each bit once
        return table

    a, b = bits(lv, li, len(left)), bits(rv, ri, len(right))
    names_a, names_b = (np.array([n for n, _ in rows], np.int64) for rows in (left, right))
    sizes_a, sizes_b = (np.array([len(s) for _, s in rows]) for rows in (left, right))
    us, vs = [], []
    for i in range(len(left)):
        common = np.bitwise_count(a[i] & b).sum(axis=1, dtype=np.int64)
        near = (100 * common >= percent * (sizes_a[i] + sizes_b - common)) & (names_b != names_a[i])
        hit = np.nonzero(near)[0]
        us.append(np.full(len(hit), i))
        vs.append(hit)
    return _forest(names_a, names_b, np.concatenate(us), np.concatenate(vs))


def _compare_tiles(percent: int):
    """Map function over rows sorted by (cluster, a, b): the links of every pair of tiles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sides = None, ([], [])

        def found() -> Iterator[pa.RecordBatch]:
            if sides[0] and sides[1]:
                u, v = tile_links(*sides, percent)
                if len(u):
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))], names=["u", "v"])

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("cluster", "a", "b", "first", "node", "members")]
            for cluster, a, b, first, node, members in zip(*columns, strict=True):
                if key != (cluster, a, b):
                    yield from found()
                    key, sides = (cluster, a, b), ([], [])
                sides[0 if first else 1].append((node, np.frombuffer(members, np.uint64)))
        yield from found()
    return run


def _rest_links(members: DataFrame, outside: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) of what the pivots left open: pairs in one bucket but in different components."""
    clusters = _clusters(members, outside).checkpoint()
    dealt = _tiles(clusters, percent).join(sets, "node")
    tiles = (dealt.repartition("cluster", "a", "b").sortWithinPartitions("cluster", "a", "b")
             .mapInArrow(_compare_tiles(percent), "u long, v long"))
    # of two members of one cluster in different components one is an outsider: their tiles meet
    of = clusters.select("node", "cluster")
    pairs = (_rest_pairs(members, outside, percent)
             .join(of.toDF("p", "cluster_p"), "p", "left").join(of.toDF("x", "cluster_x"), "x", "left")
             .filter(~F.coalesce(F.col("cluster_p") == F.col("cluster_x"), F.lit(False))).select("p", "x").checkpoint())
    return confirmed(pairs, sets, percent).unionByName(tiles.filter("u < v"))


def links(sets: DataFrame, buckets: DataFrame, percent: int) -> DataFrame:
    """(node, root): components of all similar pairs that share a band, for the linked nodes."""
    spark = buckets.sparkSession
    found = spark.createDataFrame([], "u long, v long")
    roots = spark.createDataFrame([], "node long, root long")
    turn, productive = 0, True
    while True:
        members = buckets.join(roots, "node", "left").select(
            "key", "node", "n", F.coalesce("root", "node").alias("label")).checkpoint()
        outside = _outsiders(members).checkpoint()
        if outside.isEmpty():
            return roots
        if productive:
            pairs = _pivot_pairs(members, turn, percent).checkpoint()
            more = _written(confirmed(pairs, sets, percent), "minmax-links")
        else:
            more = _written(_rest_links(members, outside, sets, percent), "minmax-links")
        new = more.count()
        found = found.unionByName(more)
        if new:
            roots = components(found.distinct())
        if not productive:
            return roots
        productive = new > PRODUCTIVE * pairs.count()
        turn += 1


def _tagged(docs: DataFrame, columns: list[Column], text_col: str, shingle: int, rows: int, bands: int,
            percent: int) -> tuple[DataFrame, DataFrame]:
    """(columns, n, node) of all rows, written, and (node, root) of the linked nodes."""
    if (1 - (percent / 100) ** rows) ** bands > MISS:
        raise ValueError(f"{bands} bands of {rows} values miss more than {MISS} of the pairs at {percent} %")
    prepare(docs.sparkSession)
    values = signature_column(quoted(text_col), shingle, rows, bands).alias("_signature")
    signed = _written(docs.select(*columns, values).select("*", "_signature.*").drop("_signature"), "minmax-rows")
    buckets = _buckets(signed)
    sets = shingle_sets(docs, text_col, buckets.select("node").distinct(), shingle)
    return signed.drop("bands"), links(sets, buckets, percent)


def minmax_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 2,
                      percent: int = 80, rows: int = ROWS, bands: int = BANDS) -> DataFrame:
    """One row per row of ``docs``: id, ``n_shingles``, ``component_id`` and ``kept``.

    Two texts are linked if their shingle sets share ``percent`` of 100 of their union.
    ``component_id`` is the smallest id reachable, the row's own included; null ids are never
    the smallest one (a component of null ids only has null).  ``kept``: the id is that one, so
    of rows of equal id all are.  Null and wordless texts have no shingle and are linked with
    nothing; their component is their own id.  Repeated rows stay.  Other columns are not read.
    An empty table gives an empty result.
    """
    tagged, roots = _tagged(docs, [quoted(id_col).alias("_id")], text_col, shingle, rows, bands, percent)
    low = tagged.filter("node IS NOT NULL").groupBy("node").agg(F.min("_id").alias("low"))
    of = low.join(roots, "node", "left").select("node", "low", F.coalesce("root", "node").alias("root"))
    smallest = of.groupBy("root").agg(F.min("low").alias("component_id"))
    labels = of.join(smallest, "root").select("node", "component_id")
    linked = tagged.filter("node IS NOT NULL").join(labels, "node").select("_id", "n", "component_id")
    alone = tagged.filter("node IS NULL").select("_id", "n", F.col("_id").alias("component_id"))
    return linked.unionByName(alone).select(
        F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), "component_id",
        F.col("_id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 2,
             percent: int = 80, rows: int = ROWS, bands: int = BANDS) -> DataFrame:
    """``docs`` with one row of each component, that of the smallest id (null ids last), all columns kept.

    Of rows with that id the first stays.  Texts without words all stay.  An empty table gives
    an empty result.
    """
    prepare(docs.sparkSession)
    rid = fresh(docs, "row_id")
    numbered = with_row_id(docs, rid, label="minmax-docs")
    tagged, roots = _tagged(numbered, [quoted(id_col).alias("_id"), quoted(rid).alias("_rid")], text_col, shingle,
                            rows, bands, percent)
    first = tagged.filter("node IS NOT NULL").groupBy("node").agg(
        F.min(F.struct(F.col("_id").isNull(), "_id", "_rid")).alias("low"))
    winners = (first.join(roots, "node", "left").groupBy(F.coalesce("root", "node")).agg(F.min("low").alias("low"))
               .select(F.col("low._rid").alias(rid)))
    wordless = tagged.filter("node IS NULL").select(F.col("_rid").alias(rid))
    return numbered.join(winners.unionByName(wordless), rid, "left_semi").select(*[quoted(c) for c in docs.columns])
