"""Ranked search, min-max near-duplicates and Merkle proofs: brute force, edge cases, large groups."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF_SMALL
from lakelens.llm import lexical, merkle, minmax, queries
from test_operators import DOCS, none, odd  # noqa: F401  fixtures

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


# ---- op11 ----------------------------------------------------------------------------------

def ranked(docs, items, top):
    """Every score, by the formula."""
    terms = [(i, TERM.findall((t or "").translate(LOWER))) for i, t in docs]
    held = [(i, Counter(w), len(w)) for i, w in terms]
    n_docs, length = sum(n > 0 for _, _, n in held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    wanted = {}
    for i, t in items:
        if t is not None:
            wanted.setdefault(i, set()).update(TERM.findall(t.translate(LOWER)))
    out = []
    for item, mine in wanted.items():
        scored = []
        for i, c, n in held:
            m = 50 + 50 * n * n_docs // length if length else 0
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                    for t in mine if t in c)
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, k + 1, x[3], -x[0]) for k, x in enumerate(sorted(scored, key=lambda x: x[:3])[:top])]
    return sorted(out, key=repr)


def test_search_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    items = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    want = ranked(texts, [(r.item_id, r.text) for r in items.collect()], 7)
    got = sorted((tuple(r) for r in lexical.search(docs.repartition(5), items, top=7).collect()), key=repr)
    assert got == want
    # in many blocks of items
    got = lexical.search(docs, items, top=7, block_bytes=2000).collect()
    assert sorted((tuple(r) for r in got), key=repr) == want


def test_search_edge_cases(spark, odd, none):  # noqa: F811
    items = spark.createDataFrame([(1, "Alpha tail; a"), (1, "beta"), (2, None), (None, "one x1"), (3, "  "), (4, "nowhere")],
                                  "item_id int, text string")
    got = sorted((tuple(r) for r in lexical.search(odd, items, top=4).collect()), key=repr)
    want = ranked([(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()],
                  [tuple(r) for r in items.collect()], 4)
    assert got == want and {r[0] for r in got} == {1, None}
    assert lexical.search(odd, items, top=4).columns == ["item_id", "rank", "doc_id", "score"]
    assert lexical.search(none, items).count() == 0
    assert lexical.search(odd, items.limit(0)).count() == 0
    named = odd.select(F.col("doc_id").cast("string").alias("a.b"), F.col("text").alias("t.x"))
    assert lexical.search(named, items, id_col="a.b", text_col="t.x", top=4).count() == len(got)


@pytest.mark.parametrize("seed", range(4))
def test_walk_is_exact_and_skips(seed):
    rng = np.random.default_rng(seed)
    n_terms, n_docs, top = 60, 700, 5
    share = 1 / (1 + np.arange(n_terms))
    rows = []
    for i in range(n_docs):
        terms = np.nonzero(rng.random(n_terms) < share * 1.5)[0]
        if len(terms):
            rows.append((i, terms, rng.integers(1, 4, len(terms)), int(rng.integers(60, 90))))
    rows += [(10_000 + i, *rows[0][1:]) for i in range(20)]  # a group of equal vectors
    weights = [int(100 * (1 + t)) for t in range(n_terms)]
    wanted = [set(rng.choice(n_terms, 8, replace=False).tolist()) for _ in range(9)]
    groups = lexical.item_groups(wanted, weights, top, size=4)
    nodes = []
    for a in range(0, len(rows), 200):  # several trees; bounds carry on from one to the next
        part = rows[a:a + 200]
        root = lexical.grow([(False, r[0]) for r in part], [r[3] for r in part],
                            np.concatenate([r[1] for r in part]).astype(np.int32),
                            np.concatenate([r[2] for r in part]).astype(np.int32),
                            np.cumsum([0, *[len(r[1]) for r in part]]))
        todo = [root]
        while todo:
            node = todo.pop()
            nodes.append(node)
            todo += node.children
            for child in node.children:
                assert set(child.terms) <= set(node.terms) and child.m >= node.m and child.low >= node.low
        for group in groups:
            group.search(root)
    assert sum(len(n.ids) for n in nodes) == len(rows)
    for group in groups:
        for number, best in zip(group.numbers, group.best, strict=True):
            scored = sorted((-sum(weights[t] * (10**9 * int(f) // (1000 * int(f) + 20 * m))
                                  for t, f in zip(terms, tfs, strict=True) if t in wanted[number]), i)
                            for i, terms, tfs, m in rows)
            assert [(s, k[1]) for s, k in best] == [x for x in scored if x[0] < 0][:top]


def test_walk_leaves_most_leaves_out():
    rng = np.random.default_rng(1)
    terms = [np.unique(np.concatenate(([0, 1], rng.integers(2, 400, 6)))) for _ in range(2000)]
    root = lexical.grow([(False, i) for i in range(2000)], [70] * 2000, np.concatenate(terms).astype(np.int32),
                        np.ones(sum(map(len, terms)), np.int32), np.cumsum([0, *map(len, terms)]))
    group = lexical.item_groups([{0, 1, 50, 300}], [5, 5] + [3000] * 398, 5)[0]
    seen = []
    plain = group.bounds
    group.bounds = lambda node, items: (seen.append(node), plain(node, items))[1]
    group.search(root)
    assert len(group.best[0]) == 5 and len(seen) < 900


# ---- op12 ----------------------------------------------------------------------------------

def shingles(text, k=2):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def classes(rows, k=2, percent=80):
    """(id, n, component) of all rows, every pair compared."""
    sets = [shingles(t, k) for _, t in rows]
    low = list(range(len(rows)))

    def find(i):
        while low[i] != i:
            i = low[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                low[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, len(s), least.get(find(i)), d == least.get(find(i)))
                   for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=repr)


def got_classes(df, **kwargs):
    return sorted((tuple(r) for r in minmax.minmax_components(df, **kwargs).collect()), key=repr)


def test_near_duplicates_equal_all_pairs(spark):
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(3000)}"
    rows = []
    for size in [*range(1, 12), 20, 40, 80, 150]:
        for _ in range(6):
            base = [word() for _ in range(size)]
            rows.append(" ".join(base))
            for edits in (0, 1, 1, 2, size // 20, size // 12, size // 8):
                copy = list(base)
                for _ in range(edits):
                    copy[rng.randrange(size)] = word()
                rows.append(" ".join(copy))
    for _ in range(3):  # chains: each a small step from the one before
        text = [word() for _ in range(60)]
        for _ in range(25):
            text[rng.randrange(60)] = word()
            text[rng.randrange(60)] = word()
            rows.append(" ".join(text).upper())
    rng.shuffle(rows)
    rows = list(enumerate(rows))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    want = classes(rows)
    assert len({r[2] for r in want}) < len(want) - 100
    assert got_classes(df) == want
    kept = sorted(r.doc_id for r in minmax.keep_one(df).collect())
    assert kept == [r[0] for r in sorted(want) if r[3]]


def test_large_group_of_near_copies(spark):
    """A hot group: copies linked to a base but mostly not to each other, and strangers that share half of it."""
    rng = random.Random(9)
    base = [f"b{i}" for i in range(100)]
    rows = [" ".join(base)]
    for _ in range(500):
        copy = list(base)
        for _ in range(rng.choice((2, 4, 5, 6))):
            copy[rng.randrange(100)] = f"x{rng.randrange(10**9)}"
        rows.append(" ".join(copy))
    for _ in range(150):
        rows.append(" ".join(base[:70] + [f"y{rng.randrange(10**9)}" for _ in range(30)]))
    rows += [rows[3]] * 400
    rng.shuffle(rows)
    rows = list(enumerate(rows))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert got_classes(df) == classes(rows)


def test_rest_is_compared_whole(spark, monkeypatch):
    """Links that no pivot sees: a small bucket's members outside the largest component meet all others."""
    rows = spark.createDataFrame([(1, i, 10, i // 2 if i > 3 else 0) for i in range(12)],
                                 "key long, node long, n long, label long")
    outside = minmax._outsiders(rows)
    assert outside.first().asDict() == {"key": 1, "total": 12, "major": 0, "others": 8}
    got = {frozenset(r) for r in minmax._rest_pairs(rows, outside, 80).collect()}
    label = {r.node: r.label for r in rows.collect()}
    want = {frozenset((a, b)) for a in label for b in label if label[a] != label[b]}
    assert got == want and len(got) == minmax._rest_pairs(rows, outside, 80).count()
    # the same in tiles: every pair with an outsider meets in some pair of tiles
    monkeypatch.setattr(minmax, "SMALL", 2)
    monkeypatch.setattr(minmax, "TILE", 3)
    assert minmax._rest_pairs(rows, outside, 80).count() == 0
    tiles = {}
    for r in minmax._tiles(minmax._clusters(rows, outside), 80).collect():
        tiles.setdefault((r.cluster, r.a, r.b), ([], []))[0 if r.first else 1].append(r.node)
    met = {frozenset((a, b)) for one, two in tiles.values() for a in one for b in two if a != b}
    assert met >= want and max(len(x) for t in tiles.values() for x in t) <= 8


def test_tiles_by_size_hold_every_similar_pair(spark, monkeypatch):
    monkeypatch.setattr(minmax, "TILE", 20)
    rng = random.Random(3)
    sizes = [rng.randrange(1, 400) for _ in range(150)]
    rows = spark.createDataFrame([(7, i, n, i % 3 == 0) for i, n in enumerate(sizes)],
                                 "cluster long, node long, n long, outsider boolean")
    tiles = {}
    for r in minmax._tiles(rows, 80).collect():
        tiles.setdefault((r.a, r.b), ([], []))[0 if r.first else 1].append(r.node)
    met = {(a, b) for one, two in tiles.values() for a in one for b in two}
    for a in range(0, 150, 3):
        for b in range(150):
            if 100 * min(sizes[a], sizes[b]) >= 80 * max(sizes[a], sizes[b]):
                assert (a, b) in met


def test_tile_links_are_exact():
    rng = np.random.default_rng(8)
    base = rng.integers(0, 1 << 64, 90, dtype=np.uint64)
    sets = []
    for i in range(60):
        own = base.copy()
        k = int(rng.integers(0, 16))
        own[rng.choice(90, k, replace=False)] = rng.integers(0, 1 << 64, k, dtype=np.uint64)
        sets.append((i, np.unique(own)))
    sets.append((60, np.unique(rng.integers(0, 1 << 64, 40, dtype=np.uint64))))

    def roots(pairs):
        low = list(range(61))

        def find(i):
            while low[i] != i:
                i = low[i]
            return i
        for a, b in pairs:
            low[max(find(a), find(b))] = min(find(a), find(b))
        return [find(i) for i in range(61)]
    left, right = sets[:20], sets
    want = [(a, b) for a, x in left for b, y in right if a != b
            and 100 * len(np.intersect1d(x, y)) >= 80 * len(np.union1d(x, y))]
    got = list(zip(*map(np.ndarray.tolist, minmax.tile_links(left, right, 80)), strict=True))
    assert roots(got) == roots(want) and len(set(roots(want))) > 2
    assert minmax.tile_links([sets[60]], sets[:5], 80)[0].tolist() == []


def test_near_duplicates_edge_cases(spark, odd, none):  # noqa: F811
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    want = classes(rows)
    # a null id is no smallest id, and a row of null text is alone whatever its id
    want = sorted(((d, n, c, d == c) for d, n, c, _ in want), key=repr)
    assert got_classes(odd) == want
    assert got_classes(none) == []
    assert minmax.keep_one(none).count() == 0
    kept = minmax.keep_one(odd)
    assert kept.columns == odd.columns
    assert sum(not shingles(t) for _, t in rows) == kept.filter(~F.coalesce("text", F.lit("")).rlike(r"\S")).count()
    dotted = odd.withColumnRenamed("found", "a.b")
    assert minmax.keep_one(dotted).columns == dotted.columns
    with pytest.raises(ValueError):
        minmax.minmax_components(odd, percent=50)


def test_min_and_max_under_each_permutation():
    values = np.random.default_rng(0).integers(0, 1 << 64, 1700, dtype=np.uint64)
    factors = minmax.multipliers(4, 10)
    assert len(factors) == 20
    low, high = minmax.min_max(values, factors)
    for f, lo, hi in zip(factors, low, high, strict=True):
        own = [int(f) * int(v) % (1 << 64) for v in values]
        assert (min(own), max(own)) == (int(lo), int(hi))
    assert len(minmax.band_keys(values, factors, 4)) == 10


def test_agreement_estimates_similarity():
    rng = np.random.default_rng(2)
    factors = minmax.multipliers(7, 64)
    errors = []
    for _ in range(40):
        a = rng.integers(0, 1 << 64, 300, dtype=np.uint64)
        b = a.copy()
        b[:30] = rng.integers(0, 1 << 64, 30, dtype=np.uint64)
        same = np.concatenate(minmax.min_max(a, factors)) == np.concatenate(minmax.min_max(b, factors))
        errors.append(same.mean() - 270 / 330)
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.03


def test_long_text_of_few_words():
    big = "z" * (3 << 20)
    for text in (big, f"{big} a", f"a {big}", f"{big} {big}1 b", " ".join(["q", big, "r", big, "q"])):
        assert len(minmax.shingle_set(text)) == len(shingles(text))
    assert len(set(map(minmax.node_of, map(minmax.shingle_set, (big, big + " a", "a", "a a"))))) == 4


# ---- op13 ----------------------------------------------------------------------------------

def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def proofs(rows, arity=16):
    """The whole tree in memory: (id, leaf, subroot, root, proof digest, folded root, verified) of all rows."""
    def leaf(r, text):
        values = (r.doc_id, r.source, r.lang, r.n_chars, text)
        return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    def climb(nodes):
        at, paths = list(range(len(nodes))), [[] for _ in nodes]
        while len(nodes) > 1:
            runs = [nodes[k:k + arity] for k in range(0, len(nodes), arity)]
            for i, k in enumerate(at):
                run, d = runs[k // arity], k % arity
                paths[i].append((run[:d], run[d + 1:]))
                at[i] = k // arity
            nodes = [digest("".join(run)) for run in runs]
        return nodes[0], paths

    groups = {}
    for r in rows:
        groups.setdefault(r.source, []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for name in names:
        mine = sorted(groups[name], key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r, r.text)))
        trees.append((mine, *climb([leaf(r, r.text) for r in mine])))
    if not trees:
        return []
    root, above = climb([t[1] for t in trees])
    out = []
    for (mine, subroot, paths), upper in zip(trees, above, strict=True):
        for r, path in zip(mine, paths, strict=True):
            hit = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and r.text is not None
            fold = leaf(r, r.text.translate(LOWER) if hit else r.text)
            for left, right in path + upper:
                fold = digest("".join([*left, fold, *right]))
            held = digest("".join("".join(a + b) for a, b in path + upper))
            out.append((r.doc_id, leaf(r, r.text), subroot, root, held, fold, fold == root))
    return sorted(out, key=repr)


def audited(df, **kwargs):
    got = merkle.audit(df, tampered={"text": merkle.lowered_every_fifth()}, **kwargs)
    return sorted((tuple(r) for r in got.collect()), key=repr)


def test_proofs_equal_tree_in_memory(spark, odd, none):  # noqa: F811
    want = proofs(odd.collect())
    assert audited(odd) == want
    assert audited(none) == []


@pytest.mark.parametrize("arity", [2, 3])
def test_proofs_of_deep_trees(spark, arity):
    rows = [Row(doc_id=i % 41, text=f"Text {i}" if i % 7 else None, lang=None, source=("a", "b", "B", None, "é")[i % 5 if i % 3 else 0],
                n_chars=i) for i in range(130)]
    rows += [Row(doc_id=5, text="lone", lang="en", source="zz", n_chars=1)] + rows[:3]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    want = proofs(rows, arity)
    assert audited(df, arity=arity) == want and {r[-1] for r in want} == {True, False}


@pytest.mark.parametrize("n", [1, 2, 16, 17])
def test_proofs_of_one_source(spark, n):
    rows = [Row(doc_id=i, text="T", lang="en", source="s", n_chars=1) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert audited(df) == proofs(rows)


def test_requests_of_some_leaves(spark, odd):  # noqa: F811
    tree = merkle.build(odd, merkle.leaf_digest([F.col("doc_id"), F.col("text")]))
    some = tree.leaves.filter("doc_id IN (3, 7)")
    got = merkle.prove(tree, some).collect()
    assert len(got) == some.count()
    for r in got:
        fold = r.leaf
        for s in r.proof:
            fold = digest(s.left + fold + s.right)
        assert fold == tree.root
    assert merkle.prove(tree, some.limit(0)).count() == 0
    held = tree.store.collect()
    assert len({r.digest for r in held}) == len(held)
    assert all(digest("".join(r.children)) == r.digest for r in held)


def test_queries_are_registered():
    """``test_operators`` holds every registered query against its SQL."""
    assert {"op11_ranked_search", "op12_minhash", "op13_merkle"} <= set(entry.queries()) & set(queries.ORACLE_SQL)
