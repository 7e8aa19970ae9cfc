"""Masked pseudo-likelihood: a bidirectional window network scores every token from both sides.

The network sees the ``REACH`` tokens left and right of a masked position: h = tanh(sum of
position weights * embeddings + b).  Its softmax has two levels, a token's class and the
token within its class, so a probability costs two small softmaxes rather than one over the
vocabulary.  A document's score is the sum of log P(token | both sides) over all its tokens.

All statistics come from the whole corpus.  Spark counts every word.  The most frequent ones
are tokens of the network; any other word is the token of its length, and its probability is
that of the token times the word's own share of the words of that length, from the counts of the
whole corpus (a table of hashed counts that grows with the number of words, up to
``RARE_BITS``).

Training is data-parallel and does not depend on how the input is laid out.  Texts are encoded
once and dealt by a hash of their content into groups of about ``GROUP_TOKENS`` tokens.  The
groups are trained in rounds, each by minibatch Adagrad in numpy over all its tokens, from the
average of the round before; a round's parameters are averaged by tokens in a reduction tree of
Spark groups, so no task and no driver call gathers more than ``FAN_IN`` models at a time.
More input gives more groups and rounds; every token is trained on once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress, groupby, pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakelens.llm.common import LOWER, prepare, quoted
from lakelens.session import work_path

#: classes, tokens in a class, length buckets for words outside the vocabulary
CLASSES, CLASS_SIZE, BUCKETS = 32, 64, 16
#: tokens seen on each side, size of embeddings and hidden layer
REACH, DIM = 2, 16
#: tokens in a minibatch of training and of scoring, Adagrad rate
BATCH, SCORE_BATCH, RATE = 4096, 16384, 0.1
#: models (or partial averages) that meet in one group of the reduction tree
FAN_IN = 64
#: distinct words a task counts before it hands them on, bytes of text split into tokens at once
COUNT_WORDS, PIECE = 200_000, 1 << 22
#: tokens of a group of texts that one task trains on, and most rounds
GROUP_TOKENS, ROUNDS = 1 << 20, 8
#: most bits of a slot number in the table of rare words
RARE_BITS = 20

OUTPUTS = CLASSES * CLASS_SIZE
VOCABULARY = OUTPUTS - BUCKETS
PAD = OUTPUTS
_WORD = bytes(32 if b < 128 and not chr(b).isalnum() else b for b in LOWER)


def _split(parts: list[bytes], rows: list[int]) -> tuple[np.ndarray, pa.Array]:
    """(row of each token, tokens) of parts of texts in which blanks separate the tokens."""
    data = b" ".join(parts)
    inside = np.zeros(len(data) + 2, bool)
    np.not_equal(np.frombuffer(data, np.uint8), 32, out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    offsets = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=offsets[1:])
    begins = np.cumsum([0, *(len(p) + 1 for p in parts)])
    of = np.repeat(np.array(rows, np.int64), np.diff(np.searchsorted(starts, begins)))
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data.translate(None, b" "))]
    return of, pa.Array.from_buffers(pa.binary(), len(starts), buffers)


def token_arrays(texts: pa.Array) -> Iterator[tuple[np.ndarray, pa.Array]]:
    """(row of each token, tokens) of all texts in their order, about ``PIECE`` bytes of text at a time.

    A token is a lower-cased run of letters, digits and non-ASCII characters; null has none.
    """
    parts, rows, held = [], [], 0
    for row, text in enumerate(texts.cast(pa.large_binary()).to_pylist()):
        data, at = (text or b"").translate(_WORD), 0
        while at < len(data):
            cut = data.find(32, at + PIECE) if len(data) - at > PIECE else -1
            part = data[at:cut] if cut >= 0 else data[at:]
            parts.append(part)
            rows.append(row)
            at, held = at + len(part), held + len(part)
            if held >= PIECE:
                yield _split(parts, rows)
                parts, rows, held = [], [], 0
    if parts:
        yield _split(parts, rows)


def token_blocks(text: str | None) -> Iterator[list[bytes]]:
    """The tokens of one text, in blocks; null has none."""
    for _, words in token_arrays(pa.array([text and text.encode("utf-8", "surrogatepass")], pa.binary())):
        yield words.to_pylist()


class Words(dict):
    """Token numbers of the vocabulary in alphabetical order, so that classes hold similar words."""

    def __init__(self, words: list[str]):
        super().__init__((w.encode("utf-8", "surrogatepass"), i) for i, w in enumerate(sorted(words)))
        self.known = pa.array(list(self), pa.binary())

    def __missing__(self, word: bytes) -> int:
        """The token of a word outside the vocabulary."""
        return VOCABULARY + min(len(word), BUCKETS) - 1

    def numbers(self, words: pa.Array) -> np.ndarray:
        """The token of each word."""
        found = pc.fill_null(pc.index_in(words, value_set=self.known), -1).to_numpy(zero_copy_only=False)
        return np.where(found < 0, VOCABULARY - 1 + np.minimum(pc.binary_length(words).to_numpy(), BUCKETS), found)

    def ids(self, text: str | None) -> np.ndarray:
        return np.array([self[w] for block in token_blocks(text) for w in block], np.int32)


def _slot(word: bytes, slots: int) -> int:
    """A word's slot; words of each length have a range of their own, so that their shares sum to 1."""
    each = slots // BUCKETS
    return (min(len(word), BUCKETS) - 1) * each + (xxhash.xxh64_intdigest(word, 9) & (each - 1))


def _slots(words: pa.Array, slots: int) -> np.ndarray:
    """The slot of each word of a binary array without nulls."""
    if not len(words):
        return np.zeros(0, np.int64)
    _, offsets, data = words.buffers()
    cuts = np.frombuffer(offsets, np.int32)[words.offset:words.offset + len(words) + 1].tolist()
    data = data.to_pybytes()
    return np.fromiter((_slot(data[a:b], slots) for a, b in pairwise(cuts)), np.int64, len(words))


class Rare:
    """Log share of a word outside the vocabulary among the rare words of its length.

    ``mean``: by slot, the mean count of the rare words in it; ``totals``: their sum by length.
    """

    def __init__(self, mean: np.ndarray, totals: np.ndarray):
        self.mean, self.totals = mean, totals

    def __getitem__(self, word: bytes) -> float:
        return self.logs(pa.array([word], pa.binary())).item()

    def logs(self, words: pa.Array) -> np.ndarray:
        """The log share of each word; each distinct one is looked up once."""
        coded = words.dictionary_encode()
        slots = _slots(coded.dictionary, len(self.mean))
        n = np.maximum(self.mean[slots].astype(np.float64), 0.5)
        logs = np.minimum(0.0, np.log(n / (self.totals[slots // (len(self.mean) // BUCKETS)] + 1)))
        return logs[coded.indices.to_numpy()]

    def sum_of(self, words: list[bytes], ids: np.ndarray) -> float:
        """Sum over the words that are no tokens of their own; ``ids`` are their tokens."""
        return self.logs(pa.array(compress(words, (ids >= VOCABULARY).tolist()), pa.binary())).sum()


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, n) over all texts; tasks count before the shuffle, ``COUNT_WORDS`` distinct words at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = pa.array([], pa.binary()), np.zeros(0, np.int64)
        words, counts = none

        def partial() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([words.cast(pa.string()), pa.array(counts)], names=["word", "n"])
        for batch in batches:
            for _, found in token_arrays(batch.column(0)):
                coded = pa.concat_arrays([words, found]).dictionary_encode()  # words counted before come first
                more = np.bincount(coded.indices.to_numpy()[len(words):], minlength=len(coded.dictionary))
                more[:len(words)] += counts
                words, counts = coded.dictionary, more
                if len(words) >= COUNT_WORDS:
                    yield partial()
                    words, counts = none
        if len(words):
            yield partial()
    parts = docs.select(text_col).mapInArrow(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def _exp(x: np.ndarray) -> np.ndarray:
    """Exponentials of logits, in place, and the sum of each row; logits beyond the range of float32 are cut."""
    np.clip(x, -80, 80, out=x)
    np.exp(x, out=x)
    return x @ np.ones(x.shape[1], np.float32)


@dataclass
class Network:
    """Parameters by name; ``log_probs`` and ``train`` work on windows of token numbers."""

    p: dict[str, np.ndarray]

    @staticmethod
    def start(unigram: np.ndarray) -> Network:
        """Start values: small fixed random weights, output biases from the corpus's token counts."""
        rng = np.random.Generator(np.random.Philox(7))
        share = (unigram + 0.5).reshape(CLASSES, CLASS_SIZE)
        by_class = share.sum(1)
        return Network({
            "embed": rng.normal(0, 0.1, (OUTPUTS + 1, DIM)).astype(np.float32),
            "place": np.ones((2 * REACH, DIM), np.float32),
            "hidden": np.zeros((1, DIM), np.float32),
            "to_class": rng.normal(0, 0.1, (DIM, CLASSES)).astype(np.float32),
            "class_bias": np.log(by_class / by_class.sum())[None, :].astype(np.float32),
            "to_word": rng.normal(0, 0.1, (CLASSES, DIM * CLASS_SIZE)).astype(np.float32),
            "word_bias": np.log(share / by_class[:, None]).astype(np.float32),
        })

    def _forward(self, context: np.ndarray, target: np.ndarray):
        p = self.p
        seen = [p["embed"].take(context[:, k], axis=0) for k in range(2 * REACH)]  # for each place, tokens x DIM
        h = np.repeat(p["hidden"], len(target), axis=0)
        for k, part in enumerate(seen):
            h += part * p["place"][k]
        np.tanh(h, out=h)
        top = h @ p["to_class"]
        top += p["class_bias"]
        cls, own = target // CLASS_SIZE, target % CLASS_SIZE
        order = np.argsort(cls.astype(np.int16), kind="stable")  # a radix sort
        cuts = np.searchsorted(cls[order], np.arange(CLASSES + 1)).tolist()
        low = np.empty((len(target), CLASS_SIZE), np.float32)  # rows in the order of their class
        h_sorted = h.take(order, axis=0)
        for c in range(CLASSES):
            a, b = cuts[c], cuts[c + 1]
            if a < b:
                part = np.matmul(h_sorted[a:b], p["to_word"][c].reshape(DIM, CLASS_SIZE), out=low[a:b])
                part += p["word_bias"][c]
        own_sorted = own.take(order)
        return seen, h, h_sorted, top, _exp(top), low, _exp(low), cls, own_sorted, order, cuts

    def log_probs(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        """log P(target | context) of each row."""
        _, _, _, top, top_sum, low, low_sum, cls, own_sorted, order, _ = self._forward(context, target)
        rows = np.arange(len(target))
        out = np.empty(len(target))
        out[order] = np.log(np.maximum(low[rows, own_sorted] / low_sum, 1e-12))
        return out + np.log(np.maximum(top[rows, cls] / top_sum, 1e-12))

    def train(self, context: np.ndarray, target: np.ndarray, sums: dict[str, np.ndarray]) -> None:
        """One Adagrad step on the mean log-likelihood of a minibatch; ``sums`` holds squared gradients."""
        p, n = self.p, len(target)
        seen, h, h_sorted, top, top_sum, low, low_sum, cls, own_sorted, order, cuts = self._forward(context, target)
        rows = np.arange(n)
        top /= top_sum[:, None]
        low /= low_sum[:, None]
        top[rows, cls] -= 1
        low[rows, own_sorted] -= 1
        d_sorted = np.empty_like(h)
        g_word, g_bias = np.zeros_like(p["to_word"]), np.zeros_like(p["word_bias"])
        ones = np.ones(n, np.float32)
        for c in range(CLASSES):
            a, b = cuts[c], cuts[c + 1]
            if a < b:
                part = low[a:b]
                np.matmul(part, p["to_word"][c].reshape(DIM, CLASS_SIZE).T, out=d_sorted[a:b])
                np.matmul(h_sorted[a:b].T, part, out=g_word[c].reshape(DIM, CLASS_SIZE))
                np.matmul(ones[:b - a], part, out=g_bias[c])
        back = np.empty_like(order)
        back[order] = rows
        d_h = top @ p["to_class"].T
        d_h += d_sorted.take(back, axis=0)
        d_h *= 1 - h * h
        flat = np.empty((2 * REACH * n, DIM), np.float32)
        for k in range(2 * REACH):
            np.multiply(d_h, p["place"][k], out=flat[k * n:(k + 1) * n])
        where = context.T.ravel()
        by = np.argsort(where.astype(np.int16), kind="stable")
        where = where.take(by)
        first = np.flatnonzero(np.diff(where, prepend=-1))
        used = where[first]
        grads = {
            "place": np.stack([ones @ (part * d_h) for part in seen]), "hidden": (ones @ d_h)[None, :],
            "to_class": h.T @ top, "class_bias": (ones @ top)[None, :], "to_word": g_word, "word_bias": g_bias,
        }
        for name, g in grads.items():
            g /= n
            sums[name] += g * g
            p[name] -= RATE * g / (np.sqrt(sums[name]) + 1e-6)
        g = np.add.reduceat(flat.take(by, axis=0), first, axis=0) / n
        squares = sums["embed"][used] + g * g
        sums["embed"][used] = squares
        p["embed"][used] -= RATE * g / (np.sqrt(squares) + 1e-6)


def windows(ids: np.ndarray) -> np.ndarray:
    """Token numbers left and right of every position, ``PAD`` beyond the ends."""
    padded = np.concatenate((np.full(REACH, PAD, np.int32), ids, np.full(REACH, PAD, np.int32)))
    n = len(ids)
    return np.stack([padded[k:k + n] for k in range(2 * REACH + 1) if k != REACH], axis=1)


def windows_at(ids: np.ndarray, at: int, size: int) -> np.ndarray:
    """Windows of the positions ``at`` to ``at + size``."""
    near = windows(ids[max(0, at - REACH):at + size + REACH])[min(at, REACH):]
    return near[:len(ids[at:at + size])]


def _batches(parts: Iterator[np.ndarray], size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Windows and targets of all tokens of all texts, ``size`` at a time."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    n = 0
    for ids in parts:
        for at in range(0, len(ids), 1 << 18):
            part = ids[at:at + (1 << 18)]
            held.append((windows_at(ids, at, 1 << 18), part))
            n += len(part)
            while n >= size:
                context, target = (np.concatenate(x) for x in zip(*held, strict=True))
                yield context[:size], target[:size]
                held, n = [(context[size:], target[size:])], n - size
    if n:
        yield tuple(np.concatenate(x) for x in zip(*held, strict=True))


#: prefix of the names of squared-gradient sums among the parameters
SUM = "sum:"
_MODEL = "task long, name string, block int, tokens double, weights binary"
#: parameters in one block of a model
BLOCK = 1024


def _trainer(state: dict[str, np.ndarray], rounds: int):
    """Map function over encoded texts sorted by group: the parameters and squared-gradient sums that
    each group's tokens lead to from ``state``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((g, ids) for batch in batches
                for g, ids in zip(batch.column("grp").to_pylist(), batch.column("ids").to_pylist(), strict=True))
        for group, members in groupby(rows, key=lambda r: r[0]):
            net = Network({k: v.copy() for k, v in state.items() if not k.startswith(SUM)})
            sums = {k: state[SUM + k].copy() for k in net.p}
            tokens = 0
            for context, target in _batches((np.frombuffer(ids, np.uint16).astype(np.int32) for _, ids in members), BATCH):
                net.train(context, target, sums)
                tokens += len(target)
            if not tokens:
                continue
            made = net.p | {SUM + k: v for k, v in sums.items()}
            blocks = [(name, at // BLOCK, v.ravel()[at:at + BLOCK].astype(np.float32).tobytes())
                      for name, v in made.items() for at in range(0, v.size, BLOCK)]
            yield pa.RecordBatch.from_arrays([
                pa.array([group // rounds] * len(blocks), pa.int64()), pa.array([b[0] for b in blocks]),
                pa.array([b[1] for b in blocks], pa.int32()), pa.array([float(tokens)] * len(blocks), pa.float64()),
                pa.array([b[2] for b in blocks], pa.binary()),
            ], names=["task", "name", "block", "tokens", "weights"])
    return run


def _average(frame: pd.DataFrame) -> pd.DataFrame:
    """Mean of one block of the models' parameters, weighted by their tokens, in the order of their tasks."""
    frame = frame.sort_values("task", kind="stable")
    total = frame["tokens"].sum()
    mean = sum(np.frombuffer(w, np.float32).astype(np.float64) * (n / total)
               for w, n in zip(frame["weights"], frame["tokens"], strict=True))
    return pd.DataFrame({"task": [int(frame["group"].iloc[0])], "name": [frame["name"].iloc[0]],
                         "block": frame["block"].iloc[:1].to_numpy(), "tokens": [float(total)], "weights": [mean.astype(np.float32).tobytes()]})


@dataclass
class Scorer:
    words: Words
    rare: Rare
    net: Network


def _vocabulary(counts: DataFrame) -> tuple[Words, Rare, np.ndarray]:
    """The network's words, the table of the others, and the corpus's count of each token.

    The driver receives the ``VOCABULARY`` most frequent words at most (of words of the last count
    all or none), 2 ** ``RARE_BITS`` hashed counts at most, and a sum a length.
    """
    size, edge, common = counts.count(), 0, []
    if size > VOCABULARY:
        edge = counts.select(F.percentile_approx("n", 1 - VOCABULARY / size, 1 << 20)).first()[0]
    common = sorted(((r["n"], r["word"]) for r in counts.filter(F.col("n") > edge).collect()), reverse=True)
    if len(common) > VOCABULARY:  # the edge is approximate in very large corpora
        edge = common[VOCABULARY][0]
        common = [c for c in common if c[0] > edge]
    words = Words([w for _, w in common])
    unigram = np.zeros(OUTPUTS)
    for n, w in common:
        unigram[words[w.encode("utf-8", "surrogatepass")]] = n
    rare = counts.filter(F.col("n") <= edge)
    totals = np.zeros(BUCKETS)
    for r in rare.groupBy(F.least(F.octet_length("word"), F.lit(BUCKETS)).alias("k")).agg(F.sum("n").alias("n")).collect():
        totals[r["k"] - 1] = r["n"]
    unigram[VOCABULARY:] += totals
    slots = 1 << 12
    while slots < min(4 * (size - len(common)), 1 << RARE_BITS):
        slots *= 2

    def number(column: pa.Array) -> pa.Array:
        return pa.array(_slots(column.cast(pa.binary()), slots))
    mean = np.zeros(slots, np.float32)
    for slot, n in (rare.select(F.arrow_udf(number, "long")("word").alias("slot"), "n")
                    .groupBy("slot").agg(F.avg("n").alias("n")).toLocalIterator()):
        mean[slot] = n
    return words, Rare(mean, totals), unigram


def _encode(texts: pa.Array, words: Words, rare: Rare | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token numbers of all texts one after another, the end of each text, and with ``rare`` the sum
    of each text's log shares of rare words."""
    ids, sizes, sums = [np.zeros(0, np.int32)], np.zeros(len(texts), np.int64), np.zeros(len(texts))
    for rows, tokens in token_arrays(texts):
        part = words.numbers(tokens).astype(np.int32)
        ids.append(part)
        sizes += np.bincount(rows, minlength=len(texts))
        if rare:
            other = part >= VOCABULARY
            sums += np.bincount(rows[other], rare.logs(tokens.filter(pa.array(other))), len(texts))
    return np.concatenate(ids), np.cumsum(sizes), sums


def _encoded(docs: DataFrame, text_col: str, id_col: str | None, words: Words, groups: int, rounds: int) -> DataFrame:
    """(grp, h, ids, round) of all texts, written by round; the group goes by content and id."""
    def encode(texts: pa.Array) -> pa.Array:
        ids, ends, _ = _encode(texts, words)
        ids = ids.astype(np.uint16)
        return pa.array([ids[a:b].tobytes() for a, b in pairwise([0, *ends.tolist()])], pa.binary())
    h = F.xxhash64(quoted(text_col), quoted(id_col)) if id_col else F.xxhash64(quoted(text_col))
    group = F.pmod(h, F.lit(groups)).cast("long")
    path = work_path(docs.sparkSession, "lm-encoded")
    (docs.filter(quoted(text_col).isNotNull())
     .select(group.alias("grp"), h.alias("h"), F.arrow_udf(encode, "binary")(quoted(text_col)).alias("ids"),
             (group % rounds).cast("int").alias("round"))
     .write.partitionBy("round").parquet(path))
    return docs.sparkSession.read.schema("grp long, h long, ids binary, round int").parquet(path)


def _train(encoded: DataFrame, state: dict[str, np.ndarray], groups: int, rounds: int) -> dict[str, np.ndarray]:
    """Parameters and sums after all rounds."""
    for turn in range(rounds):
        part = (encoded.filter(F.col("round") == turn).select("grp", "h", "ids")
                .repartition("grp").sortWithinPartitions("grp", "h"))
        models, left = part.mapInArrow(_trainer(state, rounds), _MODEL), -(-groups // rounds)
        while True:
            grouped = models.withColumn("group", F.floor(F.col("task") / FAN_IN).cast("long"))
            models = grouped.groupBy("name", "block", "group").applyInPandas(_average, _MODEL)
            left = -(-left // FAN_IN)
            if left <= 1:
                break
        state = {k: v.copy() for k, v in state.items()}
        for r in models.collect():
            values = np.frombuffer(r["weights"], np.float32)
            state[r["name"]].reshape(-1)[r["block"] * BLOCK:r["block"] * BLOCK + len(values)] = values
    return state


def fit(docs: DataFrame, text_col: str = "text", id_col: str | None = "doc_id") -> Scorer:
    """Network trained on every token of every text of ``docs``, and the shares of the rare words.

    ``id_col`` (None: no such column) tells copies apart, so that a large group of them is spread
    over the groups.  Without any token the network keeps its start values.
    """
    prepare(docs.sparkSession)
    counts = word_counts(docs, text_col).checkpoint()
    words, rare, unigram = _vocabulary(counts)
    net = Network.start(unigram)
    tokens = int(unigram.sum())
    if tokens:
        groups = -(-tokens // GROUP_TOKENS)
        rounds = min(ROUNDS, math.ceil(math.sqrt(groups)))
        state = net.p | {SUM + k: np.full_like(v, 1e-8) for k, v in net.p.items()}
        state = _train(_encoded(docs, text_col, id_col, words, groups, rounds), state, groups, rounds)
        net = Network({k: state[k] for k in net.p})
    return Scorer(words, rare, net)


def score_column(text: str | Column, scorer: Scorer) -> Column:
    """Arrow function: struct of the number of tokens and the summed log-probability of each text."""
    words, rare, net = scorer.words, scorer.rare, scorer.net

    def run(texts: pa.Array) -> pa.Array:
        ids, ends, sums = _encode(texts, words, rare)
        held: list[tuple[int, np.ndarray, np.ndarray]] = []

        def flush() -> None:
            if not held:
                return
            logs = net.log_probs(np.concatenate([c for _, c, _ in held]), np.concatenate([t for _, _, t in held]))
            at = 0
            for i, _, t in held:
                sums[i] += logs[at:at + len(t)].sum()
                at += len(t)
            held.clear()
        n = 0
        for i, (a, b) in enumerate(pairwise([0, *ends.tolist()])):
            for at in range(0, b - a, SCORE_BATCH):
                part = ids[a + at:min(b, a + at + SCORE_BATCH)]
                held.append((i, windows_at(ids[a:b], at, SCORE_BATCH), part))
                n += len(part)
                if n >= SCORE_BATCH:
                    flush()
                    n = 0
        flush()
        return pa.StructArray.from_arrays([pa.array(np.diff(ends, prepend=0)), pa.array(sums)], names=["n_tokens", "log_prob"])
    return F.arrow_udf(run, "struct<n_tokens: bigint, log_prob: double>")(text)


def score(docs: DataFrame, scorer: Scorer, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens, log_prob (sum) and mean_log_prob of every row.

    Texts without tokens (null, empty) have 0 tokens, log_prob 0 and a null mean.  Repeated
    rows and null ids stay; other columns are not read; an empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    out = docs.select(F.col(id_col).alias("id"), score_column(text_col, scorer).alias("s"))
    return out.select(F.col("id").alias(id_col), "s.*",
                      F.try_divide(F.col("s.log_prob"), F.col("s.n_tokens").cast("double")).alias("mean_log_prob"))
