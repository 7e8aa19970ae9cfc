"""Toxicity severity by cumulative-link ordinal regression over sparse text features.

P(severity > k) = sigmoid(w . x - theta_k): one weight vector is shared by all thresholds,
which are kept in order by their increments.  Features are whole words and word prefixes
(prefixes carry compound words), chosen on the labelled sample by log-likelihood ratio; x
holds the log of their counts.  The model is a few thousand numbers, fitted in numpy from a
bounded labelled sample and shipped to the tasks, which score every text in one pass.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakelens.llm.common import LOWER, prepare, word_blocks

#: labelled ids that the model is fitted on at most (those of the least hash)
MAX_LABELLED = 8000
#: P(severity > 0) from which a text is rejected
CUT = 0.45
#: features in the model, the least labelled rows that hold one, and the lengths of word prefixes
MAX_FEATURES, MIN_ROWS, PREFIXES = 2000, 4, (4, 5, 6, 7, 8)
#: chosen words and prefixes in a labelled text from which it counts as grade 2, 3 (1 below)
GRADE_HITS = (3, 8)
STEPS, RATE, L2 = 300, 0.05, 2e-4

_PUNCTUATION = bytes(32 if b < 128 and not chr(b).isalnum() else b for b in LOWER)


def feature_counts(text: str | None) -> Counter:
    """Counts of the text's words (``=word``) and word prefixes (``<prefix``); null has none."""
    words: Counter = Counter()
    if text:
        data = text.lower().encode("utf-8", "surrogatepass").translate(_PUNCTUATION)
        for block in word_blocks(data):
            words.update(block)
    out: Counter = Counter()
    for raw, n in words.items():
        word = raw.decode("utf-8", "surrogatepass")
        for f in _features(word):
            out[f] += n
    return out


def _features(word: str) -> list[str]:
    return ["=" + word, *("<" + word[:k] for k in PREFIXES if len(word) >= k)]


@dataclass
class Model:
    """Weights of the features, thresholds of the grades."""

    weights: dict[str, float]
    thresholds: list[float]
    _words: dict[bytes, tuple[str, ...]] = field(default_factory=dict)

    def __getstate__(self):
        return {"weights": self.weights, "thresholds": self.thresholds, "_words": {}}

    def _known(self, word: bytes) -> tuple[str, ...]:
        found = self._words.get(word)
        if found is None:
            found = tuple(f for f in _features(word.decode("utf-8", "surrogatepass")) if f in self.weights)
            if len(self._words) < 200_000:
                self._words[word] = found
        return found

    def score(self, text: str | None) -> float:
        """w . x of a text, 0 for one without known features."""
        if not text or not self.weights:
            return 0.0
        data = text.lower().encode("utf-8", "surrogatepass").translate(_PUNCTUATION)
        counts: dict[str, int] = {}
        for block in word_blocks(data):
            for word in block:
                for f in self._known(word):
                    counts[f] = counts.get(f, 0) + 1
        if not counts:
            return 0.0
        return float(sum(self.weights[f] * np.log1p(counts[f]) for f in sorted(counts)))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def fit_ordinal(x: np.ndarray, grades: np.ndarray, levels: int, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds that maximise the cumulative-link likelihood (Adam, L2 on the weights)."""
    n, d = x.shape
    share = [np.clip((grades > k).mean(), 1e-3, 1 - 1e-3) for k in range(levels - 1)]
    start = -np.log(np.array(share) / (1 - np.array(share)))
    gaps = np.log(np.maximum(np.diff(start), 1e-2))
    params = np.concatenate((np.zeros(d), start[:1], gaps))
    across = np.ascontiguousarray(x.T)
    m, v = np.zeros_like(params), np.zeros_like(params)
    rows = np.arange(n)
    for step in range(1, steps + 1):
        w, theta = params[:d], np.concatenate((params[d:d + 1], params[d] + np.cumsum(np.exp(params[d + 1:]))))
        bounds = np.concatenate(([-np.inf], theta, [np.inf]))
        s = (x @ w.astype(x.dtype)).astype(float)
        above, below = bounds[grades + 1] - s, bounds[grades] - s
        hi, lo = _sigmoid(above), _sigmoid(below)
        p = np.maximum(hi - lo, 1e-12)
        d_hi, d_lo = np.where(np.isinf(above), 0, hi * (1 - hi)), np.where(np.isinf(below), 0, lo * (1 - lo))
        grad_w = (across @ ((d_hi - d_lo) / p).astype(x.dtype)) / n + 2 * L2 * w
        grad_theta = np.zeros(levels + 1)
        np.add.at(grad_theta, grades[rows] + 1, -d_hi / p)
        np.add.at(grad_theta, grades[rows], d_lo / p)
        grad_theta = grad_theta[1:-1] / n
        tail = np.cumsum(grad_theta[::-1])[::-1]
        grad = np.concatenate((grad_w, [grad_theta.sum()], tail[1:] * np.exp(params[d + 1:])))
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        params = params - RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    theta = np.concatenate((params[d:d + 1], params[d] + np.cumsum(np.exp(params[d + 1:]))))
    return params[:d], theta


def _log_ratio(a: np.ndarray, b: np.ndarray, na: int, nb: int) -> np.ndarray:
    """Signed G statistic of features in a of na toxic and b of nb other rows."""
    rate = (a + b) / (na + nb)

    def part(k, n, r):
        return k * np.log(np.maximum(k, 1e-12) / np.maximum(n * r, 1e-12)) + \
            (n - k) * np.log(np.maximum(n - k, 1e-12) / np.maximum(n * (1 - r), 1e-12))
    return np.where(a / na >= b / nb, 1, -1) * 2 * (part(a, na, rate) + part(b, nb, rate))


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, toxic_col: str,
                    max_labelled: int) -> DataFrame:
    """(id, text, toxic) of at most ``max_labelled`` labelled ids, of the least hash, one row each.

    Rows of a null label or id do not count; an id labelled both ways counts as toxic.  Of several
    rows of one id the least text is taken, so the bound holds for rows as well.
    """
    sample = (labels.filter(F.col(toxic_col).isNotNull() & F.col(id_col).isNotNull())
              .groupBy(F.col(id_col).alias("id")).agg(F.max(toxic_col).alias("toxic"))
              .orderBy(F.xxhash64("id"), "id").limit(max_labelled))
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter(F.col("text").isNotNull())
            .join(F.broadcast(sample), "id").groupBy("id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        toxic_col: str = "toxic", max_labelled: int = MAX_LABELLED) -> Model:
    """Model fitted on a bounded labelled sample.

    Features are counted per row in tasks, their document frequencies summed by Spark, and
    only the chosen ones come to the driver: at most ``MAX_FEATURES`` of them in the rows of at
    most ``max_labelled`` ids.  Severity grades: 0 for rows labelled clean; labelled toxic
    rows get 1, 2 or 3 by how many strongly toxic features they hold.  Without labels of
    both classes the model is empty and scores every text 0.
    """
    prepare(docs.sparkSession)
    sample = labelled_sample(docs, labels, id_col, text_col, toxic_col, max_labelled)

    def run(texts: pa.Array) -> pa.Array:
        return pa.array([sorted(feature_counts(t).items()) for t in texts.to_pylist()],
                        pa.map_(pa.string(), pa.int32()))
    counted = sample.select(F.xxhash64("id").alias("row"), (F.col("toxic") > 0).alias("toxic"),
                            F.arrow_udf(run, "map<string, int>")("text").alias("f")).checkpoint()
    sizes = {r["toxic"]: r["n"] for r in counted.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_tox, n_ok = sizes.get(True, 0), sizes.get(False, 0)
    if not n_tox or not n_ok:
        return Model({}, [0.0])
    seen = (counted.select("toxic", F.explode("f").alias("feature", "n"))
            .groupBy("feature").agg(F.sum(F.col("toxic").cast("long")).alias("a"), F.count(F.lit(1)).alias("rows"))
            .filter(F.col("rows") >= MIN_ROWS).withColumn("b", F.col("rows") - F.col("a")))
    # how far the classes' shares differ, in standard errors: the order in which features are chosen
    gap = F.abs(F.col("a") / n_tox - F.col("b") / n_ok) / F.sqrt(
        (F.col("rows") / (n_tox + n_ok)) * (1 - F.col("rows") / (n_tox + n_ok) + 1e-9) * (1 / n_tox + 1 / n_ok))
    chosen = seen.orderBy(gap.desc(), "feature").limit(MAX_FEATURES).toPandas()
    if chosen.empty:
        return Model({}, [0.0])
    names = chosen["feature"].tolist()
    ratio = _log_ratio(chosen["a"].to_numpy(float), chosen["b"].to_numpy(float), n_tox, n_ok)
    number = {f: i for i, f in enumerate(names)}

    def pick(maps: pa.Array) -> pa.Array:
        return pa.array([[v for f, n in m if f in number for v in (number[f], n)] for m in maps.to_pylist()],
                        pa.list_(pa.int32()))
    picked = counted.select("row", "toxic", F.arrow_udf(pick, "array<int>")("f").alias("cells"))
    rows = picked.toPandas().sort_values("row")  # one row a labelled id
    x = np.zeros((len(rows), len(names)), dtype=np.float32)
    for at, cells in enumerate(rows["cells"]):
        x[at, cells[0::2]] = np.log1p(cells[1::2])
    toxic = rows["toxic"].to_numpy()
    # strongly toxic: held by toxic rows, all but never by others
    strong = (ratio > 10) & (chosen["b"].to_numpy(float) / n_ok < 0.02 * chosen["a"].to_numpy(float) / n_tox)
    hits = (x[:, strong] > 0).sum(1)
    grades = np.where(toxic, 1 + (hits >= GRADE_HITS[0]).astype(int) + (hits >= GRADE_HITS[1]), 0)
    levels = int(grades.max()) + 1
    used = np.unique(grades)
    grades = np.searchsorted(used, grades)  # grades no row has are left out
    w, theta = fit_ordinal(x, grades, min(levels, len(used)))
    return Model({f: float(c) for f, c in zip(names, w, strict=True) if abs(c) > 1e-6}, theta.tolist())


def severity_column(text: str | Column, model: Model) -> Column:
    """Arrow function: struct of P(severity > 0) and the expected severity of each text."""
    theta = np.array(model.thresholds)

    def run(texts: pa.Array) -> pa.Array:
        s = np.array([model.score(t) for t in texts.to_pylist()], dtype=float)
        above = _sigmoid(s[:, None] - theta[None, :]) if model.weights else np.zeros((len(s), 1))
        grade = (above >= 0.5).sum(1)
        return pa.StructArray.from_arrays([pa.array(above[:, 0]), pa.array(above.sum(1)),
                                           pa.array(grade.astype(np.int32))], names=["p_toxic", "severity", "grade"])
    return F.arrow_udf(run, "struct<p_toxic: double, severity: double, grade: int>")(text)


def grade(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          cut: float = CUT) -> DataFrame:
    """id, p_toxic, severity (expected grade), grade (thresholds passed) and toxic (p_toxic >= ``cut``) of every row.

    Null and empty texts hold no feature and get the score of a text without any.  Repeated
    rows and null ids stay; other columns are not read; an empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    out = docs.select(F.col(id_col).alias("id"), severity_column(text_col, model).alias("s"))
    return out.select(F.col("id").alias(id_col), "s.*", (F.col("s.p_toxic") >= cut).alias("toxic"))


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text", cut: float = CUT) -> DataFrame:
    """``docs`` without the rows of ``p_toxic`` >= ``cut``; all columns, no shuffle.

    Null and empty texts stay unless the model calls a text without any feature toxic.  An
    empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    return docs.filter(severity_column(text_col, model)["p_toxic"] < cut)
