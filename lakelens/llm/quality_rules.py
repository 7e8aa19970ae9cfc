"""Learned quality rules: a decision list grown and pruned by sequential covering.

Text statistics come from one Arrow pass.  From labelled rows the learner repeatedly grows
a conjunction of threshold conditions for the bad class (FOIL gain on two thirds of the
rows not yet covered), prunes its last conditions on the other third, and keeps the rule
while it is precise there.  The list becomes one ordered ``when`` chain over the statistics,
so judging rows is plain Spark expressions.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakelens.llm.common import prepare, word_blocks

WINDOW = 8
#: labelled rows the rules are learned from at most (those of the least hashed id)
MAX_LABELLED = 20_000
#: thresholds tried for each statistic, conditions in a rule, rules in the list
THRESHOLDS, MAX_CONDITIONS, MAX_RULES = 48, 4, 24
#: precision and rows a pruned rule needs on the rows held for pruning
MIN_PRECISION, MIN_ROWS = 0.9, 3
#: base check: fewest words, and most words of a hundred inside repeated windows
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30

_SPACE, _SYMBOLS, _UPPER = b" \t\n\x0b\x0c\r", b"#*$%&|<>", bytes(range(65, 91))
_MARKS, _DIGITS = b"!?", b"0123456789"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_chars", "n_upper", "n_marks", "n_digits", "n_distinct_words", "n_lines", "n_top_word")


def repeat_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words inside windows of ``window`` words (a power of two) found twice or more, the first included.

    Equal windows get equal numbers by doubling: a window of 2k words is the pair of its halves.
    """
    n = len(ids)
    if n <= window:
        return 0
    codes, width = ids.astype(np.int64), 1
    while width < window:
        pairs = codes[:-width] * (int(codes.max()) + 1) + codes[width:]
        width *= 2
        if width < window:
            codes = np.unique(pairs, return_inverse=True)[1]
        else:
            _, codes, counts = np.unique(pairs, return_inverse=True, return_counts=True)
    twice = np.nonzero(counts[codes] > 1)[0]
    step = np.zeros(n + 1, dtype=np.int64)
    step[twice] += 1
    step[twice + window] -= 1
    return int((np.cumsum(step) > 0).sum())


def text_counts(text: str | None) -> tuple[int, ...]:
    """The counts named in ``COUNTS``; null counts as empty."""
    if not text:
        return (0,) * len(COUNTS)
    data = text.encode("utf-8", "surrogatepass")
    spaces = len(data) - len(data.translate(None, _SPACE))
    number: dict[bytes, int] = defaultdict()
    number.default_factory = number.__len__
    blocks = [np.fromiter(map(number.__getitem__, words), np.int32, len(words)) for words in word_blocks(data)]
    ids = np.concatenate(blocks) if blocks else np.zeros(0, np.int32)
    lines, dup, n_lines = set(), 0, 0
    for line in data.split(b"\n"):
        if line.translate(None, _SPACE):
            n_lines += 1
            if line in lines:
                dup += 1
            lines.add(line)

    def count(chars: bytes) -> int:
        return len(data) - len(data.translate(None, chars))
    top = int(np.bincount(ids).max()) if len(ids) else 0
    return (len(ids), len(text) - spaces, count(_SYMBOLS), dup, repeat_words(ids), len(text),
            count(_UPPER), count(_MARKS), count(_DIGITS), len(number), n_lines, top)


def counts_column(text: str | Column) -> Column:
    """Arrow function: struct of the counts of each text."""
    def run(texts: pa.Array) -> pa.Array:
        rows = np.array([text_counts(t) for t in texts.to_pylist()], dtype=np.int64).reshape(-1, len(COUNTS))
        return pa.StructArray.from_arrays([pa.array(rows[:, i]) for i in range(len(COUNTS))], names=list(COUNTS))
    return F.arrow_udf(run, "struct<" + ", ".join(f"{c}: bigint" for c in COUNTS) + ">")(text)


def statistics(counts: Column) -> dict[str, Column]:
    """The statistics that rules test, from the struct of counts; 0 where a divisor is 0."""
    def share(a: str, b: str) -> Column:
        return F.coalesce(F.try_divide(counts[a].cast("double"), counts[b].cast("double")), F.lit(0.0))
    return {
        "words": counts["n_words"].cast("double"),
        "mean_word_chars": share("word_chars", "n_words"),
        "symbols_per_word": share("n_symbols", "n_words"),
        "marks_per_word": share("n_marks", "n_words"),
        "upper_share": share("n_upper", "word_chars"),
        "digit_share": share("n_digits", "word_chars"),
        "dup_line_share": share("n_dup_lines", "n_lines"),
        "repeat_word_share": share("n_repeat_words", "n_words"),
        "distinct_word_share": share("n_distinct_words", "n_words"),
        "top_word_share": share("n_top_word", "n_words"),
        "words_per_line": share("n_words", "n_lines"),
    }


@dataclass(frozen=True)
class Condition:
    stat: str
    above: bool
    threshold: float

    def holds(self, x: np.ndarray, names: list[str]) -> np.ndarray:
        v = x[:, names.index(self.stat)]
        return v >= self.threshold if self.above else v < self.threshold

    def expression(self, stats: dict[str, Column]) -> Column:
        return stats[self.stat] >= self.threshold if self.above else stats[self.stat] < self.threshold

    def __str__(self) -> str:
        return f"{self.stat} {'>=' if self.above else '<'} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _covers(rule: Rule, x: np.ndarray, names: list[str]) -> np.ndarray:
    out = np.ones(len(x), dtype=bool)
    for c in rule:
        out &= c.holds(x, names)
    return out


def _grow(x: np.ndarray, bad: np.ndarray, names: list[str], cuts: dict[str, np.ndarray]) -> Rule:
    """Add the condition of the most FOIL gain until no good row is covered."""
    rule: list[Condition] = []
    inside = np.ones(len(x), dtype=bool)
    while len(rule) < MAX_CONDITIONS:
        p0, n0 = int(bad[inside].sum()), int((~bad[inside]).sum())
        if not p0 or not n0:
            break
        before, best = math.log2(p0 / (p0 + n0)), None
        for k, name in enumerate(names):
            v = x[inside, k][:, None]
            for above in (True, False):
                hold = v >= cuts[name] if above else v < cuts[name]
                p, n = hold[bad[inside]].sum(0), hold[~bad[inside]].sum(0)
                gain = p * (np.log2(np.maximum(p, 1e-9) / np.maximum(p + n, 1e-9)) - before)
                i = int(np.argmax(gain))
                if gain[i] > 1e-9 and (best is None or gain[i] > best[0]):
                    best = (gain[i], Condition(name, above, float(cuts[name][i])))
        if best is None:
            break
        rule.append(best[1])
        inside &= best[1].holds(x, names)
    return tuple(rule)


def _prune(rule: Rule, x: np.ndarray, bad: np.ndarray, names: list[str]) -> tuple[Rule, float, int]:
    """The prefix of ``rule`` with the best (p - n) / (p + n) on the rows held for pruning."""
    best: tuple[float, Rule, float, int] = (-2.0, (), 0.0, 0)
    for k in range(1, len(rule) + 1):
        hit = _covers(rule[:k], x, names)
        p, n = int((hit & bad).sum()), int((hit & ~bad).sum())
        worth = (p - n) / (p + n) if p + n else -1.0
        if worth > best[0]:
            best = (worth, rule[:k], p / (p + n) if p + n else 0.0, p)
    return best[1], best[2], best[3]


def learn_rules(x: np.ndarray, bad: np.ndarray, names: list[str]) -> list[Rule]:
    """Ordered rules for the bad class; none if the labels hold one class only.

    Deterministic: every third row (in the given order) is held for pruning, ties go to the
    first statistic and threshold.
    """
    if not len(x) or not bad.any() or bad.all():
        return []
    cuts = {}
    for k, name in enumerate(names):
        values = np.unique(x[:, k])
        if len(values) > THRESHOLDS:
            values = np.unique(np.quantile(values, np.linspace(0, 1, THRESHOLDS)))
        cuts[name] = (values[1:] + values[:-1]) / 2 if len(values) > 1 else values
    held = np.arange(len(x)) % 3 == 2
    left, rules = np.ones(len(x), dtype=bool), []
    while len(rules) < MAX_RULES and (bad & left & ~held).any():
        grow, prune = left & ~held, left & held
        rule = _grow(x[grow], bad[grow], names, cuts)
        if not rule:
            break
        rule, precision, hits = _prune(rule, x[prune], bad[prune], names)
        if not rule or precision < MIN_PRECISION or hits < MIN_ROWS:
            break
        rules.append(rule)
        left &= ~_covers(rule, x, names)
    return rules


def rule_number(rules: list[Rule], stats: dict[str, Column]) -> Column:
    """Number (from 1) of the first rule that holds, in order; 0 if none does."""
    if not rules:
        return F.lit(0)
    chain = F
    for i, rule in enumerate(rules):
        test = rule[0].expression(stats)
        for c in rule[1:]:
            test = test & c.expression(stats)
        chain = chain.when(test, F.lit(i + 1))
    return chain.otherwise(F.lit(0))


def base_failure(min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT) -> Column:
    """Too few words, or too many of them inside repeated windows, from the struct of counts ``c``."""
    return (F.col("c.n_words") < min_words) | (
        F.col("c.n_repeat_words") * 100 > F.col("c.n_words") * max_repeat_percent)


def fit_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              quality_col: str = "quality", max_labelled: int = MAX_LABELLED,
              min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT) -> list[Rule]:
    """Rules learned from at most ``max_labelled`` labelled ids (those of the least hash).

    Rows that fail the base check are judged by it alone, so they teach nothing here.  Rows of
    a null label or id do not count; an id labelled both ways counts as good.  Of several rows of
    one id the least text is taken, so at most ``max_labelled`` rows come to the driver.
    """
    sample = (labels.filter(F.col(quality_col).isNotNull() & F.col(id_col).isNotNull())
              .groupBy(F.col(id_col).alias("id")).agg(F.max(quality_col).alias("quality"))
              .orderBy(F.xxhash64("id"), "id").limit(max_labelled))
    rows = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(sample), "id")
            .groupBy("id").agg(F.min("text").alias("text"), F.max("quality").alias("quality")))
    counted = rows.select("id", "quality", counts_column("text").alias("c"))
    stats = statistics(F.col("c"))
    # the base check is applied to the sample's rows here: as a filter, Spark would push it, and
    # the counting with it, below the join to all documents
    found = (counted.select(F.xxhash64("id").alias("h"), "id", "quality", *[c.alias(n) for n, c in stats.items()],
                            base_failure(min_words, max_repeat_percent).alias("failed")).toPandas())
    found = found[~found["failed"]].sort_values(["h", "id", *stats], kind="stable")
    return learn_rules(found[list(stats)].to_numpy(float), found["quality"].to_numpy() < 0.5, list(stats))


def judge(docs: DataFrame, rules: list[Rule], id_col: str = "doc_id", text_col: str = "text",
          min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT) -> DataFrame:
    """id, the counts, ``base_failed``, ``rule`` (0 none) and ``kept`` of every row.

    ``base_failed``: fewer than ``min_words`` words, or more than ``max_repeat_percent`` per
    cent of them inside repeated windows.  ``kept``: not base_failed and no rule holds.  Null
    and empty texts have all counts 0 and fail the base.  Repeated rows and null ids stay;
    other columns are not read; an empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    counted = docs.select(F.col(id_col).alias("id"), counts_column(text_col).alias("c"))
    return (counted.withColumn("base_failed", base_failure(min_words, max_repeat_percent))
            .withColumn("rule", rule_number(rules, statistics(F.col("c"))))
            .select(F.col("id").alias(id_col), "c.*", "base_failed", "rule",
                    (~F.col("base_failed") & (F.col("rule") == 0)).alias("kept")))
