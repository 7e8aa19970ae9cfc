"""Benchmark decontamination: one Aho-Corasick automaton over normalised test items.

Normalising lower-cases A-Z and turns every other ASCII character that is no letter or
digit into a blank, byte for byte, so an offset in the normalised text is the offset in
the original's UTF-8.  The automaton holds the word windows of all items (ten words, or a
whole shorter item), each as its words between blanks; one pass over a text's words finds
every occurrence, and word positions lead back to offsets of the original.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakelens.llm.common import fresh, prepare, word_blocks

WINDOW = 10
#: bytes of item text in one automaton; a larger benchmark is scanned in blocks of this size
BLOCK_BYTES = 8 << 20

NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
               for b in range(256))
HIT_TYPE = "struct<n_words: bigint, starts: array<bigint>, ends: array<bigint>, n_hit: bigint, items: array<string>>"


def words_of(text: str | None) -> list[bytes]:
    """Normalised words of a text; null has none."""
    return (text or "").encode("utf-8", "surrogatepass").translate(NORMAL).split()


def windows_of(words: list[bytes], size: int = WINDOW) -> list[bytes]:
    """The item's windows, each with a blank at both ends; a shorter item is one window."""
    if not words:
        return []
    return [b" %b " % b" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))]


@dataclass
class Scanner:
    """Automaton of the windows of some items; built once in each Python worker."""

    items: list[tuple[str | None, str | None]]
    size: int = WINDOW
    _automaton: ahocorasick.Automaton | None = None

    def __getstate__(self):
        return {"items": self.items, "size": self.size, "_automaton": None}

    def automaton(self) -> ahocorasick.Automaton:
        if self._automaton is None:
            holders: dict[str, set[str | None]] = defaultdict(set)
            for item, text in self.items:
                for window in windows_of(words_of(text), self.size):
                    holders[window.decode("utf-8", "surrogatepass")].add(item)
            made = ahocorasick.Automaton()
            for window, ids in holders.items():
                made.add_word(window, (window.count(" ") - 1, tuple(i for i in ids if i is not None)))
            if holders:
                made.make_automaton()
            self._automaton = made
        return self._automaton

    def scan(self, text: str | None) -> tuple[int, list[tuple[int, int]], int, set[str]]:
        """Number of words, hit spans (UTF-8 offsets in the original), hit words, items found."""
        if not text:
            return 0, [], 0, set()
        data = text.encode("utf-8", "surrogatepass").translate(NORMAL)
        automaton = self.automaton()
        found: set[str] = set()
        starts_at: list[int] = []  # numbers of the words at which found windows begin, and their lengths
        lengths: list[int] = []
        total = 0
        for words in word_blocks(data, carry=self.size - 1):  # a window lies whole in some block
            base = max(0, total - (self.size - 1))
            total = base + len(words)
            if not words or not len(automaton):
                continue
            line = (b" %b " % b" ".join(words)).decode("utf-8", "surrogatepass")
            ends, sizes = [], []
            for end, (n, ids) in automaton.iter(line):
                ends.append(end)
                sizes.append(n)
                found.update(ids)
            if ends:  # the blank after word k of the block is blank k + 1 of its line
                blanks = np.array([i for i, c in enumerate(line) if c == " "])
                starts_at += (base + np.searchsorted(blanks, np.array(ends)) - np.array(sizes)).tolist()
                lengths += sizes
        if not starts_at:
            return total, [], 0, set()
        step = np.zeros(total + 1, dtype=np.int64)
        np.add.at(step, starts_at, 1)
        np.add.at(step, np.array(starts_at) + np.array(lengths), -1)
        hit = np.cumsum(step[:-1]) > 0
        raw = np.frombuffer(data, dtype=np.uint8) != 32
        edge = np.diff(np.concatenate(([0], raw.view(np.int8), [0])))
        starts, stops = np.nonzero(edge == 1)[0], np.nonzero(edge == -1)[0]
        runs = np.diff(np.concatenate(([0], hit.view(np.int8), [0])))
        spans = list(zip(starts[np.nonzero(runs == 1)[0]].tolist(),
                         stops[np.nonzero(runs == -1)[0] - 1].tolist(), strict=True))
        return total, spans, int(hit.sum()), found


def hit_column(text: str | Column, scanner: Scanner) -> Column:
    """Arrow function: what ``Scanner.scan`` finds in each text."""
    def run(texts: pa.Array) -> pa.Array:
        rows = [scanner.scan(t) for t in texts.to_pylist()]
        return pa.StructArray.from_arrays([
            pa.array([r[0] for r in rows], pa.int64()),
            pa.array([[s for s, _ in r[1]] for r in rows], pa.list_(pa.int64())),
            pa.array([[e for _, e in r[1]] for r in rows], pa.list_(pa.int64())),
            pa.array([r[2] for r in rows], pa.int64()),
            pa.array([sorted(r[3]) for r in rows], pa.list_(pa.string())),
        ], names=["n_words", "starts", "ends", "n_hit", "items"])
    return F.arrow_udf(run, HIT_TYPE)(text)


def _merge(text: str | Column, one: Column, two: Column) -> Column:
    """Both blocks' findings in one: spans joined where they touch the same words."""
    def run(texts: pa.Array, left: pa.Array, right: pa.Array) -> pa.Array:
        out = {n: [] for n in ("n_words", "starts", "ends", "n_hit", "items")}
        for text, a, b in zip(texts.to_pylist(), left.to_pylist(), right.to_pylist(), strict=True):
            spans: list[list[int]] = []
            data = (text or "").encode("utf-8", "surrogatepass").translate(NORMAL)
            for s, e in sorted([*zip(a["starts"], a["ends"], strict=True), *zip(b["starts"], b["ends"], strict=True)]):
                if spans and (s <= spans[-1][1] or not data[spans[-1][1]:s].strip()):
                    spans[-1][1] = max(spans[-1][1], e)
                else:
                    spans.append([s, e])
            out["n_words"].append(a["n_words"])
            out["starts"].append([s for s, _ in spans])
            out["ends"].append([e for _, e in spans])
            out["n_hit"].append(sum(len(data[s:e].split()) for s, e in spans))
            out["items"].append(sorted({*a["items"], *b["items"]}))
        types = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.list_(pa.string()))
        return pa.StructArray.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types, strict=True)],
                                          names=list(out))
    return F.arrow_udf(run, HIT_TYPE)(text, one, two)


def find_contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                       item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                       block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, str]:
    """``docs`` plus a struct column (whose name is returned) of what the scan found.

    ``n_words``; ``starts``/``ends``: UTF-8 offsets of the hit spans in the original text;
    ``n_hit``: words inside any occurrence of a window; ``items``: ids of the items with an
    occurring window, as strings in order.  Null texts have no words and no hits.  An item
    of null or wordless text has no window; an item of null id marks words but is not listed;
    repeated items count once.  An empty benchmark hits nothing.  All columns and rows of
    ``docs`` stay, whatever their names.

    The benchmark's size is summed first.  Its items are then shipped in blocks of at most
    ``block_bytes`` (and one longer item alone); with more than one block the findings are
    cut to the checkpoint folder after each, so that a worker holds one automaton at a time.
    """
    prepare(docs.sparkSession)
    items = benchmark.select(F.col(item_col).cast("string").alias("id"), F.col(item_text_col).alias("text")).distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = -(-total // block_bytes) or 1
    name = fresh(docs, "found")
    if parts == 1:
        scanner = Scanner([tuple(r) for r in items.collect()], window)
        return docs.withColumn(name, hit_column(text_col, scanner)), name
    out = None
    for part in range(parts):
        block = items.filter(F.pmod(F.xxhash64("id", "text"), F.lit(parts)) == part)
        found = hit_column(text_col, Scanner([tuple(r) for r in block.collect()], window))
        if out is None:
            out = docs.withColumn(name, found).checkpoint()
        else:
            more = fresh(out, "more")
            out = (out.withColumn(more, found)
                   .withColumn(name, _merge(F.col(text_col), F.col(name), F.col(more))).drop(more).checkpoint())
    return out, name


def digest(items: Column) -> Column:
    """Hex SHA-256 of the ids, comma-joined."""
    return F.sha2(F.array_join(items, ",").cast("binary"), 256)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **kwargs) -> DataFrame:
    """``docs`` without the rows that hold a benchmark window; all columns, no shuffle."""
    found, name = find_contamination(docs, benchmark, text_col, **kwargs)
    return found.filter(F.col(f"{name}.n_hit") == 0).select(*docs.columns)
