"""Token counts: batch encoding in Arrow functions that return lengths only.

A text is cut in front of every blank (0x20) that follows a character which is no white
space.  Byte-level pre-tokenisers start a new piece there whatever comes before, their only
look-ahead concerns white space, and no special token holds a blank, so the tokens of the
parts are the tokens of the whole.  Parts repeat a lot: each worker keeps the lengths of a
bounded number of short parts and encodes only new ones, in batches of about equal bytes.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakelens.llm.common import prepare

#: bytes of text in one call of the encoder
BATCH_BYTES = 1 << 18
#: parts kept with their lengths in a worker, and the longest one kept
CACHE_PARTS, CACHE_CHARS = 400_000, 64
#: code points of a text that are cut into parts at a time
CHUNK_CHARS = 1 << 20


def default_tokenizer() -> str:
    """Path of the public byte-level BPE vocabulary."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def safe_parts(text: str) -> Iterator[str]:
    """Parts of ``text`` in order, cut in front of every blank after a character that is no white space."""
    held = ""
    for at in range(0, len(text), CHUNK_CHARS):
        pieces = (held + text[at:at + CHUNK_CHARS]).split(" ")
        part = pieces[0]
        for piece in pieces[1:]:
            if part and not part[-1].isspace():
                yield part
                part = " " + piece
            else:
                part += " " + piece
        held = part
    if held:
        yield held


class Counter:
    """Token lengths by one vocabulary file; the encoder is loaded once in each worker."""

    def __init__(self, path: str, batch_bytes: int = BATCH_BYTES):
        self.path, self.batch_bytes = path, batch_bytes
        self._encode = None
        self._known: dict[str, int] = {}

    def __getstate__(self):
        return {"path": self.path, "batch_bytes": self.batch_bytes, "_encode": None, "_known": {}}

    def encode(self, texts: list[str]) -> list[int]:
        if self._encode is None:
            if self.path.endswith(".model"):
                import sentencepiece
                model = sentencepiece.SentencePieceProcessor(model_file=self.path)
                self._encode = lambda x: [len(t) for t in model.encode(x, num_threads=1)]
            else:
                os.environ["TOKENIZERS_PARALLELISM"] = "false"
                from tokenizers import Tokenizer
                model = Tokenizer.from_file(self.path)
                model.no_truncation()
                model.no_padding()
                self._encode = lambda x: [len(t) for t in model.encode_batch_fast(x, add_special_tokens=False)]
        return self._encode(texts)

    def _lengths(self, parts: list[str]) -> dict[str, int]:
        """Lengths of distinct parts, encoded in batches of about equal bytes."""
        out: dict[str, int] = {}
        batch, size = [], 0
        for part in parts:
            batch.append(part)
            size += len(part)
            if size >= self.batch_bytes:
                out.update(zip(batch, self.encode(batch), strict=True))
                batch, size = [], 0
        if batch:
            out.update(zip(batch, self.encode(batch), strict=True))
        return out

    def count(self, texts: list[str | None]) -> list[int]:
        """Token counts; null counts as empty."""
        if self.path.endswith(".model"):  # its pieces can cross blanks' neighbours: whole texts
            lengths = self._lengths(list({t for t in texts if t}))
            return [lengths[t] if t else 0 for t in texts]
        out, held, size = [0] * len(texts), [], 0
        for at, text in enumerate(texts):
            for part in safe_parts(text or ""):
                held.append((at, part))
                size += len(part) + 8
                if size >= 8 * self.batch_bytes:  # parts of many short texts, or some of a long one
                    self._add(held, out)
                    held, size = [], 0
        self._add(held, out)
        return out

    def _add(self, held: list[tuple[int, str]], out: list[int]) -> None:
        """Add the lengths of the parts to the totals of their texts; new parts are encoded first."""
        known = self._known
        lengths = self._lengths(sorted({p for _, p in held if p not in known}, key=len))
        for at, part in held:
            n = known.get(part)
            out[at] += lengths[part] if n is None else n
        keep = {p: n for p, n in lengths.items() if len(p) <= CACHE_CHARS}
        if len(known) + len(keep) > CACHE_PARTS:
            known.clear()
        if len(keep) <= CACHE_PARTS:
            known.update(keep)


def token_count_column(text: str | Column, path: str | None = None, batch_bytes: int = BATCH_BYTES) -> Column:
    """Arrow function: number of tokens of each text (long), null as empty."""
    counter = Counter(path or default_tokenizer(), batch_bytes)

    def run(texts: pa.Array) -> pa.Array:
        return pa.array(counter.count(texts.to_pylist()), pa.int64())
    return F.arrow_udf(run, "long")(text)


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 path: str | None = None, limit: int = 512) -> DataFrame:
    """id, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > ``limit``) of every row.

    No begin, end or added special tokens; special strings inside a text count as the
    library's default has them; no truncation or padding.  Null texts count as empty (0, 0).
    Repeated rows and null ids stay; other columns are not read; an empty table gives an
    empty result.
    """
    prepare(docs.sparkSession)
    out = docs.select(F.col(id_col).alias(id_col),
                      F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("long").alias("n_bytes"),
                      token_count_column(text_col, path).alias("n_tokens"))
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
