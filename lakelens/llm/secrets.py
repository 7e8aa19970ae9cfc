"""Secret scan: format rules plus a guess-cost model over credential-context values.

The cost of guessing a value is the cheapest way to build it from words, dates, repeats,
keyboard walks and brute-force spans: a dynamic program over end positions keeps, for every
prefix, the least sum of log10 guesses of its segments.  Values that follow a credential
word and cost at least ``MIN_LOG10_GUESSES`` are secrets; placeholders and plain words
("changeme", "qwerty12", "2024-01-01") cost little and are left alone.  The words are a list of
placeholders and, by rank, the words that Spark counts in the corpus outside such values.
"""

from __future__ import annotations

import hashlib
import math
import re
from array import array
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakelens.llm.common import fresh, prepare
from lakelens.llm.lm_scoring import word_counts

# --- fixed values: the format rules of the base kinds, in the order of their kinds
KINDS = ("assign", "access", "hex", "guess")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_MIN, ACCESS_MIN = 8, 16
# --- fixed values: credential words whose values the guess-cost model judges
CONTEXT = re.compile(r"""(?:password|passwd|passphrase|passcode|pwd|pass|secret|token|credential|api[_-]?key"""
                     r"""|access[_-]?key|private[_-]?key|authorization|auth)s?(?:[_-][a-z0-9]++){0,8}+["']?"""
                     r"""(?:[\x20\t]*(?P<sign>:|=>|=|\x20is\x20)[\x20\t]*(?:(?:bearer|basic|token)\x20++)?+"""
                     r"""|>(?=[^<>\s]{4,}+</))"""  # the text of an element
                     r"""(?:"([^"\r\n]{4,}+)"|'([^'\r\n]{4,}+)'|([^\s"'<>,;]{4,}+))""",
                     re.IGNORECASE | re.ASCII)
# --- fixed values: keyboard rows, and common words and placeholders of credential values by rank
ROWS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
COMMON = """password passwd pass secret token key api admin root user login test example sample demo default
changeme change me your my the here none null true false todo xxx letmein welcome hello master dragon monkey
shadow sunshine princess football baseball superman iloveyou trustno qwerty abc value string text placeholder
redacted hidden masked env var config secretkey access private public client server service account email name
super guest temp dev prod staging local host database db""".split()
# ---

#: log10 guesses from which a credential value counts as a secret
MIN_LOG10_GUESSES = 9.0
#: log10 guesses that one more segment costs
SEGMENT_COST = 0.3
#: a corpus word is ranked if it occurs at least so often; the ranks are shipped to the workers, so
#: there are at most ``COMMON_MOST`` words (of at most 128 bytes), those that occur most
COMMON_LEAST, COMMON_MOST = 3, 1 << 18


class Ranks(dict):
    """Ranks of the placeholders, then of ``words``, and the length of the longest."""

    def __init__(self, words: Iterable[str] = ()):
        super().__init__()
        for w in (*COMMON, *words):
            self.setdefault(w, len(self) + 1)
        self.longest = max(map(len, self))

    def __reduce__(self):
        return Ranks, (list(self),)


_RANK = Ranks()
_PLACE = {c: (r, i) for r, row in enumerate(ROWS) for i, c in enumerate(row)}
_LEET = str.maketrans("@4310!5$7", "aaeioisst")
_ASCII_LOWER = {c: c + 32 for c in range(65, 91)}
#: characters of the longest unit whose repeats are one segment
_LONGEST_UNIT = 8
_DATE = re.compile(r"(?:19|20)\d\d[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:0[1-9]|[12]\d|3[01])"
                   r"|(?:0[1-9]|[12]\d|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:19|20)\d\d|(?:19|20)\d\d")


def _alphabet(piece: str) -> int:
    kinds = ((10, str.isdigit), (26, str.islower), (26, str.isupper))
    size = sum(n for n, has in kinds if any(map(has, piece)))
    return max(10, size + (33 if any(not c.isalnum() for c in piece) else 0))


def _adjacent(a: str, b: str) -> bool:
    p, q = _PLACE.get(a), _PLACE.get(b)
    return p is not None and q is not None and p[0] == q[0] and abs(p[1] - q[1]) == 1


def log10_guesses(value: str, words: Ranks = _RANK, least: float | None = None) -> float:
    """Least log10 guesses over all segmentations of ``value``, in time and memory linear in its length.

    With ``least`` the program ends once it is settled whether the result reaches it, and gives
    a bound on the same side: every segmentation passes a position through one of the ends
    offered from before it, so the least of those costs bounds the result from below, and the
    cost offered for the value's end bounds it from above.
    """
    n, low = len(value), value.translate(_ASCII_LOWER)
    plain = low.translate(_LEET)
    per_char = math.log10(_alphabet(value)) if value else 0.0
    best = array("d", [math.inf]) * (n + 1)
    best[0] = 0.0
    far, check = 0, 16

    def offer(i: int, j: int, cost: float) -> None:
        nonlocal far
        best[j] = min(best[j], best[i] + cost + SEGMENT_COST)
        far = max(far, j)

    # where the pattern that holds at a position ends: by repeated unit, keyboard walk, run
    units = range(1, _LONGEST_UNIT + 1)
    same, walk, run = [-1] * (_LONGEST_UNIT + 1), -1, -1
    for i in range(n):
        if least is not None and i >= check:
            check = 2 * i
            low_end = min(best[i:max(far, i) + 1])
            if low_end >= least or best[n] < least:
                return low_end if low_end >= least else best[n]
        best[i + 1] = min(best[i + 1], best[i] + per_char)  # brute force, a character at a time
        for j in range(i + 2, min(n, i + words.longest) + 1):  # words, some in capitals or with look-alike signs
            rank = words.get(low[i:j]) or words.get(plain[i:j])
            if rank:
                twist = (low[i:j] != value[i:j]) + (low[i:j] not in words)
                offer(i, j, math.log10(rank + 1) + 0.3 * twist)
        if (m := _DATE.match(value, i)) is not None:
            offer(i, m.end(), 2.1 if m.end() - i == 4 else 4.6)
        for unit in units:  # repeats of up to eight characters
            if same[unit] < i:
                k = i
                while k + unit < n and value[k] == value[k + unit]:
                    k += 1
                same[unit] = k
            times = 1 + (same[unit] - i) // unit
            if times > 1:
                offer(i, i + times * unit, unit * math.log10(_alphabet(value[i:i + unit])) + math.log10(times))
        if walk < i:
            walk = i
            while walk + 1 < n and _adjacent(low[walk], low[walk + 1]):
                walk += 1
        if walk - i >= 2:  # keyboard walks
            offer(i, walk + 1, math.log10(len(_PLACE) * 2) + math.log10(walk + 1 - i))
        if run < i:
            run = i
            while run + 1 < n and abs(ord(value[run + 1]) - ord(value[run])) == 1 and value[run + 1].isalnum():
                run += 1
        if run - i >= 2:  # runs such as 1234, abcd
            offer(i, run + 1, math.log10(36 * 2) + math.log10(run + 1 - i))
    return best[n]


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the format rules by start, then kind."""
    out = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_MIN]
    out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_MIN]
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def _prose(text: str, m: re.Match) -> bool:
    """Whether a match reads as prose: its value is letters that no ``=`` assigns, and either the
    credential word ends a longer one (bypass, compass) or a lower-case word follows ``is``."""
    at, value = m.start(), m[m.lastindex]
    if not value.isalpha() or "=" in text[at:m.start(m.lastindex)]:
        return False
    inside = at > 0 and text[at - 1].isalpha() and not (text[at - 1].islower() and text[at].isupper())
    return inside or (value.islower() and (m["sign"] or "").strip().lower() == "is")


def guess_spans(text: str, least: float = MIN_LOG10_GUESSES, words: Ranks = _RANK) -> list[tuple[str, int, int]]:
    """Spans of credential values that cost at least ``least`` log10 guesses.

    A value that costs less may itself be the next credential word, so the scan goes on at its start.
    """
    out, at = [], 0
    while (m := CONTEXT.search(text, at)) is not None:
        group = m.lastindex
        at = m.start(group)
        if not _prose(text, m) and log10_guesses(m[group], words, least) >= least:
            at = m.end(group)
            out.append(("guess", m.start(group), at))
    return out


def _without_values(text: str | None) -> str | None:
    """``text`` without the words and values that follow credential words, all of which might be secrets."""
    if not text:
        return text
    parts, end, at = [], 0, 0
    while (m := CONTEXT.search(text, at)) is not None:
        group = m.lastindex
        at = m.start(group)
        if not _prose(text, m):
            parts.append(text[end:at])
            end = max(end, m.end(group))
            if log10_guesses(m[group], least=MIN_LOG10_GUESSES) >= MIN_LOG10_GUESSES:
                at = end
    return " ".join([*parts, text[end:]])


def common_words(docs: DataFrame, text_col: str = "text", most: int = COMMON_MOST) -> Ranks:
    """Ranks of the words that ``docs`` holds ``COMMON_LEAST`` times or more outside credential
    values, after the placeholders.

    The corpus is counted once.  Were there more than ``most`` such words, those of the lower
    counts are left out, so that the table that workers get stays small.
    """
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([_without_values(t) for t in texts.to_pylist()], pa.string())
    counts = word_counts(docs.select(F.arrow_udf(run, "string")(text_col).alias("text")))
    counts = counts.filter((F.col("n") >= COMMON_LEAST) & F.col("word").rlike(r"^\p{L}{4,32}$")).checkpoint()
    size = counts.count()
    if size > most:
        edge = counts.select(F.percentile_approx("n", 1 - most / size, 1 << 20)).first()[0]
        counts = counts.filter(F.col("n") > edge)
    return Ranks(w for _, w in sorted((-r["n"], r["word"]) for r in counts.collect()))


def all_spans(text: str | None, least: float = MIN_LOG10_GUESSES, words: Ranks = _RANK) -> list[tuple[str, int, int]]:
    """Base spans and guess spans by start, then kind; none in a null or empty text."""
    if not text:
        return []
    return sorted(base_spans(text) + guess_spans(text, least, words), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def render(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def masked(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
    """``text`` with every stretch covered by spans replaced by ``[SECRET]``."""
    if not spans:
        return text
    parts, at, end = [], 0, -1
    for _, s, e in spans:
        if s > end:  # a new stretch
            if end >= 0:
                at = end
            parts += [text[at:s], "[SECRET]"]
            end = e
        end = max(end, e)
    return "".join([*parts, text[end:]])


def span_column(text: str | Column, least: float = MIN_LOG10_GUESSES, words: Ranks = _RANK) -> Column:
    """Arrow function: counts, digest and spans of each text."""
    def run(texts: pa.Array) -> pa.Array:
        cols: list[list] = [[], [], [], [], []]
        for t in texts.to_pylist():
            spans = all_spans(t, least, words)
            base = [s for s in spans if s[0] != "guess"]
            for col, kind in zip(cols, KINDS, strict=False):
                col.append(sum(s[0] == kind for s in base))
            cols[3][-1] = hashlib.sha256(render(base).encode()).hexdigest()
            cols[4].append(render(spans))
        types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
        return pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                                          names=["n_assign", "n_access", "n_hex", "base_sha256", "spans"])
    kind = "struct<n_assign: bigint, n_access: bigint, n_hex: bigint, base_sha256: string, spans: string>"
    return F.arrow_udf(run, kind)(text)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 least: float = MIN_LOG10_GUESSES, words: Ranks | None = None) -> DataFrame:
    """id, n_assign, n_access, n_hex, base_sha256 and spans (``kind:start:end``) of every row.

    Offsets are code points, end exclusive.  Null and empty texts have no spans (the digest
    of an empty list).  Rows are judged one by one, by ``words`` or else the common words of ``docs``: repeated rows and null ids stay, other
    columns are not read, an empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    found = docs.select(F.col(id_col).alias("id"), span_column(text_col, least, words or common_words(docs, text_col)).alias("found"))
    return found.select(F.col("id").alias(id_col), "found.*")


def mask_secrets(docs: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars",
                 least: float = MIN_LOG10_GUESSES, words: Ranks | None = None) -> DataFrame:
    """``docs`` with secrets in ``text_col`` replaced by ``[SECRET]`` and ``chars_col`` counted anew.

    All rows and columns stay in place; texts without secrets, null and empty ones are unchanged.
    An empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    ranks = words or common_words(docs, text_col)

    def run(texts: pa.Array) -> pa.Array:
        return pa.array([masked(t, all_spans(t, least, ranks)) for t in texts.to_pylist()], pa.string())
    new = fresh(docs, "masked")
    out = docs.withColumn(new, F.arrow_udf(run, "string")(text_col))
    changed = ~F.col(new).eqNullSafe(F.col(text_col))
    cols = []
    for c in docs.columns:
        if c == text_col:
            cols.append(F.col(new).alias(c))
        elif c == chars_col:
            kind = docs.schema[c].dataType
            cols.append(F.when(changed, F.char_length(new).cast(kind)).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(f"`{c}`"))
    return out.select(*cols)
