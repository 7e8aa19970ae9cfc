"""Hashing, base64 and byte-length helpers (all JVM-side Column expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The standard base64 alphabet and its padding character.
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
_PAD = "="


def sha256_hex(content: Column) -> Column:
    """SHA-256 of the bytes as 64 lowercase hex characters."""
    return F.sha2(content, 256)


def base64_text(content: Column) -> Column:
    """Standard base64 on one line (Spark chunks long output with CRLF; the alphabet has no CR/LF)."""
    return F.translate(F.base64(content), "\r\n", "")


# Text made of alphabet characters with at most two padding characters at its very end
# (``\z``: Java's ``$`` would also match before a final line break).
_PLAIN = r"^[A-Za-z0-9+/]*={0,2}\z"


def _plain(text: Column) -> Column:
    """One regex pass; true for the usual producer output, which needs no cleaning."""
    return text.rlike(_PLAIN)


def _cleaned(text: Column) -> Column:
    """The text without characters outside the alphabet and padding (as a lenient decoder drops them).

    Two ``translate`` passes (character maps, no regex): the first collects the
    foreign characters, the second deletes them.
    """
    foreign = F.translate(text, _ALPHABET + _PAD, "")
    return F.when(foreign == "", text).otherwise(F.call_function("translate", text, foreign, F.lit("")))


def _lenient_decodable(text: Column) -> Column:
    cleaned = _cleaned(text)
    data_len = F.length(F.translate(cleaned, _PAD, ""))
    pad_len = F.length(cleaned) - data_len
    first_pad = F.instr(cleaned, _PAD)
    return ((first_pad == 0) | (first_pad > data_len)) & (pad_len <= 2) & ((F.length(cleaned) % 4) == 0)


def base64_decodable(text: Column) -> Column:
    """Lenient decoder rule: foreign characters are dropped; then padding may only close the text,
    at most two characters of it, and the length must be a multiple of four.

    Plain text (the common case) is settled by one regex pass and the length; only other
    text takes the character-map passes."""
    ok = F.when(_plain(text), (F.length(text) % 4) == 0).otherwise(_lenient_decodable(text))
    return F.coalesce(ok, F.lit(False))


def decoded_length(text: Column) -> Column:
    """Byte length of what ``decode_base64`` returns, without decoding: three bytes per four
    characters of the cleaned text, less the padding; NULL when the text does not decode."""
    plain_pad = F.when(text.endswith("=="), 2).when(text.endswith(_PAD), 1).otherwise(0)
    plain = F.when((F.length(text) % 4) == 0, (F.length(text) / 4 * 3 - plain_pad).cast("long"))
    cleaned = _cleaned(text)
    pad_len = F.length(cleaned) - F.length(F.translate(cleaned, _PAD, ""))
    lenient = F.when(_lenient_decodable(text), (F.length(cleaned) / 4 * 3 - pad_len).cast("long"))
    return F.when(_plain(text), plain).otherwise(lenient)


def decode_base64(text: Column) -> Column:
    """Bytes of base64 text, NULL when the text does not decode."""
    plain = F.when((F.length(text) % 4) == 0, F.unbase64(text))
    lenient = F.when(F.coalesce(_lenient_decodable(text), F.lit(False)), F.unbase64(_cleaned(text)))
    return F.when(_plain(text), plain).otherwise(lenient)


def byte_length(content: Column) -> Column:
    return F.octet_length(content)
