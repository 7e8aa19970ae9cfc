"""ISO-8601 formatting and parsing that follow Python's ``isoformat`` / ``fromisoformat`` rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_OFFSET = r"(Z|[+-]\d{2}(:?\d{2})?(:?\d{2}(\.\d+)?)?)$"


def iso_naive(ts: Column) -> Column:
    """``YYYY-MM-DDTHH:MM:SS`` plus ``.ffffff`` only when the microseconds are not zero."""
    return F.regexp_replace(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), r"\.000000$", "")


def iso_utc(ts_utc: Column) -> Column:
    """isoformat of an aware UTC time: the naive form plus ``+00:00``."""
    return F.concat(iso_naive(ts_utc), F.lit("+00:00"))


def has_offset(text: Column) -> Column:
    return F.trim(text).rlike(_OFFSET)


def parse_iso_utc(text: Column) -> Column:
    """Text to a UTC wall-clock ``timestamp_ntz``; NULL when it does not parse.

    Naive text is taken as UTC; text with an offset is moved to UTC.  The offset
    branch goes through an instant, so the session time zone must be UTC
    (``lakelens.session.pin_utc``).
    """
    t = F.trim(text)
    return (F.when(has_offset(t), t.try_cast("timestamp").cast("timestamp_ntz"))
             .otherwise(t.try_cast("timestamp_ntz")))
