"""Text forms used by the run report."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_set(*values: Column, default: str = "unknown") -> Column:
    """The first value that is neither NULL nor the empty string."""
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values], F.lit(default))


def thousands(count: Column) -> Column:
    """``1234567`` as ``1,234,567``."""
    return F.format_number(count, 0)


def prefix(text: Column, length: int) -> Column:
    """The first ``length`` characters."""
    return F.substring(text, 1, length)


def duration_text(seconds: Column) -> Column:
    """``5.2s`` under a minute, ``1m 30s`` under an hour, else ``1h 1m 40s``."""
    whole = seconds.cast("bigint")
    minutes = F.floor(whole / 60).cast("bigint")
    return (
        F.when(seconds < 60, F.format_string("%.1fs", seconds.cast("double")))
        .when(whole < 3600, F.format_string("%dm %ds", minutes, whole % 60))
        .otherwise(F.format_string("%dh %dm %ds", F.floor(whole / 3600).cast("bigint"), minutes % 60, whole % 60))
    )


def seconds_since(start_iso: Column, as_of: Column) -> Column:
    """Seconds from an ISO-8601 text to ``as_of``; 0.0 when it is missing or unreadable.

    A text without an offset is read as UTC (the session time zone).
    """
    looks_like_date = start_iso.rlike(r"^\d{4}-\d{2}-\d{2}")
    start = F.when(looks_like_date, start_iso.try_cast("timestamp"))
    micros = F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(start)
    return F.coalesce(micros / F.lit(1e6), F.lit(0.0))


def content_hash(text: Column) -> Column:
    """First 16 hex characters of the SHA-256 of a text."""
    return F.substring(F.sha2(text, 256), 1, 16)


def stable_bucket(key: Column, hex_digits: int = 8) -> Column:
    """A repeatable pseudo-random integer for a key, the same on every run and engine."""
    digits = F.substring(F.md5(key.cast("string")), 1, hex_digits)
    return F.conv(digits, 16, 10).cast("bigint")
