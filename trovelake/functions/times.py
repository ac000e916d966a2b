"""Time text at the edges; TIMESTAMP (session zone UTC) inside."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The RFC 3339 form that documents carry, with and without zone.
RFC3339 = "yyyy-MM-dd'T'HH:mm:ss'Z'"
ISO8601 = "yyyy-MM-dd'T'HH:mm:ss"


def time_text(at: Column) -> Column:
    return F.date_format(at, RFC3339)


def format_timestamp(epoch_text: Column) -> Column:
    """Epoch seconds as text (zero-padded or not) to RFC 3339 UTC text."""
    return time_text(F.timestamp_seconds(epoch_text.try_cast("bigint")))


def to_timestamp(text: Column) -> Column:
    """Document time text to TIMESTAMP; the 'Z' may be missing."""
    return F.coalesce(
        F.try_to_timestamp(text, F.lit(RFC3339)), F.try_to_timestamp(text, F.lit(ISO8601))
    )


def parse_timestamp(text: Column, fmt: str | None = None) -> Column:
    """Time text to epoch seconds as text; NULL when it cannot be read."""
    at = to_timestamp(text) if fmt is None else F.try_to_timestamp(text, F.lit(fmt))
    return F.unix_seconds(at).cast("string")
