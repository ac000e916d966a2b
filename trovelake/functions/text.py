"""Text, encoding, digest and number functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def equals(a: Column, b: Column) -> Column:
    return a == b


def equals_ignore_case(a: Column, b: Column) -> Column:
    return F.lower(a) == F.lower(b)


def starts_with(text: Column, prefix: Column) -> Column:
    return F.startswith(text, prefix)


def ends_with(text: Column, suffix: Column) -> Column:
    return F.endswith(text, suffix)


def maybe_utf8(content: Column) -> Column:
    return F.is_valid_utf8(content)


def to_utf8(content: Column) -> Column:
    """Bytes to text: UTF-8 where valid, else read as Latin-1."""
    return F.when(F.is_valid_utf8(content), F.decode(content, "UTF-8")).otherwise(
        F.decode(content, "ISO-8859-1")
    )


def content_md5(content: Column) -> Column:
    """Lower-case hex MD5 of the whole content."""
    return F.md5(content)


def parse_size(text: Column) -> Column:
    return F.when(text.rlike("^[0-9]+$"), text.try_cast("bigint"))


def empty_to_null(text: Column) -> Column:
    """An empty catalogue value is an absent document property."""
    return F.nullif(text, F.lit(""))
