"""In-band errors: a nullable struct ``error(message, code)`` on each row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Error codes that documents carry.
GENERAL = -1
FILE_DOES_NOT_EXIST = -310000
CHECKSUM_MISMATCH = -314000
INPUT_PATH = -317000
INPUT_OPTION = -318000
ALREADY_EXISTS = -809000
UNKNOWN_COLLECTION = -814000
INVALID_ARGUMENT = -816000
NOTHING_CHANGED = -819000
COLLECTION_NOT_EMPTY = -821000

ERROR_TYPE = "struct<message: string, code: int>"


class RequestError(ValueError):
    """A request given as Python values is not valid."""

    def __init__(self, message: str, code: int = INVALID_ARGUMENT):
        super().__init__(message)
        self.message, self.code = message, code


def no_error() -> Column:
    return F.lit(None).cast(ERROR_TYPE)


def error(message: Column | str, code: int) -> Column:
    text = F.lit(message) if isinstance(message, str) else message
    return F.struct(text.alias("message"), F.lit(code).cast("int").alias("code"))


def first_error(*checks: tuple[Column, Column]) -> Column:
    """Error of the first (condition, error) pair whose condition holds."""
    return F.coalesce(*[F.when(bad, err) for bad, err in checks], no_error())


def missing_path(path: Column) -> Column:
    return error(
        F.format_string("nothing can be seen at '%s'", path),
        FILE_DOES_NOT_EXIST,
    )
