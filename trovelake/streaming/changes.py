"""The state a stream of metadata changes leads to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trovelake.operators.metadata import KEY, plain_units


def last_changes(changes: DataFrame, order: Column | None = None) -> DataFrame:
    """The last operation on each AVU, by (ts, request_id).

    On a stream this is an aggregation in update mode with one small buffer per
    AVU. A late change is put in its place by its time; no watermark is needed
    for right results, and none drops state.
    """
    order = F.struct("ts", "request_id") if order is None else order
    return plain_units(changes).groupBy(*KEY).agg(
        F.max_by("op", order).alias("op"), F.max("ts").alias("ts"))


def present(changes: DataFrame) -> DataFrame:
    """AVUs that exist after all changes."""
    return last_changes(changes).where(F.col("op") == "add").drop("op")
