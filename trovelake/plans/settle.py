"""Cut lineage with a table written to the cluster's shared folder."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trovelake.session import shared_folder

# Folders written within each scope that is open, innermost last.
_scopes: list[list[str]] = []

# The lowest level: about a third less than without, at hardly any time.
_PACKED = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1"}

# Whether Spark deletes the shuffle files of an execution when it has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock = threading.Lock()
_tidy: dict[str, str | int] = {"open": 0, "before": "false"}


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Actions inside leave no shuffle files behind. Otherwise these stay until the
    driver happens to collect its garbage, those of all steps of a query together.

    Only for plans that are carried out once: a plan that is carried out again
    would have to make its shuffles again. So the caller's setting comes back.
    """
    with _lock:
        if not _tidy["open"]:
            _tidy["before"] = spark.conf.get(_CLEANUP, "false")
            spark.conf.set(_CLEANUP, "true")
        _tidy["open"] += 1
    try:
        yield
    finally:
        with _lock:
            _tidy["open"] -= 1
            if not _tidy["open"]:
                spark.conf.set(_CLEANUP, _tidy["before"])


def is_empty(df: DataFrame) -> bool:
    with tidy(df.sparkSession):
        return df.isEmpty()


def settled(df: DataFrame) -> DataFrame:
    """Write a table once and read it back.

    For a table that several branches of a plan read: it is computed once, its
    size is known exactly where a join strategy depends on it, and a lost
    executor costs a re-read, not a recomputation.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/settled-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    with tidy(spark):
        df.write.options(**_PACKED).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete_folders(spark: SparkSession, folders: list[str]) -> None:
    """Delete folders of any file system that the cluster knows."""
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def settling(spark: SparkSession) -> Iterator[None]:
    """Delete the tables settled inside when it ends, for work whose results have
    been written elsewhere by then, like a micro-batch."""
    _scopes.append([])
    try:
        yield
    finally:
        delete_folders(spark, _scopes.pop())


def once(rows: DataFrame, **columns: Column) -> DataFrame:
    """Add costly columns so that each is computed once per row.

    A plain projection is merged into those above it, and filters are pushed
    below it, so that a parsed document would be parsed again for every use. A
    generator of one value is not. The column is computed below the generator,
    which would interpret functions of arrays and maps with all around them. It
    stands first: a generator knows what it need not pass on by its place, and the
    optimizer puts the fields that are read further up behind, in place of a struct.
    """
    for name, column in columns.items():
        made = f"{name} made once"
        rows = rows.select(column.alias(made), "*").select(
            "*", F.explode(F.array(F.col(f"`{made}`"))).alias(name)).drop(made)
    return rows
