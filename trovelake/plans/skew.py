"""Exact results for groups of any size, without one task per group."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trovelake.plans.settle import settled
from trovelake.session import BROADCAST_BYTES

# A group above this many rows is split over tasks.
HOT_ROWS = 1_000_000
# Entries of one nested array; a larger group continues on further pages.
PAGE_ROWS = 10_000


def is_small(stored: DataFrame) -> bool:
    """Whether a stored table is below the session's limit for broadcasts."""
    stats = stored._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes())) <= BROADCAST_BYTES


def hot_groups(rows: DataFrame, keys: list[str], limit: int) -> DataFrame:
    """Groups above ``limit`` rows with their row count.

    Counts combine before the shuffle, so a hot key is a row per task here, and
    the result has at most rows/limit entries.
    """
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("group_rows")).where(
        F.col("group_rows") > limit
    )


def with_key_in(rows: DataFrame, known: DataFrame, key: list[str],
                hot_rows: int = HOT_ROWS) -> DataFrame:
    """Rows whose key is one of ``known``. The rows of a hot key stay where they
    are: it is looked up once, and the few hot keys found are sent to the rows."""
    hot = settled(hot_groups(rows, key, hot_rows).select(*key))
    found = hot.join(known, key, "left_semi")
    normal = rows.join(F.broadcast(hot), key, "left_anti").join(known, key, "left_semi")
    return normal.unionByName(rows.join(F.broadcast(found), key, "left_semi"))


def numbered(rows: DataFrame, key: list[str], order: list[str], split: list[str],
             name: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add the 0-based position of each row within its group.

    ``order`` is a total order within a group and starts with ``split``. A
    group of normal size is one window partition. A hot group is windowed per
    split value, and shifted by the number of rows in the split values before.
    """
    assert order[: len(split)] == split
    hot = hot_groups(rows, key, hot_rows).select(*key)
    position = F.row_number().over(W.partitionBy(*key).orderBy(*order)) - 1
    normal = rows.join(hot, key, "left_anti").withColumn(name, position.cast("bigint"))

    large = rows.join(hot, key, "left_semi")
    fine = key + split
    shifts = large.groupBy(*fine).agg(F.count(F.lit(1)).alias("n"))
    offset = None
    for depth in range(len(split), 0, -1):
        upto = key + split[:depth]
        level = shifts.groupBy(*upto).agg(F.sum("n").alias("n"))
        before = W.partitionBy(*upto[:-1]).orderBy(upto[-1]).rowsBetween(
            W.unboundedPreceding, -1)
        level = level.select(*upto, F.coalesce(F.sum("n").over(before), F.lit(0))
                             .alias(f"before_{depth}"))
        offset = level if offset is None else offset.join(level, upto)
    shift = reduce(lambda a, b: a + b, [F.col(f"before_{d + 1}") for d in range(len(split))])
    inner = F.row_number().over(W.partitionBy(*fine).orderBy(*order)) - 1
    split_up = (
        large.withColumn("inner", inner)
        .join(offset.select(*fine, shift.alias("shift")), fine)
        .withColumn(name, (F.col("inner") + F.col("shift")).cast("bigint"))
    )
    return normal.unionByName(split_up.select(normal.columns))


def positioned(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Add the 0-based position of each row in the order of the whole table.

    Rows are range-partitioned and sorted once; the only table that one task
    orders holds a row per partition.
    """
    laid = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = settled(laid.withColumn("placed", F.monotonically_increasing_id()))
    part = F.shiftright("placed", 33)
    counts = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    shifts = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    inside = F.col("placed").bitwiseAND((1 << 33) - 1)
    return placed.withColumn("part", part).join(F.broadcast(shifts), "part").withColumn(
        name, F.col("shift") + inside).drop("part", "placed", "shift")


def page_counts(rows: DataFrame, key: list[str], page_rows: int = PAGE_ROWS) -> DataFrame:
    """(key, pages) of the groups that need more than one page."""
    return hot_groups(rows, key, page_rows).select(
        *key, F.ceil(F.col("group_rows") / page_rows).cast("int").alias("pages"))


def paged(rows: DataFrame, key: list[str],
          page_rows: int = PAGE_ROWS) -> tuple[DataFrame, DataFrame | None]:
    """Rows of (key, entry) with the ``page`` they are on, and (key, pages) of the
    groups with several pages, None where there is no such group.

    Page n holds the entries at positions n * page_rows and on of the group's
    sorted entries, so pages put end to end are the sorted group, however large.
    """
    rows = settled(rows.select(*key, "entry"))
    hot = settled(page_counts(rows, key, page_rows))
    if hot.isEmpty():
        return rows.withColumn("page", F.lit(0)), None
    large = rows.join(hot, key, "left_semi").withColumn("tie", F.monotonically_increasing_id())
    placed = positioned(large, [*map(F.col, key), F.col("entry"), F.col("tie")], "position")
    first = placed.groupBy(*key).agg(F.min("position").alias("first"))
    page = F.floor((F.col("position") - F.col("first")) / page_rows).cast("int")
    large = placed.join(first, key).withColumn("page", page)
    normal = rows.join(hot, key, "left_anti").withColumn("page", F.lit(0))
    return normal.unionByName(large.select(*normal.columns)), hot


def gathered(pages: DataFrame, key: list[str], name: str) -> DataFrame:
    """(key, page, name) with the sorted entries of each page."""
    return pages.groupBy(*key, "page").agg(F.sort_array(F.collect_list("entry")).alias(name))


def nested(rows: DataFrame, key: list[str], name: str, page_rows: int = PAGE_ROWS) -> DataFrame:
    """Collect the ``entry`` column per group into sorted arrays of bounded size:
    (key, page, name). No task holds a hot group and no entry is dropped."""
    return gathered(paged(rows, key, page_rows)[0], key, name)


def lagged(rows: DataFrame, key: list[str], order: str, tie: str, value: str, name: str,
           span: int = HOT_ROWS) -> DataFrame:
    """Add the value of the row before, in (order, tie) order within the key.

    ``order`` is a whole number. Each key is windowed per span of it, and the
    first row of a span looks at the last row of the span before, so a key with
    very many rows is spread over tasks.
    """
    rows = rows.withColumn("span", F.floor(F.col(order) / span))
    inner = W.partitionBy(*key, "span").orderBy(order, tie)
    inside = rows.withColumn("inside", F.lag(F.struct(F.col(value).alias("v"))).over(inner))
    ends = rows.groupBy(*key, "span").agg(
        F.max_by(value, F.struct(order, tie)).alias("last"))
    before = ends.withColumn("before", F.lag("last").over(
        W.partitionBy(*key).orderBy("span"))).drop("last")
    # keys may be null
    place = [*key, "span"]
    before = before.withColumnsRenamed({c: f"before_{c}" for c in place})
    same = [F.col(c).eqNullSafe(F.col(f"before_{c}")) for c in place]
    joined = inside.join(before, same).drop(*[f"before_{c}" for c in place])
    return joined.withColumn(
        name, F.when(F.col("inside").isNotNull(), F.col("inside.v")).otherwise(F.col("before"))
    ).drop("span", "inside", "before")


def running(rows: DataFrame, key: list[str], order: str, value: str, name: str, fold,
            span: int = HOT_ROWS) -> DataFrame:
    """Add ``fold`` (``F.max`` or ``F.sum``) of the values of the rows before, in
    order within the key; null on its first row.

    ``order`` is a whole number that is dense over the table and unique within a
    key. Each key is windowed per span of it, so a key with very many rows is spread
    over tasks. Keys are not null.
    """
    rows = rows.withColumn("span", F.floor(F.col(order) / span))
    earlier = (W.unboundedPreceding, -1)
    inside = rows.withColumn("inside", fold(value).over(
        W.partitionBy(*key, "span").orderBy(order).rowsBetween(*earlier)))
    totals = rows.groupBy(*key, "span").agg(fold(value).alias("total"))
    before = totals.withColumn("before", fold("total").over(
        W.partitionBy(*key).orderBy("span").rowsBetween(*earlier))).drop("total")
    parts = [F.col("inside"), F.col("before")]
    # one of the two may be null
    both = F.greatest(*parts) if fold is F.max else F.coalesce(
        parts[0] + parts[1], *parts)
    return inside.join(before, [*key, "span"]).withColumn(name, both).drop(
        *{"span", "inside", "before"} - {name})
