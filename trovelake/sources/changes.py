"""Changes of catalogue tables as rows, and tables with their changes merged in.

A change has the columns of its table and ``op``: ``put`` (the row as it is now),
``drop`` (only the key counts) or, for a table with a large column, ``set`` (the
row as it is now but for that column, which stays). A table is not rewritten for
a change: rows with a changed key are left out when it is read, and the new rows
are appended.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PUT, DROP, SET = "put", "drop", "set"

KEYS = {
    "collections": ("coll_id",), "replicas": ("data_id", "repl_num"),
    "avus": ("subject_type", "subject_id", "attribute", "value", "units"),
    "acls": ("subject_type", "subject_id", "owner", "owner_zone"),
    "resources": ("name", "zone"), "contents": ("data_id",), "named_queries": ("alias",),
}
# Columns that a ``set`` leaves alone.
LARGE = {"contents": ("content",)}


def key_columns(name: str, rows: DataFrame, prefix: str = "key_") -> list[Column]:
    """The key, in a form in which nulls are equal; missing and empty texts are
    the same."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return [F.coalesce(c, F.lit("") if kinds[c] == "string" else F.lit(-1)).alias(prefix + c)
            for c in KEYS[name]]


def keyed(name: str, rows: DataFrame) -> tuple[DataFrame, list[str]]:
    columns = key_columns(name, rows)
    return rows.select("*", *columns), [f"key_{c}" for c in KEYS[name]]


def change(rows: DataFrame, op: str) -> DataFrame:
    """Rows of a table, or its keys, as a change."""
    return rows.withColumn("op", F.lit(op))


def folded(name: str, steps: DataFrame) -> DataFrame:
    """One row per key of changes with a ``seq``: what they come to in order.

    A large column is not aggregated: the last put is picked by its number, and
    the column joined in from there.
    """
    large = LARGE.get(name, ())
    rows, key = keyed(name, steps)
    columns = [c for c in steps.columns if c not in ("seq", *large)]
    if not large:
        last = rows.groupBy(*key).agg(F.max_by(F.struct(*columns), "seq").alias("last"))
        return last.select("last.*")
    last = rows.groupBy(*key).agg(
        F.max_by(F.struct(*columns), "seq").alias("last"),
        F.max(F.when(F.col("op") == PUT, F.col("seq"))).alias("put_seq"),
        F.max(F.when(F.col("op") == DROP, F.col("seq"))).alias("drop_seq"))
    rewritten = F.col("put_seq") > F.coalesce("drop_seq", F.lit(-1))
    op = F.when(F.col("last.op") == DROP, DROP).when(rewritten, PUT).otherwise(SET)
    puts = rows.where(F.col("op") == PUT).select(
        *key, F.col("seq").alias("put_seq"), *large)
    facts = last.select(*key, "put_seq", *[
        F.col(f"last.{c}").alias(c) for c in columns if c != "op"], op.alias("op"))
    joined = facts.join(puts, [*key, "put_seq"], "left")
    return joined.withColumns({
        c: F.when(F.col("op") == PUT, F.col(c)) for c in large}).drop(*key, "put_seq")


def in_steps(*changes: DataFrame) -> DataFrame:
    """Changes one after the other, numbered as ``folded`` wants them."""
    numbered = [c.withColumn("seq", F.lit(n).cast("bigint")) for n, c in enumerate(changes)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), numbered)


def merged(name: str, table: DataFrame, changes: DataFrame) -> DataFrame:
    """The table after changes that hold a key once.

    The table is filtered by the keys, never shuffled on their account while they
    are few; new rows are appended.
    """
    large = LARGE.get(name, ())
    rows, key = keyed(name, table)
    news, _ = keyed(name, changes)
    whole = news.where(F.col("op") != SET) if large else news
    kept = rows.join(whole.select(*key), key, "left_anti")
    if large:
        plain = [c for c in table.columns if c in changes.columns and c not in large]
        sets = news.where(F.col("op") == SET).select(
            *key, F.struct(*plain).alias("now"))
        kept = kept.join(sets, key, "left").withColumns({
            c: F.when(F.col("now").isNotNull(), F.col(f"now.{c}")).otherwise(F.col(c))
            for c in plain})
    return kept.select(*table.columns).unionByName(
        changes.where(F.col("op") == PUT).drop("op"), allowMissingColumns=True
    ).select(*table.columns)
