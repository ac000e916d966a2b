"""Metadata search: one request given as Python values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trovelake.functions import levels
from trovelake.functions.errors import GENERAL, RequestError
from trovelake.operators.predicates import Clause, TimeClause, in_scope, where_owner
from trovelake.sources.catalogue import COLLECTION, OBJECT, Catalogue

KIND_OBJECT, KIND_COLLECTION = "object", "collection"


def matching_subjects(avus: DataFrame, subject_type: str, clauses: list[Clause]) -> DataFrame:
    """Ids of subjects that meet every clause, each with some AVU of theirs.

    One clause is a filter. Several are one aggregation with a flag per clause;
    flags combine before the shuffle, so a hot subject is one row per task.
    """
    avus = avus.where(F.col("subject_type") == subject_type)
    conditions = [clause.condition() for clause in clauses]
    if len(conditions) == 1:
        return avus.where(conditions[0]).select("subject_id").distinct()
    flags = [F.bool_or(c).alias(f"met_{i}") for i, c in enumerate(conditions)]
    return (
        avus.where(reduce(lambda a, b: a | b, conditions))
        .groupBy("subject_id").agg(*flags)
        .where(reduce(lambda a, b: a & b, [F.col(f"met_{i}") for i in range(len(flags))]))
        .select("subject_id")
    )


def _only(rows: DataFrame, id_column: str, ids: DataFrame) -> DataFrame:
    return rows.join(ids, F.col(id_column) == F.col("subject_id"), "left_semi")


def search(
    catalogue: Catalogue,
    avus: list[dict] | None,
    access: list[dict] | None = None,
    timestamps: list[dict] = (),
    collection: str | None = None,
    zone: str | None = None,
    objects: bool = True,
    collections: bool = True,
    size: bool = False,
    scope: str = "prefix",
    ids: bool = False,
) -> DataFrame:
    """(kind, collection, data_object[, size]) of everything that matches;
    with ``ids`` also (subject_type, subject_id), to add properties by.

    An empty ``avus`` list matches everything in scope; a missing one is an
    error. With ``size`` only good replicas count, and an object whose good
    replicas differ in size gives a row per size.
    """
    if avus is None:
        raise RequestError("the target lists no AVUs")
    clauses = [Clause.of(avu) for avu in avus]
    spans = [TimeClause.of(t).condition() for t in timestamps]
    if access is not None and len(access) > 1:
        raise RequestError(
            f"a search takes one permission, not {len(access)}", GENERAL)
    for entry in access or []:
        if str(entry.get("level")).lower() not in levels.LEVEL_TOKENS:
            raise RequestError("unknown permission level; known are ["
                               + ", ".join(levels.LEVEL_TOKENS) + "]")

    def restricted(rows: DataFrame, subject_type: str, id_column: str) -> DataFrame:
        rows = in_scope(rows, collection, zone, scope)
        for span in spans:
            rows = rows.where(span)
        if clauses:
            rows = _only(rows, id_column,
                         matching_subjects(catalogue.avus, subject_type, clauses))
        for entry in access or []:
            allowed = where_owner(catalogue.acls, entry["owner"], entry["level"]).where(
                F.col("subject_type") == subject_type)
            rows = _only(rows, id_column, allowed.select("subject_id").distinct())
        return rows

    def subject(subject_type: str, id_column: str) -> list:
        return [F.lit(subject_type).alias("subject_type"),
                F.col(id_column).alias("subject_id")] if ids else []

    sized = [F.col("size")] if size else []
    found = []
    if collections:
        rows = restricted(catalogue.collections, COLLECTION, "coll_id")
        unsized = [F.lit(None).cast("bigint").alias("size")] if size else []
        found.append(rows.select(
            F.lit(KIND_COLLECTION).alias("kind"), F.col("coll_path").alias("collection"),
            F.lit(None).cast("string").alias("data_object"), *unsized,
            *subject(COLLECTION, "coll_id")).distinct())
    if objects:
        rows = catalogue.good_replicas() if size else catalogue.replicas
        rows = restricted(rows, OBJECT, "data_id")
        found.append(rows.select(
            F.lit(KIND_OBJECT).alias("kind"), F.col("coll_path").alias("collection"),
            F.col("data_name").alias("data_object"), *sized,
            *subject(OBJECT, "data_id")).distinct())
    if not found:
        return catalogue.spark.createDataFrame(
            [], "kind string, collection string, data_object string")
    return reduce(DataFrame.unionByName, found)
