"""Listing of objects and collections, for a table of requests at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trovelake.functions import errors, paths
from trovelake.functions.errors import first_error, missing_path
from trovelake.operators.enrich import (
    PROPERTIES, SUBJECT, enriched, item_json, single_value, single_value_error,
)
from trovelake.plans.settle import settled
from trovelake.plans.skew import PAGE_ROWS, nested
from trovelake.sources.catalogue import COLLECTION, OBJECT, Catalogue
from trovelake.sources.requests import target_path

OBJECT_RANK, COLLECTION_RANK = 0, 1


def resolved(catalogue: Catalogue, asked: DataFrame) -> DataFrame:
    """Add (subject_type, subject_id, coll_path, data_name) to rows with a
    ``path``; all NULL where nothing has that path.

    The asked paths are joined to the replicas before these are made distinct,
    so only asked objects are ever shuffled when the requests are few.
    """
    names = asked.select("path").distinct().select(
        "path", paths.dir_name(F.col("path")).alias("coll_path"),
        paths.base_name(F.col("path")).alias("data_name"))
    objects = catalogue.replicas.select("data_id", "coll_path", "data_name").join(
        names, ["coll_path", "data_name"]).select(
        "path", F.lit(OBJECT).alias("subject_type"), F.col("data_id").alias("subject_id"),
        "coll_path", "data_name").distinct()
    collections = catalogue.collections.select("coll_id", "coll_path").join(
        names.select("path"), F.col("coll_path") == F.col("path")).select(
        "path", F.lit(COLLECTION).alias("subject_type"), F.col("coll_id").alias("subject_id"),
        "coll_path", F.lit(None).cast("string").alias("data_name"))
    return asked.join(objects.unionByName(collections), "path", "left")


def resolved_requests(catalogue: Catalogue, requests: DataFrame) -> DataFrame:
    """Requests with their subject; an unknown path becomes the error.

    Both the parsed requests and the result are small next to the catalogue and
    read by several branches, so each is stored: documents are parsed once and
    the catalogue is searched once.
    """
    found = resolved(catalogue, settled(requests.withColumn("path", target_path())))
    missing = F.col("error").isNull() & F.col("subject_id").isNull()
    return settled(found.withColumn("error", F.coalesce(
        "error", first_error((missing, missing_path(F.col("path")))))))


ROW = "request_row"


def stored_requests(requests: DataFrame, path: Column | None = None) -> DataFrame:
    """The requests, stored, with ``path`` and a number of their own (ids may repeat)."""
    return settled(requests.drop("document").withColumns({
        "path": target_path() if path is None else path,
        ROW: F.monotonically_increasing_id()}))


def resolved_facts(catalogue: Catalogue, stored: DataFrame) -> DataFrame:
    """What ``resolved_requests`` finds out about stored requests, without their
    documents: number, id, path, subject and error."""
    found = resolved(catalogue, stored.select(ROW, "request_id", "path", "error"))
    missing = F.col("error").isNull() & F.col("subject_id").isNull()
    return settled(found.withColumn("error", F.coalesce(
        "error", first_error((missing, missing_path(F.col("path")))))))


def with_documents(stored: DataFrame, facts: DataFrame) -> DataFrame:
    """Facts about stored requests with the other columns of these. Documents are
    large next to facts: they are stored once, and move only where they are read."""
    own = [c for c in stored.columns if c == ROW or c not in facts.columns]
    return facts.join(stored.select(*own), ROW)


def children(catalogue: Catalogue) -> DataFrame:
    """(parent_path, kind_rank, name, subject, size): objects rank before
    collections. The size of an object is the largest of its good replicas."""
    good_size = F.max(F.when(F.col("status") == "1", F.col("size")))
    objects = catalogue.replicas.groupBy("coll_path", "data_name", "data_id").agg(
        good_size.alias("size")).select(
        F.col("coll_path").alias("parent_path"), F.lit(OBJECT_RANK).alias("kind_rank"),
        F.col("data_name").alias("name"), F.lit(OBJECT).alias("subject_type"),
        F.col("data_id").alias("subject_id"), "size")
    collections = catalogue.collections.select(
        "parent_path", F.lit(COLLECTION_RANK).alias("kind_rank"), F.col("coll_path").alias("name"),
        F.lit(COLLECTION).alias("subject_type"), F.col("coll_id").alias("subject_id"),
        F.lit(None).cast("bigint").alias("size"))
    return objects.unionByName(collections)


def contents(catalogue: Catalogue, parents: DataFrame) -> DataFrame:
    """Children of the given ``parent_path`` rows, one level deep."""
    replicas = catalogue.replicas.join(
        parents.select(F.col("parent_path").alias("coll_path")).distinct(),
        "coll_path", "left_semi")
    return children(catalogue.with_tables(replicas=replicas)).join(
        parents, "parent_path")


def in_listing_order(rows: DataFrame) -> DataFrame:
    """Objects before collections, by name, within each parent. A range sort:
    a parent with very many children is spread over tasks by name."""
    return rows.orderBy("parent_path", "kind_rank", "name")


def _wants(arguments: Column, collection: bool = False) -> Column:
    """Wanted properties of a request; a collection itself has no checksum and
    no replicas to list."""
    without = ("checksum", "replicate") if collection else ()
    return F.struct(*[
        (F.lit(False) if p in without else arguments[p]).alias(p) for p in PROPERTIES])


def list_items(catalogue: Catalogue, found: DataFrame, page_rows: int = PAGE_ROWS) -> DataFrame:
    """(request_id, part, ... properties) of resolved list requests: one row
    per listed item, and with the contents flag one per child.

    An object must have one size over its good replicas if the size is asked
    for, and some good replica in any case.
    """
    ok = found.where(F.col("error").isNull())
    arguments = F.col("arguments")
    own = ok.select(
        "request_id", F.lit("item").alias("part"), "subject_type", "subject_id",
        F.col("coll_path").alias("collection"), F.col("data_name").alias("data_object"),
        F.when(F.col("subject_type") == OBJECT, _wants(arguments)).otherwise(
            _wants(arguments, collection=True)).alias("wants"),
        arguments["size"].alias("sized"))
    sizes = single_value(
        catalogue.replicas.join(
            own.where(F.col("subject_type") == OBJECT).select(
                F.col("subject_id").alias("data_id")).distinct(), "data_id", "left_semi"),
        "size").select(F.lit(OBJECT).alias("subject_type"),
                       F.col("data_id").alias("subject_id"), "n_values", "size")
    n_values = F.coalesce("n_values", F.lit(0))
    own = own.join(sizes, SUBJECT, "left").withColumn("list_error", F.when(
        (F.col("subject_type") == OBJECT) & (F.col("sized") | (n_values == 0)),
        single_value_error(n_values, "sizes")))
    own = own.withColumn("size", F.when(F.col("sized"), F.col("size"))).drop("n_values", "sized")
    inner = contents(catalogue, ok.where(
        arguments["contents"] & (F.col("subject_type") == COLLECTION)).select(
        "request_id", F.col("coll_path").alias("parent_path"), "arguments"))
    is_object = F.col("kind_rank") == OBJECT_RANK
    inner = inner.select(
        "request_id", F.lit("contents").alias("part"), "subject_type", "subject_id",
        F.when(is_object, F.col("parent_path")).otherwise(F.col("name")).alias("collection"),
        F.when(is_object, F.col("name")).alias("data_object"),
        _wants(arguments).alias("wants"),
        F.when(arguments["size"], F.col("size")).alias("size"),
        F.lit(None).cast(errors.ERROR_TYPE).alias("list_error"))
    rows = enriched(own.unionByName(inner), catalogue, page_rows)
    return rows.withColumn("item_error", F.coalesce("list_error", "item_error"))


def request_errors(rows: DataFrame) -> DataFrame:
    """The error of each request with a failed item, naming that item."""
    message = F.concat(
        paths.to_path(F.col("collection"), F.col("data_object")), F.lit(": "),
        F.col("item_error.message"))
    return rows.where(F.col("item_error").isNotNull()).groupBy("request_id").agg(
        F.min(F.struct(message.alias("message"), F.col("item_error.code").alias("code")))
        .alias("failed"))


def list_paths(catalogue: Catalogue, requests: DataFrame,
               page_rows: int = PAGE_ROWS) -> DataFrame:
    """Responses (request_id, page, single, error) of list requests."""
    found = resolved_requests(catalogue, requests)
    rows = settled(list_items(catalogue, found, page_rows))
    failed = request_errors(rows)
    inner = rows.where(F.col("part") == "contents").select("request_id", F.struct(
        F.when(F.col("data_object").isNull(), COLLECTION_RANK).otherwise(OBJECT_RANK)
        .alias("kind_rank"), "collection", "data_object", "page", item_json().alias("json"),
    ).alias("entry"))
    arrays = nested(inner, ["request_id"], "inner", page_rows)
    own = rows.where(F.col("part") == "item")
    # pages of the item itself, continued by pages of its contents
    pages = own.select("request_id", "page").unionByName(
        arrays.select("request_id", "page")).distinct()
    item = own.drop("access", "avus", "checksum", "replicates", "timestamps", "page", "size",
                    "part", "wants", "item_error", "list_error")
    parts = own.select("request_id", "page", "access", "avus", "checksum", "replicates",
                       "timestamps", "size")
    inner_json = F.try_parse_json(F.concat(
        F.lit("["), F.array_join(F.transform("inner", lambda e: e["json"]), ","), F.lit("]")))
    wants_contents = F.col("arguments.contents") & (F.col("subject_type") == COLLECTION)
    facts = found.select("request_id", "operation", "target_document", "arguments",
                         F.col("error").alias("request_error"))
    shown = (
        pages.join(item.dropDuplicates(["request_id"]), "request_id")
        .join(parts, ["request_id", "page"], "left").join(arrays, ["request_id", "page"], "left")
        .join(facts.select("request_id", "arguments"), "request_id")
        .select("request_id", "page", item_json(
            contents=F.when(wants_contents, F.coalesce(
                inner_json, F.try_parse_json(F.lit("[]"))))).alias("single"))
    )
    answered = facts.join(failed, "request_id", "left").withColumn(
        "error", F.coalesce("request_error", "failed"))
    return answered.join(shown, "request_id", "left").where(
        F.col("error").isNull() | (F.coalesce("page", F.lit(0)) == 0)).select(
        "request_id", "operation", "target_document", F.coalesce("page", F.lit(0)).alias("page"),
        F.when(F.col("error").isNull(), F.col("single")).alias("single"),
        F.lit(None).cast("string").alias("multiple"), "error")
