"""Properties of listed and found items: metadata, permissions, checksum,
timestamps and replicas.

Every property comes in two forms: rows (one per AVU, ACL entry, replica ...),
which is what large results are joined and counted in, and arrays on document
pages, which is how documents are written out.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trovelake.functions import documents as doc
from trovelake.functions import errors, levels, paths
from trovelake.functions.errors import error, first_error
from trovelake.plans.settle import settled
from trovelake.plans.skew import PAGE_ROWS, gathered, paged
from trovelake.sources.catalogue import COLLECTION, OBJECT, Catalogue

SUBJECT = ["subject_type", "subject_id"]
PROPERTIES = ("acl", "avu", "checksum", "timestamp", "replicate")
# Types of the properties, for those that nothing is planned for.
EMPTY = {
    "access": "array<struct<level: string, owner: string, zone: string>>",
    "avus": "array<struct<attribute: string, units: string, value: string>>",
    "checksum": "variant",
    "replicates": "array<struct<checksum: variant, location: string, number: int, "
                  "resource: string, valid: boolean>>",
    "timestamps": "array<struct<created: string, modified: string, replicates: int>>",
}


# -- one row per child ---------------------------------------------------------

def avu_rows(catalogue: Catalogue) -> DataFrame:
    return catalogue.of_subjects("avus").select(
        *SUBJECT, "attribute", "value", F.nullif("units", F.lit("")).alias("units"))


def acl_rows(catalogue: Catalogue) -> DataFrame:
    return catalogue.of_subjects("acls").select(
        *SUBJECT, "owner", "owner_zone", levels.level_word(F.col("level")).alias("level"))


def _of_objects(rows: DataFrame) -> DataFrame:
    return rows.withColumn("subject_type", F.lit(OBJECT)).withColumnRenamed(
        "data_id", "subject_id")


def timestamp_rows(catalogue: Catalogue) -> DataFrame:
    return _of_objects(catalogue.of_subjects("replicas").select(
        "data_id", "repl_num", "created", "modified"))


def located_resources(resources: DataFrame) -> DataFrame:
    """One row per resource name and zone, with the number of rows behind it."""
    return resources.groupBy(F.col("name").alias("resource"), "zone").agg(
        F.count(F.lit(1)).alias("n_found"), F.max("location").alias("location"))


def replicate_rows(catalogue: Catalogue, replicas: DataFrame | None = None) -> DataFrame:
    """Replicas with the location of their resource, the leaf of the hierarchy
    in the zone of the path. Exactly one such resource must exist."""
    replicas = catalogue.of_subjects("replicas") if replicas is None else replicas
    rows = replicas.select(
        "data_id", "coll_path", "repl_num", "status", "checksum",
        paths.hierarchy_leaf(F.col("resc_hier")).alias("resource"),
        paths.zone_name(F.col("coll_path")).alias("zone"),
    ).join(located_resources(catalogue.resources), ["resource", "zone"],
           "left")
    n_found = F.coalesce("n_found", F.lit(0))
    return _of_objects(rows.select(
        "data_id", "repl_num", "status", "checksum", "resource", "location",
        doc.replica_valid(F.col("status")).alias("valid"),
        first_error(
            (n_found != 1, error(F.format_string("Expected 1 resource result but found %d",
                                                 n_found), errors.GENERAL)),
            (~F.coalesce(F.col("status").isin(doc.STALE, doc.GOOD), F.lit(False)),
             error(F.format_string("unknown replica status '%s'", F.col("status")),
                   errors.INVALID_ARGUMENT)),
        ).alias("error"),
    ))


def single_value(replicas: DataFrame, column: str) -> DataFrame:
    """(data_id, n_values, column) over good replicas; NULL is a value too.

    Values are made distinct first, so each side of the count combines early.
    """
    good = replicas.where(F.col("status") == doc.GOOD)
    return good.select("data_id", column).distinct().groupBy("data_id").agg(
        F.count(F.lit(1)).alias("n_values"), F.max(column).alias(column))


def single_value_error(n_values: Column, what: str) -> Column:
    n_values = F.coalesce(n_values, F.lit(0))
    return first_error((n_values != 1, error(F.format_string(
        "Expected 1 data object result but found %d. This occurs when the object replicates "
        f"have different {what} in the catalogue.", n_values), errors.GENERAL)))


def checksum_rows(replicas: DataFrame) -> DataFrame:
    """(subject, checksum, error) of objects with a good replica."""
    conflict = single_value_error(F.col("n_values"), "checksum values")
    return _of_objects(single_value(replicas, "checksum").select(
        "data_id", F.when(F.col("n_values") == 1, F.col("checksum")).alias("checksum"),
        conflict.alias("error")))


def with_rows(items: DataFrame, rows: DataFrame) -> DataFrame:
    """Items with their child rows; an item without any stays, with NULLs."""
    return items.join(rows, SUBJECT, "left")


# -- documents -------------------------------------------------------------------

def _entries(catalogue: Catalogue, name: str) -> tuple[DataFrame, Callable[[Column], Column]]:
    """Child rows with a sortable ``entry``, and the shape of one entry."""
    if name == "avu":
        rows = avu_rows(catalogue)
        return rows.select(*SUBJECT, F.struct("attribute", "value", "units").alias("entry")), (
            lambda e: doc.avu(e["attribute"], e["value"], e["units"]))
    if name == "acl":
        rows = acl_rows(catalogue)
        return rows.select(*SUBJECT, F.struct("owner", "owner_zone", "level").alias("entry")), (
            lambda e: doc.access_entry(e["owner"], e["owner_zone"], e["level"]))
    if name == "timestamp":
        rows = timestamp_rows(catalogue)
        return rows.select(
            *SUBJECT, F.struct("repl_num", "created", "modified").alias("entry")), (
            lambda e: doc.timestamp_entries(e["created"], e["modified"], e["repl_num"]))
    rows = replicate_rows(catalogue)
    return rows.select(*SUBJECT, F.struct(
        "repl_num", "status", "checksum", "resource", "location", "error").alias("entry")), (
        lambda e: e)


def _checksum_json(checksum: Column) -> Column:
    """A missing checksum is a JSON null in a document, not an absent key."""
    text = F.get_json_object(F.to_json(F.struct(F.array(checksum).alias("c"))), "$.c")
    return F.try_parse_json(F.coalesce(F.substr(text, F.lit(2), F.length(text) - 2), F.lit("null")))


def _replicate(entry: Column) -> Column:
    plain = doc.replicate(entry["repl_num"], entry["status"], entry["checksum"],
                          entry["resource"], entry["location"])
    return F.struct(
        _checksum_json(entry["checksum"]).alias("checksum"),
        *[plain[n].alias(n) for n in ("location", "number", "resource", "valid")])


def wants(**flags: bool) -> Column:
    """Wanted properties as a struct, for items that all want the same."""
    return F.struct(*[F.lit(bool(flags.get(p))).alias(p) for p in PROPERTIES])


def enriched(items: DataFrame, catalogue: Catalogue, page_rows: int = PAGE_ROWS) -> DataFrame:
    """Add the wanted properties to items.

    ``items`` has the subject columns and ``wants``. The result has ``page``
    and one column per property. An item whose children fit on one page is one
    row; others continue on further rows, each with the next part of the array.
    Only properties that some item wants are looked up.
    """
    items = settled(items)
    # five flags: a property that no item wants is not planned
    any_wants = items.agg(*[F.bool_or(f"wants.{p}").alias(p) for p in PROPERTIES]).first()
    planned = [p for p in PROPERTIES if any_wants[p]]
    found, shapes, more = items.withColumn("page", F.lit(0)), {}, []
    for name in planned:
        if name == "checksum":
            continue
        asked = items.where(F.col(f"wants.{name}")).select(*SUBJECT).distinct()
        rows, shapes[name] = _entries(catalogue, name)
        pages, hot = paged(rows.join(asked, SUBJECT, "left_semi"), SUBJECT, page_rows)
        shapes[name] = (gathered(pages, SUBJECT, f"{name}_entries"), shapes[name])
        more += [] if hot is None else [hot]
    if more:
        most = reduce(DataFrame.unionByName, more).groupBy(*SUBJECT).agg(
            F.max("pages").alias("pages"))
        found = items.join(most, SUBJECT, "left").withColumn("page", F.explode(F.sequence(
            F.lit(0), F.coalesce("pages", F.lit(1)) - 1))).drop("pages")
    for rows, _ in shapes.values():
        found = found.join(rows, [*SUBJECT, "page"], "left")
    if "checksum" in planned:
        asked = items.where(F.col("wants.checksum") & (F.col("subject_type") == OBJECT)).select(
            F.col("subject_id").alias("data_id")).distinct()
        sums = checksum_rows(catalogue.of_subjects("replicas").join(
            asked, "data_id", "left_semi"))
        found = found.join(sums.withColumn("has_sum", F.lit(True)).withColumnRenamed(
            "error", "sum_error"), SUBJECT, "left")

    is_object = F.col("subject_type") == OBJECT

    def entries(name: str) -> Column:
        return F.transform(F.coalesce(f"{name}_entries", F.array()), shapes[name][1])

    def listed(name: str, when: Column | None = None) -> Column:
        wanted = F.col(f"wants.{name}")
        return F.when(wanted if when is None else wanted & when, entries(name))

    columns = {name: F.lit(None).cast(kind) for name, kind in EMPTY.items()}
    failed = []
    if "acl" in planned:
        columns["access"] = listed("acl")
    if "avu" in planned:
        columns["avus"] = listed("avu")
    if "checksum" in planned:
        wanted = F.col("wants.checksum") & is_object
        columns["checksum"] = F.when(wanted, _checksum_json(F.col("checksum")))
        failed.append(F.when(wanted, F.when(F.col("has_sum"), F.col("sum_error")).otherwise(
            single_value_error(F.lit(0), "checksum values"))))
    if "replicate" in planned:
        columns["replicates"] = F.when(F.col("wants.replicate") & is_object, F.transform(
            F.coalesce("replicate_entries", F.array()), _replicate))
        replica_errors = F.filter(F.transform("replicate_entries", lambda e: e["error"]),
                                  lambda e: e.isNotNull())
        failed.append(F.try_element_at(replica_errors, F.lit(1)))
    if "timestamp" in planned:
        times = F.flatten(entries("timestamp"))
        columns["timestamps"] = F.when(F.col("wants.timestamp"), F.when(
            F.col("subject_type") == COLLECTION, F.slice(times, 1, 0)).otherwise(times))
    item_error = F.coalesce(*failed) if failed else F.lit(None).cast(errors.ERROR_TYPE)
    return found.select(*items.columns, "page", *[c.alias(n) for n, c in columns.items()],
                        item_error.alias("item_error"))


def item_json(**extra: Column) -> Column:
    """The document of one enriched item; keys in sorted order."""
    fields = {
        "access": F.col("access"), "avus": F.col("avus"), "checksum": F.col("checksum"),
        "collection": F.col("collection"), "data_object": F.col("data_object"),
        "replicates": F.col("replicates"), "size": F.col("size"),
        "timestamps": F.col("timestamps"), **extra,
    }
    return doc.json_text(*[fields[k].alias(k) for k in sorted(fields)])
