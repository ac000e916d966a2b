"""Shaping of catalogue rows into document properties."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trovelake.functions import paths, text, times

# Replica status as the catalogue holds it.
STALE, GOOD = "0", "1"


def replica_valid(status: Column) -> Column:
    """Status text to boolean; NULL for anything but the two known values."""
    return F.when(status == GOOD, True).when(status == STALE, False)


def replicate(number: Column, status: Column, checksum: Column,
              resource: Column, location: Column) -> Column:
    return F.struct(
        checksum.alias("checksum"), location.alias("location"),
        number.try_cast("int").alias("number"), resource.alias("resource"),
        replica_valid(status).alias("valid"),
    )


def timestamp_entries(created: Column, modified: Column, number: Column) -> Column:
    """The created and the modified entry of one replica."""
    def entry(is_created: bool) -> Column:
        absent = F.lit(None).cast("string")
        return F.struct(
            (times.time_text(created) if is_created else absent).alias("created"),
            (absent if is_created else times.time_text(modified)).alias("modified"),
            number.cast("int").alias("replicates"),
        )

    return F.array(entry(True), entry(False))


def avu(attribute: Column, value: Column, units: Column) -> Column:
    return F.struct(
        attribute.alias("attribute"), text.empty_to_null(units).alias("units"),
        value.alias("value"),
    )


def access_entry(owner: Column, zone: Column, level: Column) -> Column:
    return F.struct(level.alias("level"), owner.alias("owner"), zone.alias("zone"))


def path_document(path: Column, is_object: Column) -> Column:
    """{collection} or {collection, data_object} of a path."""
    return F.struct(
        F.when(is_object, paths.dir_name(path)).otherwise(paths.trim_slash(path))
        .alias("collection"),
        F.when(is_object, paths.base_name(path)).alias("data_object"),
    )


def json_text(*fields: Column) -> Column:
    """One JSON text of named columns; NULL properties are left out.

    The caller gives the columns in key order, as documents have sorted keys.
    """
    return F.to_json(F.struct(*fields))


def avus_from_lists(attributes: Column, values: Column, units: Column,
                    operators: Column) -> Column:
    """Parallel option lists to an array of AVU documents."""
    return F.transform(
        F.arrays_zip(attributes.alias("a"), values.alias("v"), units.alias("u"),
                     operators.alias("o")),
        lambda z: F.struct(
            z["a"].alias("attribute"), z["v"].alias("value"),
            z["u"].alias("units"), z["o"].alias("operator"),
        ),
    )
