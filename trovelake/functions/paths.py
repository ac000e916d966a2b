"""Catalogue and local path functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_absolute(path: Column) -> Column:
    return F.coalesce(path.startswith("/"), F.lit(False))


def zone_name(path: Column) -> Column:
    """First component of an absolute path; NULL for a relative one."""
    return F.when(is_absolute(path), F.split_part(path, F.lit("/"), F.lit(2)))


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def dir_name(path: Column) -> Column:
    """Path without its last component; '/' for a child of the root."""
    return F.when(
        path.contains("/"),
        F.regexp_replace(F.regexp_replace(path, "/[^/]*$", ""), "^$", "/"),
    )


def trim_slash(path: Column) -> Column:
    """Drop one trailing slash, but keep the root itself."""
    return F.regexp_replace(path, "(.)/$", "$1")


def collection_path(collection: Column) -> Column:
    return trim_slash(collection)


def to_path(collection: Column, data_object: Column) -> Column:
    """Path of a collection, or of an object within a collection."""
    return F.when(data_object.isNull(), trim_slash(collection)).otherwise(
        F.concat(F.regexp_replace(collection, "/$", ""), F.lit("/"), data_object)
    )


def local_path(directory: Column, file: Column, data_object: Column) -> Column:
    """Local path of a document: own name first, object name next, '.' last."""
    folder = F.regexp_replace(F.coalesce(directory, F.lit(".")), "(.)/$", "$1")
    leaf = F.coalesce(file, data_object)
    joined = F.concat(F.regexp_replace(folder, "/$", ""), F.lit("/"), leaf)
    return F.when(leaf.isNotNull(), joined).otherwise(folder)


def represents_collection(collection: Column, data_object: Column) -> Column:
    return collection.isNotNull() & data_object.isNull()


def represents_object(collection: Column, data_object: Column) -> Column:
    return collection.isNotNull() & data_object.isNotNull()


def represents_directory(directory: Column, file: Column) -> Column:
    return directory.isNotNull() & file.isNull()


def represents_file(directory: Column, file: Column) -> Column:
    return directory.isNotNull() & file.isNotNull()


def ancestors(path: Column) -> Column:
    """The path and every collection above it: /a/b -> [/a, /a/b].

    Paths are a handful of components deep, so exploding this array turns a
    subtree condition into an equality join.
    """
    parts = F.split(F.substr(path, F.lit(2)), "/")
    upto = F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda n: F.concat(F.lit("/"), F.array_join(F.slice(parts, 1, n), "/")),
    )
    return F.when(is_absolute(path) & (F.length(path) > 1), upto).otherwise(F.array(path))


def is_zone_hint(path: Column) -> Column:
    """'/zone' alone names a zone, not a place to search under."""
    return path.rlike("^/[^/]+$")


def under(path: Column, root: Column, scope: str = "prefix") -> Column:
    """Is the path in scope of a search root?

    ``prefix``: raw SQL prefix, wildcards in the root stay live and the prefix
    may end inside a name. ``subtree``: the root itself and what lies below it.
    """
    if scope == "prefix":
        # a backslash in a path stands for itself
        plain = F.regexp_replace(root, r"\\", r"\\\\")
        return F.like(path, F.concat(plain, F.lit("%")))
    if scope == "subtree":
        return (path == root) | path.startswith(F.concat(root, F.lit("/")))
    raise ValueError(f"unknown path scope '{scope}'")


def rebase(path: Column, old_root: Column, new_root: Column) -> Column:
    """Replace the leading ``old_root`` of a path."""
    return F.concat(new_root, F.substr(path, F.length(old_root) + 1))


def owner_spec(owner: Column, zone: Column) -> Column:
    """``owner#zone``, or the plain owner where no zone is known."""
    return F.concat_ws("#", owner, zone)


def owner_of(spec: Column) -> Column:
    return F.split_part(spec, F.lit("#"), F.lit(1))


def owner_zone_of(spec: Column, local_zone: Column) -> Column:
    return F.coalesce(F.nullif(F.split_part(spec, F.lit("#"), F.lit(2)), F.lit("")), local_zone)


def hierarchy_leaf(hierarchy: Column) -> Column:
    """Last resource of a ';' separated resource hierarchy."""
    return F.substring_index(hierarchy, ";", -1)
