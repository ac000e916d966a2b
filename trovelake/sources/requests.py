"""Request documents: JSON text in, typed and validated requests out."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trovelake.functions import errors, levels, paths, times
from trovelake.functions.errors import error, first_error
from trovelake.operators.predicates import INVALID_OPERATOR, operator_of
from trovelake.plans.settle import once
from trovelake.plans.skew import positioned, running

# Property names of documents, long form first.
KEYS = {
    "operation": ("operation", "op"),
    "arguments": ("arguments", "args"),
    "target": ("target",),
    "collection": ("collection", "coll"),
    "data_object": ("data_object", "obj"),
    "directory": ("directory", "dir"),
    "file": ("file",),
    "checksum": ("checksum",),
    "avus": ("avus",),
    "attribute": ("attribute", "a"),
    "value": ("value", "v"),
    "units": ("units", "u"),
    "operator": ("operator", "o"),
    "access": ("access",),
    "owner": ("owner",),
    "zone": ("zone",),
    "level": ("level",),
    "timestamps": ("timestamps", "time"),
    "created": ("created", "c"),
    "modified": ("modified", "m"),
    "specific": ("specific",),
    "sql": ("sql", "s"),
    "sql_args": ("args", "?"),
}

# Argument names, flags first.
FLAGS = ("acl", "avu", "checksum", "collection", "contents", "force", "object", "raw", "recurse",
         "replicate", "save", "single-server", "size", "timestamp", "verify")
OPERATIONS = ("chmod", "checksum", "get", "list", "metamod", "metaquery", "put", "move", "remove",
              "mkdir", "rmdir", "supersede", "specific")
METAMOD_OPERATIONS = ("add", "rem", "remove")


# -- typed accessors over parsed JSON ----------------------------------------
#
# An object is taken apart once, into a map of its members; a member that is
# missing then costs a look into a small map, not a search of the document that
# fails.

def _members(value: Column) -> Column:
    """The members of a JSON object by name; NULL for anything else."""
    return F.try_variant_get(value, "$", "map<string, variant>")


def _member(members: Column, name: str) -> Column:
    return F.coalesce(*[F.try_element_at(members, F.lit(key)) for key in KEYS[name]])


def _is(kind: str, member: Column) -> Column:
    """Is the member a JSON value of this scalar type? False where it is missing."""
    return F.coalesce(F.schema_of_variant(member).startswith(kind), F.lit(False))


def _plain_text(member: Column) -> Column:
    return F.when(_is("STRING", member), F.try_variant_get(member, "$", "string"))


def _text(members: Column, name: str) -> Column:
    return _plain_text(_member(members, name))


def _items(member: Column) -> Column:
    """The items of a JSON array; NULL for anything else."""
    return F.try_variant_get(member, "$", "array<variant>")


def _objects(member: Column) -> Column:
    """The members of each item of an array; NULL for an item that is no object."""
    return F.transform(_items(member), _members)


def _texts(member: Column) -> Column:
    """An array of strings; NULL when any item is something else."""
    return F.when(
        F.forall(_items(member), lambda i: _is("STRING", i)),
        F.try_variant_get(member, "$", "array<string>"),
    )


def _present(members: Column, name: str) -> Column:
    member = _member(members, name)
    return member.isNotNull() & ~F.is_variant_null(member)


def _avu(members: Column) -> Column:
    return F.struct(
        _text(members, "attribute").alias("attribute"),
        _text(members, "value").alias("value"),
        _texts(_member(members, "value")).alias("values"),
        F.coalesce(_text(members, "units"), F.lit("")).alias("units"),
        operator_of(_text(members, "operator")).alias("operator"),
        members.isNotNull().alias("is_object"),
    )


def _access(members: Column) -> Column:
    return F.struct(
        _text(members, "owner").alias("owner"),
        _text(members, "zone").alias("zone"),
        _text(members, "level").alias("level"),
    )


def _timestamp(members: Column) -> Column:
    created = _present(members, "created")
    at = F.when(created, _text(members, "created")).otherwise(_text(members, "modified"))
    return F.struct(
        F.when(created, "created").when(_present(members, "modified"), "modified")
        .alias("field"),
        at.alias("text"), times.to_timestamp(at).alias("at"),
        operator_of(_text(members, "operator")).alias("operator"),
    )


def _arguments(members: Column) -> Column:
    # the few flags that are given are tested, not all there are
    given = F.map_keys(F.map_filter(members, lambda _, v: _is("BOOLEAN", v) & F.coalesce(
        F.try_variant_get(v, "$", "boolean"), F.lit(False))))
    flags = [F.coalesce(F.array_contains(given, name), F.lit(False)).alias(
        name.replace("-", "_")) for name in FLAGS]
    return F.struct(
        *flags, _text(members, "operation").alias("operation"),
        _plain_text(F.try_element_at(members, F.lit("path"))).alias("path"),
    )


def _target(members: Column, specific: Column) -> Column:
    return F.struct(
        paths.trim_slash(_text(members, "collection")).alias("collection"),
        *[_text(members, n).alias(n) for n in ("data_object", "directory", "file", "checksum")],
        F.transform(_objects(_member(members, "avus")), _avu).alias("avus"),
        F.transform(_objects(_member(members, "access")), _access).alias("access"),
        F.transform(_objects(_member(members, "timestamps")), _timestamp).alias("timestamps"),
        F.struct(
            _text(specific, "sql").alias("sql"),
            F.coalesce(_texts(_member(specific, "sql_args")), F.array().cast("array<string>"))
            .alias("args"),
        ).alias("specific"),
    )


# -- reading -------------------------------------------------------------------

def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(request_id, line, file) of the lines of text files; ids ascend with the
    file's name and the line, whatever splits Spark reads.

    Splits are numbered through one row each; lines keep their order within.
    """
    rows = spark.read.text(path).select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("place"))
    splits = rows.select("file", "start").distinct().withColumn(
        "split", F.row_number().over(W.orderBy("file", "start")) - 1)
    return rows.where(F.trim("line") != "").join(splits, ["file", "start"]).select(
        (F.col("split").cast("bigint") * (1 << 33) + F.col("place")).alias("request_id"), "line",
        "file")


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """(request_id, line) of text files with a request per line, in order."""
    return numbered_lines(spark, path).drop("file")


# A piece of a line up to the end of the next bracket that closes; texts in quotes
# are skipped, and possessive so that long ones need no stack.
_QUOTED = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"?+'
_PIECE = r'((?:[^"}\]]++|' + _QUOTED + r')*+[}\]]?+)'


def concatenated(spark: SparkSession, path: str) -> DataFrame:
    """(request_id, line) of text files with JSON documents one after the other,
    over several lines or several on one line; ids ascend in reading order.

    Lines are cut into pieces that end where a bracket closes, outside of quotes
    (which cannot contain line ends). Depths are running sums over the pieces of
    a file, whatever splits Spark reads; a closing bracket too many is text of its
    own and does not shift what follows. Text between documents becomes a line of
    its own, so that it is rejected like any other; an open document ends with its
    file.
    """
    lines = numbered_lines(spark, path)
    cut = lines.select("file", "request_id", F.posexplode(F.filter(
        F.regexp_extract_all("line", F.lit(_PIECE)), lambda p: p != "")).alias("pos", "piece"))
    bare = F.regexp_replace("piece", _QUOTED, '""')
    opens = F.length(bare) - F.length(F.translate(bare, "{[", ""))
    closes = F.when(bare.rlike(r"[}\]]$"), 1).otherwise(0)
    pieces = positioned(cut.select(
        "file", "pos", "piece", "request_id", (opens - closes).cast("bigint").alias("step"),
        (closes == 1).alias("closes"), (F.trim(bare) != "").alias("filled")),
        [F.col("request_id"), F.col("pos")], "place")
    deep = running(pieces, ["file"], "place", "step", "sum", F.sum).withColumn(
        "sum", F.coalesce("sum", F.lit(0)) + F.col("step")).withColumn("fall", -F.col("sum"))
    floored = running(deep, ["file"], "place", "fall", "fell", F.max).withColumn(
        "depth", F.col("sum") + F.greatest(F.lit(0), "fall", "fell"))
    ended = floored.withColumn("ends", F.when(
        (F.col("depth") == 0) & (F.col("closes") | F.col("filled")), 1).otherwise(0)
        .cast("bigint"))
    numbered = running(ended, ["file"], "place", "ends", "document", F.sum).withColumn(
        "document", F.coalesce("document", F.lit(0)))
    text = F.concat(F.when(F.col("pos") == 0, "\n").otherwise(""), "piece")
    whole = numbered.groupBy("file", "document").agg(
        F.min("place").alias("place"),
        F.array_sort(F.collect_list(F.struct("place", text.alias("text")))).alias("parts"))
    joined = whole.select("place", F.trim(F.regexp_replace(F.array_join(
        F.transform("parts", lambda p: p["text"]), ""), r"^\s+", "")).alias("whole"))
    # text before the first bracket is no part of the document
    before = F.regexp_extract("whole", r"^[^{\[]*+", 0)
    return joined.select("place", "whole", before.alias("before")).select(
        "place", F.posexplode(F.when(F.trim("before") == "", F.array("whole")).otherwise(F.array(
            F.trim("before"), F.expr("substr(whole, length(before) + 1)")))).alias("pos", "line")
    ).where(F.trim("line") != "").select(
        (F.col("place") * 2 + F.col("pos")).alias("request_id"), "line")


def parse_lines(lines: DataFrame) -> DataFrame:
    """(request_id, line) to (request_id, line, document); NULL where the text
    is no JSON, or has a key twice."""
    return once(lines, document=F.try_parse_json("line"))


def rejected(lines: DataFrame) -> DataFrame:
    """Lines that are no request: unparsable text is skipped, a document that
    is no object counts as an error."""
    parsed = parse_lines(lines)
    return parsed.where(_members(F.col("document")).isNull()).select(
        "request_id", "line",
        F.when(F.col("document").isNull(), "not JSON").otherwise("not an object").alias("reason"),
        F.col("document").isNotNull().alias("counts_as_error"),
    )


def spread(lines: DataFrame) -> DataFrame:
    """Spread lines over all cores: parsing costs far more than moving the
    text, and one file may be one task. The session's number of shuffle
    partitions, sized for its data, is the least."""
    spark = lines.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism,
                int(spark.conf.get("spark.sql.shuffle.partitions")))
    return lines.repartition(tasks, "request_id")


def requests(lines: DataFrame, operation: str | None = None) -> DataFrame:
    """Typed requests: (request_id, operation, arguments, target, document, error).

    With ``operation`` the lines are bare target documents of that operation.
    Without, they are envelopes {operation, arguments, target}.
    """
    parsed = once(parse_lines(spread(lines)), members=_members(F.col("document"))).where(
        "members is not null")
    envelope = F.col("members")
    typed = parsed.select(
        "request_id",
        (F.lit(operation) if operation else _text(envelope, "operation")).alias("operation"),
        F.lit(operation is None).alias("enveloped"), "document",
        _member(envelope, "arguments").alias("arguments_document"),
        (F.col("document") if operation else _member(envelope, "target"))
        .alias("target_document"),
    )
    typed = once(typed, argument_members=_members(F.col("arguments_document")),
                 target_members=_members(F.col("target_document")))
    typed = once(typed, specific_members=_members(_member(F.col("target_members"), "specific")))
    typed = once(typed, arguments=_arguments(F.col("argument_members")))
    typed = once(typed, target=_target(F.col("target_members"), F.col("specific_members")))
    return once(typed, error=validation_error()).select(
        "request_id", "operation", "enveloped", "document", "arguments", "target_document",
        "target", "error")


def from_documents(spark: SparkSession, documents: list[dict],
                   operation: str | None = None) -> DataFrame:
    """Requests of Python documents, numbered in order."""
    rows = [(i, json.dumps(d)) for i, d in enumerate(documents)]
    return requests(spark.createDataFrame(rows, "request_id long, line string"), operation)


# -- validation ------------------------------------------------------------------

def _not_text(name: str) -> tuple[Column, Column]:
    members = F.col("target_members")
    return (
        _present(members, name) & ~_is("STRING", _member(members, name)),
        error(f"'{name}' has to be a text", errors.INVALID_ARGUMENT),
    )


def _not_array(name: str) -> tuple[Column, Column]:
    members = F.col("target_members")
    return (
        _present(members, name) & _items(_member(members, name)).isNull(),
        error(f"'{name}' has to be a list", errors.INVALID_ARGUMENT),
    )


def validation_error() -> Column:
    """First thing wrong with a request, whatever the catalogue holds."""
    operation, target, arguments = F.col("operation"), F.col("target"), F.col("arguments")
    is_object = paths.represents_object(target["collection"], target["data_object"])
    is_any_path = target["collection"].isNotNull()
    searches = operation == "metaquery"
    changes_avus = operation.isin("metamod", "supersede")
    avus, access, spans = target["avus"], target["access"], target["timestamps"]
    bad_argument = errors.INVALID_ARGUMENT
    all_objects = F.coalesce(F.forall(avus, lambda a: a["is_object"]), F.lit(True))
    level_names = ", ".join(levels.LEVEL_TOKENS)
    checks = [
        (operation.isNull(), error("the request names no operation", errors.GENERAL)),
        (~operation.isin(*OPERATIONS),
         error(F.format_string("unknown operation '%s'", operation), errors.GENERAL)),
        (F.col("target_members").isNull(),
         error("the target has to be an object", bad_argument)),
        (arguments["operation"].isNotNull() & ~arguments["operation"].isin(*METAMOD_OPERATIONS),
         error(F.format_string("metadata cannot be changed by '%s'", arguments["operation"]),
               errors.GENERAL)),
        *[_not_text(n) for n in ("collection", "data_object", "directory", "file")],
        *[_not_array(n) for n in ("avus", "access", "timestamps")],
        # where the target has to name a path
        (~operation.isin("metaquery", "specific") & ~is_any_path,
         error("the target names no collection", bad_argument)),
        (is_any_path & ~paths.is_absolute(target["collection"]),
         error(F.format_string("the path '%s' does not start at the root",
                               target["collection"]), bad_argument)),
        ((operation == "checksum") & ~is_object,
         error("checksum takes data objects only", bad_argument)),
        ((operation == "remove") & ~is_object,
         error("remove takes data objects only", bad_argument)),
        ((operation == "put") & ~is_object,
         error("put takes data objects only", bad_argument)),
        ((operation == "get") & ~is_object,
         error("get takes data objects only", errors.INPUT_PATH)),
        ((operation == "mkdir") & is_object,
         error("mkdir takes collections only", bad_argument)),
        ((operation == "rmdir") & is_object,
         error("rmdir takes collections only", bad_argument)),
        ((operation == "move") & ~F.coalesce(F.length(arguments["path"]) > 0, F.lit(False)),
         error("move needs the argument path", bad_argument)),
        ((operation == "move") & ~paths.is_absolute(arguments["path"]),
         error("the argument path does not start at the root", bad_argument)),
        (operation.isin("checksum", "put") & arguments["verify"] & arguments["checksum"],
         error("verify and checksum exclude each other", errors.INPUT_OPTION)),
        # metadata
        ((searches | changes_avus) & avus.isNull(),
         error("the target lists no AVUs", bad_argument)),
        (~all_objects, error("an AVU has to be an object", bad_argument)),
        (F.exists(avus, lambda a: a["attribute"].isNull()),
         error("an AVU needs an attribute that is a text", bad_argument)),
        (searches & F.exists(avus, lambda a: a["operator"].isNull()),
         error(INVALID_OPERATOR, bad_argument)),
        (searches & F.exists(avus, lambda a: (a["operator"] == "in") & a["values"].isNull()),
         error("the operator 'in' takes a list of texts", bad_argument)),
        (searches & F.exists(avus, lambda a: (a["operator"] != "in") & a["value"].isNull()),
         error("an AVU needs a value that is a text", bad_argument)),
        (changes_avus & F.exists(avus, lambda a: a["value"].isNull()),
         error("an AVU needs a value that is a text", bad_argument)),
        (changes_avus & F.exists(avus, lambda a: a["attribute"] == ""),
         error("an attribute to change is empty", bad_argument)),
        (changes_avus & F.exists(avus, lambda a: a["value"] == ""),
         error("a value to change is empty", bad_argument)),
        ((operation == "metamod") & arguments["operation"].isNull(),
         error("metamod needs the argument operation", errors.GENERAL)),
        # permissions
        ((operation == "chmod") & access.isNull(),
         error("chmod needs a list of permissions", errors.GENERAL)),
        (searches & (F.size(access) > 1),
         error(F.format_string(
             "a search takes one permission, not %d", F.size(access)), errors.GENERAL)),
        (F.exists(access, lambda a: a["owner"].isNull() | (a["owner"] == "")),
         error("a permission names no owner", bad_argument)),
        (F.exists(access, lambda a: ~levels.is_level(a["level"])),
         error(f"unknown permission level; known are [{level_names}]", bad_argument)),
        # times
        (searches & F.exists(spans, lambda t: t["field"].isNull()),
         error("a time clause names created or modified", bad_argument)),
        (searches & F.exists(spans, lambda t: t["operator"].isNull()),
         error(INVALID_OPERATOR, bad_argument)),
        (searches & F.exists(spans, lambda t: t["operator"].isin("like", "not like", "in")),
         error("times cannot be compared with that operator", bad_argument)),
        (searches & F.exists(spans, lambda t: t["at"].isNull()),
         error("a time cannot be read", bad_argument)),
        ((operation == "specific") & target["specific"]["sql"].isNull(),
         error("a named query needs its name or text", bad_argument)),
    ]
    return first_error(*checks)


def valid(rows: DataFrame, *operations: str) -> DataFrame:
    """Valid requests of the given operations."""
    rows = rows.where(F.col("error").isNull())
    return rows.where(F.col("operation").isin(*operations)) if operations else rows


def target_path() -> Column:
    target = F.col("target")
    return paths.to_path(target["collection"], target["data_object"])


def parts_present() -> dict[str, Column]:
    """Which parts the target of a request has."""
    target = F.col("target")
    spans = F.coalesce(target["timestamps"], F.array())
    return {
        "has_collection": target["collection"].isNotNull(),
        "has_acl": target["access"].isNotNull(),
        "has_timestamps": target["timestamps"].isNotNull(),
        "has_created": F.exists(spans, lambda t: F.coalesce(t["field"] == "created", F.lit(False))),
        "has_modified": F.exists(spans, lambda t: F.coalesce(
            t["field"] == "modified", F.lit(False)))}


def run_totals(responses: DataFrame) -> DataFrame:
    """Items and errors of a run, one row; a response on several pages is one
    item."""
    first = F.col("page") == 0 if "page" in responses.columns else F.lit(True)
    return responses.agg(
        F.count_if(first).alias("items"),
        F.count_if(first & F.col("error").isNotNull()).alias("errors"))


def echoed(rows: DataFrame) -> DataFrame:
    """Responses of a change: the target comes back, or the error with it."""
    return rows.select(
        "request_id", "operation", "target_document", F.lit(0).alias("page"),
        F.when(F.col("error").isNull(), F.to_json("target_document")).alias("single"),
        F.lit(None).cast("string").alias("multiple"), "error",
    )
