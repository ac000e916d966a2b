"""Content operations: checksum, get, put."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trovelake.functions import documents as doc
from trovelake.functions import errors, text
from trovelake.functions.errors import error, first_error
from trovelake.operators.enrich import item_json
from trovelake.operators.listing import list_items, request_errors, resolved_requests
from trovelake.plans.settle import settled
from trovelake.plans.skew import is_small
from trovelake.sources.catalogue import OBJECT, Catalogue
from trovelake.sources.changes import DROP, PUT, SET, change
from trovelake.sources.contents import default_local_path
from trovelake.sources.requests import echoed, target_path


PLACE = ["coll_path", "data_name"]


# -- checksums -----------------------------------------------------------------

def calculated(contents: DataFrame, force: Column | bool = False) -> DataFrame:
    """Content rows with their checksum filled in; ``force`` computes it anew.
    Content is only read for rows that need it."""
    force = F.lit(force) if isinstance(force, bool) else force
    return contents.withColumn("checksum", F.when(
        force | F.col("checksum").isNull(), text.content_md5(F.col("content")))
        .otherwise(F.col("checksum")))


def verified(contents: DataFrame) -> DataFrame:
    """Content rows with ``checksum_ok``; NULL where no checksum is recorded."""
    return contents.withColumn(
        "checksum_ok", text.equals_ignore_case(text.content_md5(F.col("content")),
                                               F.col("checksum")))


def facts_of(rows: DataFrame, asked: DataFrame, key: str, **facts: Column) -> DataFrame:
    """(key, facts) of the rows with an asked key, computed where content is read.

    Few asked keys choose the rows there; many are joined to the facts of all
    rows. Either way no exchange carries content.
    """
    asked = settled(asked.select(key).distinct())
    columns = [column.alias(name) for name, column in facts.items()]
    if is_small(asked):
        return rows.join(F.broadcast(asked), key, "left_semi").select(key, *columns)
    return rows.select(key, *columns).join(asked, key)


def _asked_objects(found: DataFrame) -> DataFrame:
    return found.where(F.col("error").isNull() & (F.col("subject_type") == OBJECT)).select(
        F.col("subject_id").alias("data_id"))


def checksum(catalogue: Catalogue, requests: DataFrame) -> tuple[Catalogue, DataFrame]:
    """Calculate (the default) or verify checksums of whole objects.

    Calculation keeps a recorded sum unless forced, and records the sum on all
    replicas. Only content whose sum is needed is read. The response is the target
    with its ``checksum``.
    """
    found = resolved_requests(catalogue, requests)
    verify = F.col("arguments.verify")
    flags = found.where("error is null").groupBy(F.col("subject_id").alias("data_id")).agg(
        F.bool_or(verify).alias("verify"), F.bool_or(~verify).alias("calculate"),
        F.bool_or(F.col("arguments.force") & ~verify).alias("force"))
    known = settled(catalogue.contents.select(
        "data_id", F.col("checksum").alias("recorded")).join(flags, "data_id"))
    needed = known.where(F.col("verify") | F.col("force") | F.col("recorded").isNull())
    sums = settled(known.join(
        facts_of(catalogue.contents, needed, "data_id", md5=text.content_md5(F.col("content"))),
        "data_id", "left"))
    new = F.when(F.col("force") | F.col("recorded").isNull(), F.col("md5")).otherwise(
        F.col("recorded"))
    recorded = sums.where("calculate").select(
        "data_id", F.col("force").alias("forced"), new.alias("new_checksum"))

    def with_sums(table: DataFrame) -> DataFrame:
        """Rows of the table that get another sum."""
        now = F.when(F.col("forced") | F.col("checksum").isNull(), F.coalesce(
            "new_checksum", "checksum")).otherwise(F.col("checksum"))
        return table.join(recorded, "data_id").withColumn("was", F.col("checksum")).withColumn(
            "checksum", now).where(~F.col("was").eqNullSafe(F.col("checksum"))).select(
            *table.columns)

    result = found.join(sums.select(
        F.col("data_id").alias("subject_id"), "md5", "recorded"), "subject_id", "left")
    kept = F.col("recorded").isNotNull() & ~F.col("arguments.force") & ~verify
    answered = result.withColumn("error", F.coalesce("error", first_error(
        (~kept & F.col("md5").isNull(), error(F.format_string(
            "'%s' has no content to sum", "path"), errors.INPUT_PATH)),
        (verify & ~F.coalesce(text.equals_ignore_case(F.col("md5"), F.col("recorded")),
                              F.lit(False)),
         error(F.format_string("the content of '%s' does not have the recorded sum %s but %s",
                               "path", F.coalesce("recorded", F.lit("none")), "md5"),
               errors.CHECKSUM_MISMATCH)))))
    shown = F.when(verify | kept, F.col("recorded")).otherwise(F.col("md5"))
    single = doc.json_text(
        shown.alias("checksum"), F.col("target.collection").alias("collection"),
        F.col("target.data_object").alias("data_object"))
    responses = answered.select(
        "request_id", "operation", "target_document", F.lit(0).alias("page"),
        F.when(F.col("error").isNull(), single).alias("single"),
        F.lit(None).cast("string").alias("multiple"), "error")
    return catalogue.changed(
        replicas=change(with_sums(catalogue.replicas), PUT),
        contents=change(with_sums(catalogue.contents.drop("content")), SET)), responses


# -- get ---------------------------------------------------------------------------

def judged(catalogue: Catalogue, requests: DataFrame) -> DataFrame:
    """Get requests with local path, ``recorded``, ``checksum_ok`` and error.

    A checksum that differs is reported in its column; it is no error.
    """
    found = resolved_requests(catalogue, requests)
    facts = facts_of(
        catalogue.contents, _asked_objects(found), "data_id", recorded=F.col("checksum"),
        checksum_ok=text.equals_ignore_case(text.content_md5(F.col("content")), F.col("checksum")),
        is_utf8=text.maybe_utf8(F.col("content"))).withColumnRenamed("data_id", "subject_id")
    keep_raw = F.col("arguments.save") | F.col("arguments.raw")
    return found.join(facts, "subject_id", "left").withColumns({
        "local_path": default_local_path(F.col("target")),
        "error": F.coalesce("error", first_error(
            (F.col("subject_type") != OBJECT, error(F.format_string(
                "get takes data objects only: '%s'", "path"),
                errors.INPUT_PATH)),
            (~keep_raw & ~F.coalesce("is_utf8", F.lit(True)),
             error(F.format_string(
                 "the content of '%s' is no UTF-8 text", "path"),
                 errors.INPUT_PATH)))),
    }).drop("is_utf8")


def fetched(catalogue: Catalogue, requests: DataFrame) -> DataFrame:
    """Judged get requests with their content, which is joined in last."""
    rows = settled(judged(catalogue, requests))
    wanted = rows.where("error is null")
    content = catalogue.contents.select(F.col("data_id").alias("subject_id"), "content").join(
        wanted.select("subject_id").distinct(), "subject_id", "left_semi")
    return wanted.join(content, "subject_id", "left").unionByName(
        rows.where("error is not null"), allowMissingColumns=True)


def get(catalogue: Catalogue, requests: DataFrame) -> DataFrame:
    """Responses of get requests: the listing of the object, with its text."""
    found = settled(judged(catalogue, requests).withColumns({
        "coll_path": F.col("target.collection"), "data_name": F.col("target.data_object")}))
    rows = settled(list_items(catalogue, found))
    # content is joined last, so that it is never written to a table on the way
    texts = catalogue.contents.select(
        F.col("data_id").alias("subject_id"), text.to_utf8(F.col("content")).alias("data")
    ).join(rows.select("subject_id").distinct(), "subject_id", "left_semi")
    saved = found.select("request_id", F.col("arguments.save").alias("saved"))
    shown = rows.join(texts, "subject_id", "left").join(
        saved, "request_id").withColumn(
        "data", F.when(~F.col("saved") & (F.col("page") == 0), F.col("data")))
    shown = shown.select("request_id", "page", item_json(data=F.col("data")).alias("single"))
    facts = found.join(request_errors(rows), "request_id", "left").select(
        "request_id", "operation", "target_document",
        F.coalesce("error", "failed").alias("error"))
    page = F.coalesce("page", F.lit(0))
    return facts.join(shown, "request_id", "left").where(
        F.col("error").isNull() | (page == 0)).select(
        "request_id", "operation", "target_document", page.alias("page"),
        F.when(F.col("error").isNull(), F.col("single")).alias("single"),
        F.lit(None).cast("string").alias("multiple"), "error")


# -- put -----------------------------------------------------------------------------

def uploads(requests: DataFrame, files: DataFrame) -> DataFrame:
    """Put requests with size and sum of their local file, checked.

    ``verify`` compares with the checksum supplied, or with that of the file;
    ``checksum`` only records it.
    """
    arguments = F.col("arguments")
    rows = requests.withColumns({
        "local_path": default_local_path(F.col("target")), "path": target_path(),
        "supplied": F.col("target.checksum"), "verify": arguments["verify"],
        "record": arguments["verify"] | arguments["checksum"]})
    facts = facts_of(
        files, rows.select("local_path"), "local_path", has_file=F.lit(True),
        size=F.octet_length("content").cast("bigint"), md5=text.content_md5(F.col("content")))
    differs = F.col("verify") & F.col("supplied").isNotNull() & ~text.equals_ignore_case(
        F.col("md5"), F.col("supplied"))
    return rows.join(facts, "local_path", "left").withColumns({
        "checksum": F.when(F.col("record"), F.col("md5")),
        "error": F.coalesce("error", first_error(
            (F.col("has_file").isNull(), error(F.format_string(
                "there is no local file '%s'", "local_path"),
                errors.FILE_DOES_NOT_EXIST)),
            (differs, error(F.format_string(
                "the file for '%s' does not have the supplied sum", "path"),
                errors.CHECKSUM_MISMATCH)))),
    }).drop("supplied", "verify", "record", "has_file", "md5")


def last_writes(new: DataFrame, order: list[str]) -> DataFrame:
    """Of several writes of a path the last by ``order``, which has to tell them
    apart; picked by keys before any content moves."""
    last = new.groupBy(*PLACE).agg(F.max(F.struct(*order)).alias("last")).select(
        *PLACE, "last.*")
    return new.join(last, [*PLACE, *order], "left_semi")


def upserted(contents: DataFrame, new: DataFrame) -> DataFrame:
    """Content rows after writing ``new``: rows of a path replaced or added.

    A path is written once in ``new`` (``last_writes`` sees to that); repeating a
    write changes nothing. Old rows are only filtered, new ones only appended.
    """
    kept = contents.join(new.select(*PLACE), PLACE, "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def put(catalogue: Catalogue, requests: DataFrame,
        files: DataFrame) -> tuple[Catalogue, DataFrame]:
    """Write local files to data objects, over any existing content.

    Replica 0 takes the new content; other replicas become stale.
    """
    # decisions are made without content; it is joined in at the end
    checked = settled(uploads(requests, files))
    known = catalogue.collections.select("coll_path", "coll_id", "zone").join(
        checked.select(F.col("target.collection").alias("coll_path"))
                           .distinct(), "coll_path", "left_semi")
    rows = checked.join(known, F.col("target.collection") == F.col("coll_path"), "left")
    rows = settled(rows.withColumn("error", F.coalesce("error", first_error(
        (F.col("coll_id").isNull(), error(F.format_string(
            "no collection to hold '%s'", "path"),
            errors.UNKNOWN_COLLECTION))))))
    # the last write of a path, picked by id before any content moves
    last = rows.where("error is null").groupBy("path").agg(
        F.max("request_id").alias("request_id"))
    written = rows.join(last, ["path", "request_id"], "left_semi").select(
        "coll_path", F.col("target.data_object").alias("data_name"), "coll_id", "zone",
        "local_path", "size", "checksum")
    keys = PLACE
    old = catalogue.replicas.join(written.select(*keys), keys, "left_semi")
    ids = old.select(*keys, "data_id").distinct()
    top = catalogue.replicas.agg(F.max("data_id").alias("top"))
    numbered = settled(written.join(ids, keys, "left").withColumn(
        "offset", F.monotonically_increasing_id()))
    numbered = numbered.withColumn("data_id", F.coalesce(
        "data_id", F.coalesce(top.scalar(), F.lit(0)) + 1 + F.col("offset"))).drop("offset")
    at = F.current_timestamp()
    fresh = numbered.select(
        "data_id", "coll_id", *keys, F.lit(0).alias("repl_num"),
        "size", "checksum",
        F.lit(doc.GOOD).alias("status"), at.alias("modified"), "zone")
    first = old.where(F.col("repl_num") == 0).select(
        "data_id", F.col("created").alias("was_created"), "resc_hier")
    fresh = fresh.join(first, "data_id", "left").withColumn(
        "created", F.coalesce("was_created", at)).drop("was_created")
    others = old.where(F.col("repl_num") != 0).withColumn("status", F.lit(doc.STALE))
    new_contents = numbered.join(files, "local_path").select(
        "data_id", *PLACE, "content", "checksum", "zone")
    # content without replicas that lies where something is written
    stray = catalogue.contents.select("data_id", *PLACE).join(written, PLACE, "left_semi").join(
        numbered, "data_id", "left_anti").select("data_id")
    return catalogue.changed(
        replicas=change(others.unionByName(fresh), PUT),
        contents=change(new_contents, PUT).unionByName(
            change(stray, DROP), allowMissingColumns=True)), echoed(rows)


def write(catalogue: Catalogue, requests: DataFrame,
          files: DataFrame) -> tuple[Catalogue, DataFrame]:
    """Put without a server-side sum: what was written is checked afterwards."""
    after = requests.withColumn(
        "arguments", F.col("arguments").withField("verify", F.lit(True)))
    return put(catalogue, after, files)


def verified_after(written: DataFrame) -> DataFrame:
    """Written content with ``verified``: does it have the sum it should?"""
    return written.withColumn("verified", F.coalesce(
        text.content_md5(F.col("content")) == F.col("checksum"), F.lit(False)))
