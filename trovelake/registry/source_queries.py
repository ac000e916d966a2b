"""Sources and document shaping."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from trovelake.functions import documents as doc
from trovelake.registry.book import query
from trovelake.registry.request_sets import bare_requests, lines, object_requests
from trovelake.session import shared_folder, tune
from trovelake.sources import snapshots
from trovelake.sources.changes import DROP, KEYS, PUT, change
from trovelake.sources.requests import (
    concatenated, echoed, parse_lines, parts_present, rejected, requests,
)
from trovelake.sources.tables import Tables, star_catalogue


@query("src01_column_scan", """
SELECT DISTINCT coll_path AS collection, data_name AS data_object, size FROM replicas
WHERE status = '1' AND size >= 40""")
def column_scan(spark, sf):
    return star_catalogue(spark, sf).replicas.where("status = '1' AND size >= 40").select(
        F.col("coll_path").alias("collection"), F.col("data_name").alias("data_object"),
        "size").distinct()


def _mixed_lines(spark, sf):
    """Event properties (JSON), turns of talk (no JSON), and a doubled key."""
    t = Tables(spark, sf)
    good = t.events.select(F.col("event_id").alias("request_id"), F.col("props").alias("line"))
    talk = t.conversations.select((-F.col("conv_id") * 100 - F.col("turn")).alias("request_id"),
                                  F.col("text").alias("line"))
    doubled = t.labels.select(
        (F.lit(10**9) + F.col("doc_id")).alias("request_id"),
        F.concat(F.lit('{"k":1,"k":'), F.col("quality").cast("string"), F.lit("}")).alias("line"))
    arrays = t.region.select(
        (F.lit(2 * 10**9) + F.col("r_regionkey")).alias("request_id"),
        F.concat(F.lit('["'), "r_name", F.lit('"]')).alias("line"))
    return good.unionByName(talk).unionByName(doubled).unionByName(arrays)


@query("src02_rejected_lines", """
SELECT -conv_id * 100 - turn AS request_id, 'not JSON' AS reason, FALSE AS counts_as_error
  FROM conversations
UNION ALL SELECT 1000000000 + doc_id, 'not JSON', FALSE FROM labels
UNION ALL SELECT 2000000000 + r_regionkey, 'not an object', TRUE FROM region""")
def rejected_lines(spark, sf):
    return rejected(_mixed_lines(spark, sf)).select("request_id", "reason", "counts_as_error")


@query("src02_parsed_lines", """
SELECT event_id AS request_id, json_extract_string(props, '$.k')::BIGINT AS k FROM events""")
def parsed_lines(spark, sf):
    parsed = parse_lines(_mixed_lines(spark, sf))
    k = F.try_variant_get("document", "$.k", "bigint")
    return parsed.select("request_id", k.alias("k")).where("k IS NOT NULL")


@query("snk01_sorted_json", """
SELECT o_orderkey AS request_id, '{"collection":"/tpch/' || r_name || '/' || n_name || '/' ||
  c_name || '","data_object":"order_' || CAST(o_orderkey AS VARCHAR) || '"}' AS line
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey""")
def sorted_json(spark, sf):
    """Documents come back with sorted keys, whatever order they came in."""
    asked = object_requests(spark, sf, "list")
    return asked.select("request_id", F.to_json("target_document").alias("line"))


@query("prj05_key_synonyms", """
SELECT o_orderkey AS request_id, 'c' AS collection, 'status' AS attribute, o_orderstatus AS value,
  'like' AS operator FROM orders""")
def key_synonyms(spark, sf):
    """Short keys are read as long ones; a long key wins over its short form."""
    avu = F.struct(F.lit("status").alias("a"), F.col("o_orderstatus").alias("v"),
                   F.lit("like").alias("o"))
    document = F.struct(F.lit("c").alias("collection"), F.lit("other").alias("coll"),
                        F.array(avu).alias("avus"))
    typed = requests(lines(Tables(spark, sf).orders, F.col("o_orderkey"), document), "metaquery")
    return typed.select("request_id", "target.collection", F.explode("target.avus").alias("a")
                        ).select("request_id", "collection", "a.attribute", "a.value",
                                 "a.operator")


@query("prj09_error_in_band", """
SELECT o_orderkey AS request_id, '{"code":-1,"message":"unknown operation ''' || o_orderstatus ||
  '''"}' AS error FROM orders""")
def error_in_band(spark, sf):
    """An unknown operation comes back with its error."""
    document = F.struct(F.col("o_orderstatus").alias("operation"),
                        F.struct(F.lit("/x").alias("collection")).alias("target"))
    typed = requests(lines(Tables(spark, sf).orders, F.col("o_orderkey"), document))
    return typed.select("request_id", F.to_json(F.struct("error.code", "error.message"))
                        .alias("error"))


@query("prj10_echoed_target", """
SELECT o_orderkey AS request_id, '{"collection":"/tpch/' || r_name || '/' || n_name || '/' ||
  c_name || '","data_object":"order_' || CAST(o_orderkey AS VARCHAR) || '"}' AS single
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey""")
def echoed_target(spark, sf):
    return echoed(object_requests(spark, sf, "list")).select("request_id", "single")


@query("prj11_avus_from_lists", """
SELECT o_orderkey, 'status' AS attribute, o_orderstatus AS value, NULL AS units, '=' AS operator
FROM orders UNION ALL SELECT o_orderkey, 'priority', o_orderpriority, NULL, 'like' FROM orders""")
def avus_from_lists(spark, sf):
    made = doc.avus_from_lists(
        F.array(F.lit("status"), F.lit("priority")),
        F.array("o_orderstatus", "o_orderpriority"), F.array().cast("array<string>"),
        F.array(F.lit("="), F.lit("like")))
    rows = Tables(spark, sf).orders.select("o_orderkey", F.explode(made).alias("a"))
    return rows.select("o_orderkey", "a.*")


@query("fn21_typed_accessors", """
SELECT o_orderkey AS request_id, CASE o_orderstatus
  WHEN 'F' THEN '''collection'' has to be a text'
  WHEN 'O' THEN '''avus'' has to be a list' END AS message FROM orders""")
def typed_accessors(spark, sf):
    """Members of a wrong JSON type."""
    status = F.col("o_orderstatus")
    line = F.when(status == "F", '{"collection":5,"avus":[]}').when(
        status == "O", '{"collection":"/a","avus":{}}').otherwise('{"collection":"/a","avus":[]}')
    rows = Tables(spark, sf).orders.select(F.col("o_orderkey").alias("request_id"),
                                           line.alias("line"))
    return requests(rows, "metaquery").select("request_id", "error.message")


@query("fn22_mandatory_text", """
SELECT o_orderkey AS request_id, CASE o_orderstatus
  WHEN 'F' THEN 'an attribute to change is empty' WHEN 'O' THEN 'a value to change is empty' END
  AS message FROM orders""")
def mandatory_text(spark, sf):
    """Attribute and value must not be empty in a change; units may be."""
    status = F.col("o_orderstatus")
    avu = F.struct(F.when(status == "F", "").otherwise("x").alias("attribute"),
                   F.when(status == "O", "").otherwise("y").alias("value"),
                   F.lit("").alias("units"))
    document = F.struct(F.lit("/a").alias("collection"), F.array(avu).alias("avus"))
    typed = requests(lines(Tables(spark, sf).orders, F.col("o_orderkey"), document), "supersede")
    return typed.select("request_id", "error.message")


@query("act24_argument_flags", """
SELECT o_orderkey AS request_id, o_orderstatus = 'F' AS recurse, FALSE AS size FROM orders""")
def argument_flags(spark, sf):
    """Only a JSON ``true`` sets a flag."""
    document = F.struct(
        F.lit("list").alias("operation"),
        F.struct((F.col("o_orderstatus") == "F").alias("recurse"),
                 F.lit("yes").alias("size")).alias("arguments"),
        F.struct(F.lit("/a").alias("collection")).alias("target"))
    typed = requests(lines(Tables(spark, sf).orders, F.col("o_orderkey"), document))
    return typed.select("request_id", "arguments.recurse", "arguments.size")


GUARDED = ("checksum", "remove", "put", "get", "mkdir", "rmdir")


@query("act25_kind_guards", """
SELECT operation, count(*) AS n FROM orders CROSS JOIN (VALUES ('mkdir'), ('rmdir')) AS o(operation)
GROUP BY operation""")
def kind_guards(spark, sf):
    """Requests on objects: only making and removing collections is refused."""
    rows = Tables(spark, sf).orders.withColumn(
        "operation", F.explode(F.array(*[F.lit(o) for o in GUARDED])))
    document = F.struct("operation", F.struct(
        F.lit("/a").alias("collection"), F.lit("b").alias("data_object")).alias("target"))
    typed = requests(lines(rows, F.col("o_orderkey"), document))
    return typed.where("error IS NOT NULL").groupBy("operation").agg(
        F.count(F.lit(1)).alias("n"))


@query("act26_absolute_path", """
SELECT page_id AS request_id, CASE WHEN starts_with(url, 'https') THEN -816000 END AS code
FROM pages""")
def absolute_path(spark, sf):
    path = F.when(F.startswith("url", F.lit("https")), F.col("url")).otherwise(
        F.concat(F.lit("/"), "url"))
    typed = requests(lines(Tables(spark, sf).pages, F.col("page_id"),
                           F.struct(path.alias("collection"))), "list")
    return typed.select("request_id", F.col("error.code").alias("code"))


@query("src02_concatenated", """
SELECT o_orderkey, '/a}{"' || o_orderstatus AS collection, 'order_' || o_orderkey AS data_object
FROM orders""")
def concatenated_documents(spark, sf):
    """Documents over three lines, and several on a line, with brackets and quotes
    in their texts."""
    tune(spark)
    quoted = F.to_json(F.struct(
        F.concat(F.lit('/a}{"'), "o_orderstatus").alias("collection"),
        F.concat(F.lit("order_"), F.col("o_orderkey").cast("string")).alias("data_object")))
    spread = F.concat(F.lit('{"operation": "list",\n  "target": '), quoted, F.lit("\n} "))
    single = F.concat(F.lit('{"operation":"list","target":'), quoted, F.lit("}"))
    rows = Tables(spark, sf).orders.select(F.when(
        F.col("o_orderkey") % 2 == 0, spread).otherwise(single).alias("text"),
        F.floor(F.col("o_orderkey") / 5).alias("line"))
    folder = f"{shared_folder(spark)}/documents-{uuid.uuid4().hex}"
    rows.groupBy("line").agg(F.array_join(F.collect_list("text"), "").alias("value")).select(
        "value").write.text(folder)
    asked = requests(concatenated(spark, folder))
    return asked.select(
        F.regexp_extract("target.data_object", "[0-9]+", 0).cast("bigint").alias("o_orderkey"),
        "target.collection", "target.data_object")


@query("fn28_presence", """
SELECT o_orderkey AS request_id, o_orderstatus <> 'P' AS has_collection,
  o_orderstatus = 'F' AS has_acl, o_orderstatus = 'O' AS has_timestamps,
  o_orderstatus = 'O' AND o_orderkey % 2 = 0 AS has_created,
  o_orderstatus = 'O' AND o_orderkey % 2 = 1 AS has_modified FROM orders""")
def presence(spark, sf):
    """Which parts a target has; a JSON null is no part."""
    status, even = F.col("o_orderstatus"), F.col("o_orderkey") % 2 == 0
    at = F.lit("2020-01-01T00:00:00Z")
    span = F.struct(F.when(even, at).alias("c"), F.when(~even, at).alias("m"),
                    F.lit("n>").alias("o"))
    entry = F.struct(F.lit("public").alias("owner"), F.lit("read").alias("level"))
    document = F.struct(
        F.when(status != "P", "/a").alias("coll"), F.array().cast("array<string>").alias("avus"),
        F.when(status == "F", F.array(entry)).alias("access"),
        F.when(status == "O", F.array(span)).alias("time"))
    asked = bare_requests(Tables(spark, sf).orders, F.col("o_orderkey"), document, "metaquery")
    return asked.select("request_id", *[c.alias(n) for n, c in parts_present().items()])


@query("snk05_changes_on_disk", """
SELECT subject_type, subject_id, attribute, value FROM avus WHERE attribute <> 'priority'
UNION ALL SELECT DISTINCT 'D', o_orderkey, 'seen', 'yes' FROM orders
JOIN lineitem ON l_orderkey = o_orderkey""")
def changes_on_disk(spark, sf):
    """Metadata after a stored catalogue got change files and was compacted."""
    c = star_catalogue(spark, sf)
    folder = f"{shared_folder(spark)}/catalogue-{uuid.uuid4().hex}"
    snapshots.publish(c, folder)
    objects = c.avus.where("attribute = 'priority'")
    gone = change(objects.select(*KEYS["avus"]), DROP)
    seen = change(objects.withColumns({"attribute": F.lit("seen"), "value": F.lit("yes")}), PUT)
    snapshots.append(snapshots.current(spark, folder).changed(avus=gone), folder)
    snapshots.append(snapshots.current(spark, folder).changed(avus=seen), folder)
    snapshots.compact(spark, folder, "avus")
    return snapshots.current(spark, folder).avus.select(
        "subject_type", "subject_id", "attribute", "value")
