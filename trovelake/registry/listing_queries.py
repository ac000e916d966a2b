"""Listing of objects, collections and contents."""

from __future__ import annotations

from pyspark.sql import functions as F

from trovelake.operators.listing import (
    children, contents, in_listing_order, list_items, list_paths, resolved_requests,
)
from trovelake.plans.settle import settled
from trovelake.registry.book import query
from trovelake.registry.request_sets import bare_requests, lines, object_requests
from trovelake.sources.requests import requests
from trovelake.sources.tables import star_catalogue


@query("act01_list_object", """
SELECT o_orderkey AS request_id, CASE WHEN n_sizes = 1 THEN size END AS size,
  CASE WHEN n_sizes = 1 AND n_sums = 1 THEN NULL ELSE -1 END AS code
FROM orders LEFT JOIN (
  SELECT data_id, count(DISTINCT size) AS n_sizes, max(size) AS size,
    count(DISTINCT COALESCE(checksum, '')) AS n_sums
  FROM replicas WHERE status = '1' GROUP BY data_id) r ON data_id = o_orderkey
WHERE o_orderkey IN (SELECT data_id FROM replicas)""")
def list_object(spark, sf):
    c = star_catalogue(spark, sf)
    found = settled(resolved_requests(
        c, object_requests(spark, sf, "list", "size", "checksum")))
    rows = list_items(c, found)
    code = F.col("item_error.code")
    return rows.select("request_id", F.when(F.col("list_error").isNull(), F.col("size"))
                       .alias("size"), code.alias("code"))


@query("act01_list_object_documents", """
SELECT o_orderkey AS request_id,
  CASE WHEN data_id IS NULL THEN -310000 WHEN n_good IS NULL THEN -1 END AS code,
  CASE WHEN n_good > 0 THEN '{"avus":[' || avus || '],"collection":"' || coll_path ||
    '","data_object":"' || data_name || '"}' END AS document
FROM orders LEFT JOIN objects ON data_id = o_orderkey
LEFT JOIN (SELECT data_id AS id, count(*) AS n_good FROM replicas WHERE status = '1'
           GROUP BY data_id) g ON id = o_orderkey
LEFT JOIN (SELECT subject_id, string_agg('{"attribute":"' || attribute || '"' ||
    CASE WHEN units IS NULL THEN '' ELSE ',"units":"' || units || '"' END ||
    ',"value":"' || value || '"}', ',' ORDER BY attribute, value) AS avus
  FROM avus WHERE subject_type = 'D' GROUP BY subject_id) a ON subject_id = o_orderkey""")
def list_object_documents(spark, sf):
    responses = list_paths(star_catalogue(spark, sf), object_requests(spark, sf, "list", "avu"))
    return responses.select("request_id", F.col("error.code").alias("code"),
                            F.col("single").alias("document"))


def _collection_requests(spark, sf, *flags):
    rows = star_catalogue(spark, sf).collections
    arguments = F.struct(*[F.lit(True).alias(f) for f in flags])
    return requests(lines(rows, F.col("coll_id"), F.struct(
        F.lit("list").alias("op"), arguments.alias("args"),
        F.struct(F.concat("coll_path", F.lit("/")).alias("coll")).alias("target"))))


@query("act02_list_collection", """
SELECT coll_id AS request_id, coll_path AS collection, COALESCE(n_avus, 0) AS n_avus,
  COALESCE(n_access, 0) AS n_access, 0::BIGINT AS n_timestamps, FALSE AS has_checksum
FROM collections
LEFT JOIN (SELECT subject_id, count(*) AS n_avus FROM avus WHERE subject_type = 'C'
           GROUP BY subject_id) a ON a.subject_id = coll_id
LEFT JOIN (SELECT subject_id, count(*) AS n_access FROM acls WHERE subject_type = 'C'
           GROUP BY subject_id) b ON b.subject_id = coll_id""")
def list_collection(spark, sf):
    c = star_catalogue(spark, sf)
    found = settled(resolved_requests(c, _collection_requests(
        spark, sf, "acl", "avu", "checksum", "replicate", "timestamp")))
    rows = list_items(c, found)
    return rows.groupBy("request_id", "collection").agg(
        F.sum(F.size("avus")).alias("n_avus"), F.sum(F.size("access")).alias("n_access"),
        F.sum(F.size("timestamps")).alias("n_timestamps"),
        F.bool_or(F.col("checksum").isNotNull()).alias("has_checksum"))


CHILDREN = """
SELECT coll_path AS parent_path, 0 AS kind_rank, data_name AS name,
  max(CASE WHEN status = '1' THEN size END) AS size
FROM replicas GROUP BY coll_path, data_name
UNION ALL SELECT parent_path, 1, coll_path, NULL FROM collections"""


@query("src04_children", CHILDREN)
def all_children(spark, sf):
    return children(star_catalogue(spark, sf)).select("parent_path", "kind_rank", "name", "size")


@query("srt01_objects_before_collections", CHILDREN)
def listing_order(spark, sf):
    rows = in_listing_order(children(star_catalogue(spark, sf)))
    return rows.select("parent_path", "kind_rank", "name", "size")


@query("act03_contents", f"""
SELECT parent_path, kind_rank, name, size FROM ({CHILDREN}) c
WHERE parent_path IN (SELECT coll_path FROM collections JOIN avus ON coll_id = subject_id
                      WHERE attribute = 'segment' AND value = 'BUILDING')""")
def list_contents(spark, sf):
    c = star_catalogue(spark, sf)
    parents = c.collections.join(
        c.avus.where("attribute = 'segment' AND value = 'BUILDING'"),
        F.col("coll_id") == F.col("subject_id")).select(F.col("coll_path").alias("parent_path"))
    return contents(c, parents).select("parent_path", "kind_rank", "name", "size")


@query("act03_contents_documents", """
SELECT coll_id AS request_id,
  '{"collection":"' || coll_path || '","contents":[' ||
  COALESCE(string_agg('{"collection":"' || CASE kind_rank WHEN 0 THEN parent || '","data_object":"'
    || name || '"}' ELSE name || '"}' END, ',' ORDER BY kind_rank, name), '') || ']}' AS document
FROM collections LEFT JOIN (
  SELECT coll_path AS parent, 0 AS kind_rank, data_name AS name FROM objects
  UNION ALL SELECT parent_path, 1, coll_path FROM collections) c ON parent = coll_path
GROUP BY coll_id, coll_path""")
def contents_documents(spark, sf):
    c = star_catalogue(spark, sf)
    return list_paths(c, _collection_requests(spark, sf, "contents")).select(
        "request_id", F.col("single").alias("document"))


@query("prj08_single_result", """
SELECT coll_id AS request_id, '{"collection":"' || coll_path || '"}' AS single,
  NULL AS multiple FROM collections""")
def single_result(spark, sf):
    c = star_catalogue(spark, sf)
    asked = bare_requests(c.collections, F.col("coll_id"),
                          F.struct(F.col("coll_path").alias("collection")), "list")
    return list_paths(c, asked).select("request_id", "single", "multiple")
