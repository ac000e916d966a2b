"""Joins of results with their properties, and the aggregations behind them."""

from __future__ import annotations

from pyspark.sql import functions as F

from trovelake.functions import documents as doc
from trovelake.functions import times
from trovelake.operators import enrich
from trovelake.operators.listing import children, resolved_requests
from trovelake.operators.search import search
from trovelake.plans.skew import nested
from trovelake.registry.book import query
from trovelake.registry.request_sets import object_requests
from trovelake.sources.requests import run_totals
from trovelake.sources.tables import document_catalogue, star_catalogue

BRAND = [{"attribute": "brand", "value": "Brand#13"}]
BRAND_OBJECTS = """data_id IN (SELECT subject_id FROM avus
  WHERE attribute = 'brand' AND value = 'Brand#13')"""


def _found(catalogue):
    return search(catalogue, BRAND, collections=False, ids=True)


@query("join01_collection_replica", """
SELECT c.coll_path AS collection, data_name AS data_object, repl_num, size
FROM collections c JOIN replicas r ON c.coll_id = r.coll_id""")
def collection_replica(spark, sf):
    c = star_catalogue(spark, sf)
    return c.collections.select("coll_id", "coll_path").join(
        c.replicas.drop("coll_path"), "coll_id").select(
        F.col("coll_path").alias("collection"), F.col("data_name").alias("data_object"),
        "repl_num", "size")


@query("join03_acl_semi_join", """
SELECT DISTINCT coll_path AS collection, data_name AS data_object FROM objects
WHERE data_id IN (SELECT subject_id FROM acls WHERE subject_type = 'D'
                  AND owner = 'public' AND level = 'read')""")
def acl_semi_join(spark, sf):
    return search(star_catalogue(spark, sf), [], access=[{"owner": "public", "level": "read"}],
                  collections=False).select("collection", "data_object")


# Straight from the given tables: the views would be computed several times.
@query("join04_avus", """
WITH hit AS (
  SELECT o_orderkey, o_orderpriority, o_orderstatus,
    '/tpch/' || r_name || '/' || n_name || '/' || c_name AS collection,
    'order_' || CAST(o_orderkey AS VARCHAR) AS data_object
  FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
  JOIN region ON r_regionkey = n_regionkey
  WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem JOIN part ON p_partkey = l_partkey
                       WHERE p_brand = 'Brand#13')),
parts AS (
  SELECT l_orderkey, p_brand, p_type, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS quantity
  FROM lineitem JOIN part ON p_partkey = l_partkey
  WHERE l_orderkey IN (SELECT o_orderkey FROM hit)),
named AS (
  SELECT o_orderkey AS k, 'priority' AS attribute, o_orderpriority AS value,
    CAST(NULL AS VARCHAR) AS units FROM hit
  UNION ALL SELECT o_orderkey, 'status', o_orderstatus, NULL FROM hit
  UNION ALL SELECT DISTINCT l_orderkey, 'brand', p_brand, NULL FROM parts
  UNION ALL SELECT DISTINCT l_orderkey, 'type', p_type, NULL FROM parts
  UNION ALL SELECT DISTINCT l_orderkey, 'quantity', quantity, 'pcs' FROM parts)
SELECT collection, data_object, attribute, value, units FROM hit JOIN named ON k = o_orderkey""")
def with_avus(spark, sf):
    c = star_catalogue(spark, sf)
    return enrich.with_rows(_found(c), enrich.avu_rows(c)).select(
        "collection", "data_object", "attribute", "value", "units")


@query("join05_acls", f"""
SELECT coll_path AS collection, data_name AS data_object, owner, owner_zone AS zone, level
FROM objects JOIN acls ON data_id = subject_id AND subject_type = 'D' WHERE {BRAND_OBJECTS}""")
def with_acls(spark, sf):
    c = star_catalogue(spark, sf)
    return enrich.with_rows(_found(c), enrich.acl_rows(c)).select(
        "collection", "data_object", "owner", F.col("owner_zone").alias("zone"), "level")


@query("join06_checksum", f"""
SELECT o.coll_path AS collection, o.data_name AS data_object,
  CASE WHEN n = 1 THEN sum END AS checksum, COALESCE(n, 0) <> 1 AS is_error
FROM objects o LEFT JOIN (
  SELECT data_id, count(DISTINCT COALESCE(checksum, '')) AS n, max(checksum) AS sum
  FROM replicas WHERE status = '1' GROUP BY data_id) s USING (data_id)
WHERE {BRAND_OBJECTS}""")
def with_checksum(spark, sf):
    c = star_catalogue(spark, sf)
    wants = enrich.wants(checksum=True)
    rows = enrich.enriched(_found(c).withColumn("wants", wants), c)
    return rows.select(
        "collection", "data_object", F.try_variant_get("checksum", "$", "string")
        .alias("checksum"), F.col("item_error").isNotNull().alias("is_error"))


@query("join07_timestamps", f"""
SELECT coll_path AS collection, data_name AS data_object, repl_num AS replicates,
  strftime(created, '%Y-%m-%dT%H:%M:%SZ') AS created, NULL AS modified
FROM replicas WHERE {BRAND_OBJECTS}
UNION ALL SELECT coll_path, data_name, repl_num, NULL,
  strftime(modified, '%Y-%m-%dT%H:%M:%SZ') FROM replicas WHERE {BRAND_OBJECTS}""")
def with_timestamps(spark, sf):
    c = star_catalogue(spark, sf)
    rows = enrich.with_rows(_found(c), enrich.timestamp_rows(c))
    entry = F.explode(doc.timestamp_entries(F.col("created"), F.col("modified"),
                                            F.col("repl_num")))
    return rows.select("collection", "data_object", entry.alias("t")).select(
        "collection", "data_object", "t.replicates", "t.created", "t.modified")


@query("join08_replicas", f"""
SELECT coll_path AS collection, data_name AS data_object, repl_num AS number, checksum,
  status = '1' AS valid, split_part(resc_hier, ';', 3) AS resource
FROM replicas WHERE {BRAND_OBJECTS}""")
def with_replicas(spark, sf):
    c = star_catalogue(spark, sf)
    return enrich.with_rows(_found(c), enrich.replicate_rows(c)).select(
        "collection", "data_object", F.col("repl_num").alias("number"), "checksum", "valid",
        "resource")


@query("join09_resource_location", """
SELECT data_id, repl_num, name AS resource, location FROM replicas r
JOIN resources s ON s.name = split_part(resc_hier, ';', 3) AND s.zone = r.zone""")
def resource_location(spark, sf):
    rows = enrich.replicate_rows(star_catalogue(spark, sf))
    return rows.where("error IS NULL").select(
        F.col("subject_id").alias("data_id"), "repl_num", "resource", "location")


@query("join10_path_exists", """
SELECT o_orderkey AS request_id,
  '/tpch/' || r_name || '/' || n_name || '/' || c_name || '/order_' ||
    CAST(o_orderkey AS VARCHAR) AS path,
  CASE WHEN o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) THEN -310000 END AS code
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey""")
def path_exists(spark, sf):
    requests = object_requests(spark, sf, "list")
    return resolved_requests(star_catalogue(spark, sf), requests).select(
        "request_id", "path", F.col("error.code").alias("code"))


@query("join11_contents_with_acl", """
SELECT coll_path AS parent, 0 AS kind_rank, data_name AS name, owner, level
FROM objects LEFT JOIN acls ON data_id = subject_id AND subject_type = 'D'
UNION ALL SELECT parent_path, 1, coll_path, owner, level
FROM collections LEFT JOIN acls ON coll_id = subject_id AND subject_type = 'C'""")
def contents_with_acl(spark, sf):
    c = star_catalogue(spark, sf)
    return enrich.with_rows(children(c), enrich.acl_rows(c)).select(
        F.col("parent_path").alias("parent"), "kind_rank", "name", "owner", "level")


@query("agg01_nested_avus", """
SELECT subject_type, subject_id, count(*) AS n,
  string_agg(attribute || '=' || value || COALESCE(' ' || units, ''), '|'
             ORDER BY attribute, value) AS avus
FROM avus GROUP BY subject_type, subject_id""")
def nested_avus(spark, sf):
    rows = enrich.avu_rows(star_catalogue(spark, sf)).select(
        *enrich.SUBJECT, F.struct("attribute", "value", "units").alias("entry"))
    text = F.array_join(F.transform("avus", lambda a: F.concat(
        a["attribute"], F.lit("="), a["value"],
        F.coalesce(F.concat(F.lit(" "), a["units"]), F.lit("")))), "|")
    return nested(rows, enrich.SUBJECT, "avus").select(
        *enrich.SUBJECT, F.size("avus").cast("bigint").alias("n"), text.alias("avus"))


@query("agg02_checksum_conflict", """
SELECT data_id, count(DISTINCT COALESCE(checksum, '')) AS n_values FROM replicas
WHERE status = '1' GROUP BY data_id""")
def checksum_conflict(spark, sf):
    return enrich.single_value(star_catalogue(spark, sf).replicas, "checksum").select(
        "data_id", "n_values")


@query("agg03_size_conflict", """
SELECT data_id, count(DISTINCT size) AS n_values, max(size) AS size FROM replicas
WHERE status = '1' GROUP BY data_id""")
def size_conflict(spark, sf):
    return enrich.single_value(star_catalogue(spark, sf).replicas, "size").select(
        "data_id", "n_values", "size")


@query("agg04_one_resource", """
SELECT name AS resource, count(*) AS n_found, max(location) AS location
FROM resources GROUP BY name, zone""")
def one_resource(spark, sf):
    return enrich.located_resources(star_catalogue(spark, sf).resources).select(
        "resource", "n_found", "location")


@query("agg05_run_totals", """
SELECT count(*) AS items,
  sum(CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem) THEN 0 ELSE 1 END)::BIGINT
    AS errors FROM orders""")
def totals(spark, sf):
    requests = object_requests(spark, sf, "list")
    return run_totals(resolved_requests(star_catalogue(spark, sf), requests))


@query("prj01_relabel", """
SELECT coll_path AS collection, data_name AS data_object, size FROM replicas""")
def relabel(spark, sf):
    return star_catalogue(spark, sf).replicas.select(
        F.col("coll_path").alias("collection"), F.col("data_name").alias("data_object"), "size")


@query("prj02_distinct", """
SELECT 'with size' AS selected, count(*) AS n FROM (SELECT DISTINCT data_id, size FROM replicas)
UNION ALL SELECT 'without size', count(*) FROM objects""")
def distinct_rows(spark, sf):
    c = star_catalogue(spark, sf)
    sized = c.replicas.select("data_id", "size").distinct()
    return sized.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("with size").alias("selected"), "n").unionByName(
        c.objects().agg(F.count(F.lit(1)).alias("n")).select(
            F.lit("without size").alias("selected"), "n"))


@query("prj03_empty_is_absent", """
SELECT subject_id, '{"attribute":"' || attribute || '"' ||
  CASE WHEN units IS NULL THEN '' ELSE ',"units":"' || units || '"' END ||
  ',"value":"' || value || '"}' AS avu FROM avus""")
def empty_is_absent(spark, sf):
    rows = star_catalogue(spark, sf).avus.withColumn("units", F.coalesce("units", F.lit("")))
    return rows.select("subject_id", F.to_json(doc.avu(
        F.col("attribute"), F.col("value"), F.col("units"))).alias("avu"))


@query("prj04_size_as_integer", """
SELECT data_id, repl_num, size FROM replicas""")
def size_as_integer(spark, sf):
    """Sizes as a server sends them, text, back to integers."""
    rows = star_catalogue(spark, sf).replicas.withColumn("size", F.col("size").cast("string"))
    return rows.select("data_id", "repl_num", F.col("size").try_cast("bigint").alias("size"))


@query("prj06_attached_properties", """
SELECT o.coll_path AS collection, o.data_name AS data_object, n_access, n_avus, n_replicates,
  2 * n_replicates AS n_timestamps
FROM objects o
LEFT JOIN (SELECT subject_id AS data_id, count(*) AS n_avus FROM avus WHERE subject_type = 'D'
           GROUP BY subject_id) a USING (data_id)
LEFT JOIN (SELECT subject_id AS data_id, count(*) AS n_access FROM acls WHERE subject_type = 'D'
           GROUP BY subject_id) b USING (data_id)
LEFT JOIN (SELECT data_id, count(*) AS n_replicates FROM replicas GROUP BY data_id) r
  USING (data_id)""")
def attached_properties(spark, sf):
    c = star_catalogue(spark, sf)
    items = search(c, [], collections=False, ids=True).withColumn("wants", enrich.wants(
        acl=True, avu=True, replicate=True, timestamp=True))
    rows = enrich.enriched(items, c)
    n = {name: F.sum(F.size(name)).alias(f"n_{name}")
         for name in ("access", "avus", "replicates", "timestamps")}
    return rows.groupBy("collection", "data_object").agg(*n.values())


@query("prj06_documents", """
SELECT '{"avus":[{"attribute":"quality","value":"' || CAST(quality AS VARCHAR) ||
  '"},{"attribute":"toxic","value":"' || CAST(toxic AS VARCHAR) || '"}],"collection":"/docs/' ||
  source || '/' || lang || '","data_object":"doc_' || CAST(doc_id AS VARCHAR) || '.txt"}'
  AS document
FROM documents JOIN labels USING (doc_id)""")
def documents(spark, sf):
    c = document_catalogue(spark, sf)
    items = search(c, [{"a": "quality", "v": "%", "o": "like"}], collections=False,
                   ids=True).withColumn("wants", enrich.wants(avu=True)).withColumn(
        "size", F.lit(None).cast("bigint"))
    return enrich.enriched(items, c).select(enrich.item_json().alias("document"))


@query("fn18_timestamp_pair", """
SELECT data_id, repl_num, strftime(created, '%Y-%m-%dT%H:%M:%SZ') AS created,
  strftime(modified, '%Y-%m-%dT%H:%M:%SZ') AS modified FROM replicas""")
def timestamp_pair(spark, sf):
    pair = doc.timestamp_entries(F.col("created"), F.col("modified"), F.col("repl_num"))
    return star_catalogue(spark, sf).replicas.select(
        "data_id", "repl_num", pair[0]["created"].alias("created"),
        pair[1]["modified"].alias("modified"))


@query("fn17_one_timestamp", """
SELECT data_id, repl_num AS replicates, strftime(created, '%Y-%m-%dT%H:%M:%SZ') AS created
FROM replicas""")
def one_timestamp(spark, sf):
    return star_catalogue(spark, sf).replicas.select(
        "data_id", F.col("repl_num").alias("replicates"),
        times.time_text(F.col("created")).alias("created"))


@query("fn16_replicate", """
SELECT data_id, repl_num AS number, status = '1' AS valid, checksum FROM replicas""")
def replicate(spark, sf):
    null = F.lit(None).cast("string")
    made = doc.replicate(F.col("repl_num").cast("string"), F.col("status"), F.col("checksum"),
                         null, null)
    return star_catalogue(spark, sf).replicas.select("data_id", made.alias("r")).select(
        "data_id", "r.number", "r.valid", "r.checksum")
