"""Scalar functions over columns of the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from trovelake.functions import documents as doc
from trovelake.functions import levels, paths, text, times
from trovelake.registry.book import query
from trovelake.sources.tables import Tables, collection_paths, star_catalogue

URL_PATH = "'/' || regexp_replace(url, '^https?://', '')"


def _url_paths(spark, sf):
    return Tables(spark, sf).pages.select(
        "page_id", F.concat(F.lit("/"), F.regexp_replace("url", "^https?://", "")).alias("path"))


@query("fn01_format_timestamp", """
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS at FROM events""")
def format_timestamp(spark, sf):
    """From epoch seconds as text with a leading zero."""
    stored = F.concat(F.lit("0"), F.unix_seconds("ts").cast("string"))
    return Tables(spark, sf).events.select(
        "event_id", times.format_timestamp(stored).alias("at"))


@query("fn02_parse_timestamp", """
SELECT event_id, CAST(epoch(date_trunc('second', ts))::BIGINT AS VARCHAR) AS with_zone,
  CAST(epoch(date_trunc('second', ts))::BIGINT AS VARCHAR) AS without_zone, NULL AS unreadable
FROM events""")
def parse_timestamp(spark, sf):
    shown = F.date_format("ts", times.ISO8601)
    return Tables(spark, sf).events.select(
        "event_id", times.parse_timestamp(F.concat(shown, F.lit("Z"))).alias("with_zone"),
        times.parse_timestamp(shown).alias("without_zone"),
        times.parse_timestamp(F.col("props")).alias("unreadable"))


@query("fn03_zone_name", f"""
SELECT page_id, split_part({URL_PATH}, '/', 2) AS zone, NULL AS of_relative FROM pages""")
def zone_name(spark, sf):
    return _url_paths(spark, sf).select(
        "page_id", paths.zone_name(F.col("path")).alias("zone"),
        paths.zone_name(F.substr("path", F.lit(2))).alias("of_relative"))


@query("fn04_base_name", f"""
SELECT page_id, regexp_extract({URL_PATH}, '[^/]*$') AS base FROM pages""")
def base_name(spark, sf):
    return _url_paths(spark, sf).select("page_id", paths.base_name(F.col("path")).alias("base"))


@query("fn05_path_of_document", """
SELECT o_orderkey, '/tpch/' || r_name || '/' || n_name || '/' || c_name || '/order_' ||
  CAST(o_orderkey AS VARCHAR) AS path FROM orders JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def path_of_document(spark, sf):
    """A trailing slash on the collection makes no difference."""
    t = Tables(spark, sf)
    rows = t.orders.join(collection_paths(t), F.col("o_custkey") == F.col("c_custkey"))
    name = F.concat(F.lit("order_"), F.col("o_orderkey").cast("string"))
    return rows.select("o_orderkey", paths.to_path(
        F.concat("coll_path", F.lit("/")), name).alias("path"))


@query("fn06_collection_path", f"""
SELECT page_id, regexp_replace({URL_PATH}, '(.)/$', '\\1') AS path FROM pages""")
def collection_path(spark, sf):
    return _url_paths(spark, sf).select(
        "page_id", paths.collection_path(F.col("path")).alias("path"))


@query("fn07_local_path", """
SELECT doc_id, '/data/' || lang || '/' || source AS both_given,
  '/data/' || lang || '/doc' AS directory_and_object, './' || source AS file_only,
  './doc' AS object_only, '/data/' || lang AS directory_only, '.' AS nothing FROM documents""")
def local_path(spark, sf):
    none, name = F.lit(None).cast("string"), F.lit("doc")
    folder, file = F.concat(F.lit("/data/"), "lang"), F.col("source")
    return Tables(spark, sf).documents.select(
        "doc_id", paths.local_path(folder, file, name).alias("both_given"),
        paths.local_path(folder, none, name).alias("directory_and_object"),
        paths.local_path(none, file, name).alias("file_only"),
        paths.local_path(none, none, name).alias("object_only"),
        paths.local_path(folder, none, none).alias("directory_only"),
        paths.local_path(none, none, none).alias("nothing"))


@query("fn08_dir_and_base", f"""
SELECT page_id, CASE WHEN regexp_replace({URL_PATH}, '/[^/]*$', '') = '' THEN '/'
  ELSE regexp_replace({URL_PATH}, '/[^/]*$', '') END AS dir,
  regexp_extract({URL_PATH}, '[^/]*$') AS base FROM pages""")
def dir_and_base(spark, sf):
    return _url_paths(spark, sf).select(
        "page_id", paths.dir_name(F.col("path")).alias("dir"),
        paths.base_name(F.col("path")).alias("base"))


@query("fn11_equals_ignore_case", """
SELECT doc_id, lower(lang) = lower(upper(lang)) AS same, lower(lang) = lower(source) AS other
FROM documents""")
def equals_ignore_case(spark, sf):
    return Tables(spark, sf).documents.select(
        "doc_id", text.equals_ignore_case(F.col("lang"), F.upper("lang")).alias("same"),
        text.equals_ignore_case(F.col("lang"), F.col("source")).alias("other"))


@query("fn12_text_tests", """
SELECT page_id, starts_with(url, 'https://') AS starts, ends_with(url, '#top') AS ends,
  url = html AS equal FROM pages""")
def text_tests(spark, sf):
    return Tables(spark, sf).pages.select(
        "page_id", text.starts_with(F.col("url"), F.lit("https://")).alias("starts"),
        text.ends_with(F.col("url"), F.lit("#top")).alias("ends"),
        text.equals(F.col("url"), F.col("html")).alias("equal"))


@query("fn13_level_token", """
SELECT subject_type, subject_id, owner, CASE level WHEN 'own' THEN 'own'
  WHEN 'read' THEN 'read object' ELSE 'modify object' END AS token, NULL AS of_unknown FROM acls""")
def level_token(spark, sf):
    return star_catalogue(spark, sf).acls.select(
        "subject_type", "subject_id", "owner",
        levels.level_token(F.upper("level")).alias("token"),
        levels.level_token(F.col("owner")).alias("of_unknown"))


@query("fn14_level_word", """
SELECT subject_type, subject_id, owner, level, owner AS of_unknown FROM acls""")
def level_word(spark, sf):
    return star_catalogue(spark, sf).acls.select(
        "subject_type", "subject_id", "owner",
        levels.level_word(levels.level_token(F.col("level"))).alias("level"),
        levels.level_word(F.col("owner")).alias("of_unknown"))


@query("fn15_hierarchy_leaf", """
SELECT data_id, repl_num, split_part(resc_hier, ';', 3) AS leaf, data_name AS of_plain
FROM replicas""")
def hierarchy_leaf(spark, sf):
    return star_catalogue(spark, sf).replicas.select(
        "data_id", "repl_num", paths.hierarchy_leaf(F.col("resc_hier")).alias("leaf"),
        paths.hierarchy_leaf(F.col("data_name")).alias("of_plain"))


@query("fn19_path_kind", """
SELECT doc_id, quality IS NULL AS is_collection, quality IS NOT NULL AS is_object
FROM documents LEFT JOIN labels USING (doc_id)""")
def path_kind(spark, sf):
    """A label stands for the object name: present or not."""
    t = Tables(spark, sf)
    rows = t.documents.join(t.labels, "doc_id", "left")
    return rows.select(
        "doc_id", paths.represents_collection(F.col("source"), F.col("quality"))
        .alias("is_collection"),
        paths.represents_object(F.col("source"), F.col("quality")).alias("is_object"))


@query("fn20_local_kind", """
SELECT doc_id, quality IS NULL AS is_directory, quality IS NOT NULL AS is_file
FROM documents LEFT JOIN labels USING (doc_id)""")
def local_kind(spark, sf):
    t = Tables(spark, sf)
    rows = t.documents.join(t.labels, "doc_id", "left")
    return rows.select(
        "doc_id", paths.represents_directory(F.col("lang"), F.col("quality"))
        .alias("is_directory"),
        paths.represents_file(F.col("lang"), F.col("quality")).alias("is_file"))


@query("fn23_owner_spec", """
SELECT subject_id, owner || '#' || owner_zone AS spec, owner AS without_zone FROM acls""")
def owner_spec(spark, sf):
    return star_catalogue(spark, sf).acls.select(
        "subject_id", paths.owner_spec(F.col("owner"), F.col("owner_zone")).alias("spec"),
        paths.owner_spec(F.col("owner"), F.lit(None)).alias("without_zone"))


@query("fn24_parse_owner", """
SELECT o_orderkey, CASE WHEN strpos(spec, '#') > 0 THEN split_part(spec, '#', 1) ELSE spec END
    AS owner, CASE WHEN strpos(spec, '#') > 0 THEN split_part(spec, '#', 2) ELSE 'home' END AS zone
FROM (SELECT o_orderkey, c_mktsegment || CASE WHEN o_orderstatus = 'F' THEN '#away' ELSE '' END
        AS spec FROM orders JOIN customer ON o_custkey = c_custkey) t""")
def parse_owner(spark, sf):
    t = Tables(spark, sf)
    away = F.when(F.col("o_orderstatus") == "F", "#away").otherwise("")
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).withColumn(
        "spec", F.concat("c_mktsegment", away))
    return rows.select("o_orderkey", paths.owner_of(F.col("spec")).alias("owner"),
                       paths.owner_zone_of(F.col("spec"), F.lit("home")).alias("zone"))


@query("fn26_parse_size", """
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS size,
  NULL::BIGINT AS of_text FROM events""")
def parse_size(spark, sf):
    return Tables(spark, sf).events.select(
        "event_id", text.parse_size(F.get_json_object("props", "$.k")).alias("size"),
        text.parse_size(F.col("event_type")).alias("of_text"))


@query("fn27_checksum_presence", """
SELECT data_id, repl_num, checksum IS NOT NULL AS has_checksum, checksum FROM replicas""")
def checksum_presence(spark, sf):
    return star_catalogue(spark, sf).replicas.select(
        "data_id", "repl_num", F.col("checksum").isNotNull().alias("has_checksum"), "checksum")


@query("prj07_path_documents", """
SELECT coll_id AS id, '{"collection":"' || coll_path || '"}' AS document FROM collections
UNION ALL SELECT data_id, '{"collection":"' || coll_path || '","data_object":"' || data_name ||
  '"}' FROM objects""")
def path_documents(spark, sf):
    rows = star_catalogue(spark, sf).paths()
    return rows.select(F.col("subject_id").alias("id"), F.to_json(doc.path_document(
        F.col("path"), F.col("subject_type") == "D")).alias("document"))
