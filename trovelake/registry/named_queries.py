"""Named, parameterised SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from trovelake.functions.errors import no_error
from trovelake.operators import named_sql
from trovelake.plans.dispatch import specific
from trovelake.registry.book import query
from trovelake.registry.request_sets import lines
from trovelake.sources.requests import requests
from trovelake.sources.tables import Tables, star_catalogue

# 1998-01-01 and 1999-01-01 as epoch seconds.
SPAN = ["883612800", "915148800"]
IN_SPAN = "modified > TIMESTAMP '1998-01-01' AND modified <= TIMESTAMP '1999-01-01'"


@query("sql05_data_modified_id_only", f"""
SELECT DISTINCT data_id FROM replicas WHERE {IN_SPAN}""")
def data_modified_id_only(spark, sf):
    return named_sql.run(star_catalogue(spark, sf), "dataModifiedIdOnly", SPAN)


DATA_PARTIAL = f"""
SELECT coll_path AS coll_name, data_name, data_id, repl_num AS data_repl_num,
  checksum AS data_checksum, epoch(modified)::BIGINT AS data_modify_ts,
  status AS data_repl_status FROM replicas WHERE {IN_SPAN}"""


@query("sql06_data_modified_partial", DATA_PARTIAL)
def data_modified_partial(spark, sf):
    return named_sql.run(star_catalogue(spark, sf), "dataModifiedPartial", SPAN)


@query("sql07_metadata_modified_id_only", f"""
SELECT DISTINCT data_id FROM replicas r JOIN (
  SELECT subject_id FROM avus WHERE subject_type = 'D' AND {IN_SPAN}) m ON data_id = subject_id""")
def metadata_modified_id_only(spark, sf):
    return named_sql.run(star_catalogue(spark, sf), "metadataModifiedIdOnly", SPAN)


METADATA_PARTIAL = f"""
SELECT coll_path AS coll_name, data_name, data_id,
  md5(attribute || '|' || value || '|' || COALESCE(units, '')) AS meta_id,
  attribute AS meta_attr_name, value AS meta_attr_value, units AS meta_attr_unit,
  epoch(m.modified)::BIGINT AS meta_modify_ts
FROM replicas r JOIN (SELECT * FROM avus WHERE subject_type = 'D' AND {IN_SPAN}) m
  ON data_id = subject_id"""


@query("sql08_metadata_modified_partial", METADATA_PARTIAL)
def metadata_modified_partial(spark, sf):
    return named_sql.run(star_catalogue(spark, sf), "metadataModifiedPartial", SPAN)


@query("join14_four_way", METADATA_PARTIAL)
def four_way(spark, sf):
    """The same join written with DataFrames."""
    c = star_catalogue(spark, sf)
    span = (F.col("modified") > F.lit("1998-01-01").cast("timestamp")) & (
        F.col("modified") <= F.lit("1999-01-01").cast("timestamp"))
    avus = c.avus.where(F.col("subject_type") == "D").withColumn("meta_id", named_sql.meta_id())
    metamap = avus.where(span).select("subject_id", "meta_id", "modified")
    metadata = avus.select("meta_id", "attribute", "value", "units").distinct()
    return (
        c.replicas.select("data_id", "coll_id", "data_name")
        .join(c.collections.select("coll_id", "coll_path"), "coll_id")
        .join(metamap, F.col("data_id") == F.col("subject_id")).join(metadata, "meta_id")
        .select(F.col("coll_path").alias("coll_name"), "data_name", "data_id", "meta_id",
                F.col("attribute").alias("meta_attr_name"),
                F.col("value").alias("meta_attr_value"), F.col("units").alias("meta_attr_unit"),
                F.unix_seconds("modified").alias("meta_modify_ts")))


@query("join15_distinct_ids", """
SELECT DISTINCT data_id FROM replicas JOIN avus ON data_id = subject_id
WHERE subject_type = 'D' AND attribute = 'brand'""")
def distinct_ids(spark, sf):
    c = star_catalogue(spark, sf)
    ids = c.avus.where("subject_type = 'D' AND attribute = 'brand'").select("subject_id")
    return c.replicas.join(ids, F.col("data_id") == F.col("subject_id"), "left_semi").select(
        "data_id").distinct()


@query("sql03_positional_arguments", """
SELECT data_id, repl_num, size FROM replicas WHERE status = '1' AND size >= 48""")
def positional_arguments(spark, sf):
    return named_sql.run(
        star_catalogue(spark, sf),
        "select data_id, repl_num, size from replicas where status = ? "
        "and size >= cast(? as bigint)", ["1", "48"])


@query("sql04_labels", """
SELECT status, count(*) AS "count(1)", max(size) AS largest FROM replicas GROUP BY status""")
def labels(spark, sf):
    return named_sql.run(
        star_catalogue(spark, sf),
        "SELECT status, count(1), max(size) AS largest FROM replicas GROUP BY status")


@query("act22_specific_query", """
SELECT coll_path AS collection, count(*) AS n FROM replicas GROUP BY coll_path""")
def specific_query(spark, sf):
    return named_sql.run(star_catalogue(spark, sf), "SELECT coll_path AS collection, "
                         "count(*) AS n FROM replicas GROUP BY coll_path")


def _customer_replicas(spark, sf):
    """Replica 0 of every object of the BUILDING customers, by path."""
    c = star_catalogue(spark, sf)
    building = c.collections.join(
        c.avus.where("attribute = 'segment' AND value = 'BUILDING'"),
        F.col("coll_id") == F.col("subject_id"), "left_semi").select("coll_path")
    return c.replicas, c.replicas.where("repl_num = 0").join(building, "coll_path", "left_semi")


HIT = """repl_num = 0 AND coll_path IN (
  SELECT coll_path FROM collections JOIN avus ON coll_id = subject_id
  WHERE attribute = 'segment' AND value = 'BUILDING')"""


@query("sql09_set_replica_stale", f"""
SELECT data_id, repl_num, CASE WHEN {HIT} THEN '0' ELSE status END AS status FROM replicas""")
def set_replica_stale(spark, sf):
    return named_sql.set_stale(*_customer_replicas(spark, sf)).select(
        "data_id", "repl_num", "status")


@query("sql10_set_checksum_invalid", f"""
SELECT data_id, repl_num, CASE WHEN {HIT} THEN '0' ELSE checksum END AS checksum FROM replicas""")
def set_checksum_invalid(spark, sf):
    return named_sql.set_checksum_invalid(*_customer_replicas(spark, sf)).select(
        "data_id", "repl_num", "checksum")


@query("sql_show_collection_acls", """
SELECT owner, owner_zone AS zone, level FROM acls JOIN collections ON subject_id = coll_id
WHERE subject_type = 'C'
  AND coll_path = (SELECT max(coll_path) FROM collections)""")
def show_collection_acls(spark, sf):
    c = star_catalogue(spark, sf)
    last = c.collections.agg(F.max("coll_path")).first()[0]
    return named_sql.run(c, "showCollAcls", [last])


def _aliases(spark, sf):
    """A catalogue with a named query per brand, the first of them twice, and
    requests for each brand's."""
    c = star_catalogue(spark, sf)
    brands = Tables(spark, sf).part.select("p_brand").distinct()
    sql = F.concat(F.lit("SELECT DISTINCT subject_id FROM avus WHERE value = '"), "p_brand",
                   F.lit("'"))
    named = brands.select(F.col("p_brand").alias("alias"), sql.alias("sqlStr"))
    twice = named.where("alias = 'Brand#11'").withColumn("sqlStr", F.concat("sqlStr", F.lit(" ")))
    return c.with_tables(named_queries=named.unionByName(twice)), brands


@query("sql01_alias_lookup", """
SELECT text, CASE WHEN text = 'Brand#11' THEN NULL ELSE statement END AS statement,
  CASE WHEN text = 'Brand#11' OR text LIKE '%#x%' THEN -1 END AS code FROM (
  SELECT DISTINCT p_brand AS text, 'SELECT DISTINCT subject_id FROM avu' ||
    's WHERE value = ''' || p_brand || '''' AS statement FROM part
  UNION ALL SELECT DISTINCT replace(p_brand, '#', '#x'), NULL FROM part)""")
def alias_lookup(spark, sf):
    """Each alias with its one statement; unknown and doubled ones are errors."""
    c, brands = _aliases(spark, sf)
    texts = brands.select(F.col("p_brand").alias("text")).unionByName(
        brands.select(F.regexp_replace("p_brand", "#", "#x").alias("text")))
    asked = texts.select("text", F.array().cast("array<string>").alias("args"),
                         no_error().alias("error"))
    found = named_sql.resolved(c, asked)
    return found.select("text", F.when(F.col("error").isNull(), F.col("statement"))
                        .alias("statement"), F.col("error.code").alias("code"))


@query("sql11_find_query_by_alias", """
SELECT DISTINCT p_brand AS alias, 'SELECT DISTINCT subject_id FROM avu' ||
  's WHERE value = ''' || p_brand || '''' AS sql_text FROM part WHERE p_brand <> 'Brand#11'""")
def find_query_by_alias(spark, sf):
    """The built-in query over aliases, for all brands in one query."""
    c, brands = _aliases(spark, sf)
    arguments = brands.where("p_brand <> 'Brand#11'").select(F.array("p_brand").alias("args"))
    return named_sql.answered(c, named_sql.BUILT_IN["findQueryByAlias"], arguments).select(
        "alias", F.col("sqlStr").alias("sql_text"))


@query("act22_batched_named_queries", """
SELECT custkey AS request_id, count(*) AS n, min(owner) AS owner FROM (
  SELECT c_custkey AS custkey, c_name AS owner FROM customer) GROUP BY custkey""")
def batched_named_queries(spark, sf):
    """A request per customer collection for its permissions: one query."""
    c = star_catalogue(spark, sf)
    homes = c.collections.where("coll_id >= 4000000000").withColumn(
        "key", F.col("coll_id") - 4000000000)
    document = F.struct(F.lit("specific").alias("operation"), F.struct(F.struct(
        F.lit("showCollAcls").alias("sql"), F.array("coll_path").alias("args"))
        .alias("specific")).alias("target"))
    answers = specific(c, requests(lines(homes, F.col("key"), document)))
    found = F.from_json("multiple", "array<struct<owner: string, zone: string, level: string>>")
    return answers.select("request_id", F.explode(found).alias("e")).groupBy("request_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("e.owner").alias("owner"))
