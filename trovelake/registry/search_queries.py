"""Search conditions and single-request searches."""

from __future__ import annotations

from pyspark.sql import functions as F

from trovelake.operators.predicates import where_attribute, where_owner
from trovelake.operators.search import search
from trovelake.registry.book import query
from trovelake.sources.catalogue import access_rows
from trovelake.sources.tables import document_catalogue, star_catalogue

# Objects with some AVU that meets a condition.
OBJECTS_WITH = """
SELECT coll_path AS collection, data_name AS data_object FROM objects
WHERE data_id IN (SELECT subject_id FROM avus WHERE subject_type = 'D' AND {})"""


def _objects(spark, sf, avus, **options):
    found = search(star_catalogue(spark, sf), avus, collections=False, **options)
    return found.select("collection", "data_object", *(["size"] if options.get("size") else []))


def _clause_query(name: str, avu: dict, condition: str):
    query(name, OBJECTS_WITH.format(condition))(lambda spark, sf: _objects(spark, sf, [avu]))


_clause_query("flt01_eq", {"attribute": "brand", "value": "Brand#13"},
              "attribute = 'brand' AND value = 'Brand#13'")
_clause_query("flt02_like", {"attribute": "priority", "value": "%HI__", "operator": "like"},
              "attribute = 'priority' AND value LIKE '%HI__'")
_clause_query("flt03_not_like", {"a": "type", "v": "%A%", "o": "not like"},
              "attribute = 'type' AND value NOT LIKE '%A%'")
_clause_query("flt04_in", {"attribute": "brand", "value": ["Brand#1", "Brand#12", "none"],
                           "operator": "in"},
              "attribute = 'brand' AND value IN ('Brand#1', 'Brand#12', 'none')")
_clause_query("flt05_text_gt", {"attribute": "quantity", "value": "48", "operator": ">"},
              "attribute = 'quantity' AND value > '48'")
_clause_query("flt06_text_lt", {"attribute": "quantity", "value": "11", "operator": "<"},
              "attribute = 'quantity' AND value < '11'")
_clause_query("flt07_text_ge", {"attribute": "priority", "value": "4-", "operator": ">="},
              "attribute = 'priority' AND value >= '4-'")
_clause_query("flt08_text_le", {"attribute": "brand", "value": "Brand#10", "operator": "<="},
              "attribute = 'brand' AND value <= 'Brand#10'")
_clause_query("flt09_n_gt", {"attribute": "quantity", "value": "48", "operator": "n>"},
              "attribute = 'quantity' AND TRY_CAST(value AS DOUBLE) > 48")
_clause_query("flt10_n_lt", {"attribute": "quantity", "value": "3", "operator": "N<"},
              "attribute = 'quantity' AND TRY_CAST(value AS DOUBLE) < 3")
_clause_query("flt11_n_ge", {"attribute": "quantity", "value": "49.5", "operator": "n>="},
              "attribute = 'quantity' AND TRY_CAST(value AS DOUBLE) >= 49.5")
_clause_query("flt12_n_le", {"attribute": "quantity", "value": "2", "operator": "n<="},
              "attribute = 'quantity' AND TRY_CAST(value AS DOUBLE) <= 2")
_clause_query("flt12_n_le_on_text", {"attribute": "priority", "value": "9", "operator": "n<="},
              "attribute = 'priority' AND TRY_CAST(value AS DOUBLE) <= 9")
_clause_query("flt14_attribute_name", {"attribute": "status", "value": "F"},
              "attribute = 'status' AND value = 'F'")
_clause_query("flt15_units_ignored", {"attribute": "quantity", "value": "30", "units": "boxes"},
              "attribute = 'quantity' AND value = '30'")


@query("flt16_and_division", """
SELECT coll_path AS collection, data_name AS data_object FROM objects
WHERE data_id IN (SELECT subject_id FROM avus WHERE attribute = 'brand' AND value = 'Brand#13')
  AND data_id IN (SELECT subject_id FROM avus WHERE attribute = 'brand' AND value = 'Brand#21')
  AND data_id IN (SELECT subject_id FROM avus
                  WHERE attribute = 'quantity' AND TRY_CAST(value AS DOUBLE) >= 30)""")
def and_division(spark, sf):
    return _objects(spark, sf, [
        {"attribute": "brand", "value": "Brand#13"}, {"attribute": "brand", "value": "Brand#21"},
        {"attribute": "quantity", "value": "30", "operator": "n>="}])


@query("flt17_empty_avus", """
SELECT 'object' AS kind, coll_path AS collection, data_name AS data_object FROM objects
WHERE coll_path LIKE '/tpch/ASIA%'
UNION ALL SELECT 'collection', coll_path, NULL FROM collections
WHERE coll_path LIKE '/tpch/ASIA%'""")
def empty_avus(spark, sf):
    return search(star_catalogue(spark, sf), [], collection="/tpch/ASIA")


@query("flt18_acl", """
SELECT coll_path AS collection, data_name AS data_object FROM objects
WHERE data_id IN (SELECT subject_id FROM avus WHERE attribute = 'brand' AND value = 'Brand#7')
  AND data_id IN (SELECT subject_id FROM acls
                  WHERE subject_type = 'D' AND owner = 'BUILDING' AND level = 'write')""")
def by_permission(spark, sf):
    return _objects(spark, sf, [{"attribute": "brand", "value": "Brand#7"}],
                    access=[{"owner": "BUILDING", "level": "write"}])


@query("flt20_created", """
SELECT 'object' AS kind, coll_path AS collection, data_name AS data_object FROM objects
  WHERE data_id IN (SELECT data_id FROM replicas WHERE created >= TIMESTAMP '2001-01-01')
UNION ALL SELECT 'collection', coll_path, NULL FROM collections
  WHERE created >= TIMESTAMP '2001-01-01'""")
def by_created(spark, sf):
    return search(star_catalogue(spark, sf), [],
                  timestamps=[{"created": "2001-01-01T00:00:00", "operator": "n>="}])


@query("flt21_modified", """
SELECT DISTINCT coll_path AS collection, data_name AS data_object FROM replicas
WHERE modified < TIMESTAMP '1995-06-01'""")
def by_modified(spark, sf):
    return _objects(spark, sf, [], timestamps=[{"m": "1995-06-01T00:00:00Z", "o": "<"}])


@query("flt22_time_range", """
SELECT DISTINCT coll_path AS collection, data_name AS data_object FROM replicas
WHERE created < TIMESTAMP '1997-01-01' AND modified >= TIMESTAMP '1999-03-01'
  AND modified < TIMESTAMP '1999-03-31'""")
def by_time_range(spark, sf):
    return _objects(spark, sf, [], timestamps=[
        {"created": "1997-01-01T00:00:00Z", "operator": "n<"},
        {"modified": "1999-03-01T00:00:00Z", "operator": "n>="},
        {"modified": "1999-03-31T00:00:00Z", "operator": "n<"}])


@query("flt23_path_prefix", """
SELECT coll_path AS collection, data_name AS data_object FROM objects
WHERE coll_path LIKE '/tpch/AMERICA/NATION_1%'
  AND data_id IN (SELECT subject_id FROM avus WHERE attribute = 'status' AND value = 'P')""")
def under_prefix(spark, sf):
    return _objects(spark, sf, [{"attribute": "status", "value": "P"}],
                    collection="/tpch/AMERICA/NATION_1")


@query("flt23_path_subtree", """
SELECT coll_path AS collection, data_name AS data_object FROM objects
WHERE (coll_path = '/tpch/AMERICA/NATION_1' OR starts_with(coll_path, '/tpch/AMERICA/NATION_1/'))
  AND data_id IN (SELECT subject_id FROM avus WHERE attribute = 'status' AND value = 'P')""")
def under_subtree(spark, sf):
    return _objects(spark, sf, [{"attribute": "status", "value": "P"}],
                    collection="/tpch/AMERICA/NATION_1", scope="subtree")


@query("flt24_zone_hint", """
SELECT coll_path AS collection, data_name AS data_object FROM contents
WHERE data_id - 5000000000 IN (SELECT doc_id FROM labels WHERE quality = 1)""")
def zone_hint(spark, sf):
    both = star_catalogue(spark, sf).union(document_catalogue(spark, sf))
    return search(both, [{"attribute": "quality", "value": "1"}], collection="/docs",
                  collections=False).select("collection", "data_object")


@query("flt24_zone_argument_wins", """
SELECT coll_path AS collection, data_name AS data_object FROM objects
WHERE data_id IN (SELECT subject_id FROM avus WHERE attribute = 'type' AND value = 'PROMO')""")
def zone_argument_wins(spark, sf):
    both = star_catalogue(spark, sf).union(document_catalogue(spark, sf))
    return search(both, [{"attribute": "type", "value": "PROMO"}], collection="/docs",
                  zone="tpch", collections=False).select("collection", "data_object")


@query("flt25_good_replica", """
SELECT data_id, repl_num, size FROM replicas WHERE status = '1'""")
def good_replica(spark, sf):
    return star_catalogue(spark, sf).good_replicas().select("data_id", "repl_num", "size")


@query("flt26_good_replica_with_size", """
SELECT DISTINCT coll_path AS collection, data_name AS data_object, size FROM replicas
WHERE status = '1'
  AND data_id IN (SELECT subject_id FROM avus WHERE attribute = 'brand' AND value = 'Brand#3')""")
def good_replica_with_size(spark, sf):
    return _objects(spark, sf, [{"attribute": "brand", "value": "Brand#3"}], size=True)


@query("flt26_any_replica_without_size", """
SELECT DISTINCT coll_path AS collection, data_name AS data_object FROM replicas
WHERE data_id IN (SELECT subject_id FROM avus WHERE attribute = 'brand' AND value = 'Brand#3')""")
def any_replica_without_size(spark, sf):
    return _objects(spark, sf, [{"attribute": "brand", "value": "Brand#3"}])


@query("flt27_collections_only", """
SELECT coll_path AS collection FROM collections
WHERE coll_id IN (SELECT subject_id FROM avus WHERE subject_type = 'C'
                  AND attribute = 'segment' AND value = 'MACHINERY')""")
def collections_only(spark, sf):
    return search(star_catalogue(spark, sf), [{"attribute": "segment", "value": "MACHINERY"}],
                  objects=False).select("collection")


@query("flt27_both_kinds", """
SELECT 'collection' AS kind, coll_path AS collection, NULL AS data_object FROM collections
  WHERE created < TIMESTAMP '1995-03-01'
UNION ALL SELECT DISTINCT 'object', coll_path, data_name FROM replicas
  WHERE created < TIMESTAMP '1995-03-01'""")
def both_kinds(spark, sf):
    return search(star_catalogue(spark, sf), [],
                  timestamps=[{"created": "1995-03-01T00:00:00Z", "operator": "<"}])


@query("flt28_access_namespace", """
SELECT subject_type, subject_id, owner, level FROM acls""")
def access_namespace(spark, sf):
    """Access rows as a server keeps them: token names, several namespaces."""
    rows = star_catalogue(spark, sf).acls
    token = F.when(F.col("level") == "read", "read object").when(
        F.col("level") == "write", "modify object").otherwise(F.col("level"))
    tokens = rows.withColumn("level", token).withColumn(
        "namespace", F.explode(F.array(F.lit("access_type"), F.lit("user_type"))))
    return access_rows(tokens, F.col("namespace")).select(
        "subject_type", "subject_id", "owner", "level")


@query("flt29_list_one_attribute", """
SELECT subject_id, attribute, value, units FROM avus
WHERE subject_type = 'D' AND attribute = 'quantity'""")
def list_one_attribute(spark, sf):
    avus = star_catalogue(spark, sf).avus.where(F.col("subject_type") == "D")
    return where_attribute(avus, "quantity").select("subject_id", "attribute", "value", "units")


@query("flt30_by_user", """
SELECT subject_type, subject_id, level FROM acls WHERE owner = 'public'""")
def by_user(spark, sf):
    return where_owner(star_catalogue(spark, sf).acls, "public").select(
        "subject_type", "subject_id", "level")


@query("act04_metaquery", """
SELECT 'object' AS kind, coll_path AS collection, data_name AS data_object FROM objects
WHERE coll_path LIKE '/tpch/EUROPE/%'
  AND data_id IN (SELECT subject_id FROM avus
                  WHERE attribute = 'quantity' AND TRY_CAST(value AS DOUBLE) > 40)
  AND data_id IN (SELECT subject_id FROM avus
                  WHERE attribute = 'type' AND value IN ('PROMO', 'SMALL'))
  AND data_id IN (SELECT subject_id FROM acls WHERE owner = 'public' AND level = 'read')
  AND data_id IN (SELECT data_id FROM replicas WHERE created >= TIMESTAMP '1996-01-01'
                  AND modified < TIMESTAMP '2000-01-01')""")
def metaquery(spark, sf):
    return search(
        star_catalogue(spark, sf),
        [{"attribute": "quantity", "value": "40", "operator": "n>"},
         {"attribute": "type", "value": ["PROMO", "SMALL"], "operator": "in"}],
        access=[{"owner": "public", "level": "read"}],
        timestamps=[{"created": "1996-01-01T00:00:00Z", "operator": "n>="},
                    {"modified": "2000-01-01T00:00:00Z", "operator": "n<"}],
        collection="/tpch/EUROPE/")


@query("set01_bag_union", """
SELECT 'collection' AS kind, coll_path AS collection, NULL AS data_object FROM collections
WHERE coll_path LIKE '/tpch/AFRICA%'
UNION ALL SELECT 'object', coll_path, data_name FROM objects
WHERE coll_path LIKE '/tpch/AFRICA%'""")
def bag_union(spark, sf):
    return search(star_catalogue(spark, sf), [], collection="/tpch/AFRICA")


@query("srt03_kind_column", """
SELECT 'collection' AS kind, count(*) AS n FROM collections
UNION ALL SELECT 'object', count(*) FROM objects""")
def kind_column(spark, sf):
    return search(star_catalogue(spark, sf), []).groupBy("kind").agg(
        F.count(F.lit(1)).alias("n"))
