"""Change of permissions."""

from __future__ import annotations

from pyspark.sql import functions as F

from trovelake.operators import access
from trovelake.registry.book import query
from trovelake.registry.request_sets import lines, object_requests
from trovelake.sources.requests import requests
from trovelake.sources.tables import Tables, star_catalogue

ACL = ["subject_type", "subject_id", "owner", "owner_zone", "level"]
KEPT = """
SELECT subject_type, subject_id, owner, owner_zone, level FROM acls
WHERE NOT (subject_type = 'D' AND subject_id IN (SELECT data_id FROM objects) AND owner = {})"""


def _entry(owner, level, zone=None):
    fields = [F.lit(owner).alias("owner") if isinstance(owner, str) else owner.alias("owner"),
              F.lit(level).alias("level")]
    return F.struct(*fields, F.lit(zone).cast("string").alias("zone"))


@query("act08_chmod", KEPT.format("'public'") + """
UNION ALL SELECT 'D', data_id, 'public', 'tpch', 'write' FROM objects
UNION ALL SELECT 'D', data_id, 'auditor', 'other', 'read' FROM objects""")
def chmod(spark, sf):
    """Two entries for one owner: the later one counts."""
    asked = object_requests(spark, sf, "chmod", access=F.array(
        _entry("public", "read"), _entry("auditor#other", "READ"), _entry("public", "write")))
    changed, _ = access.chmod(star_catalogue(spark, sf), asked)
    return changed.acls.select(*ACL)


@query("act09_chmod_null", KEPT.format("'public'"))
def chmod_null(spark, sf):
    asked = object_requests(spark, sf, "chmod", access=F.array(_entry("public", "null")))
    changed, _ = access.chmod(star_catalogue(spark, sf), asked)
    return changed.acls.select(*ACL)


@query("act10_chmod_recurse", """
SELECT subject_type, subject_id, owner, owner_zone, level FROM acls
WHERE NOT (owner = 'public' AND owner_zone = 'tpch' AND subject_id IN (
  SELECT data_id FROM objects WHERE coll_path LIKE '/tpch/EUROPE/%'))
UNION ALL SELECT 'D', data_id, 'public', 'tpch', 'write' FROM objects
  WHERE coll_path LIKE '/tpch/EUROPE/%'
UNION ALL SELECT 'C', coll_id, 'public', 'tpch', 'write' FROM collections
  WHERE coll_path = '/tpch/EUROPE' OR coll_path LIKE '/tpch/EUROPE/%'
UNION ALL SELECT 'C', coll_id, 'public', 'tpch', 'read' FROM collections
  WHERE parent_path = '/tpch' AND coll_path <> '/tpch/EUROPE'""")
def chmod_recurse(spark, sf):
    """Recursive for one region, on the collection alone for the others."""
    regions = Tables(spark, sf).region
    deep = F.col("r_name") == "EUROPE"
    document = F.struct(
        F.lit("chmod").alias("operation"),
        F.struct(deep.alias("recurse")).alias("arguments"),
        F.struct(F.concat(F.lit("/tpch/"), "r_name").alias("collection"), F.array(F.struct(
            F.lit("public").alias("owner"),
            F.when(deep, "write").otherwise("read").alias("level"))).alias("access"))
        .alias("target"))
    asked = requests(lines(regions, F.col("r_regionkey"), document))
    changed, _ = access.chmod(star_catalogue(spark, sf), asked)
    return changed.acls.select(*ACL)


@query("join13_descendants", """
WITH roots AS (SELECT '/tpch/' || r_name AS root FROM region
  UNION ALL SELECT '/tpch/' || r_name || '/' || n_name FROM nation
  JOIN region ON n_regionkey = r_regionkey)
SELECT root, 'C' AS subject_type, coll_id AS subject_id FROM roots JOIN collections
  ON coll_path = root OR starts_with(coll_path, root || '/')
UNION ALL SELECT root, 'D', data_id FROM roots JOIN objects
  ON starts_with(coll_path, root || '/')""")
def descendants(spark, sf):
    c = star_catalogue(spark, sf)
    roots = c.collections.where("coll_id < 4000000000 AND coll_path <> '/tpch'").select(
        F.col("coll_path").alias("root"))
    return access.descendants(c, roots).select("root", "subject_type", "subject_id")


@query("src05_collection_acls", """
SELECT coll_path AS collection, owner, owner_zone AS zone, level FROM acls
JOIN collections ON subject_id = coll_id WHERE subject_type = 'C'""")
def collection_acls(spark, sf):
    c = star_catalogue(spark, sf)
    return c.acls.where("subject_type = 'C'").join(
        c.collections.select("coll_id", "coll_path"),
        F.col("subject_id") == F.col("coll_id")).select(
        F.col("coll_path").alias("collection"), "owner", F.col("owner_zone").alias("zone"),
        "level")
