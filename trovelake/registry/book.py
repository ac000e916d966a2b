"""The book of queries, and the catalogue views in portable SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Entry:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


BOOK: dict[str, Entry] = {}

# Catalogue views in SQL, in order of dependence.
VIEWS = {
    "resources": """
SELECT s_name AS name, n_name AS location, 'unixfilesystem' AS type, 'tpch' AS zone
FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "collections": """
SELECT CAST(1000000000 AS BIGINT) AS coll_id, '/tpch' AS coll_path, '/' AS parent_path,
  'tpch' AS zone, (SELECT min(o_orderdate) FROM orders) AS created,
  (SELECT max(o_orderdate) FROM orders) AS modified
UNION ALL SELECT 2000000000 + r_regionkey, '/tpch/' || r_name, '/tpch', 'tpch',
  (SELECT min(o_orderdate) FROM orders), (SELECT max(o_orderdate) FROM orders) FROM region
UNION ALL SELECT 3000000000 + n_nationkey, '/tpch/' || r_name || '/' || n_name,
  '/tpch/' || r_name, 'tpch',
  (SELECT min(o_orderdate) FROM orders), (SELECT max(o_orderdate) FROM orders)
  FROM nation JOIN region ON n_regionkey = r_regionkey
UNION ALL SELECT 4000000000 + c_custkey, '/tpch/' || r_name || '/' || n_name || '/' || c_name,
  '/tpch/' || r_name || '/' || n_name, 'tpch', first_order, last_order
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS first_order, max(o_orderdate) AS last_order
             FROM orders GROUP BY o_custkey) t ON o_custkey = c_custkey""",
    "replicas": """
SELECT o_orderkey AS data_id, 4000000000 + c_custkey AS coll_id,
  '/tpch/' || r_name || '/' || n_name || '/' || c_name AS coll_path,
  'order_' || CAST(o_orderkey AS VARCHAR) AS data_name,
  CAST(ROW_NUMBER() OVER (PARTITION BY o_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
    l_shipdate, l_quantity, l_extendedprice) - 1 AS INTEGER) AS repl_num,
  CAST(l_quantity AS BIGINT) AS size,
  CASE WHEN l_returnflag = 'N' THEN NULL
       ELSE md5(l_returnflag || CAST(o_orderkey AS VARCHAR)) END AS checksum,
  CASE WHEN l_linestatus = 'O' THEN '1' ELSE '0' END AS status,
  r_name || ';' || n_name || ';' || s_name AS resc_hier,
  o_orderdate AS created, l_shipdate AS modified, 'tpch' AS zone
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  JOIN supplier ON l_suppkey = s_suppkey""",
    "avus": """
SELECT DISTINCT 'D' AS subject_type, o_orderkey AS subject_id, 'priority' AS attribute,
  o_orderpriority AS value, CAST(NULL AS VARCHAR) AS units, o_orderdate AS modified
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey
UNION ALL SELECT DISTINCT 'D', o_orderkey, 'status', o_orderstatus, NULL, o_orderdate
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey
UNION ALL SELECT DISTINCT 'D', o_orderkey, 'brand', p_brand, NULL, o_orderdate
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
UNION ALL SELECT DISTINCT 'D', o_orderkey, 'type', p_type, NULL, o_orderdate
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
UNION ALL SELECT DISTINCT 'D', o_orderkey, 'quantity',
  CAST(CAST(l_quantity AS BIGINT) AS VARCHAR), 'pcs', o_orderdate
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey
UNION ALL SELECT 'C', 4000000000 + c_custkey, 'segment', c_mktsegment, NULL,
  CAST(NULL AS TIMESTAMP) FROM customer
UNION ALL SELECT 'C', 3000000000 + n_nationkey, 'region', r_name, NULL, CAST(NULL AS TIMESTAMP)
  FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "acls": """
SELECT 'D' AS subject_type, o_orderkey AS subject_id, c_name AS owner, 'tpch' AS owner_zone,
  'own' AS level FROM orders JOIN customer ON o_custkey = c_custkey
UNION ALL SELECT 'D', o_orderkey, 'public', 'tpch', 'read' FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT 'D', o_orderkey, c_mktsegment, 'tpch', 'write'
  FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'P'
UNION ALL SELECT 'C', 4000000000 + c_custkey, c_name, 'tpch', 'own' FROM customer""",
    "contents": """
SELECT 5000000000 + doc_id AS data_id, '/docs/' || source || '/' || lang AS coll_path,
  'doc_' || CAST(doc_id AS VARCHAR) || '.txt' AS data_name, text AS content,
  CASE WHEN doc_id % 10 = 0 THEN md5(text || 'x') WHEN doc_id % 10 = 1 THEN NULL
       ELSE md5(text) END AS checksum FROM documents""",
    "changes": """
SELECT event_id AS request_id, ts, user_id AS subject_id, 'k' AS attribute,
  json_extract_string(props, '$.k') AS value,
  CASE WHEN event_type IN ('error', 'signup') THEN 'rem' ELSE 'add' END AS op FROM events""",
    "objects": "SELECT DISTINCT data_id, coll_path, data_name FROM replicas",
    "paths": """
SELECT 'D' AS subject_type, data_id AS subject_id, coll_path || '/' || data_name AS path,
  coll_path, data_name FROM objects
UNION ALL SELECT 'C', coll_id, coll_path, coll_path, NULL FROM collections""",
}


def with_views(sql: str) -> str:
    """Put the views a query names (and theirs) in front of it as CTEs."""
    import re

    def named(text: str) -> set[str]:
        return {v for v in VIEWS if re.search(rf"\b{v}\b", text)}

    needed, todo = set(), named(sql)
    while todo:
        needed |= todo
        todo = set().union(*[named(VIEWS[v]) for v in todo]) - needed
    ctes = [f"{v} AS ({text.strip()})" for v, text in VIEWS.items() if v in needed]
    if not ctes:
        return sql
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return "WITH " + ", ".join(ctes) + ", " + body[5:]
    return "WITH " + ", ".join(ctes) + " " + body


def query(name: str, sql: str | None = None):
    """Register a query under a name, with the SQL for its result."""

    def keep(run):
        assert name not in BOOK, name
        BOOK[name] = Entry(run, None if sql is None else with_views(sql))
        return run

    return keep
