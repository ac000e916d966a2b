"""A catalogue over a TPC-H-like star schema and a document table.

Customers, nations and regions are collections, orders are data objects, order
lines are their replicas, line and part properties are their metadata.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trovelake.plans.skew import numbered
from trovelake.session import tune
from trovelake.sources.catalogue import COLLECTION, OBJECT, Catalogue

COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp",
    "events": "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, "
              "props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}

# Id ranges of the kinds of collection, so that ids do not meet.
ROOT_ID, REGION_IDS, NATION_IDS, CUSTOMER_IDS = 10**9, 2 * 10**9, 3 * 10**9, 4 * 10**9
DOCUMENT_IDS, LANG_IDS, SOURCE_IDS, DOCS_ROOT_ID = 5 * 10**9, 6 * 10**9, 7 * 10**9, 8 * 10**9

ZONE, DOCS_ZONE = "tpch", "docs"


class Tables:
    """The given tables, read with known schemas (no inference pass)."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = tune(spark), folder

    def __getattr__(self, name: str) -> DataFrame:
        if name not in COLUMNS:
            raise AttributeError(name)
        return self.spark.read.schema(COLUMNS[name]).parquet(f"{self.folder}/{name}.parquet")


def _text(column: str):
    return F.col(column).cast("string")


def _null(kind: str):
    return F.lit(None).cast(kind)


def collection_paths(t: Tables) -> DataFrame:
    """Customer collections: the parents of all objects."""
    return (
        t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .withColumn("parent_path", F.concat_ws("/", F.lit(""), F.lit(ZONE), "r_name", "n_name"))
        .withColumn("coll_path", F.concat_ws("/", "parent_path", "c_name"))
    )


def collections(t: Tables) -> DataFrame:
    span = t.orders.agg(F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"))
    first, last = span.select("first").scalar(), span.select("last").scalar()
    root = t.spark.range(1).select(
        F.lit(ROOT_ID).cast("bigint").alias("coll_id"), F.lit(f"/{ZONE}").alias("coll_path"),
        F.lit("/").alias("parent_path"), first.alias("created"), last.alias("modified"),
    )
    regions = t.region.select(
        (F.lit(REGION_IDS) + F.col("r_regionkey")).alias("coll_id"),
        F.concat(F.lit(f"/{ZONE}/"), "r_name").alias("coll_path"),
        F.lit(f"/{ZONE}").alias("parent_path"), first.alias("created"), last.alias("modified"),
    )
    nations = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        (F.lit(NATION_IDS) + F.col("n_nationkey")).alias("coll_id"),
        F.concat(F.lit(f"/{ZONE}/"), "r_name", F.lit("/"), "n_name").alias("coll_path"),
        F.concat(F.lit(f"/{ZONE}/"), "r_name").alias("parent_path"),
        first.alias("created"), last.alias("modified"),
    )
    spans = t.orders.groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("created"), F.max("o_orderdate").alias("modified")
    )
    customers = collection_paths(t).join(
        spans, F.col("o_custkey") == F.col("c_custkey"), "left"
    ).select(
        (F.lit(CUSTOMER_IDS) + F.col("c_custkey")).alias("coll_id"), "coll_path", "parent_path",
        "created", "modified",
    )
    every = root.unionByName(regions).unionByName(nations).unionByName(customers)
    return every.withColumn("zone", F.lit(ZONE))


def replicas(t: Tables) -> DataFrame:
    """One row per replica. Every line has an order, a customer and a supplier
    (the keys hold in the data), so lines can be numbered before the joins."""
    lines = numbered(
        t.lineitem, key=["l_orderkey"], name="repl_num",
        order=["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity",
               "l_extendedprice"],
        split=["l_linenumber", "l_partkey"],
    )
    return (
        lines.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(collection_paths(t), F.col("o_custkey") == F.col("c_custkey"))
        .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            F.col("o_orderkey").alias("data_id"),
            (F.lit(CUSTOMER_IDS) + F.col("c_custkey")).alias("coll_id"),
            "coll_path",
            F.concat(F.lit("order_"), _text("o_orderkey")).alias("data_name"),
            F.col("repl_num").cast("int").alias("repl_num"),
            F.col("l_quantity").cast("bigint").alias("size"),
            F.when(F.col("l_returnflag") == "N", _null("string"))
            .otherwise(F.md5(F.concat("l_returnflag", _text("o_orderkey")))).alias("checksum"),
            F.when(F.col("l_linestatus") == "O", "1").otherwise("0").alias("status"),
            F.concat_ws(";", "r_name", "n_name", "s_name").alias("resc_hier"),
            F.col("o_orderdate").alias("created"), F.col("l_shipdate").alias("modified"),
            F.lit(ZONE).alias("zone"),
        )
    )


def avus(t: Tables) -> DataFrame:
    """Metadata of orders with lines, of customers and of nations.

    A union of one branch per attribute: a filter on ``attribute`` folds away
    the other branches, so a search reads only what its clauses name.
    """
    lines = t.lineitem
    lined = t.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi")
    order_lines = t.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    with_parts = order_lines.join(t.part, F.col("l_partkey") == F.col("p_partkey"))

    def on_orders(rows: DataFrame, attribute: str, value, units=None) -> DataFrame:
        return rows.select(
            F.lit(OBJECT).alias("subject_type"), F.col("o_orderkey").alias("subject_id"),
            F.lit(attribute).alias("attribute"), value.alias("value"),
            (_null("string") if units is None else F.lit(units)).alias("units"),
            F.col("o_orderdate").alias("modified"),
        ).distinct()

    def on_collections(rows: DataFrame, ids, attribute: str, value: str) -> DataFrame:
        return rows.select(
            F.lit(COLLECTION).alias("subject_type"), ids.alias("subject_id"),
            F.lit(attribute).alias("attribute"), F.col(value).alias("value"),
            _null("string").alias("units"), _null("timestamp").alias("modified"),
        )

    nations = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    parts = [
        on_orders(lined, "priority", F.col("o_orderpriority")),
        on_orders(lined, "status", F.col("o_orderstatus")),
        on_orders(with_parts, "brand", F.col("p_brand")),
        on_orders(with_parts, "type", F.col("p_type")),
        on_orders(order_lines, "quantity",
                  F.col("l_quantity").cast("bigint").cast("string"), "pcs"),
        on_collections(t.customer, F.lit(CUSTOMER_IDS) + F.col("c_custkey"), "segment",
                       "c_mktsegment"),
        on_collections(nations, F.lit(NATION_IDS) + F.col("n_nationkey"), "region", "r_name"),
    ]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every.withColumn("zone", F.lit(ZONE))


def acls(t: Tables) -> DataFrame:
    owned = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))

    def entry(rows: DataFrame, kind: str, ids, owner, level: str) -> DataFrame:
        return rows.select(
            F.lit(kind).alias("subject_type"), ids.alias("subject_id"), owner.alias("owner"),
            F.lit(ZONE).alias("owner_zone"), F.lit(level).alias("level"),
            F.lit(ZONE).alias("zone"),
        )

    order_id = F.col("o_orderkey")
    return (
        entry(owned, OBJECT, order_id, F.col("c_name"), "own")
        .unionByName(entry(t.orders.where(F.col("o_orderstatus") == "F"), OBJECT, order_id,
                           F.lit("public"), "read"))
        .unionByName(entry(owned.where(F.col("o_orderstatus") == "P"), OBJECT, order_id,
                           F.col("c_mktsegment"), "write"))
        .unionByName(entry(t.customer, COLLECTION, F.lit(CUSTOMER_IDS) + F.col("c_custkey"),
                           F.col("c_name"), "own"))
    )


def resources(t: Tables) -> DataFrame:
    return t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_name").alias("name"), F.col("n_name").alias("location"),
        F.lit("unixfilesystem").alias("type"), F.lit(ZONE).alias("zone"),
    )


def contents(t: Tables) -> DataFrame:
    """Documents as content; one recorded sum in ten is wrong, one is missing."""
    last_digit = F.col("doc_id") % 10
    return t.documents.select(
        (F.lit(DOCUMENT_IDS) + F.col("doc_id")).alias("data_id"),
        F.concat(F.lit(f"/{DOCS_ZONE}/"), "source", F.lit("/"), "lang").alias("coll_path"),
        F.concat(F.lit("doc_"), _text("doc_id"), F.lit(".txt")).alias("data_name"),
        F.col("text").cast("binary").alias("content"),
        F.when(last_digit == 0, F.md5(F.concat("text", F.lit("x"))))
        .when(last_digit == 1, _null("string")).otherwise(F.md5("text")).alias("checksum"),
        F.lit(DOCS_ZONE).alias("zone"),
    )


def changes(t: Tables) -> DataFrame:
    """Metadata change log: one addition or removal per event."""
    return t.events.select(
        F.col("event_id").alias("request_id"), "ts", F.col("user_id").alias("subject_id"),
        F.lit("k").alias("attribute"),
        F.get_json_object("props", "$.k").alias("value"),
        F.when(F.col("event_type").isin("error", "signup"), "rem").otherwise("add").alias("op"),
    )


def star_catalogue(spark: SparkSession, folder: str) -> Catalogue:
    """Zone ``tpch``: orders as data objects."""
    t = Tables(spark, folder)
    return Catalogue.of(
        t.spark, collections=collections(t), replicas=replicas(t), avus=avus(t), acls=acls(t),
        resources=resources(t),
    )


def document_catalogue(spark: SparkSession, folder: str) -> Catalogue:
    """Zone ``docs``: documents as data objects with one good replica each."""
    t = Tables(spark, folder)
    docs = t.documents.select(
        (F.lit(DOCUMENT_IDS) + F.col("doc_id")).alias("data_id"), "doc_id", "source", "lang",
        F.octet_length("text").cast("bigint").alias("size"),
    )
    root, source_path = f"/{DOCS_ZONE}", F.concat(F.lit(f"/{DOCS_ZONE}/"), "source")
    lang_path = F.concat(source_path, F.lit("/"), "lang")
    first = F.min("doc_id")
    groups = (
        docs.groupBy("source", "lang").agg(first.alias("n")).select(
            (F.lit(LANG_IDS) + F.col("n")).alias("coll_id"), lang_path.alias("coll_path"),
            source_path.alias("parent_path"))
        .unionByName(docs.groupBy("source").agg(first.alias("n")).select(
            (F.lit(SOURCE_IDS) + F.col("n")).alias("coll_id"), source_path.alias("coll_path"),
            F.lit(root).alias("parent_path")))
        .unionByName(t.spark.range(1).select(
            F.lit(DOCS_ROOT_ID).cast("bigint").alias("coll_id"), F.lit(root).alias("coll_path"),
            F.lit("/").alias("parent_path")))
    )
    sums = contents(t).select("data_id", "checksum")
    labels = t.labels.select(
        (F.lit(DOCUMENT_IDS) + F.col("doc_id")).alias("subject_id"),
        F.explode(F.create_map(F.lit("quality"), _text("quality"),
                               F.lit("toxic"), _text("toxic"))).alias("attribute", "value"),
    )
    return Catalogue.of(
        t.spark,
        collections=groups.select(
            "*", _null("timestamp").alias("created"), _null("timestamp").alias("modified"),
            F.lit(DOCS_ZONE).alias("zone")),
        replicas=docs.join(sums, "data_id").select(
            "data_id", _null("bigint").alias("coll_id"), lang_path.alias("coll_path"),
            F.concat(F.lit("doc_"), _text("doc_id"), F.lit(".txt")).alias("data_name"),
            F.lit(0).alias("repl_num"), "size", "checksum", F.lit("1").alias("status"),
            _null("string").alias("resc_hier"), _null("timestamp").alias("created"),
            _null("timestamp").alias("modified"), F.lit(DOCS_ZONE).alias("zone")),
        avus=labels.select(
            F.lit(OBJECT).alias("subject_type"), "subject_id", "attribute", "value",
            _null("string").alias("units"), _null("timestamp").alias("modified"),
            F.lit(DOCS_ZONE).alias("zone")),
        contents=contents(t),
    )
