"""Request documents derived from the given tables, one JSON text per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trovelake.sources.requests import requests
from trovelake.sources.tables import Tables, collection_paths


def avu(attribute: str, value: Column, operator: str = "=") -> Column:
    return F.struct(F.lit(attribute).alias("attribute"), value.alias("value"),
                    F.lit(operator).alias("operator"))


def lines(rows: DataFrame, request_id: Column, document: Column) -> DataFrame:
    return rows.select(request_id.cast("bigint").alias("request_id"),
                       F.to_json(document).alias("line"))


def order_targets(spark: SparkSession, sf: str) -> DataFrame:
    """Every order with the path it has, or would have had it any lines."""
    t = Tables(spark, sf)
    return t.orders.join(collection_paths(t), F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "o_orderstatus", "o_orderpriority", "c_mktsegment",
        F.col("coll_path").alias("collection"),
        F.concat(F.lit("order_"), F.col("o_orderkey").cast("string")).alias("data_object"))


def object_requests(spark: SparkSession, sf: str, operation: str, *flags: str,
                    arguments: dict[str, Column] | None = None, where: str = "true",
                    **target: Column) -> DataFrame:
    """One enveloped request per order."""
    given = [F.lit(True).alias(f) for f in flags or ("object",)]
    given += [v.alias(k) for k, v in (arguments or {}).items()]
    document = F.struct(
        F.lit(operation).alias("operation"), F.struct(*given).alias("arguments"),
        F.struct("collection", "data_object", *[v.alias(k) for k, v in target.items()])
        .alias("target"))
    rows = order_targets(spark, sf).where(where)
    return requests(lines(rows, F.col("o_orderkey"), document))


def bare_requests(rows: DataFrame, request_id: Column, document: Column,
                  operation: str) -> DataFrame:
    """One request of a known operation per row."""
    return requests(lines(rows, request_id, document), operation)
