"""Touches that meet at a collection above very many of them."""

from __future__ import annotations

from pyspark.sql import functions as F

from trovelake.plans.levels import chains, levels, touches
from trovelake.plans.settle import settled
from trovelake.plans.skew import with_key_in
from trovelake.sources.requests import from_documents


def test_touches_of_a_hot_collection_are_not_gathered_in_one_task(spark):
    """All requests are below the root; looked up there, they stay where they are."""
    documents = [{"op": op, "target": {"coll": f"/zone/c{i}"}}
                 for i in range(30) for op in ("mkdir", "rmdir")]
    asked = settled(from_documents(spark, documents))
    key = ["chain", "key", "request_id", "class"]
    want = sorted(map(tuple, chains(touches(asked)).select(*key).collect()))
    few = chains(touches(asked), 10)
    assert sorted(map(tuple, few.select(*key).collect())) == want
    got = {r.request_id: r.level for r in levels(asked, 10).collect()}
    assert [got[i] for i in range(60)] == [0, 1] * 30
    rows = spark.range(1000).select((F.col("id") % 2).alias("k"), "id")
    kept = with_key_in(rows, spark.createDataFrame([(1,), (5,)], "k long"), ["k"], 100)
    assert sorted(r.id for r in kept.collect()) == list(range(1, 1000, 2))
