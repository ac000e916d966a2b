"""What is sent to all executors."""

from __future__ import annotations

from pyspark.sql import functions as F

from trovelake.plans.settle import settled


def executed(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_texts_stored_beside_nested_columns_are_not_broadcast(spark):
    """The estimate of such a text is a small part of its real size."""
    nested = F.struct(*[F.array(F.lit("")).alias(f"a{i}") for i in range(40)])
    text = F.concat(*[F.md5(F.concat("id", F.lit(str(i)))) for i in range(8)])
    stored = settled(spark.range(0, 200_000, 1, 4).select(text.alias("path"), nested.alias("n")))
    other = settled(stored.select("path"))
    plan = executed(stored.select("path").join(other, "path").agg(F.count(F.lit(1))))
    assert "BroadcastHashJoin" not in plan
