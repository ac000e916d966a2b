"""Skew helpers against plain windows, streams against batches, snapshots."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from small import ROOT, small_catalogue
from trovelake.operators.search import search
from trovelake.plans.dispatch import dispatch_in_order
from trovelake.plans.skew import lagged, nested, numbered
from trovelake.sources.contents import export_contents, local_files
from trovelake.sources.requests import from_documents, requests, text_lines
from trovelake.sources.snapshots import current, publish, published
from trovelake.streaming.changes import last_changes
from trovelake.streaming.requests import answer, read_lines


def _skewed(spark):
    """Half of all rows in group 0."""
    return spark.range(2000).select(
        F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 7).alias("g"),
        (F.col("id") % 5).alias("a"), (F.col("id") % 11).alias("b"), "id",
        (F.xxhash64("id") % 3).alias("v"))


@pytest.mark.parametrize("hot_rows", [1, 300, 10**6])
def test_numbered_equals_window(spark, hot_rows):
    rows = _skewed(spark)
    order = ["a", "b", "id"]
    got = numbered(rows, ["g"], order, ["a", "b"], "n", hot_rows)
    want = rows.withColumn("n", F.row_number().over(W.partitionBy("g").orderBy(*order)) - 1)
    assert sorted(got.select("id", "n").collect()) == sorted(want.select("id", "n").collect())


@pytest.mark.parametrize("span", [10, 300, 10**6])
def test_lagged_equals_window(spark, span):
    rows = _skewed(spark).withColumn("tie", F.lit(0))
    got = lagged(rows, ["g"], "id", "tie", "v", "p", span)
    want = rows.withColumn("p", F.lag("v").over(W.partitionBy("g").orderBy("id")))
    assert sorted(map(str, got.select("id", "p").collect())) == sorted(
        map(str, want.select("id", "p").collect()))


def test_nested_pages_hold_everything_once(spark):
    rows = _skewed(spark).select("g", F.struct("id").alias("entry"))
    pages = nested(rows, ["g"], "all", page_rows=100).collect()
    assert max(len(p["all"]) for p in pages) < 200
    assert sorted(e.id for p in pages for e in p["all"]) == list(range(2000))
    in_group_0 = rows.where("g = 0").count()
    assert len([p for p in pages if p.g == 0]) == -(-in_group_0 // 100)


def test_stream_of_requests(spark, tmp_path):
    good = {"operation": "list", "target": {"coll": ROOT}}
    lines = [(1, json.dumps(good)), (2, "no json"), (3, json.dumps({"operation": "x"})),
             (4, '{"operation": "list", "operation": "list"}')]
    frame = spark.createDataFrame(lines, "request_id long, line string")
    frame.where("request_id < 3").coalesce(1).write.parquet(str(tmp_path / "in"))
    c = small_catalogue(spark)

    def run():
        query = answer(read_lines(spark, str(tmp_path / "in")), lambda: c,
                       str(tmp_path / "out"), str(tmp_path / "checkpoint"))
        query.awaitTermination()

    run()
    frame.where("request_id >= 3").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    run()
    rows = {r.request_id: json.loads(r.line)
            for r in spark.read.parquet(str(tmp_path / "out/responses")).collect()}
    assert set(rows) == {1, 3}
    assert rows[1]["result"] == {"single": {"collection": ROOT}}
    assert rows[3]["error"]["code"] == -1


def test_stream_of_changes_equals_batch(spark, tmp_path):
    schema = ("request_id long, ts timestamp, subject_type string, subject_id long, "
              "attribute string, value string, units string, op string")
    log = spark.range(200).select(
        F.col("id").alias("request_id"), F.timestamp_seconds((F.col("id") * 37) % 200).alias("ts"),
        F.lit("D").alias("subject_type"), (F.col("id") % 5).alias("subject_id"),
        F.lit("k").alias("attribute"), (F.col("id") % 3).cast("string").alias("value"),
        F.lit("").alias("units"), F.when(F.col("id") % 4 == 0, "rem").otherwise("add").alias("op"))
    log.repartition(4).write.parquet(str(tmp_path / "log"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(
        str(tmp_path / "log"))
    query = (last_changes(stream).writeStream.outputMode("complete").format("memory")
             .queryName("folded").trigger(availableNow=True).start())
    query.awaitTermination()
    got = sorted(map(str, spark.table("folded").collect()))
    assert got == sorted(map(str, last_changes(log).collect())) and len(got) == 15


def test_snapshot_round_trip(spark, tmp_path):
    folder, c = str(tmp_path / "catalogue"), small_catalogue(spark)
    publish(c, folder)
    stored = current(spark, folder)
    query = [{"a": "attr1", "v": "value1"}]
    assert search(stored, query, collection=ROOT).count() == 12
    publish(stored.with_tables(avus=stored.avus.where("attribute <> 'attr1'")), folder, "avus")
    assert search(current(spark, folder), query).count() == 0
    assert current(spark, folder).replicas.count() == c.replicas.count()
    plan = stored.avus.where("zone = 'zone' AND attribute = 'a'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(zone" in plan and "EqualTo(attribute,a)" in plan


def test_files_and_export(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.txt").write_bytes(b"hello")
    files = local_files(spark, str(tmp_path / "d"))
    row = files.first()
    assert row.local_path == str(tmp_path / "d" / "a.txt") and bytes(row.content) == b"hello"
    found = small_catalogue(spark).contents.withColumn("local_path", F.col("data_name"))
    export_contents(found, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 16 and back.where(F.col("coll_path") == ROOT + "/a").count() == 3


def test_a_batch_is_published_once(spark, tmp_path):
    c, folder = small_catalogue(spark), str(tmp_path / "versions")
    publish(c, folder)
    fewer = c.with_tables(avus=c.avus.where("attribute <> 'attr1'"))
    publish(fewer, folder, "avus", batch=4)
    assert published(spark, folder, 4) and not published(spark, folder, 5)
    publish(c, folder, "avus", batch=4)  # a repeat changes nothing
    assert current(spark, folder).avus.count() == fewer.avus.count()


def test_text_lines_are_numbered_in_order(spark, tmp_path):
    for name, lines in (("b", ["3", "4"]), ("a", ["1", "", "2"])):
        (tmp_path / f"{name}.txt").write_text("\n".join(lines) + "\n")
    rows = text_lines(spark, str(tmp_path)).orderBy("request_id").collect()
    assert [r.line for r in rows] == ["1", "2", "3", "4"]


def test_trigger_size_does_not_change_answers(spark, tmp_path):
    documents = [{"op": "mkdir", "target": {"coll": ROOT + "/new"}},
                 {"op": "list", "target": {"coll": ROOT + "/new"}},
                 {"op": "rmdir", "target": {"coll": ROOT + "/new"}},
                 {"op": "list", "target": {"coll": ROOT + "/new"}}]
    rows = [(i, json.dumps(d)) for i, d in enumerate(documents)]
    _, responses = dispatch_in_order(small_catalogue(spark), from_documents(spark, documents))
    together = {r.request_id: r.error and r.error.code for r in responses.collect()}
    apart, catalogue = {}, small_catalogue(spark)
    for row in rows:
        typed = requests(spark.createDataFrame([row], "request_id long, line string"))
        catalogue, responses = dispatch_in_order(catalogue, typed)
        apart |= {r.request_id: r.error and r.error.code for r in responses.collect()}
    assert together == apart == {0: None, 1: None, 2: None, 3: -310000}


def test_lagged_keeps_null_keys(spark):
    rows = spark.createDataFrame([(None, 1, 0, "a"), (None, 2, 0, "b"), ("x", 1, 0, "c")],
                                 "g string, id long, tie int, v string")
    got = lagged(rows, ["g"], "id", "tie", "v", "p", 1).select("g", "id", "p").collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [(None, 1, None), (None, 2, "a"), ("x", 1, None)], key=str)
