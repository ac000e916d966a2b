from __future__ import annotations

import json

from pyspark.sql import functions as F

from small import ROOT, small_catalogue
from trovelake.operators.listing import list_paths
from trovelake.operators.metaquery import metaquery
from trovelake.sources.requests import from_documents

OWN = [{"owner": "test", "zone": "zone", "level": "own"}]
EMPTY_MD5 = "d41d8cd98f00b204e9800998ecf8427e"


def _list(spark, catalogue, target, **arguments):
    requests = from_documents(
        spark, [{"operation": "list", "arguments": arguments, "target": target}])
    rows = list_paths(catalogue, requests).collect()
    assert len(rows) == 1
    return rows[0].error or json.loads(rows[0].single)


def test_plain_paths(spark):
    targets = [{"coll": ROOT + "/"}, {"coll": ROOT, "obj": "f1.txt"},
               {"coll": ROOT, "obj": "none"}, {"coll": "x"}, {"collection": ROOT + "/f1.txt"}]
    rows = list_paths(small_catalogue(spark), from_documents(spark, targets, "list"))
    rows = {r.request_id: r for r in rows.collect()}
    f1 = {"collection": ROOT, "data_object": "f1.txt"}
    assert json.loads(rows[0].single) == {"collection": ROOT}
    assert json.loads(rows[1].single) == json.loads(rows[4].single) == f1
    assert rows[2].error.code == -310000 and rows[3].error.code == -816000


def test_object_with_everything(spark):
    got = _list(spark, small_catalogue(spark), {"coll": ROOT, "obj": "r1.txt"}, acl=True,
                avu=True, checksum=True, size=True, timestamp=True, replicate=True)
    assert got["access"] == OWN and got["size"] == 0 and got["checksum"] == EMPTY_MD5
    assert {"attribute": "b", "value": "z"} in got["avus"] and len(got["avus"]) == 8
    at = "2020-01-02T00:00:00Z"
    assert got["timestamps"] == [
        {"created": at, "replicates": 0}, {"modified": at, "replicates": 0},
        {"created": at, "replicates": 1}, {"modified": at, "replicates": 1}]
    assert got["replicates"] == [
        {"checksum": EMPTY_MD5, "location": f"host{n}", "number": n, "resource": f"leaf{n}",
         "valid": True} for n in (0, 1)]


def test_contents_objects_first(spark):
    got = _list(spark, small_catalogue(spark), {"coll": ROOT}, acl=True, checksum=True,
                contents=True, size=True, timestamp=True)
    assert got["access"] == OWN and got["timestamps"] == [] and "checksum" not in got
    names = [i.get("data_object", i["collection"]) for i in got["contents"]]
    assert names == ["f1.txt", "f2.txt", "f3.txt", "lorem_10k.txt", "lorem_1b.txt",
                     "lorem_1k.txt", "r1.txt", ROOT + "/a", ROOT + "/b", ROOT + "/c"]
    first = dict(got["contents"][0])
    assert len(first.pop("timestamps")) == 4
    assert first == {"access": OWN, "checksum": EMPTY_MD5, "collection": ROOT,
                     "data_object": "f1.txt", "size": 0}
    assert got["contents"][3]["size"] == 10240
    assert got["contents"][7] == {"access": OWN, "collection": ROOT + "/a", "timestamps": []}


def test_checksum_conflict_and_stale_replica(spark):
    c = small_catalogue(spark)
    second = (F.col("data_name") == "f1.txt") & (F.col("repl_num") == 1)
    other = c.replicas.withColumn("checksum", F.when(second, "0").otherwise(F.col("checksum")))
    target = {"coll": ROOT, "obj": "f1.txt"}
    conflict = _list(spark, c.with_tables(replicas=other), target, checksum=True)
    assert conflict.code == -1 and "found 2" in conflict.message
    stale = other.withColumn("status", F.when(second, "0").otherwise(F.col("status")))
    got = _list(spark, c.with_tables(replicas=stale), target, checksum=True, replicate=True)
    assert got["checksum"] == EMPTY_MD5
    assert [r["valid"] for r in got["replicates"]] == [True, False]
    none = c.replicas.withColumn("checksum", F.lit(None).cast("string"))
    got = _list(spark, c.with_tables(replicas=none), target, checksum=True)
    assert "checksum" in got and got["checksum"] is None


def test_unknown_resource_is_an_error(spark):
    c = small_catalogue(spark)
    lost = c.with_tables(resources=c.resources.where("name = 'leaf0'"))
    got = _list(spark, lost, {"coll": ROOT, "obj": "f1.txt"}, replicate=True)
    assert "Expected 1 resource result but found 0" in got.message


def test_metaquery_documents_on_pages(spark):
    c = small_catalogue(spark)
    requests = from_documents(spark, [
        {"op": "metaquery", "args": {"object": True, "avu": True},
         "target": {"avus": [{"a": "attr1", "v": "value1"}]}},
        {"op": "metaquery", "args": {"object": True}, "target": {"avus": [{"a": "a", "v": "q"}]}},
        {"op": "metaquery", "args": {"object": True}, "target": {}},
        {"op": "metaquery", "args": {"object": True, "avu": True},
         "target": {"avus": [{"a": "a", "v": "x"}]}},
    ])
    for page_rows in (10_000, 3):
        rows = metaquery(c, requests, page_rows=page_rows).collect()
        found = {i: [] for i in range(4)}
        for r in rows:
            found[r.request_id] += json.loads(r.multiple or "[]")
        assert len(found[0]) == 12 and not found[1] and not found[2]
        assert all(i["avus"] == [{"attribute": "attr1", "value": "value1", "units": "units1"}]
                   for i in found[0])
        assert sum(len(i["avus"]) for i in found[3]) == 8
        assert {i["data_object"] for i in found[3]} == {"r1.txt"}
        assert [r.error.code for r in rows if r.request_id == 2] == [-816000]
        pages = [r.page for r in rows if r.request_id == 0]
        assert len(pages) == 1 if page_rows > 12 else len(pages) > 1
