"""Where and how documents are taken apart."""

from __future__ import annotations

import re

from trovelake.sources.requests import requests


def test_documents_are_taken_apart_in_projections(spark):
    """A generator interprets what it computes."""
    lines = spark.createDataFrame(
        [(1, '{"op": "list", "args": {"size": true}, "target": {"coll": "/a"}}')],
        "request_id long, line string")
    asked = requests(lines)
    plan = asked._jdf.queryExecution().optimizedPlan().toString()
    made = re.findall(r"Generate explode\((.*?)\), \[", plan)
    assert made and all(re.fullmatch(r"array\(\w+ made once#\d+\)", m) for m in made)
    row = asked.collect()[0]
    assert row.arguments.size and not row.arguments.acl and row.target.collection == "/a"


def test_a_null_member_hides_its_short_form(spark):
    lines = spark.createDataFrame([
        (1, '{"operation": null, "op": "list", "target": {"coll": "/a"}}'),
        (2, '{"op": "list", "args": {"size": "true", "acl": 1}, "target": {"coll": "/a"}}'),
        (3, '{"op": "list", "target": {"collection": 5, "coll": "/a"}}'),
        (4, '{"op": "metaquery", "target": {"avus": [7, {"a": "k", "v": ["x"], "o": "in"}]}}'),
    ], "request_id long, line string")
    rows = {r.request_id: r for r in requests(lines).collect()}
    assert rows[1].operation is None and rows[1].error.message == "the request names no operation"
    assert not rows[2].arguments.size and not rows[2].arguments.acl and rows[2].error is None
    assert rows[3].error.message == "'collection' has to be a text"
    assert [a.is_object for a in rows[4].target.avus] == [False, True]
    assert rows[4].target.avus[1]["values"] == ["x"]
