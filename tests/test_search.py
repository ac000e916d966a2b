from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from small import ROOT, small_catalogue
from trovelake.functions.errors import RequestError
from trovelake.operators.batch_search import batch_search
from trovelake.operators.predicates import OPERATORS, compared
from trovelake.operators.search import search
from trovelake.sources.requests import from_documents

QUERIES = [
    ({"avus": [{"attribute": "attr1", "value": "value1"}], "collection": ROOT}, 12),
    ({"avus": [{"a": "attr1", "v": "value1"}], "coll": ROOT + "/a/x/m"}, 3),
    ({"avus": [{"attribute": "attr1", "value": "value1"}],
      "access": [{"owner": "test", "level": "OWN"}]}, 12),
    ({"avus": [{"attribute": "attr1", "value": "value1"}],
      "access": [{"owner": "public", "level": "read"}]}, 0),
    ({"avus": [{"attribute": "attr2", "value": "value2"}], "collection": ROOT}, 3),
    ({"avus": [{"a": "a", "v": "x"}, {"a": "a", "v": "y"}]}, 1),
    ({"avus": [{"a": "b", "v": "x"}, {"a": "b", "v": "y"}, {"a": "b", "v": "z"}]}, 1),
    ({"avus": [{"a": "b", "v": "x"}, {"a": "b", "v": "none"}]}, 0),
    ({"avus": [], "timestamps": [{"created": "2020-01-01T00:00:00Z", "operator": "n<"}]}, 0),
    ({"avus": [], "timestamps": [{"created": "2020-01-01T00:00:00", "operator": "n>="}]}, 22),
    ({"avus": [], "collection": "/zone"}, 22),
    ({"avus": [], "collection": "/other"}, 0),
    ({"avus": [], "collection": ROOT + "/a/"}, 12),
    ({"avus": [], "collection": ROOT + "/_/x"}, 8),
    ({"avus": [], "collection": "/z%/a/x"}, 8),
    ({"avus": [], "collection": ROOT, "data_object": "f1.txt"}, 22),
    ({"avus": [{"a": "numattr1", "v": ["10", "7"], "o": "in"}]}, 1),
    ({"avus": [{"a": "numattr1", "v": "99", "o": "n>"}, {"a": "a", "v": "_", "o": "like"}]}, 1),
]


def _single(catalogue, query, scope="prefix"):
    named = "data_object" in query or "obj" in query
    root = None if named else query.get("collection", query.get("coll"))
    return search(catalogue, query["avus"], query.get("access"), query.get("timestamps", ()),
                  root, scope=scope)


@pytest.mark.parametrize("query, n", QUERIES)
def test_counts(spark, query, n):
    assert _single(small_catalogue(spark), query).count() == n


@pytest.mark.parametrize("scope", ["prefix", "subtree"])
def test_batch_equals_single(spark, scope):
    catalogue = small_catalogue(spark).with_tables()
    requests = from_documents(spark, [q for q, _ in QUERIES], "metaquery")
    assert requests.where("error is not null").count() == 0
    got = batch_search(catalogue, requests, scope=scope).select(
        "request_id", "kind", "collection", "data_object").collect()
    for i, (query, _) in enumerate(QUERIES):
        want = sorted(map(repr, (tuple(r) for r in _single(catalogue, query, scope).collect())))
        assert sorted(repr(tuple(r)[1:]) for r in got if r.request_id == i) == want, query


def test_all_operators_run(spark):
    catalogue = small_catalogue(spark)
    expected = {"=": 1, "like": 1, "not like": 1, "in": 1, ">": 1, "<": 1, "n>": 1, "n<": 1,
                ">=": 1, "<=": 1, "n>=": 1, "n<=": 1}
    queries = [{"avus": [{"a": "numattr1", "v": ["10"] if op == "in" else "10", "o": op}]}
               for op in OPERATORS]
    assert {op: _single(catalogue, q).count() for op, q in zip(OPERATORS, queries)} == expected
    batch = batch_search(catalogue, from_documents(spark, queries, "metaquery"))
    assert batch.groupBy("request_id").count().where("count = 1").count() == 12


@pytest.mark.parametrize("arguments", [
    {"avus": None},
    {"avus": [{"a": "x", "v": "y", "o": "~"}]},
    {"avus": [{"a": "x", "v": "y", "o": "in"}]},
    {"avus": [{"a": "x", "v": 5}]},
    {"avus": [{"v": "y"}]},
    {"avus": [], "access": [{"owner": "a", "level": "own"}, {"owner": "b", "level": "own"}]},
    {"avus": [], "access": [{"owner": "a", "level": "all"}]},
    {"avus": [], "timestamps": [{"x": "2020-01-01T00:00:00Z"}]},
    {"avus": [], "timestamps": [{"c": "2020-01-01T00:00:00Z", "o": "like"}]},
    {"avus": [], "collection": "relative/path"},
])
def test_invalid_searches(spark, arguments):
    with pytest.raises(RequestError):
        search(small_catalogue(spark), **arguments)
    document = {k: v for k, v in arguments.items() if v is not None}
    row = from_documents(spark, [document], "metaquery").select("error").first()
    assert row.error is not None and row.error.code < 0


def test_envelope_without_kind_finds_nothing(spark):
    catalogue = small_catalogue(spark)
    target = {"avus": [{"a": "attr1", "v": "value1"}]}
    both = from_documents(spark, [
        {"operation": "metaquery", "target": target},
        {"op": "metaquery", "args": {"object": True, "size": True}, "target": target}])
    rows = batch_search(catalogue, both).collect()
    assert {r.request_id for r in rows} == {1} and len(rows) == 12
    assert all(r.size == 0 for r in rows)


@pytest.mark.parametrize("operator, value, wanted, holds", [
    ("n>", "NaN", "5", False), ("n>=", "5d", "5", False), ("n>", " 7 ", "5", True),
    ("n>", "9007199254740993", "9007199254740992", True), ("n<", "1e2", "101", True),
    ("n<", "-.5", "0", True), ("n<=", "", "0", False)])
def test_numbers_are_plain_and_exact(spark, operator, value, wanted, holds):
    row = spark.range(1).select(F.coalesce(
        compared(operator, F.lit(value), F.lit(wanted)), F.lit(False)).alias("x")).first()
    assert row.x is holds
