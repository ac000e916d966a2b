from __future__ import annotations

import hashlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trovelake.functions import documents, levels, paths, text, times
from trovelake.sources.requests import from_documents, rejected, requests


def _cases():
    none = F.lit(None).cast("string")
    return [
        (times.format_timestamp(F.lit("01375107252")), "2013-07-29T14:14:12Z"),
        (times.parse_timestamp(F.lit("2013-07-29T14:14:12Z")), "1375107252"),
        (times.parse_timestamp(F.lit("yesterday")), None),
        (paths.zone_name(F.lit("/zone/a")), "zone"),
        (paths.zone_name(F.lit("zone/a")), None),
        (paths.base_name(F.lit("/a/b.txt")), "b.txt"),
        (paths.dir_name(F.lit("/a")), "/"),
        (paths.to_path(F.lit("/a/b/"), F.lit("c.txt")), "/a/b/c.txt"),
        (paths.to_path(F.lit("/a/b/"), none), "/a/b"),
        (paths.trim_slash(F.lit("/")), "/"),
        (paths.local_path(F.lit("/file1/path"), F.lit("file1.txt"), F.lit("o")),
         "/file1/path/file1.txt"),
        (paths.local_path(none, F.lit("file1.txt"), F.lit("o")), "./file1.txt"),
        (paths.local_path(none, none, F.lit("obj1.txt")),
         "./obj1.txt"),
        (paths.hierarchy_leaf(F.lit("foo;bar;baz")), "baz"),
        (paths.hierarchy_leaf(F.lit("baz")), "baz"),
        (paths.hierarchy_leaf(F.lit(";")), ""),
        (paths.ancestors(F.lit("/a/b")), ["/a", "/a/b"]),
        (paths.is_zone_hint(F.lit("/seq")), True),
        (paths.is_zone_hint(F.lit("/")), False),
        (paths.is_zone_hint(F.lit("/seq/a")), False),
        (levels.level_token(F.lit("READ")), "read object"),
        (levels.level_token(F.lit("all")), None),
        (levels.level_word(F.lit("modify object")), "write"),
        (levels.level_word(F.lit("other")), "other"),
        (text.parse_size(F.lit("1024")), 1024),
        (text.parse_size(F.lit("-1")), None),
        (text.content_md5(F.lit(b"")), "d41d8cd98f00b204e9800998ecf8427e"),
        (documents.replica_valid(F.lit("2")), None),
    ]


def test_values(spark):
    cases = _cases()
    row = spark.range(1).select(*[c.alias(f"c{i}") for i, (c, _) in enumerate(cases)]).first()
    assert list(row) == [want for _, want in cases]


def test_every_latin1_letter(spark):
    """All 256 code points, as bytes that are no UTF-8, come out as text."""
    rows = [(i, bytearray(bytes([0xFF, i]))) for i in range(256)]
    frame = spark.createDataFrame(rows, "i int, b binary").select(
        "i", text.maybe_utf8(F.col("b")).alias("u"), text.to_utf8(F.col("b")).alias("t"))
    for r in frame.collect():
        assert not r.u and r.t == "\xff" + chr(r.i)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(max_size=40), min_size=1, max_size=20))
def test_any_text_is_kept(spark, values):
    frame = spark.createDataFrame([(v,) for v in values], "v string").select(
        "v", text.to_utf8(F.encode("v", "UTF-8")).alias("t"),
        text.content_md5(F.encode("v", "UTF-8")).alias("m"))
    for r in frame.collect():
        assert r.t == r.v and r.m == hashlib.md5(r.v.encode()).hexdigest()


def test_request_lines(spark):
    lines = spark.createDataFrame([
        (1, '{"operation": "list", "args": {"size": true, "acl": 1}, "target": {"coll": "/a/"}}'),
        (2, '{"operation": "list", "operation": "list"}'), (3, "[1]"), (4, "plain"),
    ], "request_id long, line string")
    assert {(r.request_id, r.counts_as_error) for r in rejected(lines).collect()} == {
        (2, False), (3, True), (4, False)}
    row = requests(lines).first()
    assert row.target.collection == "/a" and row.arguments.size and not row.arguments.acl
    assert row.error is None


def test_synonyms_and_long_keys_win(spark):
    row = from_documents(spark, [
        {"coll": "/x", "collection": "/y", "obj": "o", "extra": 1,
         "time": [{"c": "2020-01-01T00:00:00", "m": "2021-01-01T00:00:00", "o": "N<"}],
         "avus": [{"a": "1", "v": "2", "u": "3"}]}], "metaquery").first()
    assert (row.target.collection, row.target.data_object) == ("/y", "o")
    span = row.target.timestamps[0]
    assert span.field == "created" and span.operator == "n<" and span.at.year == 2020
    assert row.target.avus[0].units == "3" and row.error is None
