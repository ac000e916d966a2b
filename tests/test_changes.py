from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from small import ROOT, small_catalogue
from trovelake.operators import access, metadata, transfer, tree
from trovelake.plans.dispatch import dispatch, dispatch_in_order, response_lines
from trovelake.sources.requests import from_documents

F1 = {"collection": ROOT, "data_object": "f1.txt"}


def _avus(catalogue, path_id):
    rows = catalogue.avus.where((F.col("subject_id") == path_id) & (F.col("subject_type") == "D"))
    return sorted((r.attribute, r.value, r.units) for r in rows.collect())


def _errors(responses):
    return {r.request_id: r.error and r.error.code for r in responses.collect()}


def _metamod(spark, catalogue, *steps):
    documents = [{"operation": "metamod", "arguments": {"operation": op},
                  "target": {**F1, "avus": avus}} for op, avus in steps]
    return metadata.metamod(catalogue, from_documents(spark, documents))


def test_add_and_remove(spark):
    new, same = {"a": "n", "v": "1"}, {"a": "attr1", "v": "value1", "u": "units1"}
    after, responses = _metamod(
        spark, small_catalogue(spark), ("add", [new]), ("add", [new]), ("add", [same]),
        ("remove", [{**same, "u": "other"}]), ("rem", [same]), ("rem", [same]),
        ("add", [{"a": "", "v": "1"}]), ("add", [{"a": "x"}]))
    codes = _errors(responses)
    assert codes == {0: None, 1: -809000, 2: -809000, 3: -819000, 4: None, 5: -819000,
                     6: -816000, 7: -816000}
    assert _avus(after, 1) == [("n", "1", None)]


def test_supersede_twice_is_once(spark):
    target = {**F1, "avus": [{"a": "attr1", "v": "value1", "u": "units1"}, {"a": "b", "v": "c"}]}
    requests = from_documents(spark, [target, {**F1, "avus": 1}], "supersede")
    once, responses = metadata.supersede(small_catalogue(spark), requests)
    assert _errors(responses) == {0: None, 1: -816000}
    twice, _ = metadata.supersede(once, requests)
    assert _avus(once, 1) == _avus(twice, 1) == [
        ("attr1", "value1", "units1"), ("b", "c", None)]
    assert once.avus.count() == small_catalogue(spark).avus.count() + 1


def test_chmod(spark):
    def documents(arguments, *targets):
        return from_documents(spark, [
            {"operation": "chmod", "arguments": arguments, "target": t} for t in targets])

    def entries(catalogue, owner):
        return {(r.subject_type, r.subject_id, r.owner_zone, r.level)
                for r in catalogue.acls.where(F.col("owner") == owner).collect()}

    grant = [{"owner": "public", "level": "write"}, {"owner": "public", "level": "READ"},
             {"owner": "other#far", "level": "own"}]
    after, responses = access.chmod(small_catalogue(spark), documents(
        {}, {**F1, "access": grant}, {**F1, "access": [{"owner": "x", "level": "all"}]}, F1))
    assert _errors(responses) == {0: None, 1: -816000, 2: -1}
    assert entries(after, "public") == {("D", 1, "zone", "read")}
    assert entries(after, "other") == {("D", 1, "far", "own")}
    gone, _ = access.chmod(after, documents(
        {}, {**F1, "access": [{"owner": "public", "zone": "zone", "level": "null"}]}))
    assert entries(gone, "public") == set()
    deep, _ = access.chmod(small_catalogue(spark), documents(
        {"recurse": True}, {"coll": ROOT + "/a/x", "access": grant[:1]}))
    assert {(t, i) for t, i, _, _ in entries(deep, "public")} == {
        ("C", 1002), ("C", 1003), *[("D", i) for i in range(7, 13)]}


def _tree(catalogue):
    return ({r.coll_path: r.coll_id for r in catalogue.collections.collect()},
            {(r.coll_path, r.data_name) for r in catalogue.replicas.collect()})


def _ask(spark, operation, *targets, **arguments):
    return from_documents(spark, [
        {"operation": operation, "arguments": arguments, "target": t} for t in targets])


def test_move_and_back(spark):
    c = small_catalogue(spark)
    there, responses = tree.move(
        c, _ask(spark, "move", {"coll": ROOT + "/a/x"}, path=ROOT + "/b/y"))
    assert _errors(responses) == {0: None}
    collections, objects = _tree(there)
    assert ROOT + "/b/y/m" in collections and ROOT + "/a/x" not in collections
    assert (ROOT + "/b/y/m", "f10.txt") in objects
    back, _ = tree.move(there, _ask(spark, "move", {"coll": ROOT + "/b/y"}, path=ROOT + "/a/x"))
    assert _tree(back) == _tree(c)
    renamed, _ = tree.move(c, _ask(spark, "move", F1, path=ROOT + "/c/g.txt"))
    assert (ROOT + "/c", "g.txt") in _tree(renamed)[1]
    for path, code in [(ROOT + "/b", -809000), ("/no/where", -814000),
                       (ROOT + "/a/x/in", -814000), ("", -816000)]:
        _, responses = tree.move(c, _ask(spark, "move", {"coll": ROOT + "/a/x"}, path=path))
        assert _errors(responses) == {0: code}, path


def test_remove_objects(spark):
    after, responses = tree.remove(small_catalogue(spark), _ask(
        spark, "remove", F1, {"coll": ROOT + "/a"}, {"coll": ROOT, "obj": "none"}))
    assert _errors(responses) == {0: None, 1: -816000, 2: -310000}
    assert (ROOT, "f1.txt") not in _tree(after)[1]
    assert _avus(after, 1) == [] and after.acls.where("subject_id = 1").count() == 0
    assert after.contents.where("data_id = 1").count() == 0


def test_mkdir_and_rmdir(spark):
    c = small_catalogue(spark)
    plain, responses = tree.mkdir(c, _ask(
        spark, "mkdir", {"coll": ROOT + "/d"}, {"coll": ROOT + "/d/e/"}, {"coll": ROOT + "/q/r"},
        {"coll": ROOT + "/a"}, F1))
    assert _errors(responses) == {0: None, 1: None, 2: -814000, 3: -809000, 4: -816000}
    made = _tree(plain)[0]
    assert ROOT + "/d/e" in made and ROOT + "/q/r" not in made
    assert len(set(made.values())) == len(made)
    deep, responses = tree.mkdir(c, _ask(
        spark, "mkdir", {"coll": ROOT + "/q/r/s"}, {"coll": ROOT + "/a"}, recurse=True))
    assert _errors(responses) == {0: None, 1: None}
    assert {ROOT + "/q", ROOT + "/q/r", ROOT + "/q/r/s"} <= set(_tree(deep)[0])
    left, responses = tree.rmdir(c, _ask(
        spark, "rmdir", {"coll": ROOT + "/b"}, {"coll": ROOT + "/a/x"}))
    assert _errors(responses) == {0: None, 1: -821000} and ROOT + "/b" not in _tree(left)[0]
    none, _ = tree.rmdir(c, _ask(spark, "rmdir", {"coll": ROOT + "/a/x"}, recurse=True))
    assert len(_tree(none)[0]) == 4 and len(_tree(none)[1]) == 10


def _sum(catalogue, name):
    return {r.checksum for r in catalogue.replicas.where(F.col("data_name") == name).collect()}


def test_checksum(spark):
    c = small_catalogue(spark)
    wrong = c.with_tables(**{n: c.tables()[n].withColumn("checksum", F.lit("0"))
                             for n in ("replicas", "contents")})
    for flags, code, recorded in [({}, None, "0"), ({"force": True}, None, "d41d8cd98f00b204e980"
                                                    "0998ecf8427e"),
                                  ({"verify": True}, -314000, "0"),
                                  ({"verify": True, "checksum": True}, -318000, "0")]:
        after, responses = transfer.checksum(wrong, _ask(spark, "checksum", F1, **flags))
        assert _errors(responses) == {0: code} and _sum(after, "f1.txt") == {recorded}
    _, responses = transfer.checksum(c, _ask(
        spark, "checksum", F1, {"coll": ROOT + "/a"}, verify=True))
    assert _errors(responses) == {0: None, 1: -816000}


def test_get(spark):
    c = small_catalogue(spark)
    binary = c.contents.withColumn("content", F.when(
        F.col("data_name") == "f1.txt", F.unhex(F.lit("FF"))).otherwise(F.col("content")))
    c = c.with_tables(contents=binary)
    rows = {r.request_id: r for r in transfer.get(c, _ask(
        spark, "get", {"coll": ROOT, "obj": "lorem_1k.txt"}, F1, {"coll": ROOT, "obj": "no"},
        size=True)).collect()}
    assert json.loads(rows[0].single) == {
        "collection": ROOT, "data_object": "lorem_1k.txt", "size": 1024, "data": "x" * 1024}
    assert rows[1].error.code == -317000 and rows[2].error.code == -310000
    fetched = transfer.fetched(c, _ask(
        spark, "get", {**F1, "dir": "/tmp/d"}, save=True)).first()
    assert fetched.error is None and fetched.local_path == "/tmp/d/f1.txt"
    assert fetched.checksum_ok is False


def test_put(spark):
    c = small_catalogue(spark)
    files = spark.createDataFrame(
        [("./f1.txt", bytearray(b"new")), ("/l/x.txt", bytearray(b"file"))],
        "local_path string, content binary")
    new = {"coll": ROOT + "/b", "obj": "y.txt", "directory": "/l", "file": "x.txt"}
    after, responses = transfer.put(c, _ask(
        spark, "put", F1, new, {"coll": ROOT, "obj": "none.txt"},
        {**new, "coll": "/none"}, checksum=True), files)
    assert _errors(responses) == {0: None, 1: None, 2: -310000, 3: -814000}
    rows = after.replicas.where("data_name = 'f1.txt'").orderBy("repl_num").collect()
    assert [(r.size, r.status, r.data_id) for r in rows] == [(3, "1", 1), (0, "0", 1)]
    made = after.replicas.where("data_name = 'y.txt'").collect()
    assert len(made) == 1 and made[0].checksum == "8c7dd922ad47494fc02c388e12c00eac"
    twice, _ = transfer.put(after, _ask(spark, "put", F1, new, checksum=True), files)
    assert twice.contents.count() == after.contents.count() == c.contents.count() + 1
    for supplied, code in [("0", -314000), ("22AF645D1859CB5CA6DA0C484F1F37EA", None)]:
        _, responses = transfer.put(c, _ask(
            spark, "put", {**F1, "checksum": supplied}, verify=True), files)
        assert _errors(responses) == {0: code}
    _, responses = transfer.put(c, _ask(spark, "put", F1, verify=True, checksum=True), files)
    assert _errors(responses) == {0: -318000}


@pytest.fixture(scope="module")
def mixed(spark):
    avu = {"a": "k", "v": "1"}
    query = {"operation": "metaquery", "arguments": {"object": True}, "target": {"avus": [avu]}}
    return from_documents(spark, [
        query,
        {"operation": "metamod", "arguments": {"operation": "add"},
         "target": {**F1, "avus": [avu]}},
        query,
        {"operation": "specific", "target": {"specific": {
            "sql": "findQueryByAlias", "args": ["dataModifiedIdOnly"]}}},
        {"operation": "specific", "target": {"specific": {"sql": "unknown"}}},
        {"operation": "fly", "target": F1},
        {"operation": "list", "target": F1},
        {"target": F1},
    ])


def test_dispatch(spark, mixed):
    _, responses = dispatch(small_catalogue(spark), mixed)
    rows = {r.request_id: r for r in responses.collect()}
    assert len(rows) == 8
    assert json.loads(rows[0].multiple) == json.loads(rows[2].multiple) == []
    named = json.loads(rows[3].multiple)
    assert len(named) == 1 and named[0]["alias"] == "dataModifiedIdOnly"
    assert {i: rows[i].error.code for i in (4, 5, 7)} == {4: -1, 5: -1, 7: -1}
    lines = {r.request_id: json.loads(r.line) for r in response_lines(responses, mixed).collect()}
    assert lines[1]["arguments"] == {"operation": "add"}
    assert lines[6] == {"operation": "list", "result": {"single": F1}, "target": F1}
    assert set(lines[5]) == {"error", "operation", "target"}


def test_dispatch_in_order_sees_changes(spark, mixed):
    after, responses = dispatch_in_order(small_catalogue(spark), mixed.where("request_id < 3"))
    rows = {r.request_id: r for r in responses.collect()}
    assert json.loads(rows[0].multiple) == []
    assert json.loads(rows[2].multiple) == [F1]
    assert ("k", "1", None) in _avus(after, 1)


def test_conflicting_moves(spark):
    """The first move of an item, and to a path, counts."""
    c = small_catalogue(spark)
    other = {"coll": ROOT, "obj": "f2.txt"}
    asked = from_documents(spark, [
        {"op": "move", "args": {"path": path}, "target": t} for t, path in [
            (F1, ROOT + "/c/a.txt"), (F1, ROOT + "/c/b.txt"), (other, ROOT + "/c/a.txt")]])
    after, responses = tree.move(c, asked)
    assert _errors(responses) == {0: None, 1: -310000, 2: -809000}
    assert after.replicas.count() == c.replicas.count()
    assert after.replicas.groupBy("coll_path", "data_name", "repl_num").count().where(
        "count > 1").isEmpty()


def test_metamod_stops_at_its_first_failure(spark):
    """What a request no longer does can let a later one succeed."""
    same = {"a": "attr1", "v": "value1", "u": "units1"}
    n1, n2 = {"a": "n1", "v": "1"}, {"a": "n2", "v": "2"}
    after, responses = _metamod(spark, small_catalogue(spark), ("add", [n1, same, n2]),
                                ("add", [n2]), ("rem", [n2, n1]))
    assert _errors(responses) == {0: -809000, 1: None, 2: None}
    assert _avus(after, 1) == [("attr1", "value1", "units1")]
    bare = from_documents(spark, [{**F1, "avus": [same]}], "metamod")
    after, responses = metadata.metamod(small_catalogue(spark), bare)
    assert _errors(responses) == {0: -1} and len(_avus(after, 1)) == 1


def test_bad_requests_do_not_end_a_batch(spark):
    def find(operator, value, **target):
        return {"op": "metaquery", "args": {"object": True},
                "target": {"avus": [{"a": "attr1", "o": operator, "v": value}], **target}}

    def named(sql, *args):
        return {"op": "specific", "target": {"specific": {"sql": sql, "args": list(args)}}}

    asked = from_documents(spark, [
        find("like", "odd\\"), find("like", "a\\b%"), find("=", "value1", coll=ROOT + "\\x"),
        named("SELECT 1"), named("SELECT * FROM nowhere"), named("dataModifiedIdOnly"),
        named("dataModifiedIdOnly", "x", "y"), find("like", "value_")])
    _, responses = dispatch(small_catalogue(spark), asked)
    rows = {r.request_id: r for r in responses.collect()}
    assert {i: r.error and r.error.code for i, r in rows.items()} == {
        0: None, 1: None, 2: None, 3: -1, 4: -1, 5: -1, 6: -1, 7: None}
    assert json.loads(rows[0].multiple) == json.loads(rows[2].multiple) == []
    assert len(json.loads(rows[7].multiple)) == 12
