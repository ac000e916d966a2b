"""Levels of conflicting requests against the strict sequence, change files,
batches of named queries, ordered pages."""

from __future__ import annotations

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from small import ROOT, small_catalogue
from trovelake.operators import access, listing, metadata
from trovelake.plans import dispatch as dispatching
from trovelake.plans.dispatch import dispatch, dispatch_in_order
from trovelake.plans.levels import chains, levels, touches
from trovelake.plans.settle import settled, settling
from trovelake.plans.skew import paged, positioned, running
from trovelake.session import shared_folder
from trovelake.sources import snapshots
from trovelake.sources.changes import DROP, PUT, SET, folded, merged
from trovelake.sources.requests import from_documents


def mod(op, a, *, coll=ROOT, obj=None, value="1"):
    target = {"coll": coll, "avus": [{"a": a, "v": value}]}
    return {"op": "metamod", "args": {"operation": op},
            "target": target if obj is None else {**target, "obj": obj}}


def one(op, coll, obj=None, **args):
    target = {"coll": coll} if obj is None else {"coll": coll, "obj": obj}
    return {"op": op, "args": args, "target": target}


def find(a, coll=None):
    target = {"avus": [{"a": a, "v": "1"}]}
    return {"op": "metaquery", "args": {"object": True, "collection": True},
            "target": target if coll is None else {**target, "coll": coll}}


def levels_of(spark, documents, span=10**6):
    rows = levels(from_documents(spark, documents), span).collect()
    return [r.level for r in sorted(rows, key=lambda r: r.request_id)]


def random_requests(seed, n):
    rng = random.Random(seed)
    folders = [ROOT + f for f in ("", "/a", "/a/x", "/a/x/m", "/b", "/c", "/d", "/d/e", "/q/r")]
    names = ["f1.txt", "f4.txt", "f7.txt", "f10.txt", "new.txt"]
    out = []
    for _ in range(n):
        coll, name, a = rng.choice(folders), rng.choice(names), rng.choice("kl")
        out.append(rng.choice([
            mod("add", a, coll=coll, obj=name), mod("rem", a, coll=coll, obj=name),
            mod("add", a, coll=coll), one("list", coll, name, avu=True),
            one("list", coll, contents=True), one("list", coll, avu=True, acl=True),
            one("mkdir", coll), one("mkdir", coll, recurse=True), one("rmdir", coll),
            one("remove", coll, name),
            one("move", coll, name, path=rng.choice(folders) + "/" + rng.choice(names)),
            one("move", coll, path=rng.choice(folders) + "/z"), find(a), find(a, rng.choice(folders)),
            {"op": "chmod", "args": {"recurse": rng.random() < 0.5}, "target": {
                "coll": coll, "access": [{"owner": "o", "level": rng.choice(["read", "null"])}]}},
            {"op": "supersede", "target": {"coll": coll, "obj": name,
                                           "avus": [{"a": a, "v": "1"}]}},
        ]))
    return out


def closed_form(documents, touched):
    """Levels by comparing all earlier requests, one by one."""
    by = {}
    for t in touched:
        by.setdefault(t.request_id, []).append(t)

    def inside(p, q):
        return q == "/" or p == q or p.startswith(q + "/")

    out = []
    for i in range(len(documents)):
        level = 0
        for j in range(i):
            for s in by.get(i, []):
                for t in by.get(j, []):
                    meet = s.path == t.path or (s.deep and inside(t.path, s.path)) or (
                        t.deep and inside(s.path, t.path))
                    if not meet or (s.change is None and t.change is None):
                        continue
                    same = s.change == t.change and s.path == t.path
                    level = max(level, out[j] if same else out[j] + 1)
        out.append(level)
    return out


@pytest.mark.parametrize("seed,span", [(1, 10**6), (2, 5)])
def test_levels_are_those_of_pairwise_conflicts(spark, seed, span):
    documents = random_requests(seed, 60)
    asked = settled(from_documents(spark, documents))
    got = levels_of(spark, documents, span)
    want = closed_form(documents, touches(asked).collect())
    # runs may put a request later than needed, never before what it depends on
    touched = touches(asked).collect()
    assert all(g >= w for g, w in zip(got, want)) and max(got) <= max(want) + 3
    assert settled(chains(touches(asked))).groupBy("chain", "key", "request_id").count().where(
        "count > 1").isEmpty() and touched


def test_alternating_requests_on_different_paths_are_two_levels(spark):
    documents = []
    for i in range(500):
        documents += [mod("add", "k", obj=f"f{i}"), one("list", ROOT, f"f{i}")]
    assert levels_of(spark, documents) == [0, 1] * 500
    assert levels_of(spark, [find("k"), one("list", ROOT)] * 5) == [0] * 10
    assert levels_of(spark, [mod("add", "k", obj="f"), mod("rem", "k", obj="f")] * 3) == [0] * 6
    assert levels_of(spark, [one("remove", ROOT, "f")] * 3) == [0, 1, 2]
    assert levels_of(spark, [find("k"), mod("add", "k", obj="f"), find("k"), mod(
        "add", "k", coll="/other/zone")]) == [0, 1, 2, 3]
    assert levels_of(spark, [find("k", ROOT + "/a"), mod("add", "k", obj="f"), find(
        "k", ROOT + "/a/x"), mod("add", "k", coll="/other/zone")]) == [0, 1, 2, 0]


def outcome(catalogue, responses):
    """Responses and tables without what differs from run to run."""
    answers = sorted((r.request_id, r.error and r.error.code, r.single, r.multiple)
                     for r in responses)
    names = {r.coll_id: r.coll_path for r in catalogue.collections.collect()}
    names |= {-r.data_id: f"{r.coll_path}/{r.data_name}" for r in catalogue.replicas.collect()}

    def who(r):
        return names.get(r.subject_id if r.subject_type == "C" else -r.subject_id)

    return answers, sorted(names.values()), sorted(
        (who(r), r.attribute, r.value) for r in catalogue.avus.collect()), sorted(
        (who(r), r.owner, r.level) for r in catalogue.acls.collect()), sorted(
        (r.coll_path, r.data_name, bytes(r.content)) for r in catalogue.contents.collect())


@pytest.mark.parametrize("seed", [4])
def test_order_of_a_batch_is_the_strict_sequence(spark, seed):
    documents = random_requests(seed, 9)
    asked = settled(from_documents(spark, documents))
    together = dispatch_in_order(small_catalogue(spark), asked)
    catalogue, responses = small_catalogue(spark), []
    for i in range(len(documents)):
        catalogue, answer = dispatch(catalogue, asked.where(F.col("request_id") == i))
        responses += answer.collect()
        catalogue = catalogue.with_tables(**{
            n: settled(t) for n, t in catalogue.tables().items()})
    got, want = outcome(together[0], together[1].collect()), outcome(catalogue, responses)
    for a, b in zip(got[0], want[0]):
        assert a == b, (documents[a[0]], a, b)
    assert got == want


# -- changes on disk ------------------------------------------------------------

def folder_bytes(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs)


def test_one_change_writes_one_small_file(spark, tmp_path):
    folder, c = str(tmp_path / "catalogue"), small_catalogue(spark)
    snapshots.publish(c, folder)
    before = {n: folder_bytes(f"{folder}/{n}") for n in c.tables()}
    stored = snapshots.current(spark, folder)
    asked = from_documents(spark, [mod("add", "k", obj="f1.txt")])
    changed, _ = metadata.metamod(stored, asked)
    snapshots.append(changed, folder, batch=1)
    snapshots.append(changed, folder, batch=1)          # a repeat changes nothing
    after = {n: folder_bytes(f"{folder}/{n}") for n in c.tables()}
    assert {n for n in after if after[n] != before[n]} == {"avus"}
    assert 0 < after["avus"] - before["avus"] < 10_000
    again = snapshots.current(spark, folder)
    assert again.avus.where("attribute = 'k'").count() == 1
    assert again.avus.count() == c.avus.count() + 1
    # the other way round, then the same batch number again
    undone, _ = metadata.metamod(again, from_documents(spark, [mod("rem", "k", obj="f1.txt")]))
    snapshots.append(undone, folder, batch=2)
    assert snapshots.current(spark, folder).avus.count() == c.avus.count()
    plan = again.avus.where("attribute = 'k'")._jdf.queryExecution().toString()
    assert "EqualTo(attribute,k)" in plan


def test_compaction_by_zone_and_clean_up(spark, tmp_path):
    folder, c = str(tmp_path / "catalogue"), small_catalogue(spark)
    far = c.avus.withColumns({"zone": F.lit("far"), "subject_id": F.col("subject_id") + 5000})
    c = c.with_tables(avus=c.avus.unionByName(far))
    snapshots.publish(c, folder)
    wanted = from_documents(spark, [mod("add", "k", obj="f1.txt"), one("remove", ROOT, "f2.txt"),
                                    one("move", ROOT, "f3.txt", path=ROOT + "/b/m.txt")])
    changed, _ = dispatch_in_order(snapshots.current(spark, folder), wanted)
    snapshots.append(changed, folder)

    def state():
        return {n: sorted(map(str, t.collect())) for n, t in
                snapshots.current(spark, folder).tables().items()}

    before = state()
    assert before["replicas"] != sorted(map(str, c.replicas.collect()))
    snapshots.compact(spark, folder)
    assert state() == before
    far_files = {d for d, _, fs in os.walk(f"{folder}/avus") if "zone=far" in d and fs}
    assert len(far_files) == 1          # the zone without changes was not rewritten
    total = folder_bytes(folder)
    snapshots.clean(spark, folder)
    assert folder_bytes(folder) < total and state() == before
    changed, _ = access.chmod(snapshots.current(spark, folder), from_documents(spark, [
        {"op": "chmod", "target": {"coll": ROOT, "access": [{"owner": "o", "level": "read"}]}}]))
    snapshots.append(changed, folder)
    assert snapshots.current(spark, folder).acls.where("owner = 'o'").count() == 1


def test_folded_changes_equal_steps(spark):
    schema = "data_id long, coll_path string, data_name string, content binary, checksum string, zone string"
    rng = random.Random(9)
    table = spark.createDataFrame([(i, "/p", f"n{i}", bytearray(b"old"), "s", "z")
                                   for i in range(6)], schema)
    steps, there = [], set(range(6))
    for n in range(25):
        i = rng.randrange(8)
        op = rng.choice([PUT, DROP, SET] if i in there else [PUT])
        there = there - {i} if op == DROP else there | {i}
        steps.append((i, "/p", f"n{i}-{n}", bytearray(b"new%d" % n) if op == PUT else None,
                      f"s{n}", "z", op, n))
    changes = spark.createDataFrame(steps, schema + ", op string, seq long")
    want = table
    for n in range(25):
        want = settled(merged("contents", want, changes.where(F.col("seq") == n).drop("seq")))
    got = merged("contents", table, folded("contents", changes))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_a_scope_deletes_what_it_settled(spark):
    folder = shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    with settling(spark):
        assert settled(spark.range(5)).count() == 5
        assert set(os.listdir(folder)) != before
    assert set(os.listdir(folder)) == before


# -- named queries, pages, positions -------------------------------------------------

def named(sql, *args):
    return {"op": "specific", "target": {"specific": {"sql": sql, "args": list(args)}}}


def test_requests_of_one_statement_are_one_query(spark, monkeypatch):
    calls = []
    real = dispatching.named_sql.answered
    monkeypatch.setattr(dispatching.named_sql, "answered",
                        lambda *a: calls.append(a[1]) or real(*a))
    paths = [ROOT, ROOT + "/a", "/nowhere"]
    documents = [named("showCollAcls", p) for p in paths * 30]
    documents += [named("dataModifiedIdOnly", str(t), "2000000000") for t in (0, 1, 1900000000)]
    documents += [named("dataModifiedIdOnly", "x", "1"), named("showCollAcls"), named("none")]
    _, responses = dispatch(small_catalogue(spark), from_documents(spark, documents))
    rows = {r.request_id: r for r in responses.collect()}
    assert len(calls) == 2 and len(rows) == len(documents)
    sizes = [len(json.loads(rows[i].multiple)) for i in range(93)]
    assert sizes == [1, 1, 0] * 30 + [16, 16, 0]
    assert json.loads(rows[0].multiple)[0]["owner"] == "test"
    assert [rows[i].error.code for i in (93, 94, 95)] == [-1] * 3


def test_pages_end_to_end_are_the_sorted_list(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") < 2500, 0).otherwise(1 + F.col("id") % 3).alias("g"),
        F.struct((F.col("id") % 700).alias("v")).alias("entry"))
    pages, hot = paged(rows, ["g"], 100)
    assert [tuple(r) for r in hot.orderBy("g").collect()] == [(0, 25), (1, 2), (2, 2), (3, 2)]
    got = {}
    for r in pages.collect():
        got.setdefault(r.g, {}).setdefault(r.page, []).append(r.entry.v)
    for g, of_group in got.items():
        assert all(len(of_group[p]) == 100 for p in range(len(of_group) - 1))
        flat = [v for p in sorted(of_group) for v in sorted(of_group[p])]
        assert flat == sorted(r.entry.v for r in rows.where(F.col("g") == g).collect())


def test_a_listing_above_the_limit_keeps_its_order(spark):
    asked = from_documents(spark, [one("list", ROOT, contents=True)])
    whole = listing.list_paths(small_catalogue(spark), asked).collect()
    cut = sorted(listing.list_paths(small_catalogue(spark), asked, page_rows=3).collect(),
                 key=lambda r: r.page)
    inner = [c for r in cut for c in json.loads(r.single)["contents"]]
    assert len(cut) == 4 and inner == json.loads(whole[0].single)["contents"]


def test_positions_and_running_folds(spark):
    rows = spark.range(1000).select("id", (F.col("id") * 7919 % 1000).alias("v"),
                                    (F.col("id") % 3).alias("g")).repartition(7)
    placed = positioned(rows, [F.col("v")], "n").collect()
    assert all(r.n == r.v for r in placed) and len(placed) == 1000
    data = sorted((r.v, r.g, r.id) for r in placed)
    for fold, python in ((F.max, max), (F.sum, sum)):
        got = {r.id: r.w for r in running(rows, ["g"], "v", "id", "w", fold, 17).collect()}
        for place, (_, g, key) in enumerate(data):
            before = [i for _, h, i in data[:place] if h == g]
            assert got[key] == (python(before) if before else None)


def test_tables_in_buckets_are_joined_where_they_lie(spark, tmp_path):
    """With nothing small enough to broadcast, no catalogue table is moved."""
    folder, c = str(tmp_path / "catalogue"), small_catalogue(spark)
    snapshots.publish(c, folder, buckets=4)
    stored = snapshots.current(spark, folder)
    asked = from_documents(spark, [
        one("list", ROOT, contents=True, avu=True, acl=True, timestamp=True),
        one("list", ROOT, "r1.txt", avu=True, acl=True, replicate=True, checksum=True)])
    want = sorted(map(str, listing.list_paths(c, asked).select("request_id", "single").collect()))
    assert sorted(map(str, listing.list_paths(stored, asked).select(
        "request_id", "single").collect())) == want
    subjects = settled(c.avus.select("subject_type", "subject_id").distinct())
    limits = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    kept = [spark.conf.get(k) for k in limits]
    for k in limits:
        spark.conf.set(k, "-1")
    try:
        joined = stored.of_subjects("avus").join(
            subjects, ["subject_type", "subject_id"], "left_semi").groupBy(
            "subject_type", "subject_id").count()
        plan = joined._jdf.queryExecution().executedPlan().toString()
        moved = c.avus.join(subjects, ["subject_type", "subject_id"], "left_semi")
        assert plan.count("Exchange") == 1 and "Bucketed: true" in plan, plan
        assert moved._jdf.queryExecution().executedPlan().toString().count("Exchange") == 2
    finally:
        for k, v in zip(limits, kept):
            spark.conf.set(k, v)
    changed, _ = metadata.metamod(stored, from_documents(spark, [mod("add", "k", obj="f1.txt")]))
    assert changed.of_subjects("avus").where("attribute = 'k'").count() == 1
    snapshots.append(changed, folder)
    assert snapshots.current(spark, folder).of_subjects("avus").count() == c.avus.count() + 1
    snapshots.compact(spark, folder)
    snapshots.clean(spark, folder)
    again = snapshots.current(spark, folder)
    assert again.of_subjects("avus").count() == again.avus.count() == c.avus.count() + 1


def test_content_crosses_one_exchange_at_most(spark):
    """Facts of content are found where it is read, whatever is asked for."""
    from trovelake.operators import transfer

    c = small_catalogue(spark)
    asked = from_documents(spark, [{"coll": ROOT, "obj": "f1.txt"}], "get")
    files = c.contents.select(F.col("data_name").alias("local_path"), "content")
    facts = transfer.facts_of(c.contents, c.contents, "data_id",
                              size=F.octet_length("content"))
    judged = transfer.judged(c, asked)
    for frame in (facts, judged, transfer.uploads(from_documents(
            spark, [{"coll": ROOT, "obj": "f1.txt"}], "put"), files)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        exchanged = [line for line in plan.splitlines() if "Exchange" in line]
        assert "content" not in frame.columns
        assert all("content#" not in line for line in exchanged), plan
