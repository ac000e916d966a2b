"""A small catalogue with known answers."""

from __future__ import annotations

import datetime as dt
import functools
import hashlib

from trovelake.sources.catalogue import SCHEMAS, Catalogue

ROOT = "/zone/home/test"
ROOT_CREATED = dt.datetime(2020, 1, 1)
SIZES = {"lorem_1b.txt": 1, "lorem_1k.txt": 1024, "lorem_10k.txt": 10240}


@functools.cache
def small_catalogue(spark) -> Catalogue:
    folders = ["", "/a", "/a/x", "/a/x/m", "/b", "/c"]
    ids = {ROOT + f: 1000 + i for i, f in enumerate(folders)}
    at = ROOT_CREATED + dt.timedelta(days=1)
    collections = [(i, p, p.rsplit("/", 1)[0], ROOT_CREATED, at, "zone") for p, i in ids.items()]
    names = [(ROOT + f, f"f{n}.txt") for f, ns in
             {"": (1, 2, 3), "/a": (4, 5, 6), "/a/x": (7, 8, 9), "/a/x/m": (10, 11, 12)}.items()
             for n in ns]
    names += [(ROOT, "r1.txt"), *[(ROOT, n) for n in SIZES]]
    replicas, avus, acls, contents = [], [], [], []
    for data_id, (folder, name) in enumerate(names, start=1):
        content = b"x" * SIZES.get(name, 0)
        digest = hashlib.md5(content).hexdigest()
        for number in (0, 1):
            replicas.append((data_id, ids[folder], folder, name, number, len(content), digest,
                             "1", f"root;leaf{number}", at, at, "zone"))
        contents.append((data_id, folder, name, bytearray(content), digest, "zone"))
        if name.startswith("f"):
            avus.append(("D", data_id, "attr1", "value1", "units1", at, "zone"))
        if name == "r1.txt":
            for a, v in [("a", "x"), ("a", "y"), ("b", "x"), ("b", "y"), ("b", "z"),
                         ("numattr1", "1"), ("numattr1", "10"), ("numattr1", "100")]:
                avus.append(("D", data_id, a, v, None, at, "zone"))
        acls.append(("D", data_id, "test", "zone", "own", "zone"))
    for folder in ("/a", "/a/x", "/a/x/m"):
        avus.append(("C", ids[ROOT + folder], "attr2", "value2", "units2", at, "zone"))
    for coll_id in ids.values():
        acls.append(("C", coll_id, "test", "zone", "own", "zone"))
    resources = [(f"leaf{n}", f"host{n}", "unixfilesystem", "zone") for n in (0, 1)]
    named = [("findQueryByAlias",
              "SELECT alias, sqlStr FROM named_queries WHERE alias = ?"),
             ("dataModifiedIdOnly",
              "SELECT DISTINCT data_id FROM replicas WHERE unix_seconds(modified) > "
              "CAST(? AS BIGINT) AND unix_seconds(modified) <= CAST(? AS BIGINT)")]
    data = dict(collections=collections, replicas=replicas, avus=avus, acls=acls,
                resources=resources, contents=contents, named_queries=named)
    frames = {}
    for name, rows in data.items():
        columns = [c.split()[0] for c in SCHEMAS[name].split(", ")]
        assert all(len(r) == len(columns) for r in rows), name
        frames[name] = spark.createDataFrame(rows, SCHEMAS[name]).coalesce(1).cache()
    return Catalogue(**frames)
