from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from trovelake.llm import kd_search, url_templates

VECTORS = "vec_id long, embedding array<float>, length int, block string"


def brute(rows, asked, k):
    known = {}
    for key, vector, *_ in rows:
        if key is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        whole = [float(x) for x in vector]
        known[key] = min(known.get(key, whole), whole)
    points = {key: [math.floor(64 * x) for x in v] for key, v in known.items()}
    out = {}
    for key in filter(asked, points):
        scores = sorted((-sum(a * b for a, b in zip(points[key], v)), other)
                        for other, v in points.items()
                        if other != key and len(v) == len(points[key]))[:k]
        for rank, (score, other) in enumerate(scores, 1):
            out[key, rank] = (other, -score)
    return out


def searched(spark, rows, k=20):
    df = spark.createDataFrame(rows, VECTORS)
    return {(r.query_id, r.rank): (r.vec_id, r.score)
            for r in kd_search.top_k(df, F.col("vec_id") % 20 == 0, k).collect()}


def test_top_k_equals_brute_force_with_ties_and_odd_rows(spark, monkeypatch):
    rng = random.Random(3)
    monkeypatch.setattr(kd_search, "SHARD_ROWS", 100)
    monkeypatch.setattr(kd_search, "LEAF_ROWS", 8)
    monkeypatch.setattr(kd_search, "BLOCK_QUERIES", 8)
    rows = [(i, [rng.randint(-16, 16) / 16 for _ in range(4)], 1, "x") for i in range(600)]
    rows += [(i, [0.5, 0.5, 0.5, 0.5], 1, "x") for i in range(600, 900)]  # many equal rows
    rows += [(900, None, 1, "x"), (920, [1.0, None, 0.0, 0.0], 1, "x"), (None, [1.0] * 4, 1, "x"),
             (940, [float("nan")] * 4, 1, "x"), (960, [float("inf")] * 4, 1, "x"),
             (980, [0.25, 0.5], 1, "x"), (981, [0.5, 0.5], 1, "x"), (1000, [], 1, "x"),
             (1020, [0.1] * 4, 1, "x"), (1020, [0.1] * 4, 1, "x")]
    assert searched(spark, rows) == brute(rows, lambda i: i % 20 == 0, 20)


def test_top_k_of_huge_components_and_empty_table(spark):
    rows = [(0, [3e38, 1.0], 1, "x"), (1, [3e38, -1.0], 1, "x"), (2, [-3e38, 0.0], 1, "x")]
    found = searched(spark, rows, 2)
    assert [found[0, r][0] for r in (1, 2)] == [1, 2] and found[0, 1][1] == 2**63 - 1
    assert searched(spark, []) == {}


def judged(spark, urls):
    df = spark.createDataFrame([(i, u, "a", "b") for i, u in enumerate(urls)],
                               "page_id long, url string, host string, template string")
    return {r.page_id: r for r in url_templates.filtered(df).collect()}


@pytest.mark.parametrize("url, host, path, rule, verdict", [
    ("http://WWW.Example.com/en/1?x#y", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
    ("https://a.example.com/en/1", "a.example.com", "/en/1", "example.com/en/", "block"),
    ("https://a.example.com/de/1", "a.example.com", "/de/1", "com/", "allow"),
    ("https://x.net/fr/", "x.net", "/fr/", "net/fr/", "block"),
    ("https://x.net/fr", "x.net", "/fr", None, "allow"),
    ("https://planet/fr/", "planet", "/fr/", None, "allow"),
    ("x://a.com", "a.com", "", None, "allow"),
    ("x://a.com?q=/b", "a.com", "", None, "allow"),
    ("a.com/en/", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("", "", "", None, "allow"),
    ("http://a.org://b/c", "a.org:", "//b/c", None, "allow"),
    ("http://É.COM/\nb", "É.com", "/\nb", "com/", "allow"),
])
def test_url_parts_and_rules(spark, url, host, path, rule, verdict):
    row = judged(spark, [url])[0]
    assert (row.host, row.path, row.rule, row.verdict) == (host, path, rule, verdict)


def test_template_tree_rejects_by_labelled_share(spark):
    """Pages under a variable first segment share a template, also those that no
    rule reaches; it is rejected because its labelled pages were blocked."""
    urls = [f"http://h.net/{a}/{b}" for a in ("es", "fr") for b in range(30)]
    urls += [f"http://h.net/u{b}/x" for b in range(30)]          # nothing labelled
    urls += [f"http://ok.com/{a}/{b}" for a in "ab" for b in range(10)]
    got = judged(spark, urls)
    first = got[0]
    assert first.template == "/*/*" and first.examples == 60 and first.blocked_share > 0.8
    assert got[70].rule is None
    assert got[70].verdict == ("block" if got[70].template == "/*/*" else "allow")
    assert len(got) == len(urls)


def test_templates_do_not_change_as_rows_repeat(spark):
    """Each page 30 times: 10 different children for 300 rows are still variable."""
    urls = [f"http://h.net/{a}/{b}" for a in ("es", "en") for b in range(10)]
    once, often = judged(spark, urls), judged(spark, urls * 30)
    assert {r.template for r in once.values()} == {"/+/*"}
    assert {r.template for r in often.values()} == {"/+/*"}


def test_branches_without_labels_are_judged_by_siblings_or_parent(spark):
    urls = [f"http://h.net/es/{b}" for b in range(20)]      # blocked by a rule
    urls += [f"http://h.net/en/{b}" for b in range(20)]     # of like structure
    urls += [f"http://h.net/de/{b}/x" for b in range(20)]   # only the host has examples
    urls += [f"http://other.org/en/{b}" for b in range(20)]  # nothing is known
    got = judged(spark, urls)
    assert [got[i].template for i in (0, 20, 40, 60)] == ["/+/*", "/+/*", "/**", "/en/*"]
    assert [got[i].examples for i in (0, 20, 40, 60)] == [20, 20, 20, 0]
    assert [got[i].verdict for i in (0, 20, 40)] == ["block"] * 3
    assert got[60].verdict == "allow"  # fewer than LEAST_EXAMPLES


def test_url_filter_of_empty_table(spark):
    assert judged(spark, []) == {}
