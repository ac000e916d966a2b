"""Documents over several lines or several on a line, in any splits."""

from __future__ import annotations

import json
import random

import pytest

from trovelake.sources.requests import concatenated


@pytest.mark.parametrize("split", [40, 10**6])
def test_documents_are_found_whatever_the_lines(spark, tmp_path, split):
    rng = random.Random(2)
    texts = ['a}b{"', "\\", "[[", "ü\n", "", "x" * 50]
    wanted = []
    for name in ("a", "b", "c"):
        out = ""
        for i in range(40):
            document = {"k": rng.choice(texts), "n": [i, {"d": rng.choice(texts)}], "f": name}
            wanted.append(document)
            out += json.dumps(document, indent=rng.choice([None, None, 1]))
            out += rng.choice(["", " ", "\n", "\n\n"])
        if name == "b":
            out += '\n{"open": [1, 2'       # ends with its file
        (tmp_path / f"{name}.txt").write_text(out)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        rows = concatenated(spark, str(tmp_path)).orderBy("request_id").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len({r.request_id for r in rows}) == len(rows)
    got = [r.line for r in rows]
    assert [json.loads(t) for t in got if '"open"' not in t] == wanted
    assert got[80].startswith('{"open"') and len(got) == 121


def test_text_between_documents_is_a_line_of_its_own(spark, tmp_path):
    (tmp_path / "a.txt").write_text('{"a":1} no json {"b":2}\n}\n] {"c":3}\n17 "x"\n[1,\n2]\n')
    got = [r.line for r in concatenated(spark, str(tmp_path)).orderBy("request_id").collect()]
    assert [t for t in got if t.startswith("{")] == ['{"a":1}', '{"b":2}', '{"c":3}']
    assert "no json" in got and json.loads(got[-1]) == [1, 2] and '17 "x"' in got
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "a.txt").write_text("")
    assert concatenated(spark, str(tmp_path / "empty")).collect() == []


def test_long_texts(spark, tmp_path):
    document = {"t": "\\\"}" * 200_000, "l": [[1]] * 20_000}
    (tmp_path / "a.txt").write_text(json.dumps(document) * 2)
    rows = concatenated(spark, str(tmp_path)).collect()
    assert [json.loads(r.line) for r in rows] == [document] * 2
