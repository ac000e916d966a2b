"""Every registered query runs at the smallest scale, and those with SQL give
the rows that DuckDB gives."""

from __future__ import annotations

import os
from concurrent.futures import ThreadPoolExecutor

import duckdb
import pytest

from trovelake.registry import BOOK
from trovelake.sources.tables import COLUMNS

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in [*COLUMNS, "embeddings"]:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(repr(tuple(row[i] for i in order)) for row in rows)


# Queries that register views, or delete what they have stored, run by themselves.
ALONE = ("sql", "act22", "act23", "str01", "snk05")


@pytest.fixture(scope="module")
def answers(spark):
    """Rows or the problem of every query; most of the time goes into planning, so
    several run at a time."""
    def run(name):
        try:
            df = BOOK[name].run(spark, FOLDER)
            return canonical(df.columns, df.collect())
        except Exception as problem:
            return problem

    together = [n for n in BOOK if not n.startswith(ALONE)]
    with ThreadPoolExecutor(6) as pool:
        found = dict(zip(together, pool.map(run, together)))
    return found | {n: run(n) for n in BOOK if n not in found}


@pytest.mark.skipif(not (os.path.isdir(FOLDER) and os.environ.get("ALL_QUERIES")),
                    reason="takes over seven minutes; set ALL_QUERIES=1")
@pytest.mark.parametrize("name", list(BOOK))
def test_registered_query(answers, duck, name):
    got = answers[name]
    if isinstance(got, Exception):
        raise got
    if BOOK[name].sql is not None:
        result = duck.execute(BOOK[name].sql)
        assert got == canonical([d[0] for d in result.description], result.fetchall())
