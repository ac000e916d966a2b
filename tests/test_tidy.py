"""What stored tables leave on disk."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from trovelake.plans import settle


def _shuffle_files(spark):
    blocks = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    names = [blocks.apply(i).getName() for i in range(blocks.size())]
    return {n for n in names if n.startswith("shuffle_")}


def test_a_stored_table_leaves_no_shuffle_files(spark):
    setting = spark.conf.get(settle._CLEANUP)
    before = _shuffle_files(spark)
    stored = settle.settled(spark.range(0, 10_000, 1, 4).groupBy(
        (F.col("id") % 1000).alias("k")).count())
    for _ in range(50):
        if not _shuffle_files(spark) - before:
            break
        time.sleep(0.2)
    assert not _shuffle_files(spark) - before
    assert stored.count() == 1000 and spark.conf.get(settle._CLEANUP) == setting
