"""A flag that is set on requests after they were taken apart."""

from __future__ import annotations

import json

from pyspark.sql import functions as F
from small import ROOT, small_catalogue

from trovelake.operators import transfer
from trovelake.sources.requests import requests


def _asked(spark, operation, **more):
    lines = spark.createDataFrame([(0, json.dumps(
        {"collection": ROOT, "data_object": "f1.txt", **more}))], "request_id long, line string")
    asked = requests(lines, operation)
    return asked.withColumn("arguments", F.col("arguments").withField("verify", F.lit(True)))


def test_verify_set_on_checksum_requests(spark):
    c = small_catalogue(spark)
    _, responses = transfer.checksum(c, _asked(spark, "checksum"))
    assert [r.error for r in responses.collect()] == [None]


def test_write_verifies_what_it_puts(spark):
    c = small_catalogue(spark)
    files = spark.createDataFrame([("/l/f1.txt", bytearray(b"new"))],
                                  "local_path string, content binary")
    for more, code in [({}, None), ({"checksum": "0"}, -314000)]:
        _, responses = transfer.write(c, requests(spark.createDataFrame([(0, json.dumps(
            {"collection": ROOT, "data_object": "f1.txt", "directory": "/l", **more}))],
            "request_id long, line string"), "put"), files)
        assert [r.error and r.error.code for r in responses.collect()] == [code]
