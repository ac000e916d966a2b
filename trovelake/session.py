"""Session settings the plans in this package are written for."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# A side is broadcast when its size is at most this, beyond it joins shuffle. The
# driver builds each table it broadcasts, several at a time. The estimate before
# a run takes a column's share of a file from the types alone: that of a text
# beside nested columns is a fiftieth of its real size, so that its limit is low.
# The size measured at run time is of compressed rows.
BROADCAST_BYTES = 1024 * 1024
MEASURED_BROADCAST_BYTES = 8 * 1024 * 1024

# forceOptimizeSkewedJoin: a skewed sort-merge join is split even where that
# costs one more shuffle, because one key may hold a third of all rows.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(BROADCAST_BYTES),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(MEASURED_BROADCAST_BYTES),
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder for written intermediate tables.

    Only a session without ``spark.checkpoint.dir`` (a local test) gets a
    temporary folder of its own, which is then kept as the setting.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        configured = tempfile.mkdtemp(prefix="trovelake-")
        spark.conf.set("spark.checkpoint.dir", configured)
    return configured
