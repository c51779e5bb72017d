"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import sys
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import SparkSession

RUNTIME_CONF = {
    # All dates and ISO strings are UTC.
    "spark.sql.session.timeZone": "UTC",
    # Duplicate JSON keys: the last one wins.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Split hot join keys even where that costs one more exchange.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Keyed state of streams on local disk, with changes only in the checkpoint.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Documents are wide: keep the batches sent to Python small.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
}


def configure(spark: SparkSession) -> SparkSession:
    """Set the runtime options above on a session and return it.

    Functions of this package that run in Python workers travel by value, so the workers
    need no installed copy.
    """
    cloudpickle.register_pickle_by_value(sys.modules["docvault"])
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared directory named by spark.checkpoint.dir."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="docvault-")
    return f"{root.rstrip('/')}/docvault/{name}-{uuid.uuid4().hex}"
