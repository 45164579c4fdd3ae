"""Session settings that the engine's results rely on."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def session(app: str = "silverloom", **conf: str) -> SparkSession:
    """A session in UTC with ANSI casts and adaptive execution; conf overrides, dots written as '__'.

    Sources written in Python are asked for filters, and the state of streams is kept in RocksDB, not in the executors' heaps.
    """
    own = {
        "spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.python.filterPushdown.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    builder = SparkSession.builder.appName(app).config(map=own)
    for k, v in conf.items():
        builder = builder.config(k.replace("__", "."), v)
    return builder.getOrCreate()


def scratch(spark: SparkSession) -> str:
    """A new folder for tables of a run, below the session's spark.checkpoint.dir, which driver and executors share.

    Without that setting a session of one machine gets a temporary folder, and a cluster an error.
    """
    sc = spark.sparkContext
    shared = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if shared is None:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = tempfile.mkdtemp(prefix="work-")
    return f"{shared}/work-{uuid.uuid4().hex}"
