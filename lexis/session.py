"""Spark session and shared-folder helpers.

Library code never builds its own session: every operator takes DataFrames
and returns DataFrames. ``get_spark`` is for scripts, tests and the bench.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "lexis") -> SparkSession:
    """Session with the settings the operators are tuned for.

    AQE re-plans at runtime (coalesces small shuffles, splits skewed join
    partitions); the UI stays off. ``shuffle_partitions`` should follow the
    cluster: about 2-3x the executor cores, so one shuffle partition of the
    postings fits executor memory at the target scale.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.driver.memory": os.environ.get("LEXIS_DRIVER_MEMORY", "8g"),
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Written tables that cut lineage go under it, so a lost executor never
    takes the only copy with it. Only when the session names no folder (local
    tests) is a private one set.
    """
    sc = spark.sparkContext
    path = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not re.fullmatch(r"local(\[[^]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="lexis-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
        path = sc.getCheckpointDir() or path
    return path.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
