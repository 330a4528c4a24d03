"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # size of the files a rebalanced write makes, and of the pieces a skewed partition is cut into
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str = "local[8]", app: str = "shelfline", **extra: str) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: spark.checkpoint.dir, or the one set on the context.

    A session that names none gets a fresh local folder if it runs in this one process; on a cluster,
    where each machine would write to its own disk, that is an error.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        if named is None and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="shelfline-"))
    return named or os.path.dirname(context.getCheckpointDir())
