"""Session settings the jobs are planned for."""

from __future__ import annotations

import tempfile
from functools import cache

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # Compressed files understate what a broadcast would hold.
    "spark.sql.sources.fileCompressionFactor": "4.0",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "propfold", master: str | None = None, **settings) -> SparkSession:
    """Session with adaptive execution on.

    ``master`` and the shuffle width are left to ``spark-submit`` unless given,
    so that nothing tuned for one machine reaches a cluster.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder for staged tables: the one named in ``spark.checkpoint.dir``.

    Only a local session may do without that setting; a cluster needs a folder
    which all executors see.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return local_dir()


@cache
def local_dir() -> str:
    """One folder for a local session, which has no other machines."""
    return tempfile.mkdtemp(prefix="propfold-")
