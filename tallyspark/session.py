"""Session defaults: UTC, adaptive plans, Arrow transfer. Partition counts are left to the cluster."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

_own: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share, spark.checkpoint.dir; in local mode, where that is unset, a temporary
    one of this process. The session stays as it is."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if at:
        return at.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _own:
        _own.append("file://" + tempfile.mkdtemp(prefix="tallyspark-"))
    return _own[0]


def session(app: str = "tallyspark", **conf: str) -> SparkSession:
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    return SparkSession.builder.appName(app).config(map=settings).getOrCreate()
