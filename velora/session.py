"""The session that the engine expects: UTC, ANSI casts, adaptive plans with skew handling."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
}


def workers_find_package(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it, however the driver was started."""
    root, env = str(Path(__file__).resolve().parent.parent), spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def build_session(name: str = "velora", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the engine's settings; on a cluster the master comes from spark-submit."""
    builder = SparkSession.builder.appName(name).config(map=SETTINGS | extra)
    return (builder.master(master) if master else builder).getOrCreate()
