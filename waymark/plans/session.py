"""Session factory with the settings every stage relies on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

#: UTC timestamps, ANSI casts, text partition values and runtime re-planning.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def make_session(master: str = "local[*]", app: str = "waymark", **extra: str) -> SparkSession:
    """A session for local work; on a cluster spark-submit supplies master and sizes."""
    builder = SparkSession.builder.master(master).appName(app)
    memory = os.environ.get("WAYMARK_DRIVER_MEMORY", "8g")
    for key, value in {"spark.driver.memory": memory, "spark.sql.shuffle.partitions": "8", **SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
