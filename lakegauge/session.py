"""Session settings the library is meant to run under.

Nothing in the library needs them for right results: writes name their overwrite mode and casts
do not depend on the ANSI switch. They are here for speed and for stable timestamps.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # A load task writes few partitions, so keeping their writers open saves a sort of the
    # task's rows; tasks that meet more partitions fall back to the sort.
    "spark.sql.maxConcurrentOutputFileWriters": "4",
    # The JVM never compiles methods above this size, and a generated stage casting a few dozen
    # columns is larger; past the limit Spark generates one method per expression instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
}


def build_session(
    app_name: str = "lakegauge", master: str | None = None, **settings: str
) -> SparkSession:
    """Session with :data:`SETTINGS`; ``settings`` override them (dots written as ``__``)."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
