"""Session settings the pipelines rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Hot codes and merchants are split at run time.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Stored positions and days must not depend on where a task runs.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def build_session(app_name: str = "tallymark", **settings: str) -> SparkSession:
    """A session with ``SETTINGS``; ``settings`` adds or overrides. The master comes from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for name, value in {**SETTINGS, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
