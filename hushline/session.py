"""Session settings which suit these jobs."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Splits hot keys in the one wide join (turn rows with their context).
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Redaction is bound by computing, not by reading: smaller scan tasks spread better.
    "spark.sql.files.maxPartitionBytes": str(64 << 20),
    "spark.sql.session.timeZone": "UTC",
    # Column building from Python takes a third of the time without call-site capture.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Apply the settings to a session under construction."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder
