"""Session settings the library counts on; everything else is the caller's."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Stored times carry no zone; they are read as UTC everywhere.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A partition that a hot key swells is split in joins, even where the split
    # costs the aggregate after the join a shuffle of its own.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to `spark`."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark
