"""A session with the settings the operators expect."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

SETTINGS = {
    # Calendar parts and ISO dates must not depend on the zone of the machine.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Rebalanced output aims at files of this size.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
}


def build_session(
    app_name: str = "tillroll",
    master: str | None = None,
    settings: Mapping[str, str] | None = None,
) -> SparkSession:
    """Create or get a session; ``settings`` win over the defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
