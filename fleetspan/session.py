"""Session settings the jobs are designed for."""

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot engine's join partition even when that costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Rows already placed by engine may join on (dataset, engine) without a new exchange.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "fleetspan", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; cluster sizing stays with spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
