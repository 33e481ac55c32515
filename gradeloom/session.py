"""Session factory with the settings the engine is designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(
    app: str = "gradeloom",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with AQE, skew-join splitting, UTC and Arrow switched on.

    ``shuffle_partitions`` is left to the cluster unless given: AQE merges small
    partitions, so a large value is safe on a cluster and 8 is right for tests.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf |= extra or {}
    return b.config(map=conf).getOrCreate()
