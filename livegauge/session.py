"""Session settings for the jobs."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "livegauge", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on; pass any further Spark settings as ``conf`` (dots as ``__``).

    ``spark.sql.shuffle.partitions`` is an upper bound that adaptive execution coalesces down from, so on a
    cluster set it high (two to three times the executor cores) and leave the advisory size to decide.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
