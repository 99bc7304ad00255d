"""SparkSession factory used by the command line, the bench and the tests."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "docketlake", master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with UTC times and adaptive execution.

    On a cluster the master and sizes come from spark-submit; ``master`` and ``shuffle_partitions`` are for local runs.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
