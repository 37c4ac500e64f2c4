"""Spark session defaults tuned for large shuffles."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans at stage boundaries: it coalesces
# small shuffle partitions, splits skewed join partitions and turns a sort-merge
# join into a broadcast join only after measuring the real size of a side.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app_name: str = "entwise",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with SCALE_CONF applied.

    On a cluster leave ``master`` unset so spark-submit decides, and size
    ``shuffle_partitions`` to the data (~128-256 MB per shuffle partition);
    AQE then coalesces downwards at run time.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and local benchmarks."""
    return get_session(master=f"local[{cores}]", shuffle_partitions=shuffle_partitions,
                       extra={"spark.driver.memory": os.environ.get("ENTWISE_DRIVER_MEMORY", "16g")})
