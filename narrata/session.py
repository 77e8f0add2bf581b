"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "narrata", extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session for the operators in this package.

    On a cluster the master and sizing come from ``spark-submit``; the
    explicit arguments and ``extra`` settings are for local runs and tests.
    """
    builder = SparkSession.builder.appName(app_name)
    if os.environ.get("NARRATA_EVENT_LOG"):
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", os.environ["NARRATA_EVENT_LOG"])
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("NARRATA_DRIVER_MEMORY", "12g"),
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf |= extra or {}
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder: ``spark.checkpoint.dir`` from the session.

    A local master (tests, notebooks) that names none gets a folder under the
    warehouse; on a cluster the setting is required, as neither the warehouse's
    default nor any other folder is known to be shared.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext.getCheckpointDir() or configured
