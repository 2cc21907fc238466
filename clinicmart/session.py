"""Session settings the library is written for."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


#: Shuffle partitions to begin with on a cluster; adaptive execution joins small ones.
CLUSTER_PARTITIONS = 4096


def build_session(app: str = "clinicmart", master: str | None = None, **conf: str) -> SparkSession:
    """Start (or reuse) a session.

    UTC and ANSI are needed for right results, AQE for right plans. On a
    cluster leave ``master`` unset and let spark-submit set it, along with
    ``spark.checkpoint.dir`` on storage all executors can reach. Settings given as ``conf`` come last.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # The JIT compiler skips methods above this size; a projection that cleans
        # dozens of columns is then better split than fused with its stage.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        # Recording a call site for each column expression slows plan building.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if master and master.startswith("local"):
        cores = os.cpu_count() or 8
        builder = (
            builder.config("spark.ui.enabled", "false")
            .config("spark.sql.shuffle.partitions", str(cores))
            .config("spark.driver.memory", "8g")
        )
    else:
        builder = builder.config(
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(CLUSTER_PARTITIONS)
        )
    for key, value in conf.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session
