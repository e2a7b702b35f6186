"""Local session for tests, checks and the benchmark."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cpus: str | None = None, partitions: int = 8) -> SparkSession:
    cores = cpus or os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("meterloom")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Model fits work long on few bytes; a megabyte a task, the default, would leave them to one core.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.extraJavaOptions", "-Dlog4j2.level=ERROR")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
