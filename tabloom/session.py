"""Session settings used by the tests and the benchmark; a cluster brings its own session."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(app: str = "tabloom", cpus: int | None = None) -> SparkSession:
    n = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    spark = (
        SparkSession.builder.master(f"local[{n}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
