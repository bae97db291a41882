"""A local session for tests and benchmarks. On a cluster, use the session it gives."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", name: str = "glossaflow", memory: str = "12g") -> SparkSession:
    partitions = str(cpus) if str(cpus).isdigit() else "8"
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
