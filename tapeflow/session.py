"""Session for tests, the benchmark and single-machine use.

On a cluster the caller brings the session; nothing in the library sets
configuration on it.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", app: str = "tapeflow", **conf: str) -> SparkSession:
    partitions = "8" if cpus == "*" else str(cpus)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.driver.memory", "8g")
    )
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
