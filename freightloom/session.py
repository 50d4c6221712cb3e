"""Session for one machine: tests, benchmark, examples.  On a cluster use the session it provides."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cpus: int | str = 8, memory: str = "16g") -> SparkSession:
    """Local session with the settings the library expects: UTC, ANSI casts, adaptive execution."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("freightloom")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
