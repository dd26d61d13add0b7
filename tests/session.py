"""The local session of tests and bench."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cores: str = "8", memory: str = "8g") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("textmill")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", memory))
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
