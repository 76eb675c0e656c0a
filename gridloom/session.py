"""A session with the settings the library is tested under. Any other session works too."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: int | str = "*", partitions: int = 8, **more: str) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cpus}]").config(map=SETTINGS | {"spark.sql.shuffle.partitions": str(partitions), "spark.driver.memory": "8g"} | more)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
