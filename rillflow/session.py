"""A Spark session with the settings the engine is tested with."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(master: str = "local[8]", shuffle_partitions: int = 8, **more: str) -> SparkSession:
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    } | more
    made = SparkSession.builder.master(master).appName("rillflow").config(map=conf).getOrCreate()
    made.sparkContext.setLogLevel("ERROR")
    return made
