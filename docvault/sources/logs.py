"""Reading JSON log lines, as tables or streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.col("value").alias("line"))


def stream_logs(spark: SparkSession, path: str, max_files_per_trigger: int = 1000) -> DataFrame:
    reader = spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(path).select(F.col("value").alias("line"))
