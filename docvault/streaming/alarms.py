"""The windowed alarms as streams that append finished windows to tables.

A table of windows has one part per micro-batch and is only appended to. Rows that come after
the watermark are left out of the windows: run the same operator over the table of all rows
when that has happened, append operators.monitor.corrections with `append_corrections`, and read
with `read_windows`, which takes the newest entry of each window.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from docvault.operators.monitor import (
    corrections,
    duration_counts,
    error_alarm,
    newest_windows,
    windows_of_counts,
)

ERROR_WINDOWS = "window_start timestamp, window_end timestamp, events bigint, errors bigint"
DURATION_WINDOWS = "window_start timestamp, window_end timestamp, events bigint, p99_ms double"


def append_stream(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    finish: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Write the finished windows of each micro-batch as a part of their own, at revision 0.

    `finish` is applied to the rows of a micro-batch. A micro-batch that runs again replaces its
    own part.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        done = finish(batch) if finish else batch
        done.withColumn("revision", F.lit(0)).write.mode("overwrite").parquet(f"{path}/part={batch_id}")

    return (
        rows.writeStream.outputMode("append")
        .foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )


def run_error_alarm(
    logs: DataFrame, path: str, checkpoint: str, watermark: str = "5 minutes", trigger: dict | None = None
) -> StreamingQuery:
    return append_stream(error_alarm(logs, watermark), path, checkpoint, trigger)


def run_duration_windows(
    durations: DataFrame,
    path: str,
    checkpoint: str,
    watermark: str = "10 minutes",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append finished windows; operators.monitor.slow_alarm reads the table they make.

    The stream counts durations, dealt out by window and duration; when a window is finished, its
    counts become the exact percentile in a batch step that narrows large windows down first.
    No task holds all durations of a window.
    """
    return append_stream(duration_counts(durations, watermark), path, checkpoint, trigger, windows_of_counts)


def entries(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All entries of a table of windows, with their revision."""
    full = T.StructType.fromDDL(f"{schema}, revision int, part string")
    return spark.read.schema(full).parquet(path).drop("part")


def read_windows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Each window once, corrections taken into account."""
    return newest_windows(entries(spark, path, schema)).drop("revision")


def append_corrections(recomputed: DataFrame, path: str, schema: str, name: str) -> None:
    """Append what late rows have changed, as the part `name` (a new one each time)."""
    spark = recomputed.sparkSession
    found = corrections(entries(spark, path, schema), recomputed)
    found.write.mode("errorifexists").parquet(f"{path}/part={name}")
