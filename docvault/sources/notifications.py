"""Reading queue messages, as tables or streams."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docvault.functions.timing import moment
from docvault.schemas import DELIVERY, MESSAGE


def normalize_messages(messages: DataFrame, default_received_at: datetime | str | Column) -> DataFrame:
    """(message_id, body, received_at) from (messageId, body, receivedAt).

    A message without an id is called "unknown"; one without a time gets the default.
    """
    return messages.select(
        F.coalesce("messageId", F.lit("unknown")).alias("message_id"),
        "body",
        F.coalesce("receivedAt", moment(default_received_at)).alias("received_at"),
    )


def open_messages(reader, path: str, deliveries: bool | str) -> DataFrame:
    """Raw messages from JSON lines, or from delivered batches of the form {"Records": [...]}.

    deliveries=True reads files with one batch each, deliveries="lines" files with one batch a
    line, which several tasks can share. A batch that cannot be read, or is none, becomes one
    message whose body is what was read of it, so that it ends up among the failures.
    """
    if not deliveries:
        return reader.schema(MESSAGE).json(path)
    reader = reader.schema(DELIVERY).option("columnNameOfCorruptRecord", "unreadable")
    batches = reader.option("multiLine", str(deliveries != "lines").lower()).json(path)
    opened = batches.filter("Records IS NULL OR size(Records) > 0").selectExpr(
        "Records IS NULL AS _none", "unreadable", "inline_outer(Records)"
    )
    body = F.when(F.col("_none"), F.coalesce("unreadable", F.lit("{}"))).otherwise(F.col("body"))
    return opened.select("messageId", body.alias("body"), "receivedAt")


def read_notifications(
    spark: SparkSession, path: str, default_received_at: datetime | str, deliveries: bool | str = False
) -> DataFrame:
    """Messages of a folder; a line that cannot be read becomes a message without a body."""
    return normalize_messages(open_messages(spark.read, path, deliveries), default_received_at)


def stream_notifications(
    spark: SparkSession,
    path: str,
    max_files_per_trigger: int = 1000,
    default_received_at: datetime | str | None = None,
    deliveries: bool | str = False,
) -> DataFrame:
    """The same messages as a stream over a folder."""
    reader = spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger)
    default = F.current_timestamp() if default_received_at is None else default_received_at
    return normalize_messages(open_messages(reader, path, deliveries), default)
