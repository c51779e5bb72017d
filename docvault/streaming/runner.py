"""The document flow as a stream of micro-batches."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docvault.operators.delivery import dead_letters
from docvault.operators.ingest import split_valid
from docvault.operators.vault import IDENTITY
from docvault.plans.batch import process_batch
from docvault.plans.process import requests_of
from docvault.settings import JobSettings
from docvault.sources.answers import Answers
from docvault.sources.ledger import read_ledger
from docvault.sources.sinks import Tables, create_tables, write_batch


def run_stream(
    messages: DataFrame,
    documents: DataFrame | Callable[[DataFrame], DataFrame],
    tables: Tables,
    checkpoint: str,
    settings: JobSettings,
    model: Callable[[str, str], str] | None = None,
    as_of: datetime | str | None = None,
    trigger: dict | None = None,
    explode_records: bool = False,
    whole_table: bool = False,
    answers: Answers | None = None,
) -> StreamingQuery:
    """Process every micro-batch into the tables.

    There is no watermark here, so late messages are processed like any other. A batch that
    is delivered again after a crash replaces its own rows and keeps its moment. From time to
    time stop the stream, let plans.batch.write_snapshot merge the parts of old batches, and go
    on with the snapshot.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        moment = as_of or datetime.now(timezone.utc)
        process_batch(
            batch, documents, tables, batch_id, moment, settings, model, explode_records, whole_table, answers
        )

    return (
        messages.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .start()
    )


def dedupe_stream(
    messages: DataFrame,
    tables: Tables,
    checkpoint: str,
    settings: JobSettings,
    explode_records: bool = False,
    trigger: dict | None = None,
    keep: str | None = None,
) -> StreamingQuery:
    """Valid requests, one of each (document, bucket, version), into the table `distinct`.

    Exact whatever the delay. What was let through is kept as keyed state, in the RocksDB store
    that session.configure sets: a micro-batch looks up its own keys there and reads nothing
    else, however long the history. Requests of one identity differ at most in the message that
    announced them; which of those in one micro-batch goes on is not fixed. Run again, a
    micro-batch starts from the same state and replaces its own rows. State and table belong
    together: with a lost checkpoint, start over with a new table.

    With `keep`, an interval such as "400 days", an identity is forgotten so long after the
    newest arrival, and requests older than that are left out: the state is bounded then.
    """
    valid, _ = split_valid(requests_of(messages, settings, explode_records))
    if keep:
        arrived = F.timestamp_millis("version").alias("arrived")
        once = valid.select("*", arrived).withWatermark("arrived", keep).dropDuplicatesWithinWatermark(IDENTITY)
    else:
        once = valid.dropDuplicates(IDENTITY)
    create_tables(messages.sparkSession, tables)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, tables, "distinct", batch_id)

    return (
        once.writeStream.foreachBatch(on_batch)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .start()
    )


def dead_letter_table(spark, tables: Tables, settings: JobSettings) -> DataFrame:
    """Messages that have failed too often, from the stored ledger."""
    return dead_letters(read_ledger(spark, tables), settings.max_deliveries)
