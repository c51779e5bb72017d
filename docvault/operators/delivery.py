"""Failures, redelivery and dead letters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docvault.operators.ingest import VALIDATION, message_key, parse_notifications
from docvault.schemas import FAILURE

# Fixed value: one failed message is counted under both its id and what it is about (its
# document, or its body where that names none), because messages without an id all share the
# name "unknown".
LEDGER_KEY = ["message_id", "message_key"]
#: What a batch has added to a message's entry in the stored ledger.
BATCH_ENTRY = ["batch_id", "attempts", "document_id", "stage", "error_type", "error"]
LEDGER_ARRAY = (
    "array<struct<batch_id:bigint,attempts:bigint,document_id:string,stage:string,error_type:string,error:string>>"
)


def failure_rows(failed: DataFrame, stage: str) -> DataFrame:
    """Failed requests as failure records; the object key itself is left out."""
    return failed.select(
        "message_id",
        "message_key",
        "document_id",
        "version",
        F.lit(stage).alias("stage"),
        "error_type",
        "error",
        (F.col("error_type") != VALIDATION).alias("retryable"),
    ).select(*FAILURE.names)


def collect_failures(rejected: DataFrame, failed: DataFrame) -> DataFrame:
    """All failures of a batch: those that left at the start and those that failed later."""
    early = failure_rows(rejected, "validate")
    late = failed.select(
        *LEDGER_KEY,
        "document_id",
        "version",
        "stage",
        "error_type",
        "error",
        (F.col("error_type") != VALIDATION).alias("retryable"),
    )
    return early.unionByName(late)


def attempt_ledger(failures: DataFrame, order: str = "batch_id") -> DataFrame:
    """Failed attempts per message with the newest error."""
    newest = F.max(F.struct(F.col(order).alias("at"), "stage", "error_type", "error"))
    ledger = failures.groupBy(*LEDGER_KEY).agg(
        F.max("document_id").alias("document_id"),
        F.count(F.lit(1)).alias("attempts"),
        newest.alias("_newest"),
    )
    return ledger.select(
        *LEDGER_KEY,
        "document_id",
        "attempts",
        F.col("_newest.at").alias("last_attempt"),
        "_newest.stage",
        "_newest.error_type",
        "_newest.error",
    )


def batch_attempts(failures: DataFrame) -> DataFrame:
    """Failed attempts per message and batch, with the newest error, from rows with batch_id."""
    newest = F.max(F.struct("stage", "error_type", "error"))
    counted = failures.groupBy(*LEDGER_KEY, "batch_id").agg(
        F.max("document_id").alias("document_id"), F.count(F.lit(1)).alias("attempts"), newest.alias("_newest")
    )
    return counted.select(*LEDGER_KEY, "batch_id", "attempts", "document_id", "_newest.*")


def ledger_entries(attempts: DataFrame) -> DataFrame:
    """One entry per message, with what each batch has added to it, from batch_attempts."""
    entries = attempts.groupBy(*LEDGER_KEY).agg(F.sort_array(F.collect_list(F.struct(*BATCH_ENTRY))).alias("by_batch"))
    return entries.withColumn("revision", F.lit(0).cast("bigint"))


def newest_entries(entries: DataFrame) -> DataFrame:
    """The entry of the highest revision of each message."""
    newest = entries.groupBy(*LEDGER_KEY).agg(F.max_by("by_batch", "revision").alias("by_batch"), F.max("revision").alias("revision"))
    return newest.select(*LEDGER_KEY, "by_batch", "revision")


def merge_attempts(entries: DataFrame, attempts: DataFrame, batch_id: int) -> DataFrame:
    """The entries that a batch changes, each a revision higher.

    What an earlier run of the batch added is taken out, also where the message did not fail this
    time. So batches can run again, in any order, and merging twice changes no count.
    `attempts` are the batch's own, `entries` the newest of all messages that it may concern.
    """
    own = attempts.select(*[F.col(c).alias(f"_{c}") for c in LEDGER_KEY], F.struct(*BATCH_ENTRY).alias("_own"))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in LEDGER_KEY]
    known = entries.withColumn("_known", F.lit(True))
    joined = known.join(own, same[0] & same[1], "full")
    others = F.filter(F.coalesce("by_batch", F.array().cast(LEDGER_ARRAY)), lambda b: b["batch_id"] != batch_id)
    merged = F.when(F.col("_own").isNull(), others).otherwise(F.sort_array(F.concat(others, F.array("_own"))))
    concerned = F.col("_own").isNotNull() | F.exists("by_batch", lambda b: b["batch_id"] == batch_id)
    keys = [F.when(F.col("_known"), F.col(c)).otherwise(F.col(f"_{c}")).alias(c) for c in LEDGER_KEY]
    return joined.filter(concerned).select(*keys, merged.alias("by_batch"), (F.coalesce("revision", F.lit(-1)) + 1).alias("revision"))


def ledger_of(entries: DataFrame) -> DataFrame:
    """The newest entries in the columns of `attempt_ledger`; messages without attempts are left out."""
    newest = F.array_max(F.transform("by_batch", lambda b: F.struct(b["batch_id"].alias("at"), b["stage"].alias("stage"), b["error_type"].alias("error_type"), b["error"].alias("error"))))
    return entries.filter(F.size("by_batch") > 0).select(
        *LEDGER_KEY,
        F.array_max("by_batch.document_id").alias("document_id"),
        F.aggregate("by_batch", F.lit(0).cast("bigint"), lambda n, b: n + b["attempts"]).alias("attempts"),
        newest["at"].alias("last_attempt"),
        newest["stage"].alias("stage"),
        newest["error_type"].alias("error_type"),
        newest["error"].alias("error"),
    )


def dead_letters(ledger: DataFrame, max_deliveries: int = 3) -> DataFrame:
    return ledger.filter(F.col("attempts") >= max_deliveries)


def still_retrying(ledger: DataFrame, max_deliveries: int = 3) -> DataFrame:
    return ledger.filter(F.col("attempts") < max_deliveries)


def select_for_retry(
    messages: DataFrame, failures: DataFrame, dead: DataFrame | None = None, explode_records: bool = False
) -> DataFrame:
    """Messages to deliver again: those listed as failed, without the dead letters.

    Messages are told apart as in the ledger. With explode_records a message with several
    failed records is delivered once.
    """
    due = failures.select(*LEDGER_KEY).distinct()
    if dead is not None:
        due = due.join(dead.select(*LEDGER_KEY), LEDGER_KEY, "left_anti")
    whole = messages.withColumn("_message", F.struct(*messages.columns))
    named = parse_notifications(whole, explode_records).select(
        "_message", "message_id", message_key(F.col("source_key"), F.col("body_digest")).alias("message_key")
    )
    found = named.join(due, LEDGER_KEY, "left_semi").select("_message.*")
    return found.dropDuplicates(messages.columns) if explode_records else found
