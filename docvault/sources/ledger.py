"""The stored ledger of failed attempts, to which each batch adds its own failures.

The table is only appended to: an entry of a higher revision takes the place of those before it.
It is divided by a hash of the message, so that a batch reads only where its messages may be.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docvault.operators.delivery import (
    LEDGER_ARRAY,
    LEDGER_KEY,
    batch_attempts,
    ledger_entries,
    ledger_of,
    merge_attempts,
    newest_entries,
)
from docvault.sources.sinks import Tables, read_batch

NAME = "ledger"
#: Parts of the ledger; the number stays with the table.
SLOTS = 16
SCHEMA = f"message_id string, message_key string, by_batch {LEDGER_ARRAY}, revision bigint, slot int"


def slot() -> Column:
    return F.pmod(F.xxhash64(*LEDGER_KEY), F.lit(SLOTS)).cast("int")


def stored_entries(spark: SparkSession, tables: Tables) -> DataFrame:
    try:
        return spark.read.schema(SCHEMA).parquet(tables.path(NAME))
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], SCHEMA)


def append_entries(entries: DataFrame, tables: Tables) -> None:
    rows = entries.withColumn("slot", slot()).select(*LEDGER_KEY, "by_batch", "revision", "slot")
    rows.hint("rebalance", "slot").write.mode("append").partitionBy("slot").parquet(tables.path(NAME))


def add_failures(failures: DataFrame, tables: Tables, batch_id: int, again: bool) -> None:
    """Merge a batch's failures, stored rows with batch_id, into the ledger.

    On its first run a batch reads the parts its messages hash to, at most SLOTS numbers that
    reach the driver, and nothing without failures. `again` says that it may have run before:
    then the whole ledger is searched for what that run added. A merge that was broken off is
    made good by running the batch again, as every batch stands in an entry once.
    """
    spark = failures.sparkSession
    stored = stored_entries(spark, tables)
    if not again:
        needed = [r["slot"] for r in failures.select(slot().alias("slot")).distinct().collect()]
        if not needed:
            return
        stored = stored.filter(F.col("slot").isin(needed))
    append_entries(merge_attempts(newest_entries(stored), batch_attempts(failures), batch_id), tables)


def add_batch(spark: SparkSession, tables: Tables, batch_id: int, again: bool) -> None:
    add_failures(read_batch(spark, tables, "failures", batch_id), tables, batch_id, again)


def rebuild(failures: DataFrame, tables: Tables) -> None:
    """A new ledger from failures of any batches."""
    append_entries(ledger_entries(batch_attempts(failures)), tables)


def read_ledger(spark: SparkSession, tables: Tables) -> DataFrame:
    """Failed attempts per message with the newest error, as operators.delivery.attempt_ledger has them."""
    return ledger_of(newest_entries(stored_entries(spark, tables)))
