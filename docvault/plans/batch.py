"""Processing one batch of messages into the pipeline's tables, and keeping the tables."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from functools import partial, reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docvault.functions.timing import SECONDS_PER_DAY, moment
from docvault.operators.delivery import collect_failures
from docvault.operators.ingest import split_valid
from docvault.operators.lookup import KEY, likely_requested
from docvault.operators.vault import (
    IDENTITY,
    active_records,
    append_new_only,
    audit_rows,
    output_rows,
    vault_rows,
    version_date,
)
from docvault.plans.process import Documents, failed, outcomes_of, requests_of, results_of, stored
from docvault.settings import JobSettings
from docvault.sources.answers import Answers, answered, clear_working
from docvault.sources.ledger import add_batch, rebuild
from docvault.sources.records import index_rows
from docvault.sources.sinks import (
    LAYOUT,
    WORKING,
    Tables,
    clear_batch,
    create_tables,
    read_batch,
    read_table,
    write_batch,
    write_merged,
)


def first_moment(spark, tables: Tables, batch_id: int, as_of: datetime | str) -> tuple[Column, bool]:
    """The moment that the batch was first run at, which a later run keeps to, and whether this is one."""
    known = read_batch(spark, tables, "moments", batch_id).first()
    again = known is not None
    if not again:
        now = spark.range(1).select(F.unix_micros(moment(as_of)).alias("as_of_us"))
        write_batch(now, tables, "moments", batch_id)
        known = read_batch(spark, tables, "moments", batch_id).first()
    return F.timestamp_micros(F.lit(known["as_of_us"])), again


def process_batch(
    messages: DataFrame,
    documents: Documents,
    tables: Tables,
    batch_id: int,
    as_of: datetime | str,
    settings: JobSettings,
    model: Callable[[str, str], str] | None = None,
    explode_records: bool = False,
    whole_table: bool = False,
    answers: Answers | None = None,
) -> None:
    """Write vault, output, audit and failure rows of one batch; safe to repeat.

    Each step is written before the next reads it, so messages are parsed once, a model is
    called once per document, and a lost executor costs at most the running step. Steps that do
    not need each other run side by side. What was found stands once per document; messages about it carry keys only, and duplicates are gone
    before what was found is joined on. Output and audit are read off the vault rows that were
    written, so duplicates have neither, and so is the index by source key.

    Run again, a batch replaces all that it wrote, whatever comes out this time, and keeps the
    moment of its first run. The working tables hold nothing of a batch once it is through.

    The documents asked for are classified where they lie, as long as hashes of their keys can
    be handed round; see `likely_requested`.

    With a table of answers the model is called once per content, whichever batch has it first.
    """
    spark = messages.sparkSession
    create_tables(spark, tables)
    now, again = first_moment(spark, tables, batch_id, as_of)

    write_batch(requests_of(messages, settings, explode_records), tables, "requests", batch_id)
    valid, rejected = split_valid(read_batch(spark, tables, "requests", batch_id).drop("batch_id"))
    classify = None
    if answers and model:
        classify = partial(
            answered, model=model, answers=answers, settings=settings, batch_id=batch_id, now=now
        )
    if not callable(documents) and not whole_table:
        documents, whole_table = likely_requested(documents, valid)
    found = results_of(valid, documents, settings, model, whole_table, classify)
    write_batch(found, tables, "results", batch_id)
    if classify:
        clear_working(spark, answers, batch_id)
    results = read_batch(spark, tables, "results", batch_id).drop("batch_id")

    outcomes = outcomes_of(valid, results.drop("classification"))

    def write_failures() -> None:
        write_batch(collect_failures(rejected, failed(outcomes)), tables, "failures", batch_id)
        add_batch(spark, tables, batch_id, again)

    def write_records() -> None:
        # The day range of the batch prunes the vault.
        candidates = stored(outcomes).select(*IDENTITY, "source_key").distinct()
        day = version_date(F.col("version"))
        first, last = candidates.agg(F.min(day), F.max(day)).first()
        in_range = F.lit(False) if first is None else F.col("version_date").between(first, last)
        others = read_table(spark, tables, "vault").filter(in_range & (F.col("batch_id") != batch_id))
        fresh = append_new_only(candidates, others.select(*IDENTITY))
        found = fresh.join(results.select(*KEY, "classification"), KEY)
        records = vault_rows(found, settings, now)
        write_batch(records.withColumn("version_date", day), tables, "vault", batch_id)

    at_once(write_failures, write_records)
    written = read_batch(spark, tables, "vault", batch_id)
    beside = {"output": output_rows, "audit": audit_rows, "index": index_rows}
    at_once(*[partial(write_batch, rows(written), tables, name, batch_id) for name, rows in beside.items()])
    at_once(*[partial(clear_batch, spark, tables, name, batch_id) for name in WORKING])


def at_once(*steps: Callable[[], None]) -> None:
    """Run independent steps side by side; waits for all, and fails if one does.

    Threads of the driver that submit jobs; each keeps the properties of the caller's thread.
    """
    with ThreadPoolExecutor(len(steps)) as pool:
        running = [pool.submit(inheritable_thread_target(step)) for step in steps]
    for step in running:
        step.result()


def write_snapshot(
    spark, tables: Tables, target: Tables, as_of: datetime | str, settings: JobSettings, merge_before: int
) -> None:
    """The tables without what has expired, and with few files, in a new place to switch to.

    Vault and audit rows go by their expires_at, output rows with their vault rows, failures by
    the age of their messages, and the ledger of attempts with them. Batches below `merge_before` become one part; they must not run
    again. Later ones keep a part of their own and can. Working tables start empty.
    """
    now_s = F.unix_seconds(moment(as_of))
    vault = active_records(read_table(spark, tables, "vault"), as_of)
    kept = {
        "vault": vault,
        "audit": active_records(read_table(spark, tables, "audit"), as_of),
        "index": index_rows(vault, "batch_id"),
        "output": read_table(spark, tables, "output").join(vault.select(*IDENTITY), IDENTITY, "left_semi"),
        "failures": read_table(spark, tables, "failures").filter(
            F.floor(F.col("version") / 1000) + settings.ttl_days * SECONDS_PER_DAY > now_s
        ),
        "distinct": read_table(spark, tables, "distinct").filter(
            F.floor(F.col("version") / 1000) + settings.ttl_days * SECONDS_PER_DAY > now_s
        ),
        "moments": read_table(spark, tables, "moments").filter(F.col("batch_id") >= merge_before),
    }
    for name, rows in kept.items():
        write_merged(rows, target, name, merge_before)
    create_tables(spark, target)
    rebuild(read_table(spark, target, "failures"), target)


def snapshot_counts(spark, tables: Tables, target: Tables) -> DataFrame:
    """Rows of each table before and after a snapshot."""
    names = [n for n in LAYOUT if n not in (*WORKING, "moments", "index")]
    counts = [
        read_table(spark, place, name).select(
            F.lit(name).alias("table_name"), F.lit(after).alias("before"), F.lit(1 - after).alias("after")
        )
        for name in names
        for place, after in ((tables, 1), (target, 0))
    ]
    rows = reduce(DataFrame.unionAll, counts)
    return rows.groupBy("table_name").agg(F.sum("before").alias("rows_before"), F.sum("after").alias("rows_after"))
