"""Vault rows: assembly, append-once rule, summaries and reads."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docvault.functions.classification import (
    classification_to_json,
    guard_size,
    item_total,
    json_to_classification,
    pii_counts,
)
from docvault.functions.json_text import strict_json
from docvault.functions.keys import audit_key, document_id, output_key
from docvault.functions.masking import mask_ssns
from docvault.functions.timing import duration_ms, expires_at, moment, processed_at
from docvault.operators.once import compute_once
from docvault.schemas import COUNTS
from docvault.settings import JobSettings

IDENTITY = ["document_id", "source_bucket", "version"]
HOUR_MS = 3_600_000


def vault_rows(classified: DataFrame, settings: JobSettings, as_of: datetime | str | Column) -> DataFrame:
    """Vault records from (source_bucket, source_key, version, classification).

    Social security numbers are masked here, whatever was done before. The counts are taken
    before the size guard, so they stay true when the values are replaced by the marker.
    """
    now = moment(as_of)
    doc_id = document_id(F.col("source_key"))
    found = F.col("classification")
    classified = classified.withColumn("classification", mask_ssns(found))
    compact = compute_once(classified, {"_json": classification_to_json(found)})
    return compact.select(
        doc_id.alias("document_id"),
        F.col("version").cast("bigint").alias("version"),
        "source_key",
        "source_bucket",
        doc_id.alias("source_key_hash"),
        F.to_json(pii_counts(found)).alias("pii_counts"),
        guard_size(found, F.col("_json"), settings.max_pii_bytes).alias("pii_data"),
        processed_at(now).alias("processed_at"),
        duration_ms(now, F.col("version")).alias("duration_ms"),
        expires_at(now, settings.ttl_days).alias("expires_at"),
    )


def version_date(version: Column) -> Column:
    return F.to_date(F.timestamp_millis(version))


def once_per_identity(records: DataFrame) -> DataFrame:
    """One record per (document, bucket, version); of different ones the least by all columns.

    Copies are combined before the exchange, so many copies of one record do not meet in
    one task. Pass narrow rows: keys first, what was found joined on afterwards.
    """
    rest = F.struct(*[c for c in records.columns if c not in IDENTITY])
    kept = records.groupBy(*IDENTITY).agg(F.min(rest).alias("_kept"))
    return kept.select(*IDENTITY, "_kept.*").select(*records.columns)


def append_new_only(candidates: DataFrame, existing_keys: DataFrame) -> DataFrame:
    """Candidates whose (document, bucket, version) is not in the vault yet, each once.

    The same key in two buckets are two documents. Only the key columns of the vault take
    part. Callers prune the vault to the days of the candidates first: the version decides the
    day, so no duplicate can lie elsewhere. The join finds the candidates already exchanged by
    identity.
    """
    return once_per_identity(candidates).join(
        existing_keys.select(*IDENTITY), IDENTITY, "left_anti"
    )


def read_counts(pii_counts_json: Column) -> Column:
    return F.from_json(pii_counts_json, COUNTS)


def with_classification(records: DataFrame) -> DataFrame:
    """Records with the classification read back from its stored JSON."""
    parsed = compute_once(records, {"_stored": strict_json(F.col("pii_data"))})
    found = json_to_classification(F.col("_stored"))
    return compute_once(parsed, {"classification": found}).drop("_stored")


def output_rows(written: DataFrame) -> DataFrame:
    """Count-only summaries of records that were written."""
    counted = compute_once(written, {"_counts": read_counts(F.col("pii_counts"))})
    return counted.select(
        output_key(F.col("source_key")).alias("output_key"),
        "source_bucket",
        "document_id",
        "version",
        F.col("_counts").alias("pii_counts"),
    )


def audit_rows(written: DataFrame) -> DataFrame:
    """Audit records of records that were written: counts and hashes, no values."""
    day = F.to_date(F.substring("processed_at", 1, 10))
    counted = compute_once(written, {"_counts": read_counts(F.col("pii_counts"))})
    return counted.select(
        audit_key(day, F.col("document_id"), F.col("version")).alias("audit_key"),
        "document_id",
        "version",
        "source_key_hash",
        "source_bucket",
        F.col("_counts").alias("pii_counts"),
        "expires_at",
        "processed_at",
        "duration_ms",
        day.alias("audit_date"),
    )


def find_by_source_key(records: DataFrame, source_key: str) -> DataFrame:
    return records.filter(F.col("source_key") == source_key)


def find_by_source_keys(records: DataFrame, keys: DataFrame) -> DataFrame:
    """Records of many keys at once; keys has a source_key column."""
    return records.join(keys.select("source_key").distinct(), "source_key", "left_semi")


def version_history(records: DataFrame) -> DataFrame:
    """Each record with its number among the versions of its document and what changed.

    A document is a key in a bucket. Versions are numbered within (document, hour) first. A
    document has at most one record per millisecond, so such a group is bounded whatever the
    share of the document in the table; the last record of every hour then carries the running
    totals to the next one.
    """
    document = ["document_id", "source_bucket"]
    counted = compute_once(
        records.select(*IDENTITY, "pii_counts"), {"_counts": read_counts(F.col("pii_counts"))}
    )
    slot = F.expr(f"version div {HOUR_MS}")
    base = counted.select(*IDENTITY, item_total(F.col("_counts")).alias("items"), slot.alias("_slot"))
    # The same filter and columns on both sides of the join let them share one exchange.
    base = base.filter("document_id IS NOT NULL AND source_bucket IS NOT NULL AND _slot IS NOT NULL")
    in_slot = Window.partitionBy(*document, "_slot").orderBy("version")
    numbered = base.select(
        "*",
        F.row_number().over(in_slot).alias("_n"),
        F.lag("version").over(in_slot).alias("_version_before"),
        F.lag("items").over(in_slot).alias("_items_before"),
        F.lead("version").over(in_slot).isNull().alias("_last"),
    )
    by_slot = Window.partitionBy(*document).orderBy("_slot")
    earlier = by_slot.rowsBetween(Window.unboundedPreceding, -1)
    carried = numbered.filter("_last").select(
        *document,
        "_slot",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"),
        F.lag("version").over(by_slot).alias("_version_carried"),
        F.lag("items").over(by_slot).alias("_items_carried"),
    )
    joined = numbered.join(carried, [*document, "_slot"])
    return joined.select(
        *IDENTITY,
        (F.col("_offset") + F.col("_n")).alias("version_no"),
        "items",
        F.coalesce("_version_before", "_version_carried").alias("previous_version"),
        (F.col("items") - F.coalesce("_items_before", "_items_carried")).alias("items_change"),
    )


def latest_version(rows: DataFrame, key: str = "document_id") -> DataFrame:
    """The newest row per key and bucket, as the same key in two buckets is two documents.

    The newest version is found from few columns with partial results, and joined back; of
    several rows with one version the one with the least document id stays.
    """
    rows = rows.filter(F.col(key).isNotNull() & F.col("version").isNotNull())
    newest = rows.groupBy(key, "source_bucket").agg(F.max("version").alias("version"))
    newest = newest.select(*[F.col(c).alias(f"_{c}") for c in (key, "source_bucket", "version")])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (key, "source_bucket", "version")]
    found = rows.join(newest, same[0] & same[1] & same[2], "left_semi")
    order = Window.partitionBy(key, "source_bucket").orderBy("document_id")
    return found.withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n")


def active_records(records: DataFrame, as_of: datetime | str | Column) -> DataFrame:
    return records.filter(F.col("expires_at") > F.unix_seconds(moment(as_of)))


def expired_records(records: DataFrame, as_of: datetime | str | Column) -> DataFrame:
    """Dry run of the purge: the rows that would go."""
    return records.filter(F.col("expires_at") <= F.unix_seconds(moment(as_of)))
