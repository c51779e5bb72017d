"""A third of all rows under one key: results stay whole and the work is split."""

import json

import pytest
from pyspark.sql import functions as F

from docvault.operators import vault
from docvault.plans.process import failures_of, process_messages, records_of
from docvault.settings import JobSettings

BUCKET = "docs-in"
SETTINGS = JobSettings(expected_bucket=BUCKET)
SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "64",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
}


@pytest.fixture
def small_partitions(spark):
    before = {k: spark.conf.get(k, None) for k in SMALL}
    for key, value in SMALL.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def executed(frame):
    rows = frame.collect()
    return rows, frame._jdf.queryExecution().executedPlan().toString()


def hot_messages(spark, total):
    """Every third message is about document 0, each at its own second."""
    number = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
    key = F.concat(F.lit("incoming/"), number.cast("string"))
    return spark.range(0, total, 1, 8).select(
        F.concat(F.lit("m"), F.col("id").cast("string")).alias("message_id"),
        F.to_json(F.struct(F.lit(BUCKET).alias("bucket"), key.alias("key"))).alias("body"),
        F.timestamp_seconds(F.col("id")).alias("received_at"),
    )


def test_hot_document(spark, small_partitions):
    total = 30_000
    documents = spark.range(0, total).filter("id % 3 != 1").select(
        F.lit(BUCKET).alias("source_bucket"),
        F.concat(F.lit("incoming/"), F.col("id").cast("string")).alias("source_key"),
        F.concat(F.lit("mail user"), F.col("id").cast("string"), F.lit("@example.com")).alias("text"),
    )
    outcomes, rejected = process_messages(hot_messages(spark, total), documents, SETTINGS, whole_table=True)
    rows, plan = executed(outcomes.select("message_id", "error", "classification"))
    assert len(rows) == total and sum(r["error"] is not None for r in rows) == total // 3
    assert all(len(r["classification"]["emails"]) == 1 for r in rows if r["error"] is None)
    assert "skew=true" in plan
    assert failures_of(outcomes, rejected).count() == total // 3
    records = records_of(outcomes, SETTINGS, "2024-02-01 00:00:00")
    assert vault.append_new_only(records, records.limit(0)).count() == total - total // 3


def test_hot_history(spark, small_partitions):
    """One document with most versions: its groups are hours, and the input is read once."""
    total = 20_000
    counts = json.dumps({c: 1 for c in ["names", "emails", "phones", "ssns", "addresses", "dates_of_birth", "other_pii"]})
    records = spark.range(0, total, 1, 4).select(
        F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("document_id"),
        F.lit("b").alias("source_bucket"),
        (F.col("id") * 60_000).alias("version"),
        F.lit(counts).alias("pii_counts"),
    )
    rows, plan = executed(vault.version_history(records))
    hot = sorted((r for r in rows if r["document_id"] == "hot"), key=lambda r: r["version"])
    assert len(rows) == total
    assert [r["version_no"] for r in hot] == list(range(1, len(hot) + 1))
    assert all(b["previous_version"] == a["version"] and b["items_change"] == 0 for a, b in zip(hot, hot[1:]))
    assert "ReusedExchange" in plan
