"""Aggregations over records, audit rows and failures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docvault.functions.classification import item_total
from docvault.operators.percentiles import group_percentiles
from docvault.schemas import CATEGORIES, LIST_CATEGORIES


def pii_items(classification: Column) -> Column:
    """Array of (category, type, value) over the seven lists."""

    def plain(name: str) -> Column:
        return F.transform(
            classification[name],
            lambda v: F.struct(
                F.lit(name).alias("category"),
                F.lit(None).cast("string").alias("type"),
                v.alias("value"),
            ),
        )

    other = F.transform(
        classification["other_pii"],
        lambda i: F.struct(
            F.lit("other_pii").alias("category"),
            i["type"].alias("type"),
            i["value"].alias("value"),
        ),
    )
    return F.concat(*[plain(c) for c in LIST_CATEGORIES], other)


def explode_pii(classified: DataFrame, carry: list[str]) -> DataFrame:
    """One row per found item."""
    items = classified.select(*carry, pii_items(F.col("classification")).alias("_items"))
    return items.select(*carry, F.explode("_items").alias("_item")).select(*carry, "_item.*")


def category_totals(counted: DataFrame, by: list[str], rollup: bool = False) -> DataFrame:
    """Items per category and group from a pii_counts column, in long form.

    The seven sums are taken in one pass and turned into rows afterwards, so only one row
    per group is exchanged. With rollup there are also totals over the groups and over the
    categories, marked by nulls.
    """
    sums = [F.sum(F.col("pii_counts")[c]).alias(c) for c in CATEGORIES]
    documents = F.count(F.lit(1)).alias("documents")
    grouped = counted.rollup(*by) if rollup else counted.groupBy(*by)
    wide = grouped.agg(documents, *sums)
    pairs = [F.struct(F.lit(c).alias("category"), F.col(c).alias("items")) for c in CATEGORIES]
    if rollup:
        total = sum((F.col(c) for c in CATEGORIES[1:]), F.col(CATEGORIES[0]))
        pairs.append(F.struct(F.lit(None).cast("string").alias("category"), total.alias("items")))
    long = wide.select(*by, "documents", F.explode(F.array(*pairs)).alias("_pair"))
    return long.select(*by, "_pair.category", "documents", "_pair.items")


def batch_summary(outcomes: DataFrame) -> DataFrame:
    """Messages received and failed per batch."""
    return outcomes.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("received"),
        F.count_if(F.col("error").isNotNull()).alias("failed"),
    )


def failure_breakdown(failures: DataFrame) -> DataFrame:
    return failures.groupBy("stage", "error_type", "error").agg(F.count(F.lit(1)).alias("failures"))


def audit_history(audit: DataFrame) -> DataFrame:
    """Documents, items and duration statistics per day and bucket.

    Sums are taken with partial results; the exact percentiles order only the durations near
    them, so a day with most of the rows is no single task.
    """
    group = ["audit_date", "source_bucket"]
    rows = audit.select(*group, item_total(F.col("pii_counts")).alias("_items"), "duration_ms")
    totals = rows.groupBy(*group).agg(
        F.count(F.lit(1)).alias("documents"),
        F.sum("_items").alias("items"),
        F.min("duration_ms").alias("min_duration_ms"),
        F.max("duration_ms").alias("max_duration_ms"),
    )
    named = {"p50_duration_ms": 0.5, "p99_duration_ms": 0.99}
    return totals.join(group_percentiles(rows, group, "duration_ms", named), group)
