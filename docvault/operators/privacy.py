"""Checks that no raw value leaves the vault."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docvault.functions.masking import has_unmasked

#: Lists of more values than this are searched by an automaton, others value by value.
FEW = 16


def check_masked(classified: DataFrame) -> DataFrame:
    """Rows whose social security numbers are not all masked."""
    return classified.filter(has_unmasked(F.col("classification.ssns")))


def outward_texts(rows: DataFrame, kind: str) -> DataFrame:
    """(document_id, record_kind, record_id, text) of the rows of an outward table."""
    whole = F.struct(*[c for c in rows.columns])
    return rows.select(
        "document_id",
        F.lit(kind).alias("record_kind"),
        F.to_json(whole).alias("text"),
    ).withColumn("record_id", F.sha2("text", 256))


def written_forms(value: Column) -> Column:
    """A value as it is and as it looks inside a JSON string."""
    quoted = F.to_json(F.struct(value.alias("v")))
    return F.array_distinct(F.array(value, F.substring(quoted, F.lit(7), F.length(quoted) - 8)))


@F.pandas_udf(T.ArrayType(T.StringType()))
def found_together(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """The values of a list that stand in a text, from one pass over the text.

    Records of one document follow each other out of a join, so the last automaton is kept.
    """
    last, automaton = None, None
    for texts, lists in batches:
        found = []
        for text, values in zip(texts, lists):
            if text is None or values is None:
                found.append(None)
                continue
            values = tuple(values)
            if values != last:
                last, automaton = values, ahocorasick.Automaton()
                for value in values:
                    automaton.add_word(value, value)
                automaton.make_automaton()
            found.append(sorted({value for _, value in automaton.iter(text)}))
        yield pd.Series(found, dtype=object)


def values_in(text: Column, values: Column, few: int) -> Column:
    """The values that stand in a text; only long lists and their texts go to Python."""
    short = F.size(values) <= few
    one_by_one = F.filter(values, lambda v: text.contains(v))
    together = found_together(F.when(~short, text), F.when(~short, values))
    return F.when(short, one_by_one).otherwise(together)


def scan_for_leaks(
    values: DataFrame,
    outward: DataFrame,
    list_values: int = 5_000,
    list_bytes: int = 250_000,
    few: int = FEW,
) -> DataFrame:
    """Values of a document that appear in an outward record of the same document.

    values has (document_id, value), outward what outward_texts gives. The distinct values of a
    document are dealt by their hash into lists of about `list_values` values and `list_bytes`
    bytes. Every record of the document meets every list, is searched for all its values in one
    pass where they meet, and only hits go on; so nothing is paired within a group, no list grows
    with its document, and the work goes with texts and values, not with their product.
    """
    distinct = (
        values.filter("document_id IS NOT NULL AND value != ''")
        .select("document_id", F.explode(written_forms(F.col("value"))).alias("value"))
        .filter("value IS NOT NULL")
        .distinct()
    )
    sizes = distinct.groupBy("document_id").agg(
        F.ceil(F.greatest(F.count(F.lit(1)) / list_values, F.sum(F.octet_length("value")) / list_bytes)).alias("_lists")
    )
    number = F.pmod(F.xxhash64("value"), F.col("_lists"))
    lists = (
        distinct.join(sizes, "document_id")
        .groupBy("document_id", number.alias("_list"))
        .agg(F.collect_list("value").alias("_values"))
    )
    outward = outward.filter("document_id IS NOT NULL AND text IS NOT NULL")
    hits = values_in(F.col("text"), F.col("_values"), few)
    found = outward.join(lists, "document_id").withColumn("value", F.explode(hits))
    return found.select("document_id", "record_kind", "record_id", "value").distinct()
