"""The seven-category classification: shape, counts, JSON and size guard."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from docvault.functions.json_text import as_items, as_string, child, is_object
from docvault.schemas import CATEGORIES, CLASSIFICATION, LIST_CATEGORIES, OTHER_PII_ITEM

# Fixed value: what is stored when a classification is too large.
OVERSIZE_MARKER = json.dumps(
    {
        "other_pii": [
            {"type": "TRUNCATED", "value": "Response too large. Reprocess with chunked input."}
        ]
    }
)


def no_strings() -> Column:
    return F.array().cast("array<string>")


def no_items() -> Column:
    return F.array().cast(f"array<{OTHER_PII_ITEM.simpleString()}>")


def make_classification(lists: dict[str, Column], other_pii: Column, parse_error: Column) -> Column:
    fields = [lists[c].alias(c) for c in LIST_CATEGORIES]
    whole = F.struct(*fields, other_pii.alias("other_pii"), parse_error.alias("parse_error"))
    return whole.cast(CLASSIFICATION)


def parse_error_classification() -> Column:
    return make_classification(
        {c: no_strings() for c in LIST_CATEGORIES}, no_items(), F.lit(True)
    )


def string_list(value: Column, name: str) -> Column:
    """A list member as strings: empty when absent, NULL when it is not a list."""
    member = child(value, f"$.{name}")
    return F.when(member.isNull(), no_strings()).otherwise(
        F.try_variant_get(value, f"$.{name}", "array<string>")
    )


def other_pii_items(value: Column) -> Column:
    """Object items of other_pii; an absent type or value is empty, a null one stays null."""

    def field(item: Column, name: str) -> Column:
        return F.when(child(item, f"$.{name}").isNull(), F.lit("")).otherwise(
            as_string(child(item, f"$.{name}"))
        )

    objects = F.filter(as_items(child(value, "$.other_pii")), is_object)
    items = F.transform(
        objects, lambda i: F.struct(field(i, "type").alias("type"), field(i, "value").alias("value"))
    )
    return F.coalesce(items, no_items())


def json_to_classification(value: Column) -> Column:
    """A JSON object as a classification; absent keys become empty lists."""
    flagged = F.coalesce(F.try_variant_get(value, "$.parse_error", "boolean"), F.lit(False))
    lists = {c: string_list(value, c) for c in LIST_CATEGORIES}
    return make_classification(lists, other_pii_items(value), flagged)


def classification_to_json(classification: Column) -> Column:
    return F.to_json(classification, {"ignoreNullFields": "false"})


def pii_counts(classification: Column) -> Column:
    return F.struct(*[F.size(classification[c]).alias(c) for c in CATEGORIES])


def item_total(counts: Column) -> Column:
    return sum((counts[c] for c in CATEGORIES[1:]), counts[CATEGORIES[0]]).cast("bigint")


def stored_bytes(classification: Column, compact: Column) -> Column:
    """Size of the spaced, ASCII-escaped JSON that the stored-size limit is defined on.

    Against the compact text it adds one byte per separator, and it writes every character
    outside printable ASCII as six bytes, or twelve above U+FFFF.
    """
    ascii_only = (F.octet_length(compact) == F.length(compact)) & ~compact.contains("\x7f")
    wide = F.when(ascii_only, F.lit("")).otherwise(F.regexp_replace(compact, r"[\x00-\x7E]+", ""))
    astral = F.length(F.regexp_replace(wide, r"[\x{0}-\x{FFFF}]+", ""))
    commas = sum(
        (F.greatest(F.size(classification[c]) - 1, F.lit(0)) for c in CATEGORIES), F.lit(15)
    )
    item_separators = 3 * F.size(classification["other_pii"])
    return F.length(compact) + 5 * F.length(wide) + 6 * astral + commas + item_separators


def guard_size(classification: Column, compact: Column, max_bytes: int | None) -> Column:
    """The JSON text, or the marker when it is over the limit, if there is one; small texts skip the count."""
    if max_bytes is None:
        return compact
    surely_fits = F.octet_length(compact).cast("bigint") * 7 + 64 <= max_bytes
    too_large = stored_bytes(classification, compact) > max_bytes
    return (
        F.when(surely_fits, compact)
        .when(too_large, F.lit(OVERSIZE_MARKER))
        .otherwise(compact)
    )
