"""From queue messages to validated document requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docvault.functions.json_text import (
    as_items,
    as_string,
    child,
    is_array,
    is_object,
    is_string,
    is_truthy,
    strict_json,
)
from docvault.functions.keys import INCOMING_PREFIX, MAX_KEY_LENGTH, decode_key, document_id
from docvault.functions.timing import version_ms
from docvault.operators.once import compute_once
from docvault.settings import JobSettings

# The kinds of failure.
VALIDATION = "ValidationError"
EXTRACTION = "ExtractionError"
CLASSIFY = "ClassificationError"
UNEXPECTED = "UnexpectedError"

NOT_JSON = "body_not_json"
UNKNOWN_SHAPE = "body_not_recognised"
BAD_SHAPE = "body_malformed"


def member_or_empty(parent: Column, name: str) -> Column:
    """Member of an object, or an empty object when the member is absent."""
    return F.coalesce(child(parent, f"$.{name}"), F.parse_json(F.lit("{}")))


def direct_value(value: Column) -> Column:
    """A value of the direct form as text; JSON null counts as missing, booleans as words."""
    text = as_string(value)
    return F.when(F.schema_of_variant(value) == "BOOLEAN", F.initcap(text)).otherwise(text)


def bare_value_error(value: Column) -> Column:
    """Error code of a body that is JSON but no object.

    A list or a string is not recognised, unless it "contains" the expected names: then it
    breaks later, as numbers, booleans and null do at once.
    """
    items = F.transform(as_items(value), lambda i: F.when(is_string(i), as_string(i)))

    def names(word: str) -> Column:
        in_list = F.coalesce(F.array_contains(items, word), F.lit(False))
        in_text = F.coalesce(as_string(value).contains(word), F.lit(False))
        return F.when(is_array(value), in_list).otherwise(in_text)

    lookalike = names("Records") | (names("bucket") & names("key"))
    container = is_array(value) | is_string(value)
    return F.when(container & ~lookalike, F.lit(UNKNOWN_SHAPE)).otherwise(F.lit(BAD_SHAPE))


def parse_notifications(messages: DataFrame, explode_records: bool = False) -> DataFrame:
    """Add source_bucket, source_key, error_type and error to (message_id, body, ...).

    The event form {"Records": [{"s3": ...}]} is tried first and its key is form-decoded,
    then the direct form {"bucket", "key"}. Only the first record of an event counts unless
    explode_records is set. `body_digest` stands for the body. Nothing is raised: every other shape ends up in error_type.
    """
    carried = [c for c in messages.columns if c != "body"]
    messages = messages.withColumn("body_digest", F.sha2(F.coalesce("body", F.lit("")), 256))
    carried.append("body_digest")
    whole, records, first = F.col("_json"), F.col("_records"), F.col("_first")
    parsed = compute_once(messages, {"_json": strict_json(F.col("body"))})
    parsed = compute_once(
        parsed,
        {
            "_is_object": is_object(whole),
            "_records": child(whole, "$.Records"),
            "_direct_bucket": child(whole, "$.bucket"),
            "_direct_key": child(whole, "$.key"),
        },
    )
    event = F.col("_is_object") & is_truthy(records)
    events = F.when(is_array(records), as_items(records))
    if explode_records:
        parsed = compute_once(parsed, {"_event": event})
        parsed = parsed.select("*", F.explode_outer(events).alias("_first"))
    else:
        parsed = compute_once(parsed, {"_event": event, "_first": F.get(events, F.lit(0))})
    s3 = member_or_empty(first, "s3")
    bucket, stored = member_or_empty(s3, "bucket"), member_or_empty(s3, "object")
    parts = {"_s3": s3, "_bucket": bucket, "_object": stored}
    parts |= {"_name": child(bucket, "$.name"), "_key": child(stored, "$.key")}
    parsed = compute_once(parsed, parts)

    event_ok = is_object(first) & is_object(F.col("_s3"))
    event_ok = event_ok & is_object(F.col("_bucket")) & is_object(F.col("_object"))
    event_ok = event_ok & (F.col("_key").isNull() | is_string(F.col("_key")))
    direct_ok = F.col("_direct_bucket").isNotNull() & F.col("_direct_key").isNotNull()
    error = (
        F.when(whole.isNull(), F.lit(NOT_JSON))
        .when(~F.col("_is_object"), bare_value_error(whole))
        .when(F.col("_event"), F.when(~event_ok, F.lit(BAD_SHAPE)))
        .when(~direct_ok, F.lit(UNKNOWN_SHAPE))
    )
    event_bucket = F.when(F.col("_name").isNull(), F.lit("")).when(
        is_string(F.col("_name")), as_string(F.col("_name"))
    )
    event_key = F.when(F.col("_key").isNull(), F.lit("")).otherwise(
        decode_key(as_string(F.col("_key")))
    )
    bucket = F.when(F.col("_event"), event_bucket).otherwise(direct_value(F.col("_direct_bucket")))
    key = F.when(F.col("_event"), event_key).otherwise(direct_value(F.col("_direct_key")))
    parsed = compute_once(parsed, {"error": error})
    usable = F.col("error").isNull()
    kind = F.when(F.col("error") == BAD_SHAPE, F.lit(UNEXPECTED)).otherwise(F.lit(VALIDATION))
    request = compute_once(
        parsed,
        {
            "source_bucket": F.when(usable, bucket),
            "source_key": F.when(usable, key),
            "error_type": F.when(~usable, kind),
        },
    )
    return request.select(*carried, "source_bucket", "source_key", "error_type", "error")


def rule_broken(bucket: Column, key: Column, settings: JobSettings) -> Column:
    """Code of the first rule a request breaks, NULL when it breaks none."""
    rules = F.when(bucket.isNull() | (bucket == ""), F.lit("bucket_missing"))
    if settings.expected_bucket:
        rules = rules.when(bucket != settings.expected_bucket, F.lit("bucket_mismatch"))
    return (
        rules.when(key.isNull() | (key == ""), F.lit("key_missing"))
        .when(~key.startswith(INCOMING_PREFIX), F.lit("key_outside_incoming"))
        .when(key.contains(".."), F.lit("key_traversal"))
        .when(F.length(key) > MAX_KEY_LENGTH, F.lit("key_too_long"))
    )


def message_key(key: Column, body_digest: Column) -> Column:
    """What a message is about: its document, or its body where that names none."""
    return F.coalesce(document_id(key), F.concat(F.lit("body:"), body_digest))


def validate_inputs(parsed: DataFrame, settings: JobSettings) -> DataFrame:
    """Apply the rules to parsed requests and give every row its document id and version."""
    broken = rule_broken(F.col("source_bucket"), F.col("source_key"), settings)
    rule = F.when(F.col("_unparsed").isNull(), broken)
    checked = compute_once(parsed.withColumnRenamed("error", "_unparsed"), {"_rule": rule})
    return checked.select(
        *[c for c in parsed.columns if c not in ("error_type", "error")],
        F.when(F.col("_rule").isNotNull(), F.lit(VALIDATION))
        .otherwise(F.col("error_type"))
        .alias("error_type"),
        F.coalesce("_rule", "_unparsed").alias("error"),
        document_id(F.col("source_key")).alias("document_id"),
        message_key(F.col("source_key"), F.col("body_digest")).alias("message_key"),
        version_ms(F.col("received_at")).alias("version"),
    )


def split_valid(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Requests to go on with, and those that leave before any expensive step."""
    return checked.filter("error IS NULL"), checked.filter("error IS NOT NULL")
