"""Schemas of the records that flow through the pipeline."""

from __future__ import annotations

from pyspark.sql import types as T

# The six list categories, then the typed one.
LIST_CATEGORIES = ["names", "emails", "phones", "ssns", "addresses", "dates_of_birth"]
CATEGORIES = [*LIST_CATEGORIES, "other_pii"]

OTHER_PII_ITEM = T.StructType().add("type", T.StringType()).add("value", T.StringType())

CLASSIFICATION = T.StructType(
    [T.StructField(c, T.ArrayType(T.StringType())) for c in LIST_CATEGORIES]
    + [
        T.StructField("other_pii", T.ArrayType(OTHER_PII_ITEM)),
        T.StructField("parse_error", T.BooleanType()),
    ]
)

COUNTS = T.StructType([T.StructField(c, T.IntegerType()) for c in CATEGORIES])

# One queue message per JSON line.
MESSAGE = "messageId STRING, body STRING, receivedAt TIMESTAMP"
# One delivered batch per JSON document.
DELIVERY = "Records ARRAY<STRUCT<messageId: STRING, body: STRING, receivedAt: TIMESTAMP>>, unreadable STRING"

OCR_BLOCKS = T.ArrayType(
    T.StructType().add("BlockType", T.StringType()).add("Text", T.StringType())
)

# The moment a batch was first run at.
MOMENT = T.StructType().add("as_of_us", T.LongType())

REQUEST = (
    T.StructType()
    .add("message_id", T.StringType())
    .add("message_key", T.StringType())
    .add("source_bucket", T.StringType())
    .add("source_key", T.StringType())
    .add("document_id", T.StringType())
    .add("version", T.LongType())
    .add("error_type", T.StringType())
    .add("error", T.StringType())
)

RESULT = (
    T.StructType()
    .add("source_bucket", T.StringType())
    .add("source_key", T.StringType())
    .add("blank", T.BooleanType())
    .add("stage", T.StringType())
    .add("classification", CLASSIFICATION)
    .add("error_type", T.StringType())
    .add("error", T.StringType())
)

OUTCOME = (
    T.StructType()
    .add("message_id", T.StringType())
    .add("message_key", T.StringType())
    .add("source_bucket", T.StringType())
    .add("source_key", T.StringType())
    .add("document_id", T.StringType())
    .add("version", T.LongType())
    .add("stage", T.StringType())
    .add("error_type", T.StringType())
    .add("error", T.StringType())
    .add("blank", T.BooleanType())
    .add("classification", CLASSIFICATION)
)

VAULT = (
    T.StructType()
    .add("document_id", T.StringType())
    .add("version", T.LongType())
    .add("source_key", T.StringType())
    .add("source_bucket", T.StringType())
    .add("source_key_hash", T.StringType())
    .add("pii_counts", T.StringType())
    .add("pii_data", T.StringType())
    .add("processed_at", T.StringType())
    .add("duration_ms", T.LongType())
    .add("expires_at", T.LongType())
)

OUTPUT = (
    T.StructType()
    .add("output_key", T.StringType())
    .add("source_bucket", T.StringType())
    .add("document_id", T.StringType())
    .add("version", T.LongType())
    .add("pii_counts", COUNTS)
)

AUDIT = (
    T.StructType()
    .add("audit_key", T.StringType())
    .add("document_id", T.StringType())
    .add("version", T.LongType())
    .add("source_key_hash", T.StringType())
    .add("source_bucket", T.StringType())
    .add("pii_counts", COUNTS)
    .add("expires_at", T.LongType())
    .add("processed_at", T.StringType())
    .add("duration_ms", T.LongType())
)

# Where the records of a source key stand in the vault.
INDEX = (
    T.StructType()
    .add("source_key", T.StringType())
    .add("source_bucket", T.StringType())
    .add("document_id", T.StringType())
    .add("version", T.LongType())
    .add("version_date", T.DateType())
)

FAILURE = (
    T.StructType()
    .add("message_id", T.StringType())
    .add("message_key", T.StringType())
    .add("document_id", T.StringType())
    .add("version", T.LongType())
    .add("stage", T.StringType())
    .add("error_type", T.StringType())
    .add("error", T.StringType())
    .add("retryable", T.BooleanType())
)
