"""Object keys and document identity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Key prefixes and the key length limit.
INCOMING_PREFIX = "incoming/"
OUTPUT_PREFIX = "processed/"
AUDIT_PREFIX = "lambda-audit/"
MAX_KEY_LENGTH = 1024


def decode_key(key: Column) -> Column:
    """Form-decode a key: '+' is a space, %XX a byte, any other '%' stays as it is."""
    return F.try_url_decode(F.regexp_replace(key, "%(?![0-9A-Fa-f]{2})", "%25"))


def document_id(key: Column) -> Column:
    """SHA-256 hex of a key; NULL for an empty key, which has no identity."""
    return F.when(F.length(key) > 0, F.sha2(key, 256))


def output_key(key: Column) -> Column:
    stripped = F.regexp_replace(key, f"^{INCOMING_PREFIX}", "")
    return F.concat(F.lit(OUTPUT_PREFIX), stripped)


def audit_key(audit_date: Column, doc_id: Column, version: Column) -> Column:
    name = F.concat(doc_id, F.lit("-"), version.cast("string"), F.lit(".json"))
    return F.concat(F.lit(AUDIT_PREFIX), audit_date.cast("string"), F.lit("/"), name)
