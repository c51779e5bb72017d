"""Social security number masking and its check."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The masked forms.
MASK_PREFIX = "XXX-XX-"
MASK_ALL = "XXX-XX-XXXX"


def mask_ssn(raw: Column) -> Column:
    """Keep the last four digits of any script; hide all when there are fewer than four."""
    digits = F.regexp_replace(F.coalesce(raw, F.lit("")), r"\P{Nd}", "")
    last_four = F.concat(F.lit(MASK_PREFIX), F.substring(digits, -4, 4))
    return F.when(F.length(digits) >= 4, last_four).otherwise(F.lit(MASK_ALL))


def mask_ssns(classification: Column) -> Column:
    return classification.withField("ssns", F.transform(classification["ssns"], mask_ssn))


def has_unmasked(ssns: Column) -> Column:
    masked = r"^XXX-XX-(\p{Nd}{4}|XXXX)$"
    return F.coalesce(
        F.exists(ssns, lambda s: ~F.coalesce(s.rlike(masked), F.lit(False))), F.lit(False)
    )
