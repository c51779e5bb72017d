"""Job parameters used by the data logic."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class JobSettings:
    expected_bucket: str | None = None
    ttl_days: int = 365
    # Cut texts before a model, and replace large classifications by a marker. Both lose values,
    # so they are off unless a number is given.
    max_text_chars: int | None = None
    max_pii_bytes: int | None = None
    # A model gets longer texts in pieces of so many characters, each starting so many before
    # the end of the last.
    piece_chars: int = 180_000
    piece_overlap: int = 1_000
    max_attempts: int = 3
    retry_base_ms: int = 500
    max_deliveries: int = 3
    slow_ms: int = 108_000
    # Tasks that share the calls to a model; None leaves it to the plan.
    model_tasks: int | None = None
