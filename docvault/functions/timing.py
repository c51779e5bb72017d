"""Versions, expiry and durations, all from explicit timestamps."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86_400


def moment(as_of: datetime | str | Column) -> Column:
    """A timestamp column from a job parameter; text is read as UTC."""
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of).cast("timestamp")


def version_ms(received_at: Column) -> Column:
    return F.unix_millis(received_at)


def processed_at(as_of: Column) -> Column:
    """ISO 8601 in UTC; the fraction is left out when it is zero."""
    whole = F.date_format(as_of, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    fine = F.date_format(as_of, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    return F.when(F.pmod(F.unix_micros(as_of), F.lit(1_000_000)) == 0, whole).otherwise(fine)


def expires_at(as_of: Column, ttl_days: int) -> Column:
    return F.unix_seconds(as_of) + F.lit(ttl_days * SECONDS_PER_DAY)


def duration_ms(as_of: Column, version: Column) -> Column:
    return F.unix_millis(as_of) - version
