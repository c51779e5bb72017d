"""Computing intermediate columns once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute_once(rows: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that later steps refer to instead of repeating their expressions.

    Filters are pushed below plain projections together with a copy of the expressions they
    use, and a chain of derived columns then grows with every level. The fields of an
    exploded one-item array stay as they were computed, without an exchange.
    """
    row = F.struct(*[value.alias(name) for name, value in columns.items()])
    return rows.select("*", F.inline(F.array(row)))
