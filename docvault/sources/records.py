"""Reads of the vault by source key, through an index that each batch writes beside it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docvault.sources.sinks import Tables, read_parts

#: Folders that a part of the index is divided into; the number stays with the table.
SLOTS = 16
PLACE = ["part", "version_date"]


def slot_of(source_key: Column) -> Column:
    return F.pmod(F.xxhash64(source_key), F.lit(SLOTS)).cast("int")


def index_rows(written: DataFrame, *carried: str) -> DataFrame:
    """The index entries of vault rows that were written."""
    return written.select(
        *carried, "source_key", "source_bucket", "document_id", "version", "version_date", slot_of(F.col("source_key")).alias("slot")
    )


def addresses(spark: SparkSession, tables: Tables, source_key: str) -> DataFrame:
    """The index entries of one key; opens one folder of each part."""
    key = F.lit(source_key)
    return read_parts(spark, tables, "index").filter((F.col("slot") == slot_of(key)) & (F.col("source_key") == key))


def find_records(spark: SparkSession, tables: Tables, source_key: str) -> DataFrame:
    """All records of one source key, from the parts and days that the index names.

    Those, at most one for each version of the document, reach the driver. Files of the vault
    are sorted by source key, so Parquet skips most of what is in them.
    """
    places = addresses(spark, tables, source_key).select(*PLACE).distinct().collect()
    vault = read_parts(spark, tables, "vault").filter(F.col("source_key") == source_key)
    parts, days = ({p[c] for p in places} for c in PLACE)
    in_place = F.col("part").isin(sorted(parts)) & F.col("version_date").isin(sorted(days)) if places else F.lit(False)
    return vault.filter(in_place).drop("part")


def find_records_of(spark: SparkSession, tables: Tables, keys: DataFrame) -> DataFrame:
    """The records of many source keys (a column source_key).

    The index, not the vault, is searched for the keys; the vault is then read where it has
    them: Spark prunes its parts and days by what the index gives.
    """
    wanted = keys.select("source_key").distinct().withColumn("slot", slot_of(F.col("source_key")))
    found = read_parts(spark, tables, "index").join(wanted, ["slot", "source_key"], "left_semi")
    identity = [*PLACE, "source_key", "source_bucket", "version"]
    return read_parts(spark, tables, "vault").join(found.select(*identity), identity, "left_semi").drop("part")
