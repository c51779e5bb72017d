"""Documents in buckets by a hash of bucket and key, so that looking them up exchanges no text."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docvault.operators.lookup import KEY

COLUMNS = "name_hash string, source_bucket string, source_key string, text string"
# Fixed value: Spark ends the name of a bucketed file with the number of its bucket.
BUCKET_OF_FILE = r"_(\d{5})(?:[.]|$)"


@dataclass(frozen=True)
class DocumentStore:
    """A folder of Parquet files in so many buckets; the number stays with the folder."""

    path: str
    buckets: int

    @property
    def table(self) -> str:
        """The name that a session knows the folder by."""
        return "docvault_documents_" + hashlib.sha256(f"{self.path}:{self.buckets}".encode()).hexdigest()[:16]


def name_hash(bucket: Column, key: Column) -> Column:
    """One value that stands for (bucket, key)."""
    return F.sha2(F.concat(F.octet_length(bucket).cast("string"), F.lit(":"), bucket, key), 256)


def named(rows: DataFrame) -> DataFrame:
    return rows.withColumn("name_hash", name_hash(F.col("source_bucket"), F.col("source_key")))


def bucket_of(name: Column, buckets: int) -> Column:
    """The bucket that Spark puts a name into."""
    return F.pmod(F.hash(name), F.lit(buckets))


def open_store(spark: SparkSession, store: DocumentStore) -> DataFrame:
    """The table of documents; Spark knows its buckets, so joins on name_hash leave it in place."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {store.table} ({COLUMNS}) USING parquet "
        f"CLUSTERED BY (name_hash) SORTED BY (name_hash) INTO {store.buckets} BUCKETS LOCATION '{store.path}'"
    )
    spark.catalog.refreshTable(store.table)
    return spark.table(store.table)


def add_documents(documents: DataFrame, store: DocumentStore) -> None:
    """Append documents (source_bucket, source_key, text) to a store, which may be new.

    Each text is exchanged once, here. Rows without a bucket or a key cannot be asked for and are
    left out. Add each document once: a key that is there twice is found twice.
    """
    spark = documents.sparkSession
    rows = named(documents.filter("source_bucket IS NOT NULL AND source_key IS NOT NULL").select(*KEY, "text"))
    rows = rows.select("name_hash", *KEY, "text").repartition(store.buckets, "name_hash")
    writer = rows.write.mode("append").bucketBy(store.buckets, "name_hash").sortBy("name_hash")
    writer.option("path", store.path).saveAsTable(store.table)
    spark.catalog.refreshTable(store.table)


def selected(spark: SparkSession, store: DocumentStore, names: DataFrame) -> DataFrame:
    """The documents in the buckets that any of the names falls into; other files are not opened.

    Only bucket numbers, no more than there are buckets, reach the driver.
    """
    found = names.select(bucket_of(F.col("name_hash"), store.buckets).alias("b")).distinct().collect()
    needed = sorted(r["b"] for r in found if r["b"] is not None)
    rows = open_store(spark, store)
    if len(needed) < store.buckets:
        number = F.regexp_extract("_metadata.file_name", BUCKET_OF_FILE, 1).cast("int")
        rows = rows.filter(number.isin(needed) if needed else F.lit(False))
    return rows.select("name_hash", *KEY, "text")


def store_lookup(store: DocumentStore) -> Callable[[DataFrame], DataFrame]:
    """A function from distinct keys to their texts, for plans.process and streaming.runner.

    The keys are exchanged to the buckets (or broadcast, if they are few); the texts stay where
    they are. A micro-batch opens the buckets of its keys only.
    """

    def lookup(keys: DataFrame) -> DataFrame:
        names = named(keys).select("name_hash")
        found = selected(keys.sparkSession, store, names).join(names, "name_hash", "left_semi")
        return found.select(*KEY, "text")

    return lookup
