"""Tables the pipeline writes, and how a batch replaces all of itself.

A table is a folder with one part per batch. A write puts a whole part in place of the one that
was there, also when the new rows are fewer, lie on other days, or are none, so a batch that is
run again leaves what its last run made. The vault and the audit table are divided by day
inside their parts, which lets readers prune by time; the index is divided by a hash of the
source key, so that a point read opens one folder of a part.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docvault.schemas import AUDIT, FAILURE, INDEX, MOMENT, OUTPUT, REQUEST, RESULT, VAULT


@dataclass(frozen=True)
class Tables:
    """Folders of one pipeline under a shared root."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"


#: Columns of each table, and the column that divides its parts.
LAYOUT = {
    "moments": (MOMENT, []),
    "requests": (REQUEST, []),
    "results": (RESULT, []),
    "distinct": (REQUEST, []),
    "vault": (VAULT, ["version_date"]),
    "index": (INDEX, ["slot"]),
    "output": (OUTPUT, []),
    "audit": (AUDIT, ["audit_date"]),
    "failures": (FAILURE, []),
}
#: The column that spreads rows over files, and the one they are sorted by inside a file, so
#: that reads by key can skip parts of it.
SPREAD = {
    "moments": "as_of_us",
    "requests": "message_id",
    "results": "source_key",
    "distinct": "document_id",
    "vault": "version_date",
    "index": "slot",
    "output": "document_id",
    "audit": "audit_date",
    "failures": "message_id",
}
SORTED = {"vault": "source_key", "index": "source_key", "output": "output_key"}
DIVIDED_BY = {"version_date": T.DateType(), "audit_date": T.DateType(), "slot": T.IntegerType()}
#: Working tables hold only the batch that is running; the others are the pipeline's results.
WORKING = ["requests", "results"]
#: The part that holds batches whose parts were merged.
MERGED = -1


def full_schema(name: str) -> T.StructType:
    fields, days = LAYOUT[name]
    added = [T.StructField("batch_id", T.LongType()), T.StructField("part", T.LongType())]
    return T.StructType(fields.fields + added + [T.StructField(d, DIVIDED_BY[d]) for d in days])


#: The tables that an application has seen to already.
_made: set[tuple[str, str]] = set()


def create_tables(spark: SparkSession, tables: Tables) -> None:
    """Make the folders of tables that do not exist yet, once in an application."""
    key = (spark.sparkContext.applicationId, tables.root)
    if key in _made:
        return
    _made.add(key)
    nothing = spark.range(0, 0, 1, 1)
    for name in LAYOUT:
        columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in full_schema(name)]
        nothing.select(*columns).write.mode("ignore").parquet(tables.path(name))


def read_parts(spark: SparkSession, tables: Tables, name: str) -> DataFrame:
    """All batches of a table, with batch_id and the part that they are in."""
    return spark.read.schema(full_schema(name)).parquet(tables.path(name))


def read_table(spark: SparkSession, tables: Tables, name: str) -> DataFrame:
    """All batches of a table, with batch_id."""
    return read_parts(spark, tables, name).drop("part")


def read_batch(spark: SparkSession, tables: Tables, name: str, batch_id: int) -> DataFrame:
    """One batch of a table; lists its own folder only. Without one, no rows."""
    reader = spark.read.schema(full_schema(name)).option("basePath", tables.path(name))
    try:
        return reader.parquet(f"{tables.path(name)}/part={batch_id}").drop("part")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], full_schema(name)).drop("part")


def laid_out(rows: DataFrame, name: str, by: list[str]) -> DataFrame:
    """Rows in files of even size: small pieces are merged and hot ones split.

    The rebalance step goes by a column, not round robin: a task that is run again sends its
    rows to the same places.
    """
    rows = rows.hint("rebalance", SPREAD[name])
    return rows.sortWithinPartitions(*by, SORTED[name]) if name in SORTED else rows


def write_batch(rows: DataFrame, tables: Tables, name: str, batch_id: int) -> None:
    """Write one batch of a table in place of whatever an earlier run of it has left."""
    fields, days = LAYOUT[name]
    batch = rows.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    batch = laid_out(batch.select(*fields.names, "batch_id", *days), name, days)
    writer = batch.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*days) if days else writer).parquet(f"{tables.path(name)}/part={batch_id}")


def clear_batch(spark: SparkSession, tables: Tables, name: str, batch_id: int) -> None:
    write_batch(read_batch(spark, tables, name, batch_id).filter("false"), tables, name, batch_id)


def write_merged(rows: DataFrame, target: Tables, name: str, merge_before: int) -> None:
    """Rows of a table into a new place, all batches below a number as one part."""
    fields, days = LAYOUT[name]
    part = F.when(F.col("batch_id") < merge_before, F.lit(MERGED)).otherwise(F.col("batch_id"))
    rows = rows.withColumn("part", part.cast("bigint")).select(*fields.names, "batch_id", "part", *days)
    laid_out(rows, name, ["part", *days]).write.mode("errorifexists").partitionBy("part", *days).parquet(target.path(name))


def write_json(rows: DataFrame, path: str, partitions: list[str]) -> None:
    """Summaries as JSON lines, for readers that expect JSON objects."""
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("ignoreNullFields", "false")
        .partitionBy(*partitions)
        .json(path)
    )
