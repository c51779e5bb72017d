"""Reading documents: stored texts, OCR blocks, or raw objects for a text extractor."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docvault.functions.text import assemble_lines

# Object stores address a document as <scheme>://<bucket>/<key>.
OBJECT_PATH = "^[^:]+:/+([^/]+)/(.*)$"


def texts_from_blocks(documents: DataFrame) -> DataFrame:
    """(source_bucket, source_key, text) from rows that hold a document's ordered blocks."""
    return documents.select("source_bucket", "source_key", assemble_lines(F.col("blocks")).alias("text"))


def joined_lines(rows: DataFrame, by: list[str], text: str, order: str) -> DataFrame:
    return rows.groupBy(*by).agg(
        F.expr(f"listagg({text}, '\\n') WITHIN GROUP (ORDER BY {order})").alias(text)
    )


def texts_from_block_rows(blocks: DataFrame, keys: list[str], chunk: int = 4096) -> DataFrame:
    """Text per document from one row per block (keys, seq, BlockType, Text).

    seq numbers the blocks of a document from zero. Documents without lines give "". Lines are
    joined within runs of `chunk` numbers first and the runs after that, so the task that ends
    up with a text never holds its single blocks.
    """
    line = F.when((F.col("BlockType") == "LINE") & (F.length("Text") > 0), F.col("Text"))
    run = F.floor(F.col("seq") / chunk)
    lines = blocks.select(*keys, "seq", run.alias("_run"), line.alias("text"))
    runs = joined_lines(lines, [*keys, "_run"], "text", "seq")
    whole = joined_lines(runs, keys, "text", "_run")
    return whole.select(*keys, F.coalesce("text", F.lit("")).alias("text"))


def read_objects(spark: SparkSession, path: str) -> DataFrame:
    """(source_bucket, source_key, content) of stored files, for operators.classify.extract_with."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(
        F.regexp_extract("path", OBJECT_PATH, 1).alias("source_bucket"),
        F.regexp_extract("path", OBJECT_PATH, 2).alias("source_key"),
        "content",
    )
