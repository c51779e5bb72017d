"""Documents to training sequences: five stages, each a table read and a table written."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docvault.llm import decontamination, jaccard_join, line_dedup, packing, quality
from docvault.llm.frames import stored
from docvault.session import configure

TOKENIZER = "word_bpe_49k.json"


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on the labelled ones, does not reject."""
    labels = configure(spark).read.parquet(f"{sf_dir}/labels.parquet")
    scored = quality.score(docs, quality.fit(docs, labels), *docs.columns)
    return scored.where("predicted = 1").drop("score", "predicted")


def without_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that many documents share; n_chars follows the text."""
    configure(spark)
    return line_dedup.dedup_lines(docs).drop("n_lines", "n_dropped").withColumn("n_chars", F.length("text").cast("bigint"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the least doc_id."""
    configure(spark)
    return jaccard_join.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    benchmark = configure(spark).read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.decontaminate(docs, benchmark)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document stands in the training sequences."""
    configure(spark)
    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality classifier", good_documents),
    ("line dedup", without_common_lines),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", without_benchmark),
    ("best-fit packing", packed),
]

#: The classifier is trained and the tokenizer is no SQL function; the tests hold the rows
#: against a plain version of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written and read again before the next."""
    docs = configure(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
