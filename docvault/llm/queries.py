"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docvault.llm import (
    conversations,
    decontamination,
    fingerprints,
    jaccard_join,
    language_mixture,
    line_dedup,
    manifest,
    minhash,
    packing,
    quality,
    sharding,
    surrogates,
    warc,
)
from docvault.session import configure

#: The key of the surrogates; a job passes its own.
SURROGATE_SECRET = os.environ.get("DOCVAULT_SURROGATE_SECRET", "test key")
TOKENIZER = "word_bpe_49k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def id_part(parts: int) -> Column:
    """The checksum of the id as text, modulo `parts`; null without an id."""
    return F.pmod(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")), F.lit(parts))


def held_out(parts: int, part: int) -> Column:
    return F.coalesce(id_part(parts) == part, F.lit(False))


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_next(table(spark, sf_dir, "documents"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.hilbert_shards(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "curve",
    )


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


def op5_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    replaced = surrogates.replace_entities(table(spark, sf_dir, "documents"), SURROGATE_SECRET)
    return replaced.select("doc_id", "n_entities", "kinds", "text")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    text = F.coalesce("text", F.lit(""))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(text, 256).alias("kept_sha256"))


def op8_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language_mixture.identify(docs, docs.where(~held_out(4, 2)))
    return found.select("doc_id", held_out(4, 2).alias("held_out"), "lang_pred", "score", "mixture")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels.where(~held_out(5, 0)))
    scored = quality.score(docs, model, "doc_id")
    return scored.select("doc_id", held_out(5, 0).alias("held_out"), "score", "predicted")


def damaged_replica(pages: DataFrame) -> DataFrame:
    """The pages with one character overwritten in some and a few missing, by fixed rules."""
    half = F.floor(F.length("html") / 2).cast("int")
    flipped = F.concat(F.substr("html", F.lit(1), half), F.lit("~"), F.substr("html", half + 2))
    html = F.when(F.expr("page_id % 97 = 13"), flipped).otherwise(F.col("html"))
    return pages.where("NOT coalesce(page_id % 5003 = 4007, false)").withColumn("html", html)


def op10_warc_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return warc.replica_audit(pages, damaged_replica(pages))


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = manifest.verified_versions(docs, id_part(5) == 0, manifest.lower_cased(F.col("text")))
    return found.withColumn("n_copied", F.size("copied")).drop("copied")


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_damaged(table(spark, sf_dir, "conversations"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        op1_fingerprints, op2_sharding, op3_decontamination, op4_jaccard_join, op5_surrogates,
        op6_packing, op7_line_dedup, op8_language_mixture, op9_quality, op10_warc_audit,
        op11_minhash, op12_manifest, op13_conversations, pipeline,
    ]
    return {query.__name__: query for query in found}
