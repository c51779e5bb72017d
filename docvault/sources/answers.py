"""Answers of a model, kept by the content they were given for.

Copies of a text, in one batch or in later ones, and batches that run again are answered from
the table; the model is asked once per content. The table is only appended to and is divided by
a hash of the content, so that a batch reads only where its contents may be. It holds masked
classifications, never a text, an unmasked social security number or a failure.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docvault.functions.masking import mask_ssns
from docvault.functions.text import SYSTEM_PROMPT, USER_PREFIX
from docvault.functions.timing import SECONDS_PER_DAY, moment
from docvault.operators.classify import classify_in_pieces
from docvault.operators.ingest import CLASSIFY
from docvault.operators.lookup import KEY
from docvault.schemas import CLASSIFICATION
from docvault.settings import JobSettings

#: Parts of the table; the number stays with the table.
SLOTS = 64
ASKED = T.StructType(
    [T.StructField(c, T.StringType()) for c in (*KEY, "stage", "error_type", "error", "ask")]
).add("blank", T.BooleanType())
TRIED = (
    T.StructType()
    .add("ask", T.StringType())
    .add("classification", CLASSIFICATION)
    .add("error_type", T.StringType())
    .add("error", T.StringType())
)
ANSWER = (
    T.StructType()
    .add("ask", T.StringType())
    .add("classification", CLASSIFICATION)
    .add("answered_us", T.LongType())
    .add("slot", T.IntegerType())
)


@dataclass(frozen=True)
class Answers:
    """A table of answers in a folder that batches share, and the model that gives them.

    The name must change with the model, or with anything in it that changes its answers.
    """

    root: str
    model_name: str

    @property
    def path(self) -> str:
        return f"{self.root.rstrip('/')}/answers"

    def working(self, batch_id: int, name: str) -> str:
        return f"{self.root.rstrip('/')}/working/batch={batch_id}/{name}"


def content_key(text: Column, answers: Answers, settings: JobSettings) -> Column:
    """What an answer depends on: model, prompt, how texts are cut, and the whole text."""
    asked = [answers.model_name, SYSTEM_PROMPT, USER_PREFIX]
    asked += [settings.max_text_chars, settings.piece_chars, settings.piece_overlap]
    return F.sha2(F.concat(F.lit(hashlib.sha256(json.dumps(asked).encode()).hexdigest()), text), 256)


def slot() -> Column:
    return F.pmod(F.xxhash64("ask"), F.lit(SLOTS)).cast("int")


def read_answers(spark: SparkSession, answers: Answers) -> DataFrame:
    """All stored answers; contents that batches asked at the same time can be there twice."""
    try:
        return spark.read.schema(ANSWER).parquet(answers.path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ANSWER)


def known_answers(answers: Answers, asked: DataFrame) -> DataFrame:
    """(ask, classification) of the contents asked for, one row each, the oldest answer.

    Opens the parts that the contents hash to, at most SLOTS numbers that reach the driver.
    """
    contents = asked.filter("ask IS NOT NULL").select("ask").distinct()
    slots = [r["slot"] for r in contents.select(slot().alias("slot")).distinct().collect()]
    stored = read_answers(asked.sparkSession, answers).filter(F.col("slot").isin(slots))
    wanted = stored.join(contents, "ask", "left_semi")
    return wanted.groupBy("ask").agg(F.min_by("classification", "answered_us").alias("classification"))


def append_answers(rows: DataFrame, answers: Answers) -> None:
    rows = rows.withColumn("slot", slot()).select(*ANSWER.names).hint("rebalance", "slot")
    rows.sortWithinPartitions("slot", "ask").write.mode("append").partitionBy("slot").parquet(answers.path)


def written(rows: DataFrame, place: str, schema: T.StructType) -> DataFrame:
    rows.select(*schema.names).write.mode("overwrite").parquet(place)
    return rows.sparkSession.read.schema(schema).parquet(place)


def holders_of(asked: DataFrame, known: DataFrame) -> DataFrame:
    """For each content without an answer the one document that is sent to the model.

    Only keys and hashes move, with partial results for contents that many documents share.
    """
    named = asked.filter("ask IS NOT NULL").dropna(subset=KEY)
    fresh = named.join(known.select("ask"), "ask", "left_anti")
    chosen = fresh.groupBy("ask").agg(F.min(F.struct(*KEY)).alias("_key"))
    return chosen.select("ask", *[F.col("_key")[c].alias(c) for c in KEY])


def answered(
    texts: DataFrame,
    model: Callable[[str, str], str],
    answers: Answers,
    settings: JobSettings,
    batch_id: int,
    now: Column,
) -> DataFrame:
    """Replace text by classification, asking the model only for contents without an answer.

    texts has one row per document: its key, text, blank, stage, error_type and error. The texts
    are read twice, to hash them and to send those of the chosen documents; what the model said
    is written before it is used. A failure goes to all documents of the batch that have the
    content and is not kept, so the content is asked again by the next batch that has it. Null
    texts and rows with an error go past the model. A chosen document that reads differently
    the second time fails for this batch with `answer_missing`.
    """
    askable = F.col("text").isNotNull() & F.col("error").isNull()
    texts = texts.withColumn("ask", F.when(askable, content_key(F.col("text"), answers, settings)))
    asked = written(texts, answers.working(batch_id, "asked"), ASKED)
    known = known_answers(answers, asked)
    chosen = texts.join(holders_of(asked, known), [*KEY, "ask"], "left_semi").select("ask", "text")
    if settings.model_tasks:
        chosen = chosen.repartition(settings.model_tasks, "ask")
    said = classify_in_pieces(chosen, ["ask"], model, settings)
    said = said.withColumn("classification", mask_ssns(F.col("classification")))
    tried = written(said, answers.working(batch_id, "tried"), TRIED)
    new = tried.filter("error IS NULL").withColumn("answered_us", F.unix_micros(now))
    append_answers(new, answers)

    found = known.unionByName(tried, allowMissingColumns=True).withColumnsRenamed(
        {"error_type": "_error_type", "error": "_error"}
    )
    rows = asked.join(found.withColumn("_found", F.lit(True)), "ask", "left")
    lost = F.col("ask").isNotNull() & F.col("_found").isNull()
    return rows.select(
        *KEY,
        "blank",
        "stage",
        "classification",
        F.coalesce("error_type", "_error_type", F.when(lost, F.lit(CLASSIFY))).alias("error_type"),
        F.coalesce("error", "_error", F.when(lost, F.lit("answer_missing"))).alias("error"),
    )


def clear_working(spark: SparkSession, answers: Answers, batch_id: int) -> None:
    """Empty the working tables of a batch that is through."""
    for name, schema in (("asked", ASKED), ("tried", TRIED)):
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(answers.working(batch_id, name))


def copy_current(
    spark: SparkSession, answers: Answers, target: Answers, as_of: datetime | str, settings: JobSettings
) -> None:
    """The answers that have not expired, one per content, in a new place to switch to."""
    oldest = F.unix_micros(moment(as_of)) - settings.ttl_days * SECONDS_PER_DAY * 1_000_000
    current = read_answers(spark, answers).filter(F.col("answered_us") > oldest)
    first = F.min_by("classification", "answered_us").alias("classification")
    append_answers(current.groupBy("ask").agg(first, F.min("answered_us").alias("answered_us")), target)
