"""The document flow: messages and documents in, outcomes, records and failures out."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docvault.functions.masking import mask_ssns
from docvault.functions.text import is_blank
from docvault.operators.classify import (
    classify_in_pieces,
    classify_rules,
    with_errors,
)
from docvault.operators.delivery import collect_failures
from docvault.operators.ingest import (
    EXTRACTION,
    parse_notifications,
    split_valid,
    validate_inputs,
)
from docvault.operators.lookup import KEY, requested_keys
from docvault.operators.vault import vault_rows
from docvault.schemas import OUTCOME, REQUEST
from docvault.settings import JobSettings

Classifier = Callable[[DataFrame], DataFrame]

# A table of (source_bucket, source_key, text), or a function from distinct keys to such rows.
Documents = DataFrame | Callable[[DataFrame], DataFrame]


def rules_classifier(settings: JobSettings) -> Classifier:
    def classify(texts: DataFrame) -> DataFrame:
        return classify_rules(texts, settings)

    return classify


def model_classifier(model: Callable[[str, str], str], settings: JobSettings) -> Classifier:
    def classify(texts: DataFrame) -> DataFrame:
        if settings.model_tasks:
            texts = texts.repartition(settings.model_tasks, *KEY)
        return classify_in_pieces(texts, KEY, model, settings)

    return classify


def classify_documents(documents: DataFrame, classify: Classifier) -> DataFrame:
    """(key, blank, classification, error_type, error) per document, masked, without text.

    One pass over the documents. Blank texts, and documents that already carry an error from
    an extractor, go past the classifier with a null text.
    """
    blank = is_blank(F.col("text")) & F.col("error").isNull()
    texts = with_errors(documents).select(
        *KEY, "error_type", "error", blank.alias("blank"), F.when(~blank, F.col("text")).alias("text")
    )
    texts = texts.withColumn(
        "stage", F.when(F.col("error").isNull(), F.lit("classify")).otherwise(F.lit("extract"))
    )
    return classify(texts).select(
        *KEY,
        "blank",
        "stage",
        F.when(~F.col("blank"), mask_ssns(F.col("classification"))).alias("classification"),
        "error_type",
        "error",
    )


def requests_of(messages: DataFrame, settings: JobSettings, explode_records: bool = False) -> DataFrame:
    """Each message, or each of its records, as a checked request; errors say which go no further."""
    checked = validate_inputs(parse_notifications(messages, explode_records), settings)
    return checked.select(*REQUEST.names)


def results_of(
    valid: DataFrame,
    documents: Documents,
    settings: JobSettings,
    model: Callable[[str, str], str] | None = None,
    whole_table: bool = False,
    classify: Classifier | None = None,
) -> DataFrame:
    """What was found in each requested document: one row per document, however often announced.

    The requested keys select the texts first, where Spark broadcasts them if they are few.
    With whole_table the caller says that about all documents are asked for; they are then
    classified where they lie and only what was found is exchanged, never a text. A classifier
    of the caller's own takes the place of the model and the patterns.
    """
    keys = requested_keys(valid)
    if callable(documents):
        texts = documents(keys)
    elif whole_table:
        texts = documents
    else:
        texts = documents.join(keys, KEY, "left_semi")
    own = model_classifier(model, settings) if model else rules_classifier(settings)
    return classify_documents(texts, classify or own)


def outcomes_of(valid: DataFrame, results: DataFrame) -> DataFrame:
    """What became of each valid request. Carries what columns of a result there are."""
    joined = valid.drop("error_type", "error").join(results.withColumn("_found", F.lit(True)), KEY, "left")
    missing = F.col("_found").isNull()
    outcomes = joined.withColumns(
        {
            "stage": F.when(missing, F.lit("extract")).otherwise(F.col("stage")),
            "error_type": F.when(missing, F.lit(EXTRACTION)).otherwise(F.col("error_type")),
            "error": F.when(missing, F.lit("document_not_found")).otherwise(F.col("error")),
            "blank": F.coalesce("blank", F.lit(False)),
        }
    )
    return outcomes.select(*[c for c in OUTCOME.names if c in outcomes.columns])


def process_messages(
    messages: DataFrame,
    documents: Documents,
    settings: JobSettings,
    model: Callable[[str, str], str] | None = None,
    explode_records: bool = False,
    whole_table: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(outcomes, rejected): what became of each valid message, and the invalid ones.

    documents is a table of (source_bucket, source_key, text), or a function that fetches
    the documents of a table of distinct keys.

    Both results are plans: with a model, write the outcomes before using them twice, or
    the model is called twice (plans.batch writes each step).
    """
    valid, rejected = split_valid(requests_of(messages, settings, explode_records))
    return outcomes_of(valid, results_of(valid, documents, settings, model, whole_table)), rejected


def stored(outcomes: DataFrame) -> DataFrame:
    """Outcomes that become records: neither failed nor blank."""
    return outcomes.filter("error IS NULL AND NOT blank")


def failed(outcomes: DataFrame) -> DataFrame:
    return outcomes.filter("error IS NOT NULL")


def records_of(outcomes: DataFrame, settings: JobSettings, as_of: datetime | str | Column) -> DataFrame:
    return vault_rows(stored(outcomes), settings, as_of)


def failures_of(outcomes: DataFrame, rejected: DataFrame) -> DataFrame:
    return collect_failures(rejected, failed(outcomes))
