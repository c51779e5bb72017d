"""Fetching document texts for requests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docvault.functions.text import is_blank
from docvault.operators.ingest import EXTRACTION

KEY = ["source_bucket", "source_key"]
#: Requested keys up to which 64-bit hashes of them are handed to all readers of texts (some 60 MB).
MOST_MARKS = 1_000_000


def requested_keys(requests: DataFrame) -> DataFrame:
    """Each requested document once, however often it was announced."""
    return requests.select(*KEY).distinct()


def likely_requested(documents: DataFrame, requests: DataFrame) -> tuple[DataFrame, bool]:
    """The documents whose key has the hash of a requested one, and whether the others are left out.

    The hashes are small enough to go to the texts, so no text is exchanged to find out that nobody
    asked for it. Another document with such a hash may stand among them; joins by key leave it
    out later. Where more keys are requested, all documents come back as they are. Counts the
    hashes, so pass stored requests.
    """
    mark = F.xxhash64(*KEY)
    marks = requests.select(mark.alias("_mark")).distinct()
    if marks.count() > MOST_MARKS:
        return documents, False
    marked = documents.withColumn("_mark", mark)
    return marked.join(F.broadcast(marks), "_mark", "left_semi").drop("_mark"), True


def lookup_documents(requests: DataFrame, documents: DataFrame) -> DataFrame:
    """Requests with their text; a request without a document gets an extraction error.

    The requested keys select the texts first: where they are few, Spark broadcasts them and
    no other text is exchanged; otherwise the texts are exchanged once for both joins, and hot
    keys on the request side are split.
    """
    wanted = documents.join(requested_keys(requests), KEY, "left_semi")
    found = wanted.select(*KEY, "text", F.lit(True).alias("_found"))
    joined = requests.join(found, KEY, "left")
    missing = F.col("_found").isNull()
    return joined.withColumns(
        {
            "error_type": F.when(missing, F.lit(EXTRACTION)),
            "error": F.when(missing, F.lit("document_not_found")),
        }
    ).drop("_found")


def missing_documents(requests: DataFrame, documents: DataFrame) -> DataFrame:
    """Requests without a document, with their error; no text is read."""
    missing = requests.drop("error_type", "error").join(documents.select(*KEY), KEY, "left_anti")
    return missing.withColumns({"error_type": F.lit(EXTRACTION), "error": F.lit("document_not_found")})


def drop_blank_text(texts: DataFrame) -> DataFrame:
    """Documents with something to classify; the others end here without a failure."""
    return texts.filter(~is_blank(F.col("text")))
