"""Classification of texts, by rules or by a user-supplied model, and response parsing."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import replace
from functools import partial
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docvault.functions.classification import (
    json_to_classification,
    make_classification,
    parse_error_classification,
)
from docvault.functions.json_text import child, is_array, is_object, is_string, strict_json
from docvault.functions.rules import classify_text, has_digit, without_secrets
from docvault.functions.text import SYSTEM_PROMPT, build_prompt, strip, text_pieces, truncate_text
from docvault.operators.ingest import CLASSIFY, EXTRACTION, UNEXPECTED
from docvault.operators.once import compute_once
from docvault.schemas import LIST_CATEGORIES, OCR_BLOCKS
from docvault.settings import JobSettings


class TransientError(Exception):
    """Raised by a plugged-in function for a failure worth another try."""


def with_retries(call: Callable, max_attempts: int, base_ms: int) -> Callable:
    """Call again after a transient error, waiting twice as long each time."""

    def attempt(*args):
        for n in range(max_attempts):
            try:
                return call(*args)
            except TransientError:
                if n + 1 == max_attempts:
                    raise
                time.sleep(base_ms * 2**n / 1000)

    return attempt


def guarded(call: Callable, expected: str) -> Callable:
    """Turn an exception into (None, error_type, error), so one record fails alone."""

    def safe(*args):
        try:
            return call(*args), None, None
        except TransientError:
            return None, expected, "attempts_exhausted"
        except Exception as exc:
            return None, expected, type(exc).__name__

    return safe


def with_errors(rows: DataFrame) -> DataFrame:
    """Rows with error_type and error, null unless an earlier step filled them."""
    absent = [c for c in ("error_type", "error") if c not in rows.columns]
    return rows.withColumns({c: F.lit(None).cast("string") for c in absent}) if absent else rows


def map_once(
    rows: DataFrame,
    source: str,
    call: Callable,
    target: str,
    target_type: T.DataType,
    calls_at_once: int,
) -> DataFrame:
    """Replace column source by target = call(source), in Arrow batches, several calls at a time."""

    def one(value, error_type, error):
        if value is None or error is not None:
            return None, error_type, error
        return call(value)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(calls_at_once) as pool:
            for batch in batches:
                errors = batch[["error_type", "error"]].astype(object)
                errors = errors.where(errors.notna(), None)
                results = pool.map(one, batch[source], errors["error_type"], errors["error"])
                answers = pd.DataFrame(
                    list(results), columns=[target, "error_type", "error"], index=batch.index
                )
                yield batch.drop(columns=[source, "error_type", "error"]).join(answers)

    carried = rows.drop(source, "error_type", "error")
    added = [(target, target_type), ("error_type", T.StringType()), ("error", T.StringType())]
    schema = T.StructType(carried.schema.fields + [T.StructField(n, t) for n, t in added])
    return rows.select(*carried.columns, source, "error_type", "error").mapInPandas(run, schema)


def classify_with(
    texts: DataFrame,
    model: Callable[[str, str], str],
    settings: JobSettings,
    calls_at_once: int = 4,
) -> DataFrame:
    """Replace text by response, with error_type and error, by calling a model function.

    model takes the system text and the user message and returns the raw response; it may raise
    TransientError. It is called once per row with a text, so pass distinct documents. Rows with
    a null text or with an error from an earlier step go through without a call. Texts go out
    whole unless the settings cut them; `classify_in_pieces` sends long ones in pieces.
    """
    prompt = build_prompt(truncate_text(F.col("text"), settings.max_text_chars))
    asked = partial(model, SYSTEM_PROMPT)
    call = guarded(with_retries(asked, settings.max_attempts, settings.retry_base_ms), CLASSIFY)
    prompts = with_errors(texts).withColumn("text", prompt)
    return map_once(prompts, "text", call, "response", T.StringType(), calls_at_once)


def extract_with(
    objects: DataFrame,
    extractor: Callable[[bytes], list[dict]],
    settings: JobSettings,
    calls_at_once: int = 4,
) -> DataFrame:
    """Add ordered OCR blocks to rows with a content column, by a plugged-in extractor.

    extractor takes the bytes of one object and returns [{"BlockType", "Text"}, ...].
    """
    call = guarded(with_retries(extractor, settings.max_attempts, settings.retry_base_ms), EXTRACTION)
    return map_once(with_errors(objects), "content", call, "blocks", OCR_BLOCKS, calls_at_once)


def parse_responses(answers: DataFrame) -> DataFrame:
    """Replace response by classification; error columns are filled for malformed answers.

    A code fence around the JSON is removed. Text that is not JSON gives an empty
    classification with parse_error set, which is stored like any other. JSON that is not an
    object, or has something else than a list in a list category, fails the record. Rows that
    already carry an error keep it.
    """
    answers = with_errors(answers)
    opened = F.regexp_replace("response", r"(?Ui)^```(?:json)?[\s\x1c-\x1f]*", "")
    closed = F.regexp_replace(opened, r"(?U)[\s\x1c-\x1f]*```[\s\x1c-\x1f]*\z", "")
    parsed = compute_once(answers, {"_cleaned": strip(closed)})
    parsed = compute_once(parsed, {"_json": strict_json(F.col("_cleaned"))})
    value = F.col("_json")
    members = {f"_{c}": child(value, f"$.{c}") for c in LIST_CATEGORIES}
    parsed = compute_once(
        parsed, {"_is_object": is_object(value), "_other": child(value, "$.other_pii"), **members}
    )
    other = F.col("_other")

    iterable = other.isNull() | is_array(other) | is_object(other) | is_string(other)
    unreadable = value.isNull() | (F.col("_is_object") & ~iterable)
    wrong_list = F.lit(False)
    for name in LIST_CATEGORIES:
        wrong_list = wrong_list | (F.col(f"_{name}").isNotNull() & ~is_array(F.col(f"_{name}")))
    parsed = compute_once(parsed, {"_unreadable": unreadable, "_wrong_list": wrong_list})
    malformed = ~F.col("_unreadable") & (~F.col("_is_object") | F.col("_wrong_list"))
    failed_before = F.col("error").isNotNull()

    parsed = compute_once(parsed, {"_malformed": malformed})
    good = json_to_classification(value)
    classification = (
        F.when(failed_before | F.col("_malformed"), F.lit(None))
        .when(F.col("_unreadable"), parse_error_classification())
        .otherwise(good)
    )
    newly_failed = ~failed_before & F.col("_malformed")
    parsed = compute_once(parsed, {"classification": classification})
    return parsed.select(
        *[c for c in answers.columns if c not in ("response", "error_type", "error")],
        "classification",
        F.when(newly_failed, F.lit(UNEXPECTED)).otherwise(F.col("error_type")).alias("error_type"),
        F.when(newly_failed, F.lit("malformed_classification"))
        .otherwise(F.col("error"))
        .alias("error"),
    )


def classify_in_pieces(
    texts: DataFrame, by: list[str], model: Callable[[str, str], str], settings: JobSettings
) -> DataFrame:
    """Replace text by a classification from a model that sees every part of it.

    A text longer than `piece_chars` is sent in overlapping pieces, and the lists that come back
    are joined: repeated values stay, as in the list of a short text, and only what two pieces
    have both found in their overlap counts once. A document fails if a piece does, with the
    error of the first. `by` names the documents; rows of one name are one document.
    """
    text = truncate_text(F.col("text"), settings.max_text_chars)
    pieces = F.posexplode(text_pieces(text, settings.piece_chars, settings.piece_overlap))
    cut = with_errors(texts).select("*", pieces.alias("_piece", "_part")).drop("text")
    seam = F.when(F.col("_piece") > 0, F.left("_part", F.lit(settings.piece_overlap)))
    cut = cut.withColumn("_seam", seam).withColumnRenamed("_part", "text")
    answers = parse_responses(classify_with(cut, model, replace(settings, max_text_chars=None)))
    carried = [c for c in answers.columns if c not in (*by, "_piece", "_seam", "classification")]
    row = F.struct("_piece", "_seam", *carried, "classification")
    merged = answers.groupBy(*by).agg(F.sort_array(F.collect_list(row)).alias("_rows"))
    failing = F.get(F.filter("_rows", lambda r: r["error"].isNotNull()), F.lit(0))
    merged = compute_once(merged, {"_first": F.coalesce(failing, F.get("_rows", F.lit(0)))})
    return merged.select(
        *by,
        *[F.col("_first")[c].alias(c) for c in carried],
        F.when(failing.isNull(), joined_classification(F.col("_rows"))).alias("classification"),
    )


def occurrences(text: Column, value: Column) -> Column:
    """How often a value stands in a text."""
    left = F.length(F.replace(text, value, F.lit("")))
    return F.when(F.length(value) > 0, F.coalesce((F.length(text) - left) / F.length(value), F.lit(0))).otherwise(0)


def joined_classification(rows: Column) -> Column:
    """The classifications of a text's pieces, in order, as one.

    Of a value that stands k times in the overlap with the piece before, the first k that both
    pieces have found are left out of the later list.
    """

    def joined(name: str, text_of: Callable[[Column], Column]) -> Column:
        def times(values: Column, value: Column) -> Column:
            return F.size(F.filter(values, lambda other: other.eqNullSafe(value)))

        def own(row: Column, i: Column) -> Column:
            values, before = row["classification"][name], F.get(rows, i - 1)["classification"][name]

            def stays(value: Column, j: Column) -> Column:
                common = F.least(occurrences(row["_seam"], text_of(value)), times(before, value))
                return F.coalesce(times(F.slice(values, F.lit(1), j + 1), value) > common, F.lit(True))

            return F.when(i == 0, values).otherwise(F.filter(values, stays))

        return F.flatten(F.transform(rows, own))

    broken = F.exists(rows, lambda r: r["classification"]["parse_error"])
    lists = {c: joined(c, lambda v: v) for c in LIST_CATEGORIES}
    found = make_classification(lists, joined("other_pii", lambda v: v["value"]), broken)
    return F.when(F.get(rows, F.lit(0))["classification"].isNotNull(), found)


def classify_rules(texts: DataFrame, settings: JobSettings) -> DataFrame:
    """Replace text by a classification made from the built-in patterns, without Python.

    The patterns see the whole text, however long, unless the settings cut it.
    """
    carried = [c for c in texts.columns if c != "text"]
    shortened = truncate_text(F.col("text"), settings.max_text_chars)
    read = texts.select(*carried, shortened.alias("_text"))
    read = compute_once(
        read, {"_plain": without_secrets(F.col("_text")), "_digits": has_digit(F.col("_text"))}
    )
    found = classify_text(F.col("_text"), F.col("_plain"), F.col("_digits"))
    return compute_once(read, {"classification": found}).select(*carried, "classification")
