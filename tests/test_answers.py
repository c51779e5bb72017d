"""Answers of a model by content: calls, failures, privacy, pruning, expiry."""

import json
import os
import uuid

import pytest
from pyspark.sql import functions as F
from test_store import DOCUMENT, opened_files
from test_stream import AS_OF, BUCKET, SETTINGS, batch, message

from docvault.functions.masking import has_unmasked
from docvault.functions.text import USER_PREFIX
from docvault.plans.batch import process_batch
from docvault.settings import JobSettings
from docvault.sources.answers import (
    Answers,
    answered,
    append_answers,
    copy_current,
    holders_of,
    known_answers,
    read_answers,
)
from docvault.sources.notifications import stream_notifications
from docvault.sources.sinks import Tables, read_table
from docvault.streaming.runner import run_stream

#: Contents by number: a third of the documents share the first, one is always refused.
CONTENTS = ["same text"] + [f"text {i}" for i in range(8)] + ["refused"]


def content(i):
    return CONTENTS[0] if i % 3 == 0 else CONTENTS[1 + i % 9]


def logging_model(place):
    """A model that leaves a file for every call, whichever worker makes it."""

    def model(system, prompt):
        text = prompt[len(USER_PREFIX):]
        with open(os.path.join(place, uuid.uuid4().hex), "w") as log:
            log.write(text)
        if text == "refused":
            raise ValueError("401")
        return json.dumps({"names": [text, text], "ssns": ["123-45-6789"]})

    return model


def calls(place):
    """The texts asked for since the last look."""
    found = sorted((place / name).read_text() for name in os.listdir(place))
    for name in os.listdir(place):
        os.unlink(place / name)
    return found


@pytest.fixture
def log(tmp_path):
    place = tmp_path / "calls"
    place.mkdir()
    return place


def table(spark, numbers):
    return spark.createDataFrame([(BUCKET, f"incoming/{i}", content(i)) for i in numbers], DOCUMENT)


def run(spark, tmp_path, numbers, batch_id, log, answers, settings=SETTINGS):
    tables = Tables(str(tmp_path / "t"))
    messages = batch(spark, [message(i, f"incoming/{i}") for i in numbers])
    process_batch(
        messages, table(spark, numbers), tables, batch_id, AS_OF, settings, logging_model(str(log)), answers=answers
    )
    return tables


def test_each_content_is_asked_once(spark, tmp_path, log):
    answers = Answers(str(tmp_path / "a"), "m1")
    asked = {content(i) for i in range(30)}
    tables = run(spark, tmp_path, range(30), 0, log, answers)
    assert calls(log) == sorted(asked)
    first = sorted(read_table(spark, tables, "vault").collect())
    # New copies cost nothing but the refused content, and neither does the batch run again.
    run(spark, tmp_path, range(30, 60), 1, log, answers)
    assert calls(log) == ["refused"]
    run(spark, tmp_path, range(30), 0, log, answers)
    assert calls(log) == ["refused"]
    assert sorted(read_table(spark, tables, "vault").filter("batch_id = 0").collect()) == first
    refused = [i for i in range(60) if content(i) == "refused"]
    failures = read_table(spark, tables, "failures").collect()
    assert sorted(r["message_id"] for r in failures) == sorted(f"m{i}" for i in refused)
    assert {r["error"] for r in failures} == {"ValueError"}
    assert read_table(spark, tables, "vault").count() == 60 - len(refused)


def test_same_rows_as_without_answers(spark, tmp_path, log):
    plain = run(spark, tmp_path / "plain", range(24), 0, log, None)
    assert len(calls(log)) == 24
    kept = run(spark, tmp_path / "kept", range(24), 0, log, Answers(str(tmp_path / "a"), "m1"))
    for name in ("vault", "output", "audit", "failures"):
        rows = [sorted(map(str, read_table(spark, t, name).collect())) for t in (plain, kept)]
        assert rows[0] == rows[1]


def test_stream_asks_once(spark, tmp_path, log):
    """Two micro-batches with copies of one text: one call."""
    inbox, tables = tmp_path / "inbox", Tables(str(tmp_path / "t"))
    inbox.mkdir()
    for i in (0, 3):
        (inbox / f"{i}.json").write_text(json.dumps(message(i, f"incoming/{i}")))
    stream = run_stream(
        stream_notifications(spark, str(inbox), max_files_per_trigger=1), table(spark, (0, 3)), tables, str(tmp_path / "c"),
        SETTINGS, logging_model(str(log)), AS_OF, {"availableNow": True}, answers=Answers(str(tmp_path / "a"), "m1"),
    )
    stream.awaitTermination()
    assert read_table(spark, tables, "vault").select("batch_id").distinct().count() == 2
    assert calls(log) == ["same text"]


def test_nothing_raw_is_kept(spark, tmp_path, log):
    answers = Answers(str(tmp_path / "a"), "m1")
    run(spark, tmp_path, range(12), 0, log, answers)
    stored = read_answers(spark, answers)
    assert stored.count() and stored.filter(has_unmasked(F.col("classification.ssns"))).count() == 0
    for name in ("asked", "tried"):
        assert spark.read.parquet(answers.working(0, name)).count() == 0


def test_another_model_or_cut_is_asked_anew(spark, tmp_path, log):
    run(spark, tmp_path, [1, 2], 0, log, Answers(str(tmp_path / "a"), "m1"))
    assert len(calls(log)) == 2
    run(spark, tmp_path, [1, 2], 1, log, Answers(str(tmp_path / "a"), "m2"))
    assert len(calls(log)) == 2
    cut = JobSettings(expected_bucket=BUCKET, retry_base_ms=1, max_text_chars=3)
    run(spark, tmp_path, [1, 2], 2, log, Answers(str(tmp_path / "a"), "m1"), cut)
    assert len(calls(log)) == 2


def test_rows_without_a_question(spark, tmp_path, log):
    """Null and blank texts, earlier errors, null keys, and no rows at all."""
    schema = DOCUMENT + ", blank boolean, stage string, error_type string, error string"
    rows = [
        (BUCKET, "a", None, True, "classify", None, None),
        (BUCKET, "b", "x", False, "extract", "ExtractionError", "broken"),
        (BUCKET, "c", "", False, "classify", None, None),
        (BUCKET, "d", "y", False, "classify", None, None),
        (None, "e", "y", False, "classify", None, None),
        (None, "f", "only here", False, "classify", None, None),
    ]
    answers = Answers(str(tmp_path / "a"), "m1")
    ask = [logging_model(str(log)), answers, SETTINGS]
    got = answered(spark.createDataFrame(rows, schema), *ask, 0, F.to_timestamp(F.lit(AS_OF)))
    by_key = {r["source_key"]: r for r in got.collect()}
    assert calls(log) == ["", "y"] and len(by_key) == 6
    assert by_key["a"]["classification"] is None and by_key["a"]["error"] is None
    assert by_key["b"]["error"] == "broken" and by_key["b"]["error_type"] == "ExtractionError"
    assert by_key["c"]["classification"]["names"] == ["", ""]
    assert by_key["d"]["classification"] == by_key["e"]["classification"] is not None
    assert by_key["f"]["error"] == "answer_missing"
    none = answered(spark.createDataFrame([], schema), *ask, 1, F.to_timestamp(F.lit(AS_OF)))
    assert none.count() == 0 and calls(log) == []


def test_one_holder_of_a_hot_content(spark):
    """Half of 200,000 documents share a content; one row goes on for each content."""
    name = F.col("id").cast("string")
    ask = F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(name)
    asked = spark.range(200_000).select(F.lit("b").alias("source_bucket"), name.alias("source_key"), ask.alias("ask"))
    known = spark.range(1, 200_000, 4).select(F.col("id").cast("string").alias("ask"))
    holders = holders_of(asked, known)
    assert holders.count() == 50_001
    assert holders.filter("ask = 'hot'").first()["source_key"] == "0"


def test_few_contents_open_few_parts(spark, tmp_path):
    answers = Answers(str(tmp_path / "a"), "m1")
    shape = read_answers(spark, answers).schema
    stored = spark.range(5_000).select(F.sha2(F.col("id").cast("string"), 256).alias("ask"), F.col("id").alias("answered_us"))
    stored = stored.withColumn("classification", F.lit(None).cast(shape["classification"].dataType))
    append_answers(stored, answers)
    append_answers(stored.limit(10).withColumn("answered_us", F.lit(9_999_999)), answers)
    asked = stored.orderBy("answered_us").limit(3).select("ask")
    known = known_answers(answers, asked)
    assert known.count() == 3
    files = sum(len(f) for _, _, f in os.walk(answers.path))
    known.collect()
    assert min(n for n in opened_files(known) if n) <= 6 < files / 10


def test_expired_answers_stay_behind(spark, tmp_path):
    old, new = Answers(str(tmp_path / "a"), "m1"), Answers(str(tmp_path / "b"), "m1")
    shape = read_answers(spark, old).schema["classification"].dataType
    rows = [("x", "2023-01-01 00:00:00"), ("y", "2024-01-01 00:00:00"), ("y", "2024-01-02 00:00:00")]
    frame = spark.createDataFrame(rows, "ask string, at string")
    append_answers(
        frame.select("ask", F.unix_micros(F.to_timestamp("at")).alias("answered_us"), F.lit(None).cast(shape).alias("classification")),
        old,
    )
    copy_current(spark, old, new, AS_OF, SETTINGS)
    assert [r["ask"] for r in read_answers(spark, new).collect()] == ["y"]
