import json
import urllib.parse

import pytest
from pyspark.sql import functions as F

from docvault.operators.delivery import (
    attempt_ledger,
    collect_failures,
    dead_letters,
    failure_rows,
    select_for_retry,
)
from docvault.operators.ingest import parse_notifications, split_valid, validate_inputs
from docvault.operators.lookup import drop_blank_text, lookup_documents, requested_keys
from docvault.settings import JobSettings
from docvault.sources.notifications import read_notifications

BUCKET = "docs-in"
SETTINGS = JobSettings(expected_bucket=BUCKET)


def event(bucket, key):
    record = {"s3": {"bucket": {"name": bucket}, "object": {"key": urllib.parse.quote_plus(key)}}}
    return json.dumps({"Records": [record]})


def direct(bucket, key):
    return json.dumps({"bucket": bucket, "key": key})


def messages(spark, bodies):
    rows = [(f"m{i}", body) for i, body in enumerate(bodies)]
    raw = spark.createDataFrame(rows, "message_id string, body string")
    return raw.withColumn("received_at", F.lit("2024-01-01 00:00:00").cast("timestamp"))


def parsed(spark, bodies, **options):
    rows = parse_notifications(messages(spark, bodies), **options).collect()
    by_id = sorted(rows, key=lambda r: int(r["message_id"][1:]))
    return [(r["source_bucket"], r["source_key"], r["error_type"], r["error"]) for r in by_id]


def test_good_shapes(spark):
    key = "incoming/my report é.pdf"
    got = parsed(
        spark,
        [
            event(BUCKET, key),
            direct(BUCKET, "incoming/a+b%20.pdf"),
            json.dumps({"Records": [], "bucket": BUCKET, "key": "incoming/x"}),
            json.dumps({"Records": [{}]}),
            json.dumps({"Records": [{"s3": {"bucket": {"name": 5}, "object": {"key": "k"}}}]}),
            json.dumps({"bucket": True, "key": 7}),
            json.dumps({"bucket": None, "key": "incoming/x"}),
            '{"bucket": "first", "key": "k", "bucket": "last"}',
        ],
    )
    assert got == [
        (BUCKET, key, None, None),
        (BUCKET, "incoming/a+b%20.pdf", None, None),
        (BUCKET, "incoming/x", None, None),
        ("", "", None, None),
        (None, "k", None, None),
        ("True", "7", None, None),
        (None, "incoming/x", None, None),
        ("last", "k", None, None),
    ]


@pytest.mark.parametrize(
    "error_type, error, bodies",
    [
        ("ValidationError", "body_not_json", [None, "", "not-json", "{} x", '{"a": NaN}', "[1,]"]),
        (
            "ValidationError",
            "body_not_recognised",
            ['{"unexpected": "format"}', "[]", '"text"', '["bucket"]', '{"Records": []}', '{"bucket": "b"}'],
        ),
        (
            "UnexpectedError",
            "body_malformed",
            [
                "null",
                "5",
                "true",
                '"about Records"',
                '["Records"]',
                '["bucket", "key"]',
                '{"Records": {"s3": 1}}',
                '{"Records": "text"}',
                '{"Records": 1}',
                '{"Records": [null]}',
                '{"Records": [{"s3": null}]}',
                '{"Records": [{"s3": {"bucket": "b"}}]}',
                '{"Records": [{"s3": {"object": {"key": null}}}]}',
                '{"Records": [{"s3": {"object": {"key": 1}}}]}',
            ],
        ),
    ],
)
def test_bad_shapes(spark, error_type, error, bodies):
    assert parsed(spark, bodies) == [(None, None, error_type, error)] * len(bodies)


def test_first_record_or_all(spark):
    both = json.loads(event(BUCKET, "incoming/1"))
    both["Records"] += json.loads(event(BUCKET, "incoming/2"))["Records"]
    body = json.dumps(both)
    assert [r[1] for r in parsed(spark, [body])] == ["incoming/1"]
    everything = parsed(spark, [body, direct(BUCKET, "incoming/3"), "x"], explode_records=True)
    assert sorted(r[1] for r in everything if r[1]) == ["incoming/1", "incoming/2", "incoming/3"]
    assert len(everything) == 4


def test_rules_in_order(spark):
    cases = [
        ("", "bad", "bucket_missing"),
        ("wrong-bucket", "bad", "bucket_mismatch"),
        (BUCKET, "", "key_missing"),
        (BUCKET, "uploads/../test.pdf", "key_outside_incoming"),
        (BUCKET, "incoming/../secret.pdf" + "a" * 2000, "key_traversal"),
        (BUCKET, "incoming/" + "a" * 1020, "key_too_long"),
        (BUCKET, "incoming/" + "a" * 1015, None),
        (BUCKET, "incoming/" + "😀" * 1015, None),
    ]
    checked = validate_inputs(
        parse_notifications(messages(spark, [direct(b, k) for b, k, _ in cases])), SETTINGS
    )
    got = {r["message_id"]: r["error"] for r in checked.collect()}
    assert [got[f"m{i}"] for i in range(len(cases))] == [want for *_, want in cases]
    anyone = validate_inputs(
        parse_notifications(messages(spark, [direct("wrong-bucket", "incoming/x")])), JobSettings()
    )
    assert anyone.first()["error"] is None


def test_one_failure_leaves_the_others(spark):
    checked = validate_inputs(
        parse_notifications(messages(spark, [direct(BUCKET, "incoming/ok"), "broken", direct(BUCKET, "x")])),
        SETTINGS,
    )
    valid, rejected = split_valid(checked)
    assert [r["message_id"] for r in valid.collect()] == ["m0"]
    empty = valid.withColumn("stage", F.lit("x")).filter("false")
    failures = collect_failures(rejected, empty)
    rows = {r["message_id"]: r for r in failures.collect()}
    assert set(rows) == {"m1", "m2"}
    assert rows["m1"]["document_id"] is None and rows["m2"]["document_id"] is not None
    assert not rows["m1"]["retryable"]
    again = messages(spark, [direct(BUCKET, "incoming/ok"), "broken", direct(BUCKET, "x")])
    retry = select_for_retry(again, failures)
    assert sorted(r["message_id"] for r in retry.collect()) == ["m1", "m2"]
    assert retry.columns == again.columns


def test_messages_without_an_id_are_told_apart(spark):
    unnamed = messages(spark, ["a", "b", "c", direct(BUCKET, "incoming/ok"), "b"]).withColumn("message_id", F.lit("unknown"))
    checked = validate_inputs(parse_notifications(unnamed), SETTINGS)
    _, rejected = split_valid(checked)
    failed = failure_rows(rejected, "validate").withColumn("batch_id", F.lit(0))
    ledger = attempt_ledger(failed)
    assert sorted(r["attempts"] for r in ledger.collect()) == [1, 1, 2]
    assert dead_letters(ledger, 3).isEmpty()
    retry = select_for_retry(unnamed, failed.filter("false").unionAll(failed), dead_letters(ledger, 2))
    assert sorted(r["body"] for r in retry.collect()) == ["a", "c"]


def test_lookup_and_blank(spark):
    documents = spark.createDataFrame(
        [(BUCKET, "incoming/a", "text"), (BUCKET, "incoming/b", " \n"), (BUCKET, "incoming/c", None)],
        "source_bucket string, source_key string, text string",
    )
    requests = spark.createDataFrame(
        [("m0", BUCKET, "incoming/a"), ("m1", BUCKET, "incoming/a"), ("m2", BUCKET, "incoming/none")],
        "message_id string, source_bucket string, source_key string",
    )
    found = {r["message_id"]: r for r in lookup_documents(requests, documents).collect()}
    assert found["m0"]["text"] == found["m1"]["text"] == "text"
    assert found["m2"]["error_type"] == "ExtractionError"
    assert requested_keys(requests).count() == 2
    assert [r["source_key"] for r in drop_blank_text(documents).collect()] == ["incoming/a"]


def test_reading_messages(spark, tmp_path):
    lines = [{"messageId": "a", "body": "x", "receivedAt": "2024-01-01T00:00:00Z"}, {"body": "y"}]
    (tmp_path / "lines.json").write_text("\n".join(map(json.dumps, lines)) + "\nbroken line\n")
    got = read_notifications(spark, str(tmp_path / "lines.json"), "2024-02-01 00:00:00").collect()
    assert [(r["message_id"], r["body"]) for r in got] == [("a", "x"), ("unknown", "y"), ("unknown", None)]
    assert got[1]["received_at"].month == 2
    (tmp_path / "batch.json").write_text(json.dumps({"Records": lines}, indent=1))
    batch = read_notifications(spark, str(tmp_path / "batch.json"), "2024-02-01 00:00:00", deliveries=True)
    assert [r["message_id"] for r in batch.collect()] == ["a", "unknown"]
