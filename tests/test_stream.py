import json

import pytest
from pyspark.sql import functions as F

from docvault.operators.monitor import error_alarm, parse_logs
from docvault.plans.batch import process_batch, snapshot_counts, write_snapshot
from docvault.plans.process import process_messages
from docvault.settings import JobSettings
from docvault.sources.logs import read_logs
from docvault.sources.notifications import read_notifications, stream_notifications
from docvault.sources.sinks import WORKING, Tables, read_table, write_json
from docvault.streaming.runner import dead_letter_table, dedupe_stream, run_stream

BUCKET = "docs-in"
SETTINGS = JobSettings(expected_bucket=BUCKET, retry_base_ms=1)
AS_OF = "2024-02-01 00:00:00"
TEXTS = {
    "incoming/a": "Name: Jane Smith. SSN: 123-45-6789.",
    "incoming/b": "mail jane@example.com",
    "incoming/blank": " \n ",
}


@pytest.fixture
def documents(spark):
    rows = [(BUCKET, k, t) for k, t in TEXTS.items()]
    return spark.createDataFrame(rows, "source_bucket string, source_key string, text string")


def message(number, key, second=0, bucket=BUCKET):
    return {
        "messageId": f"m{number}",
        "body": json.dumps({"bucket": bucket, "key": key}),
        "receivedAt": f"2024-01-01T00:00:{second:02d}Z",
    }


def batch(spark, messages):
    rows = [(m["messageId"], m["body"], m["receivedAt"]) for m in messages]
    raw = spark.createDataFrame(rows, "message_id string, body string, received_at string")
    return raw.withColumn("received_at", F.to_timestamp("received_at"))


def contents(spark, tables):
    counts = {n: read_table(spark, tables, n).count() for n in ("vault", "output", "audit", "failures")}
    return [counts[n] for n in ("vault", "output", "audit", "failures")]


FIRST = [message(1, "incoming/a"), message(2, "incoming/b"), message(3, "incoming/blank"),
         message(4, "incoming/none"), message(5, "elsewhere"), message(6, "incoming/a")]
SECOND = [message(1, "incoming/a"), message(7, "incoming/a", second=9), message(4, "incoming/none")]


def exchanged(plan):
    """The exchanges of a plan that carry texts."""
    return [line for line in plan._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange" in line and "text" in line]


@pytest.mark.parametrize("most, whole", [(1_000, True), (1, False)])
def test_texts_are_classified_where_they_lie(spark, tmp_path, documents, monkeypatch, most, whole):
    from docvault.operators import lookup
    from docvault.plans import batch as batches

    monkeypatch.setattr(lookup, "MOST_MARKS", most)
    seen = []

    def results_of(valid, given, settings, model, whole_table, classify):
        seen.append((given.count(), exchanged(given), whole_table))
        return found(valid, given, settings, model, whole_table, classify)

    found = batches.results_of
    monkeypatch.setattr(batches, "results_of", results_of)
    lake = str(tmp_path / "documents")
    documents.unionAll(spark.range(50).selectExpr(f"'{BUCKET}'", "concat('incoming/more', id)", "'SSN: 123-45-6789.'")).write.parquet(lake)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tables = Tables(str(tmp_path / "t"))
        process_batch(batch(spark, FIRST), spark.read.parquet(lake), tables, 0, AS_OF, SETTINGS)
        assert seen == [(3 if whole else 53, [], whole)]
        assert contents(spark, tables) == [2, 2, 2, 2]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_replayed_batches_leave_one_copy(spark, tmp_path, documents):
    tables = Tables(str(tmp_path / "t"))
    for number, rows in [(0, FIRST), (1, SECOND), (1, SECOND), (0, FIRST)]:
        process_batch(batch(spark, rows), documents, tables, number, AS_OF, SETTINGS)
    # a at two versions and b; the redelivered first message is skipped without output.
    assert contents(spark, tables) == [3, 3, 3, 3]
    data = [r["pii_data"] for r in read_table(spark, tables, "vault").collect()]
    assert not any("123-45-6789" in d for d in data) and any("XXX-XX-6789" in d for d in data)
    third = Tables(tables.root)
    process_batch(batch(spark, SECOND), documents, third, 2, AS_OF, SETTINGS)
    dead = dead_letter_table(spark, tables, SETTINGS).collect()
    assert [(r["message_id"], r["attempts"], r["error"]) for r in dead] == [("m4", 3, "document_not_found")]


def test_batch_of_only_failures(spark, tmp_path, documents):
    tables = Tables(str(tmp_path / "t"))
    process_batch(batch(spark, [message(5, "elsewhere")]), documents, tables, 0, AS_OF, SETTINGS)
    assert contents(spark, tables) == [0, 0, 0, 1]


def counting_model(calls_file):
    def model(system, prompt):
        with open(calls_file, "a") as log:
            log.write("call\n")
        if "mail" in prompt:
            raise ValueError("refused")
        return '{"names": ["Jane"], "ssns": ["123-45-6789"]}'

    return model


def test_model_is_called_once_per_document(spark, tmp_path, documents):
    tables, calls = Tables(str(tmp_path / "t")), tmp_path / "calls"
    many = [message(i, "incoming/a", second=i % 60) for i in range(100)]
    settings = JobSettings(expected_bucket=BUCKET, model_tasks=2)
    rows = batch(spark, [*many, message(200, "incoming/b"), message(201, "incoming/blank")])
    process_batch(rows, documents, tables, 0, AS_OF, settings, model=counting_model(str(calls)))
    assert len(calls.read_text().split()) == 2
    assert contents(spark, tables) == [60, 60, 60, 1]
    assert read_table(spark, tables, "failures").first()["error_type"] == "ClassificationError"


def test_documents_fetched_by_key(spark, tmp_path, documents):
    tables = Tables(str(tmp_path / "t"))

    def fetch(keys):
        found = keys.join(documents, ["source_bucket", "source_key"])
        broken = found["source_key"] == "incoming/b"
        return found.withColumns(
            {
                "text": F.when(~broken, F.col("text")),
                "error_type": F.when(broken, F.lit("ExtractionError")),
                "error": F.when(broken, F.lit("OSError")),
            }
        )

    process_batch(batch(spark, FIRST), fetch, tables, 0, AS_OF, SETTINGS)
    errors = {r["message_id"]: (r["stage"], r["error"]) for r in read_table(spark, tables, "failures").collect()}
    assert errors == {
        "m2": ("extract", "OSError"),
        "m4": ("extract", "document_not_found"),
        "m5": ("validate", "key_outside_incoming"),
    }


def test_stream_over_files(spark, tmp_path, documents):
    inbox, tables = tmp_path / "inbox", Tables(str(tmp_path / "t"))
    inbox.mkdir()

    def run():
        stream = stream_notifications(spark, str(inbox), max_files_per_trigger=1)
        query = run_stream(
            stream, documents, tables, str(tmp_path / "c"), SETTINGS, as_of=AS_OF, trigger={"availableNow": True}
        )
        assert query.awaitTermination(300)

    (inbox / "1.json").write_text("\n".join(map(json.dumps, FIRST)))
    run()
    assert contents(spark, tables) == [2, 2, 2, 2]
    (inbox / "2.json").write_text("\n".join(map(json.dumps, SECOND)))
    run()
    assert contents(spark, tables) == [3, 3, 3, 3]


def test_summaries_as_json(spark, tmp_path, documents):
    tables = Tables(str(tmp_path / "t"))
    process_batch(batch(spark, FIRST), documents, tables, 0, AS_OF, SETTINGS)
    write_json(read_table(spark, tables, "output"), str(tmp_path / "json"), ["batch_id"])
    rows = [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "json" / "batch_id=0")).collect()]
    assert {tuple(sorted(r)) for r in rows} == {("document_id", "output_key", "pii_counts", "source_bucket", "version")}


def test_selected_and_whole_table_agree(spark, documents):
    got = []
    for whole in (True, False):
        outcomes, _ = process_messages(batch(spark, FIRST), documents, SETTINGS, whole_table=whole)
        got.append(sorted(map(str, outcomes.collect())))
    assert got[0] == got[1] and len(got[0]) == 5


def test_replay_on_another_day_leaves_one_copy(spark, tmp_path, documents):
    tables = Tables(str(tmp_path / "t"))
    for moment in ("2024-01-31 23:59:59", "2024-02-01 00:00:05"):
        process_batch(batch(spark, FIRST), documents, tables, 0, moment, SETTINGS)
        assert contents(spark, tables) == [2, 2, 2, 2]
    assert {r["audit_date"].isoformat() for r in read_table(spark, tables, "audit").collect()} == {"2024-01-31"}


def test_replay_with_another_outcome_replaces_all(spark, tmp_path, documents):
    def refuse(system, prompt):
        raise ValueError("no")

    tables = Tables(str(tmp_path / "t"))
    good = [message(1, "incoming/a"), message(2, "incoming/b")]
    process_batch(batch(spark, good), documents, tables, 0, AS_OF, SETTINGS, model=refuse)
    assert contents(spark, tables) == [0, 0, 0, 2]
    process_batch(batch(spark, good), documents, tables, 0, AS_OF, SETTINGS)
    assert contents(spark, tables) == [2, 2, 2, 0]
    process_batch(batch(spark, []), documents, tables, 0, AS_OF, SETTINGS)
    assert contents(spark, tables) == [0, 0, 0, 0]
    assert all(read_table(spark, tables, name).isEmpty() for name in WORKING)


def test_one_key_in_two_buckets(spark, tmp_path):
    rows = [(b, "incoming/a", "mail x@y.org") for b in ("b", "b2")]
    docs = spark.createDataFrame(rows, "source_bucket string, source_key string, text string")
    tables = Tables(str(tmp_path / "t"))
    both = [message(1, "incoming/a", bucket="b"), message(2, "incoming/a", bucket="b2")]
    process_batch(batch(spark, both), docs, tables, 0, AS_OF, JobSettings())
    assert contents(spark, tables) == [2, 2, 2, 0]


def test_every_record_of_an_event(spark, tmp_path, documents):
    records = [{"s3": {"bucket": {"name": BUCKET}, "object": {"key": k}}} for k in ("incoming/a", "incoming/b")]
    event = {"messageId": "m", "body": json.dumps({"Records": records}), "receivedAt": "2024-01-01T00:00:00Z"}
    tables = Tables(str(tmp_path / "t"))
    process_batch(batch(spark, [event]), documents, tables, 0, AS_OF, SETTINGS, explode_records=True)
    assert contents(spark, tables) == [2, 2, 2, 0]


def test_late_requests_pass_once(spark, tmp_path):
    inbox, tables = tmp_path / "inbox", Tables(str(tmp_path / "t"))
    inbox.mkdir()
    late = dict(message(3, "incoming/c"), receivedAt="2023-12-20T00:00:00Z")
    for number, rows in enumerate([[message(1, "incoming/a")], [message(2, "incoming/b")] * 2, [late, message(1, "incoming/a")]]):
        (inbox / f"{number}.json").write_text("\n".join(map(json.dumps, rows)))
        stream = stream_notifications(spark, str(inbox), max_files_per_trigger=1, default_received_at=AS_OF)
        query = dedupe_stream(stream, tables, str(tmp_path / "c"), SETTINGS, trigger={"availableNow": True})
        query.awaitTermination()
    got = sorted(r["source_key"] for r in read_table(spark, tables, "distinct").collect())
    assert got == ["incoming/a", "incoming/b", "incoming/c"]


def test_snapshot_drops_what_expired_and_can_go_on(spark, tmp_path, documents):
    tables, target = Tables(str(tmp_path / "t")), Tables(str(tmp_path / "next"))
    process_batch(batch(spark, FIRST), documents, tables, 0, "2023-02-01 00:00:00", SETTINGS)
    process_batch(batch(spark, SECOND), documents, tables, 1, AS_OF, SETTINGS)
    write_snapshot(spark, tables, target, "2024-03-01 00:00:00", SETTINGS, merge_before=1)
    got = {r["table_name"]: (r["rows_before"], r["rows_after"]) for r in snapshot_counts(spark, tables, target).collect()}
    assert got == {"vault": (3, 1), "audit": (3, 1), "output": (3, 1), "failures": (3, 3)}
    for _ in range(2):  # the kept batch again, then a new one
        process_batch(batch(spark, SECOND), documents, target, 1, AS_OF, SETTINGS)
    process_batch(batch(spark, [message(9, "incoming/b", second=30)]), documents, target, 2, AS_OF, SETTINGS)
    assert contents(spark, target)[0] == 3


def test_unreadable_deliveries_become_failures(spark, tmp_path, documents):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.json").write_text(json.dumps({"Records": [message(1, "incoming/a")]}, indent=1))
    (tmp_path / "in" / "2.json").write_text('{"Records": [{"messageId"')
    (tmp_path / "in" / "3.json").write_text('{"other": 1}')
    (tmp_path / "in" / "4.json").write_text('{"Records": []}')
    tables = Tables(str(tmp_path / "t"))
    messages = read_notifications(spark, str(tmp_path / "in"), AS_OF, deliveries=True)
    process_batch(messages, documents, tables, 0, AS_OF, SETTINGS)
    assert contents(spark, tables) == [1, 1, 1, 2]


def test_logs_to_alarms(spark, tmp_path):
    lines = [
        {"level": level, "timestamp": f"2024-01-01T00:0{minute}:30.5+00:00", "message": "x", "duration_ms": 1}
        for minute, level in enumerate(["ERROR", "INFO", "ERROR"])
    ]
    (tmp_path / "log.txt").write_text("\n".join(map(json.dumps, lines)) + "\nnot json\n")
    logs = parse_logs(read_logs(spark, str(tmp_path / "log.txt")))
    assert logs.filter("level IS NULL").count() == 1
    alarms = error_alarm(logs).collect()
    assert sorted(r["window_start"].minute for r in alarms) == [0, 2]
