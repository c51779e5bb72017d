"""Documents in buckets, keyed state, the stored ledger, and window tables."""

import json
import random

import pytest
from pyspark.sql import functions as F
from test_stream import AS_OF, BUCKET, FIRST, SECOND, SETTINGS, batch, contents, message

from docvault.operators import delivery, monitor
from docvault.operators.classify import classify_in_pieces
from docvault.operators.percentiles import brackets, counted_percentiles
from docvault.plans.batch import process_batch, write_snapshot
from docvault.plans.process import results_of
from docvault.settings import JobSettings
from docvault.sources import ledger, records
from docvault.sources.notifications import stream_notifications
from docvault.sources.sinks import Tables, read_batch, read_table
from docvault.sources.store import DocumentStore, add_documents, bucket_of, named, open_store, store_lookup
from docvault.streaming.alarms import DURATION_WINDOWS, ERROR_WINDOWS, append_corrections, entries, read_windows, run_duration_windows
from docvault.streaming.runner import dead_letter_table, dedupe_stream, run_stream

DOCUMENT = "source_bucket string, source_key string, text string"


def plan_nodes(frame):
    """The nodes of the plan that was executed."""
    found = []

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        found.append((name, node))
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(frame._jdf.queryExecution().executedPlan())
    return found


def opened_files(frame):
    return [n.metrics().apply("numFiles").value() for name, n in plan_nodes(frame) if name == "FileSourceScanExec"]


def exchanged(frame):
    """The columns of all exchanges."""
    nodes = [n for name, n in plan_nodes(frame) if name == "ShuffleExchangeExec"]
    return {n.output().apply(i).name() for n in nodes for i in range(n.output().size())}


@pytest.fixture
def store(spark, tmp_path):
    place = DocumentStore(str(tmp_path / "documents"), 16)
    rows = [(BUCKET, f"incoming/{i}", f"Name: Jane Smith. Text {i}.") for i in range(400)]
    rows += [("other", "incoming/1", "elsewhere"), (None, "incoming/x", "a"), (BUCKET, None, "b"), (BUCKET, "incoming/null", None)]
    add_documents(spark.createDataFrame(rows, DOCUMENT), place)
    return place


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def keys(spark, *names):
    return spark.createDataFrame([(BUCKET, n) for n in names], "source_bucket string, source_key string")


def test_store_finds_by_bucket_and_key(spark, store):
    wanted = keys(spark, "incoming/1", "incoming/7", "incoming/none", "incoming/null")
    got = sorted((r["source_bucket"], r["source_key"], r["text"]) for r in store_lookup(store)(wanted).collect())
    assert got == [(BUCKET, "incoming/1", "Name: Jane Smith. Text 1."), (BUCKET, "incoming/7", "Name: Jane Smith. Text 7."), (BUCKET, "incoming/null", None)]
    assert store_lookup(store)(keys(spark, "a").limit(0)).count() == 0
    assert open_store(spark, store).count() == 402


def test_texts_stay_where_they_are(spark, store, no_broadcast):
    """The plan of results has no exchange of texts, whether all buckets are asked for or one."""
    for names in ([f"incoming/{i}" for i in range(400)], ["incoming/5"]):
        requests = keys(spark, *names)
        found = results_of(requests, store_lookup(store), SETTINGS)
        assert len(found.collect()) == len(names)
        columns = exchanged(found)
        assert "name_hash" in columns and "text" not in columns


def test_only_the_buckets_of_the_keys_are_opened(spark, store, no_broadcast):
    for names in (["incoming/5"], ["incoming/5", "incoming/6", "incoming/7"]):
        requests = keys(spark, *names)
        buckets = named(requests).select(bucket_of(F.col("name_hash"), store.buckets)).distinct().count()
        found = store_lookup(store)(requests)
        assert len(found.collect()) == len(names) and opened_files(found) == [buckets]


def test_documents_can_be_added(spark, store):
    add_documents(spark.createDataFrame([(BUCKET, "incoming/new", "late")], DOCUMENT), store)
    got = store_lookup(store)(keys(spark, "incoming/new", "incoming/1")).collect()
    assert {r["source_key"] for r in got} == {"incoming/new", "incoming/1"}


def test_stream_opens_few_buckets(spark, store, tmp_path, no_broadcast):
    """Each micro-batch reads the buckets of its own keys."""
    inbox, tables, looked_up = tmp_path / "inbox", Tables(str(tmp_path / "t")), []
    inbox.mkdir()
    for number in range(3):
        (inbox / f"{number}.json").write_text(json.dumps(message(number, f"incoming/{number}")))
    lookup = store_lookup(store)

    def watched(wanted):
        looked_up.append(lookup(wanted))
        return looked_up[-1]

    stream = stream_notifications(spark, str(inbox), max_files_per_trigger=1, default_received_at=AS_OF)
    run_stream(stream, watched, tables, str(tmp_path / "c"), SETTINGS, as_of=AS_OF, trigger={"availableNow": True}).awaitTermination()
    assert read_table(spark, tables, "vault").count() == 3
    assert len(looked_up) == 3


# --- keyed state


def test_history_is_not_read(spark, tmp_path):
    """However much was let through, a micro-batch reads its own rows and looks them up."""
    inbox, tables = tmp_path / "inbox", Tables(str(tmp_path / "t"))
    inbox.mkdir()
    read = []
    for number, size in enumerate((300, 300, 5, 5)):
        first = 0 if number == 3 else 300 * number
        (inbox / f"{number}.json").write_text("\n".join(json.dumps(message(i, f"incoming/{i}")) for i in range(first, first + size)))
        stream = stream_notifications(spark, str(inbox), max_files_per_trigger=1, default_received_at=AS_OF)
        query = dedupe_stream(stream, tables, str(tmp_path / "c"), SETTINGS, trigger={"availableNow": True})
        query.awaitTermination()
        progress = [p for p in query.recentProgress if p["numInputRows"]]
        read += [(p["numInputRows"], p["stateOperators"][0]["numRowsTotal"]) for p in progress]
    assert read == [(300, 300), (300, 600), (5, 605), (5, 605)]
    assert read_table(spark, tables, "distinct").count() == 605


def test_state_can_be_bounded(spark, tmp_path):
    inbox, tables = tmp_path / "inbox", Tables(str(tmp_path / "t"))
    inbox.mkdir()
    old = dict(message(3, "incoming/c"), receivedAt="2023-01-20T00:00:00Z")
    for number, rows in enumerate([[message(1, "incoming/a")], [old, message(1, "incoming/a"), message(2, "incoming/b")]]):
        (inbox / f"{number}.json").write_text("\n".join(map(json.dumps, rows)))
        stream = stream_notifications(spark, str(inbox), max_files_per_trigger=1, default_received_at=AS_OF)
        dedupe_stream(stream, tables, str(tmp_path / "c"), SETTINGS, trigger={"availableNow": True}, keep="100 days").awaitTermination()
    assert sorted(r["source_key"] for r in read_table(spark, tables, "distinct").collect()) == ["incoming/a", "incoming/b"]


# --- ledger


def failures(spark, rows, batch_id):
    columns = "message_id string, message_key string, document_id string, stage string, error_type string, error string"
    return spark.createDataFrame(rows, columns).withColumn("batch_id", F.lit(batch_id).cast("bigint"))


def test_ledger_equals_the_recomputed_one(spark, tmp_path):
    """After batches, replays with other failures, and replays with none, in any order."""
    rng, tables, now = random.Random(4), Tables(str(tmp_path / "t")), {}
    for step in range(12):
        batch_id = rng.randrange(4)
        rows = []
        for _ in range(rng.choice((0, 3, 12))):
            n = rng.randrange(6)
            rows.append((f"m{n}", f"k{n % 4}" if n else None, rng.choice([None, f"d{n}"]), rng.choice(["validate", "classify"]), "E", f"e{rng.randrange(3)}"))
        ledger.add_failures(failures(spark, rows, batch_id), tables, batch_id, again=batch_id in now)
        now[batch_id] = rows
        if step % 4 == 3:
            whole = [(*r, b) for b, own in now.items() for r in own]
            every = spark.createDataFrame(whole, "message_id string, message_key string, document_id string, stage string, error_type string, error string, batch_id bigint")
            want = sorted(map(str, delivery.attempt_ledger(every).collect()))
            assert sorted(map(str, ledger.read_ledger(spark, tables).collect())) == want


def test_merging_twice_changes_nothing(spark, tmp_path):
    tables = Tables(str(tmp_path / "t"))
    own = failures(spark, [("m", "k", None, "classify", "E", "e")] * 2, 7)
    for again in (False, True, True):
        ledger.add_failures(own, tables, 7, again)
    assert [r["attempts"] for r in ledger.read_ledger(spark, tables).collect()] == [2]


def test_first_run_reads_the_parts_of_its_messages(spark, tmp_path, monkeypatch):
    tables = Tables(str(tmp_path / "t"))
    many = [(f"m{i}", f"k{i}", None, "classify", "E", "e") for i in range(300)]
    ledger.add_failures(failures(spark, many, 0), tables, 0, again=False)
    seen = []
    monkeypatch.setattr(ledger, "newest_entries", lambda rows, f=ledger.newest_entries: seen.append(rows) or f(rows))
    ledger.add_failures(failures(spark, many[:1], 1), tables, 1, again=False)
    assert seen[0].count() < 10
    assert len(opened_files(seen[0])) == 1 and opened_files(seen[0])[0] <= 2
    assert {r["message_id"]: r["attempts"] for r in ledger.read_ledger(spark, tables).collect()}["m0"] == 2


def test_dead_letters_come_from_the_ledger(spark, tmp_path):
    tables = Tables(str(tmp_path / "t"))
    documents = spark.createDataFrame([(BUCKET, "incoming/a", "x")], DOCUMENT)
    lost = [message(4, "incoming/none")]
    for batch_id in (0, 1, 1, 0):
        process_batch(batch(spark, lost), documents, tables, batch_id, AS_OF, SETTINGS)
    assert dead_letter_table(spark, tables, SETTINGS).count() == 0
    process_batch(batch(spark, lost), documents, tables, 2, AS_OF, SETTINGS)
    assert [r["attempts"] for r in dead_letter_table(spark, tables, SETTINGS).collect()] == [3]
    # The batch again, and nothing fails this time.
    process_batch(batch(spark, [message(4, "incoming/a")]), documents, tables, 2, AS_OF, SETTINGS)
    assert dead_letter_table(spark, tables, SETTINGS).count() == 0


def test_ledger_in_a_snapshot(spark, tmp_path):
    tables, target = Tables(str(tmp_path / "t")), Tables(str(tmp_path / "next"))
    documents = spark.createDataFrame([(BUCKET, "incoming/a", "x")], DOCUMENT)
    process_batch(batch(spark, FIRST), documents, tables, 0, AS_OF, SETTINGS)
    process_batch(batch(spark, SECOND), documents, tables, 1, AS_OF, SETTINGS)
    write_snapshot(spark, tables, target, "2024-03-01 00:00:00", SETTINGS, merge_before=1)
    want = sorted(map(str, delivery.attempt_ledger(read_table(spark, target, "failures")).collect()))
    assert sorted(map(str, ledger.read_ledger(spark, target).collect())) == want
    process_batch(batch(spark, SECOND), documents, target, 1, AS_OF, SETTINGS)
    assert sorted(map(str, ledger.read_ledger(spark, target).collect())) == want
    assert read_batch(spark, target, "failures", 1).count() and contents(spark, target)[3] > 1


# --- index


def test_point_read_through_the_index(spark, tmp_path):
    """One folder of the index is opened in each part, and no day of the vault without the key."""
    tables, target = Tables(str(tmp_path / "t")), Tables(str(tmp_path / "next"))
    names = [f"incoming/{i}" for i in range(60)]
    documents = spark.createDataFrame([(BUCKET, n, f"Name: Jane Smith {n}") for n in names], DOCUMENT)
    rows = [dict(message(i, n), receivedAt=f"2024-01-{1 + i % 28:02d}T00:00:00Z") for i, n in enumerate(names)]
    for batch_id in (0, 1, 0):
        process_batch(batch(spark, rows[30 * batch_id : 30 * batch_id + 30]), documents, tables, batch_id, AS_OF, SETTINGS)
    again = dict(message(99, "incoming/7"), receivedAt="2024-01-20T00:00:00Z")
    process_batch(batch(spark, [again]), documents, tables, 2, AS_OF, SETTINGS)
    write_snapshot(spark, tables, target, "2024-03-01 00:00:00", SETTINGS, merge_before=2)
    for place, parts in ((tables, 3), (target, 2)):
        addresses = records.addresses(spark, place, "incoming/7")
        assert len(addresses.collect()) == 2 and opened_files(addresses)[0] <= parts
        found = records.find_records(spark, place, "incoming/7")
        whole = read_table(spark, place, "vault").filter("source_key = 'incoming/7'")
        assert sorted(found.collect()) == sorted(whole.select(found.columns).collect()) and found.count() == 2
        found.collect()
        assert opened_files(found)[0] <= 4
        assert records.find_records(spark, place, "incoming/none").count() == 0
        many = records.find_records_of(spark, place, documents.filter("source_key LIKE '%1'").select("source_key"))
        assert many.count() == 6


# --- windows


def test_a_window_of_a_million_durations(spark):
    counts = spark.range(0, 1_000_000, 1, 4).select(
        F.lit("w").alias("w"), (F.pow(F.col("id") / 1000, 3) + F.col("id")).alias("_v"), (F.col("id") % 3 + 1).alias("_c")
    )
    bounds = brackets(counts, ["w"], [0.5, 0.99]).first()
    for low, high in zip(bounds["_low"], bounds["_high"], strict=True):
        assert 0 < counts.filter(F.col("_v").between(low, high)).count() < 25_000
    got = counted_percentiles(counts, ["w"], "_v", "_c", {"p50": 0.5, "p99": 0.99}, total="n").first()
    want = counts.agg(F.percentile("_v", 0.5, F.col("_c")), F.percentile("_v", 0.99, F.col("_c")), F.sum("_c")).first()
    assert (got["p50"], got["p99"], got["n"]) == tuple(want)


@pytest.mark.parametrize("small", [0, 3, 10_000])
def test_counted_percentiles_of_any_group(spark, monkeypatch, small):
    """Ties, hot values, nulls and groups of few values, whether narrowed down or not."""
    from docvault.operators import percentiles

    monkeypatch.setattr(percentiles, "SMALL", small)
    rng = random.Random(6)
    rows = [("a", float(rng.randrange(50)), rng.randrange(1, 9)) for _ in range(300)] + [("a", 7.0, 5000)]
    rows += [("b", None, 4), (None, 1.0, 1), (None, 2.0, 1), ("c", None, 2), ("c", 5.0, 1), ("d", 1.0, 1), ("d", 1e9, 1)]
    frame = spark.createDataFrame(rows, "g string, v double, c bigint")
    fractions = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    got = {r["g"]: tuple(r)[1:] for r in counted_percentiles(frame, ["g"], "v", "c", fractions).collect()}
    want = frame.groupBy("g").agg(*[F.percentile("v", f, F.col("c")).alias(n) for n, f in fractions.items()])
    assert got == {r["g"]: tuple(r)[1:] for r in want.collect()}


def test_stream_of_durations(spark, tmp_path):
    """Finished windows equal the table's; a second run appends the later ones."""
    place = str(tmp_path / "rows")
    rows = spark.range(6000).select(
        F.timestamp_seconds(F.col("id")).alias("timestamp"), F.pmod(F.col("id") * 7919, F.lit(1009)).cast("double").alias("duration_ms")
    )
    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in/*")
    for part in (0, 1):
        rows.filter((F.col("timestamp") >= F.timestamp_seconds(F.lit(3000))) == bool(part)).write.parquet(f"{tmp_path}/in/{part}")
        run_duration_windows(stream, place, str(tmp_path / "c"), trigger={"availableNow": True}).awaitTermination()
    got = {r["window_start"]: (r["events"], r["p99_ms"]) for r in read_windows(spark, place, DURATION_WINDOWS).collect()}
    want = {r["window_start"]: (r["events"], r["p99_ms"]) for r in monitor.duration_windows(rows).collect()}
    assert len(got) == 17 and got.items() <= want.items() and len(want) == 20


def test_corrections_change_a_window_once(spark, tmp_path):
    place = str(tmp_path / "rows")

    def windows(*rows):
        return spark.createDataFrame(rows, "s int, events bigint, errors bigint").select(
            F.timestamp_seconds(F.col("s")).alias("window_start"), F.timestamp_seconds(F.col("s") + 60).alias("window_end"), "events", "errors"
        )

    windows((0, 5, 1), (60, 6, 2)).withColumn("revision", F.lit(0)).write.parquet(f"{place}/part=0")
    whole = windows((0, 9, 1), (60, 6, 2), (120, 1, 1))
    for name in ("one", "two"):
        append_corrections(whole, place, ERROR_WINDOWS, name)
    append_corrections(windows((0, 9, 3), (60, 6, 2), (120, 1, 1)), place, ERROR_WINDOWS, "three")
    got = sorted((r["window_start"].second + 60 * r["window_start"].minute, r["events"], r["errors"]) for r in read_windows(spark, place, ERROR_WINDOWS).collect())
    assert got == [(0, 9, 3), (60, 6, 2), (120, 1, 1)]
    assert entries(spark, place, ERROR_WINDOWS).count() == 5


# --- texts in pieces


def test_repeated_values_count_alike_in_short_and_long_texts(spark):
    """The same lists whether a text goes out whole or in pieces; what an overlap shows twice counts once."""
    rng = random.Random(3)
    words = ["qq", "zz", "a@b.co", "c@d.org", "#", "-----"]
    texts = [" ".join(rng.choice(words) for _ in range(n)) + " " for n in (0, 5, 40, 200) for _ in range(4)]
    rows = spark.createDataFrame(list(enumerate(texts)), "key int, text string")

    def model(system, prompt):
        found = [w for w in prompt.split("\n")[-1].split(" ") if w in ("a@b.co", "c@d.org")]
        other = [{"type": "T", "value": w} for w in prompt.split("\n")[-1].split(" ") if w == "zz"]
        return json.dumps({"emails": found, "other_pii": other})

    lists = []
    for chars in (10_000, 100):
        settings = JobSettings(piece_chars=chars, piece_overlap=20, retry_base_ms=1)
        got = classify_in_pieces(rows, ["key"], model, settings).collect()
        lists.append({r["key"]: (r["classification"]["emails"], [o["value"] for o in r["classification"]["other_pii"]]) for r in got})
    assert {k: tuple(map(sorted, v)) for k, v in lists[0].items()} == {k: tuple(map(sorted, v)) for k, v in lists[1].items()}
