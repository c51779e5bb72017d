import random

import pytest
from pyspark.sql import functions as F

from docvault.operators import delivery, monitor, privacy, reports, vault
from docvault.operators.percentiles import group_percentiles
from docvault.schemas import CATEGORIES, CLASSIFICATION
from docvault.settings import JobSettings
from docvault.sources.documents import texts_from_block_rows

SETTINGS = JobSettings(max_pii_bytes=350_000)
AS_OF = "2024-02-01 00:00:00"


def classified(spark, rows):
    """rows of (bucket, key, version, names, ssns)."""
    empty = {c: [] for c in CLASSIFICATION.names}
    data = [
        (b, k, v, tuple({**empty, "parse_error": False, "names": names, "ssns": ssns}.values()))
        for b, k, v, names, ssns in rows
    ]
    schema = f"source_bucket string, source_key string, version bigint, classification {CLASSIFICATION.simpleString()}"
    return spark.createDataFrame(data, schema)


def records(spark, rows):
    return vault.vault_rows(classified(spark, rows), SETTINGS, AS_OF)


def test_vault_row(spark):
    row = records(spark, [("b", "incoming/a", 1706745599000, ["Jane"], ["XXX-XX-1234"])]).first()
    assert row["document_id"] == row["source_key_hash"] and len(row["document_id"]) == 64
    assert row["pii_counts"].startswith('{"names":1,"emails":0')
    assert row["duration_ms"] == 1000 and row["processed_at"] == "2024-02-01T00:00:00+00:00"


def test_oversize_record_keeps_true_counts(spark):
    rows = classified(spark, [("b", "incoming/a", 1, ["x" * 1000] * 400, [])])
    row = vault.vault_rows(rows, SETTINGS, AS_OF).first()
    assert "TRUNCATED" in row["pii_data"] and '"names":400' in row["pii_counts"]
    whole = vault.vault_rows(rows, JobSettings(), AS_OF).first()
    assert len(whole["pii_data"]) > 400_000 and "TRUNCATED" not in whole["pii_data"]


def test_numbers_are_masked_in_the_vault_step(spark):
    row = records(spark, [("b", "incoming/a", 1, ["Ann Lee"], ["123-45-6789", "XXX-XX-1111"])]).first()
    assert '"ssns":["XXX-XX-6789","XXX-XX-1111"]' in row["pii_data"] and "123-45" not in row["pii_data"]


def test_append_skips_what_is_there(spark):
    new = records(
        spark,
        [("b", "incoming/a", 1, [], []), ("b", "incoming/a", 1, [], []), ("b", "incoming/a", 2, [], []),
         ("a", "incoming/c", 5, [], []), ("z", "incoming/c", 5, [], [])],
    )
    existing = records(spark, [("b", "incoming/a", 2, [], [])])
    rows = vault.append_new_only(new, existing).collect()
    # One key in two buckets is two documents.
    assert sorted((r["source_key"], r["version"], r["source_bucket"]) for r in rows) == [
        ("incoming/a", 1, "b"),
        ("incoming/c", 5, "a"),
        ("incoming/c", 5, "z"),
    ]


def test_outward_rows_hold_no_values(spark):
    rows = records(spark, [("b", "incoming/x/a.pdf", 7, ["Jane"], ["XXX-XX-1234"])])
    output, audit = vault.output_rows(rows), vault.audit_rows(rows)
    assert output.columns == ["output_key", "source_bucket", "document_id", "version", "pii_counts"]
    assert "pii_data" not in audit.columns
    assert output.first()["output_key"] == "processed/x/a.pdf"
    assert output.first()["pii_counts"]["ssns"] == 1
    first = audit.first()
    assert first["audit_key"] == f"lambda-audit/2024-02-01/{first['document_id']}-7.json"


def test_history_equals_one_window_per_document(spark):
    rng = random.Random(3)
    hour = vault.HOUR_MS
    made = [
        ("b", f"incoming/{rng.randint(0, 4)}", rng.randint(0, 6) * hour + rng.randint(-3, 3) + 10, ["n"] * rng.randint(0, 3), [])
        for _ in range(300)
    ]
    rows = vault.once_per_identity(records(spark, made))
    got = {(r["document_id"], r["version"]): r for r in vault.version_history(rows).collect()}
    by_doc = {}
    for r in rows.collect():
        items = int(r["pii_counts"].split(":")[1].split(",")[0])
        by_doc.setdefault(r["document_id"], []).append((r["version"], items))
    assert len(got) == sum(map(len, by_doc.values()))
    for doc, versions in by_doc.items():
        before = None
        for number, (version, items) in enumerate(sorted(versions), start=1):
            row = got[(doc, version)]
            assert (row["version_no"], row["items"]) == (number, items)
            assert row["previous_version"] == (before and before[0])
            assert row["items_change"] == (None if before is None else items - before[1])
            before = (version, items)


def test_latest_find_and_expiry(spark):
    rows = records(spark, [("b", "incoming/a", 1, [], []), ("b", "incoming/a", 9, ["x"], []), ("b", "incoming/c", 4, [], [])])
    assert sorted(r["version"] for r in vault.latest_version(rows).collect()) == [4, 9]
    assert vault.find_by_source_key(rows, "incoming/a").count() == 2
    assert vault.active_records(rows, "2025-01-31 00:00:00").count() == 0
    assert vault.expired_records(rows, "2025-01-31 00:00:00").count() == 3
    assert vault.active_records(rows, "2025-01-30 23:59:59").count() == 3


def test_latest_of_two_buckets(spark):
    rows = records(spark, [("z", "incoming/a", 9, [], []), ("b", "incoming/a", 9, [], []), ("a", "incoming/a", 1, [], [])])
    got = sorted((r["source_bucket"], r["version"]) for r in vault.latest_version(rows).collect())
    assert got == [("a", 1), ("b", 9), ("z", 9)]  # the same key in two buckets is two documents


def test_ledger_and_dead_letters(spark):
    rows = [("m1", "d1", 1, "e1"), ("m1", "d1", 2, "e2"), ("m1", "d1", 3, "e3"), ("unknown", "body:1", 1, "x"),
            ("unknown", "body:2", 2, "x"), ("unknown", "body:3", 3, "x")]
    failures = spark.createDataFrame(rows, "message_id string, message_key string, batch_id bigint, error string")
    failures = failures.withColumns({"stage": F.lit("s"), "error_type": F.lit("t"), "document_id": F.lit(None).cast("string")})
    ledger = delivery.attempt_ledger(failures)
    dead = delivery.dead_letters(ledger).collect()
    assert [(r["message_id"], r["attempts"], r["error"]) for r in dead] == [("m1", 3, "e3")]
    assert delivery.still_retrying(ledger).count() == 3
    alarm = monitor.dlq_alarm(delivery.dead_letters(ledger)).first()
    assert alarm["depth"] == 1 and alarm["alarm"]
    assert not monitor.dlq_alarm(ledger.filter("false")).first()["alarm"]


def test_rollup_totals(spark):
    counts = classified(spark, [("b", "k", 1, ["a", "b"], ["c"]), ("c", "k", 1, ["a"], [])])
    from docvault.functions.classification import pii_counts

    counted = counts.select("source_bucket", pii_counts(F.col("classification")).alias("pii_counts"))
    got = {
        (r["source_bucket"], r["category"]): (r["documents"], r["items"])
        for r in reports.category_totals(counted, ["source_bucket"], rollup=True).collect()
    }
    assert got[("b", "names")] == (1, 2) and got[(None, "names")] == (2, 3)
    assert got[("b", None)] == (1, 3) and got[(None, None)] == (2, 4)
    assert len(got) == 3 * (len(CATEGORIES) + 1)


@pytest.mark.parametrize("one_by_one", [0, 2, 16])
@pytest.mark.parametrize("few, few_bytes", [(1, 100), (3, 1000), (1000, 15), (1000, 1000)])
def test_leaks_whatever_the_lists(spark, few, few_bytes, one_by_one):
    rng = random.Random(5)
    values = [(f"d{rng.randint(0, 2)}", v) for v in ["Jane", "jane@x.org", "555", 'a"b', "é😀", "", "Ja", "10.0.0.1", "zz"]]
    texts = [
        (f"d{rng.randint(0, 2)}", "log", f"r{i}", "".join(rng.choices(["Jane ", "jane@x.org", '"', 'a\\"b', "é😀", "55", "5 ", "zz"], k=5)))
        for i in range(60)
    ]
    found = privacy.scan_for_leaks(
        spark.createDataFrame(values, "document_id string, value string"),
        spark.createDataFrame(texts, "document_id string, record_kind string, record_id string, text string"),
        few,
        few_bytes,
        one_by_one,
    )
    want = set()
    for doc, value in values:
        for form in {value, value.replace('"', '\\"')} - {""}:
            want |= {(doc, "log", r, form) for d, _, r, t in texts if d == doc and form in t}
    got = [tuple(r) for r in found.select("document_id", "record_kind", "record_id", "value").collect()]
    assert len(got) == len(set(got)) and set(got) == want and want


def test_leaks_of_many_values(spark):
    """Thousands of values of one document, nested in each other, in long texts; null texts and values."""
    rng = random.Random(8)
    words = ["".join(rng.choices("abé😀", k=rng.randint(1, 9))) for _ in range(6_000)]
    values = [("d", w) for w in words] + [("d", None), (None, "a"), ("other", "a")]
    texts = [("d", "log", f"r{i}", "".join(rng.choices("abcé😀", k=40_000))) for i in range(3)]
    texts += [("d", "log", "none", None), (None, "log", "r0", "a"), ("d", "log", "empty", "")]
    found = privacy.scan_for_leaks(
        spark.createDataFrame(values, "document_id string, value string"),
        spark.createDataFrame(texts, "document_id string, record_kind string, record_id string, text string"),
        list_values=1_500,
    )
    got = [(r["record_id"], r["value"]) for r in found.collect()]
    want = {(r, w) for d, _, r, t in texts if d and t for w in set(words) if w in t}
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 1_000


@pytest.mark.parametrize("chunk", [2, 4096])
def test_lines_in_chunks(spark, chunk):
    rng = random.Random(1)
    rows = [(f"d{d}", s, rng.choice(["LINE", "PAGE"]), rng.choice(["", f"t{s}", f"u{s}"])) for d in range(4) for s in range(d * 4 + 1)]
    rng.shuffle(rows)
    blocks = spark.createDataFrame(rows, "doc string, seq bigint, BlockType string, Text string")
    got = {r["doc"]: r["text"] for r in texts_from_block_rows(blocks, ["doc"], chunk).collect()}
    for doc in got:
        mine = sorted(r for r in rows if r[0] == doc)
        assert got[doc] == "\n".join(t for _, _, kind, t in sorted(mine, key=lambda r: r[1]) if kind == "LINE" and t)
    assert len(got) == 4


def test_percentiles_are_exact(spark):
    rng = random.Random(2)
    rows = [("hot", float(rng.randint(0, 10**9))) for _ in range(30_000)]
    rows += [("hot", 5.0)] * 9_000 + [("few", float(i)) for i in range(10)] + [("one", 3.0), ("none", None), (None, 1.5), (None, 2.5)]
    frame = spark.createDataFrame(rows, "g string, v double")
    fractions = {"p0": 0.0, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    got = {r["g"]: tuple(r)[1:] for r in group_percentiles(frame, ["g"], "v", fractions).collect()}
    want = frame.groupBy("g").agg(*[F.percentile("v", f).alias(n) for n, f in fractions.items()])
    assert got == {r["g"]: tuple(r)[1:] for r in want.collect()} and len(got) == 5
