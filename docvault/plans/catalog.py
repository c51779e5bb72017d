"""The registered queries: each runs an operator of the package over whole tables."""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docvault.functions import rules
from docvault.functions.classification import (
    classification_to_json,
    guard_size,
    item_total,
    make_classification,
    no_items,
    no_strings,
    pii_counts,
    stored_bytes,
)
from docvault.functions.keys import audit_key, document_id, output_key
from docvault.functions.masking import mask_ssn
from docvault.functions.text import USER_PREFIX, build_prompt, truncate_text
from docvault.functions.timing import expires_at, version_ms
from docvault.operators import classify, delivery, ingest, lookup, monitor, privacy, reports, vault
from docvault.operators.once import compute_once
from docvault.plans import inputs
from docvault.operators.ingest import split_valid
from docvault.plans.batch import process_batch, snapshot_counts, write_snapshot
from docvault.plans.process import failures_of, outcomes_of, process_messages, records_of, requests_of, results_of
from docvault.schemas import CATEGORIES, LIST_CATEGORIES
from docvault.session import configure, work_dir
from docvault.settings import JobSettings
from docvault.sources import documents as document_sources
from docvault.sources.answers import Answers, answered
from docvault.sources.notifications import normalize_messages, read_notifications, stream_notifications
from docvault.sources.sinks import Tables, read_table
from docvault.sources.ledger import add_failures, read_ledger
from docvault.sources.records import find_records_of
from docvault.sources.store import DocumentStore, add_documents, store_lookup
from docvault.streaming.alarms import (
    DURATION_WINDOWS,
    ERROR_WINDOWS,
    append_corrections,
    read_windows,
    run_duration_windows,
    run_error_alarm,
)
from docvault.streaming.runner import dedupe_stream, run_stream

SETTINGS = JobSettings(expected_bucket=inputs.BUCKET)
SHORT_TEXT = 1000
SMALL_JSON = 5000
DAY_S = 86_400
LATER = "2024-02-02 00:00:05"


def wide_counts(counted: DataFrame, *carry: str) -> DataFrame:
    return counted.select(
        *carry, *[F.col("pii_counts")[c].cast("bigint").alias(f"n_{c}") for c in CATEGORIES]
    )


def as_text(rows: DataFrame, *columns: str) -> DataFrame:
    """Numbers and flags that can be null as text, which compares the same everywhere."""
    return rows.withColumns({c: F.col(c).cast("string") for c in columns})


def joined_lists(found) -> list:
    """The lists of a classification as text columns, which compare the same everywhere."""
    lists = [F.array_join(found[c], "|").alias(c) for c in LIST_CATEGORIES]
    items = F.transform(
        found["other_pii"],
        lambda i: F.concat(F.coalesce(i["type"], F.lit("?")), F.lit("="), i["value"]),
    )
    return [*lists, F.array_join(items, "|").alias("other_pii")]


def rule_classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = inputs.documents(spark, sf_dir).select(
        "doc_id", "source", "n_chars", "source_bucket", "source_key", "received_at", "text"
    )
    return classify.classify_rules(docs, SETTINGS)


def clean_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcomes, _ = process_messages(
        inputs.messages(spark, sf_dir, damaged=False),
        inputs.documents(spark, sf_dir),
        SETTINGS,
        whole_table=True,
    )
    return outcomes


def document_records(spark: SparkSession, sf_dir: str, as_of=inputs.AS_OF) -> DataFrame:
    """Vault rows straight from the documents, for the queries on stored records."""
    rows = rule_classified(spark, sf_dir).withColumn("version", version_ms(F.col("received_at")))
    return vault.vault_rows(rows, SETTINGS, as_of)


# --- sources, parsing, routing ---------------------------------------------------------------


def document_ids(spark, sf_dir):
    docs = inputs.documents(spark, sf_dir)
    doc_id = document_id(F.col("source_key"))
    day = vault.version_date(version_ms(F.col("received_at")))
    return docs.select(
        "doc_id",
        doc_id.alias("document_id"),
        output_key(F.col("source_key")).alias("output_key"),
        audit_key(day, doc_id, version_ms(F.col("received_at"))).alias("audit_key"),
    )


def parsed_notifications(spark, sf_dir):
    parsed = ingest.parse_notifications(inputs.messages(spark, sf_dir))
    return parsed.select("message_id", "source_bucket", "source_key", "error_type", "error")


def validated_inputs(spark, sf_dir):
    parsed = ingest.parse_notifications(inputs.messages(spark, sf_dir))
    checked = ingest.validate_inputs(parsed, SETTINGS)
    return checked.select("message_id", "document_id", "version", "error_type", "error")


def valid_requests(spark, sf_dir):
    parsed = ingest.parse_notifications(inputs.messages(spark, sf_dir))
    valid, _ = ingest.split_valid(ingest.validate_inputs(parsed, SETTINGS))
    return valid.select("message_id", "source_bucket", "source_key")


def all_event_records(spark, sf_dir):
    """Events that announce two documents at once, every record taken."""
    docs = inputs.documents(spark, sf_dir)

    def record(key):
        return F.struct(
            F.struct(
                F.struct(F.lit(inputs.BUCKET).alias("name")).alias("bucket"),
                F.struct(key.alias("key")).alias("object"),
            ).alias("s3")
        )

    first = inputs.encoded_key(F.col("source"), F.col("doc_id"))
    second = F.concat(F.lit("incoming/100%/"), F.col("doc_id").cast("string"), F.lit("%zz%41"))
    body = F.to_json(F.struct(F.array(record(first), record(second)).alias("Records")))
    events = docs.select(
        F.col("doc_id").cast("string").alias("messageId"), body.alias("body"), F.col("received_at").alias("receivedAt")
    )
    parsed = ingest.parse_notifications(normalize_messages(events, inputs.AS_OF), explode_records=True)
    return parsed.select("message_id", "source_bucket", "source_key", "error")


def kept(rows: DataFrame, name: str) -> DataFrame:
    """Rows written once for several readers."""
    place = work_dir(rows.sparkSession, name)
    rows.write.parquet(place)
    return rows.sparkSession.read.schema(rows.schema).parquet(place)


def ended_messages(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """(outcomes, rejected) of damaged messages whose documents go through a model, step by step."""
    requests = kept(requests_of(inputs.messages(spark, sf_dir), SETTINGS), "requests")
    valid, rejected = split_valid(requests)
    results = results_of(valid, inputs.documents(spark, sf_dir), SETTINGS, model=sample_model)
    return outcomes_of(valid, kept(results.drop("classification"), "results")), rejected


def failures(spark, sf_dir):
    """Failures of every stage: parsing, rules, missing documents, model."""
    return failures_of(*ended_messages(spark, sf_dir))


def failure_list(spark, sf_dir):
    return failures(spark, sf_dir).drop("message_key")


def failure_breakdown(spark, sf_dir):
    return reports.failure_breakdown(failures(spark, sf_dir))


def batch_summary(spark, sf_dir):
    """Queue batches of five consecutive messages, and how many of each failed at any stage."""
    outcomes, rejected = ended_messages(spark, sf_dir)
    ended = outcomes.select("version", "error").unionByName(rejected.select("version", "error"))
    return reports.batch_summary(ended.withColumn("batch_id", F.floor(F.col("version") / 5000)))


def delivered_messages(spark, sf_dir):
    """Delivered batches of five messages, one a line, some cut short, through the reader."""
    docs = inputs.documents(spark, sf_dir)
    message = F.struct(
        F.col("doc_id"),
        F.concat(F.lit("m"), F.col("doc_id").cast("string")).alias("messageId"),
        inputs.direct_body(F.col("source_bucket"), F.col("source_key")).alias("body"),
        F.col("received_at").alias("receivedAt"),
    )
    batches = docs.groupBy(F.floor(F.col("doc_id") / 5).alias("batch")).agg(
        F.sort_array(F.collect_list(message)).alias("rows")
    )
    records = F.transform("rows", lambda r: r.dropFields("doc_id"))
    line = F.to_json(F.struct(records.alias("Records")))
    line = F.when(F.pmod("batch", F.lit(50)) == 49, F.substring(line, 1, 20)).otherwise(line)
    place = work_dir(spark, "deliveries")
    batches.select(line.alias("value")).write.text(place)
    found = read_notifications(spark, place, inputs.AS_OF, deliveries="lines")
    return found.select("message_id", "body", F.unix_millis("received_at").alias("received_ms"))


def document_lookup(spark, sf_dir):
    parsed = ingest.parse_notifications(inputs.messages(spark, sf_dir))
    valid, _ = ingest.split_valid(ingest.validate_inputs(parsed, SETTINGS))
    requests = valid.select("message_id", *lookup.KEY)
    found = lookup.lookup_documents(requests, inputs.documents(spark, sf_dir))
    return found.select("message_id", "source_key", "text", "error_type", "error")


def document_store(spark, sf_dir, buckets: int = 8) -> DocumentStore:
    store = DocumentStore(work_dir(spark, "documents"), buckets)
    add_documents(inputs.documents(spark, sf_dir), store)
    return store


def bucketed_lookup(spark, sf_dir):
    """Vault rows of two batches whose texts stay in the buckets that they were written to."""
    tables, lookup_texts = Tables(f"{work_dir(spark, 'bucketed')}/tables"), store_lookup(document_store(spark, sf_dir))
    messages = inputs.messages(spark, sf_dir)
    for batch_id in (0, 1):
        own = messages.filter((F.unix_seconds("received_at") % 5 == 0).cast("int") == batch_id)
        process_batch(own, lookup_texts, tables, batch_id, inputs.AS_OF, SETTINGS)
    return read_table(spark, tables, "vault").select("document_id", "version", "source_key", "pii_counts")


def block_rows(spark, sf_dir):
    turns = inputs.table(spark, sf_dir, "conversations")
    kind = F.when(F.col("role") == "user", F.lit("LINE")).otherwise(F.lit("PAGE"))
    return turns.select("conv_id", F.col("turn").alias("seq"), kind.alias("BlockType"), F.col("text").alias("Text"))


def assembled_lines(spark, sf_dir):
    return document_sources.texts_from_block_rows(block_rows(spark, sf_dir), ["conv_id"])


def assembled_blocks(spark, sf_dir):
    """Each turn as a document whose blocks are its lines, behind a page block."""
    turns = inputs.table(spark, sf_dir, "conversations")
    lines = F.transform(
        F.split("text", "\n"), lambda t: F.struct(F.lit("LINE").alias("BlockType"), t.alias("Text"))
    )
    page = F.array(F.struct(F.lit("PAGE").alias("BlockType"), F.col("role").alias("Text")))
    docs = turns.select(
        F.col("conv_id").cast("string").alias("source_bucket"),
        F.col("turn").cast("string").alias("source_key"),
        F.concat(page, lines).alias("blocks"),
    )
    return document_sources.texts_from_blocks(docs)


def plain_lines(content: bytes) -> list[dict]:
    """A text extractor for plain text objects."""
    return [{"BlockType": "LINE", "Text": line} for line in content.decode("utf-8").split("\n")]


def extracted_texts(spark, sf_dir):
    objects = inputs.documents(spark, sf_dir).select(
        "source_bucket", "source_key", F.encode("text", "UTF-8").alias("content")
    )
    blocks = classify.extract_with(objects, plain_lines, SETTINGS)
    return document_sources.texts_from_blocks(blocks)


# --- text and classification -----------------------------------------------------------------


def classification_prompts(spark, sf_dir):
    docs = inputs.documents(spark, sf_dir)
    return docs.select("doc_id", build_prompt(truncate_text(F.col("text"), SHORT_TEXT)).alias("prompt"))


def nonblank_text(spark, sf_dir):
    """Texts of two sources replaced by two kinds of white space."""
    docs = inputs.documents(spark, sf_dir)
    text = (
        F.when(F.col("source") == "src3", F.lit("\u00a0\u2003\u0085"))
        .when(F.col("source") == "src7", F.lit(" \t\n\x1c\x1f"))
        .otherwise(F.col("text"))
    )
    return lookup.drop_blank_text(docs.select("doc_id", text.alias("text")))


def rule_matches(spark, sf_dir):
    found = rule_classified(spark, sf_dir)
    return found.select("doc_id", *joined_lists(F.col("classification")))


def page_matches(spark, sf_dir):
    pages = inputs.table(spark, sf_dir, "pages").select("page_id", F.col("html").alias("text"))
    found = classify.classify_rules(pages, SETTINGS)
    return found.select("page_id", *joined_lists(F.col("classification")))


def sentences(spark, sf_dir) -> DataFrame:
    """Order facts written out as sentences, which have what the documents lack."""
    orders = inputs.table(spark, sf_dir, "orders")
    number = F.col("o_orderkey").cast("string")
    padded = F.lpad(number, 9, "0")
    names = F.array(*[F.lit(n) for n in ("Ada Lovelace", "Alan Turing", "Grace Hopper")])
    text = F.concat(
        F.lit("Name: "),
        F.get(names, (F.col("o_orderkey") % 3).cast("int")),
        F.lit(". SSN: "),
        F.concat_ws("-", F.substring(padded, 1, 3), F.substring(padded, 4, 2), F.substring(padded, 6, 4)),
        F.lit(" born "),
        F.date_format("o_orderdate", "MM/dd/yyyy"),
        F.lit(", lives at "),
        number,
        F.lit(" Main Street, call +1-555-"),
        F.substring(padded, 1, 3),
        F.lit("-"),
        F.substring(padded, 6, 4),
        F.lit(". Status "),
        F.col("o_orderstatus"),
    )
    return orders.select("o_orderkey", text.alias("text"))


def labelled_text_matches(spark, sf_dir):
    found = classify.classify_rules(sentences(spark, sf_dir), SETTINGS)
    return found.select("o_orderkey", *joined_lists(F.col("classification")))


def long_text_matches(spark, sf_dir):
    """Two hundred documents at a time as one text, with a number to find at its end."""
    docs = inputs.documents(spark, sf_dir).select(F.floor(F.col("doc_id") / 200).alias("part"), "doc_id", "text")
    texts = document_sources.joined_lines(docs, ["part"], "text", "doc_id")
    last = F.lpad(F.col("part").cast("string"), 4, "0")
    texts = texts.select("part", F.concat("text", F.lit("\nSSN: 123-45-"), last).alias("text"))
    found = classify.classify_rules(texts, SETTINGS)
    return found.select("part", *joined_lists(F.col("classification")))


def document_pii_counts(spark, sf_dir):
    """The flow end to end: messages to masked classifications to counts per document."""
    outcomes = clean_outcomes(spark, sf_dir)
    counted = outcomes.select("source_key", "document_id", pii_counts(F.col("classification")).alias("pii_counts"))
    return wide_counts(counted, "source_key", "document_id")


def pii_items(spark, sf_dir):
    return reports.explode_pii(rule_classified(spark, sf_dir), ["doc_id"])


def category_totals(spark, sf_dir):
    counted = rule_classified(spark, sf_dir).select(
        "source", pii_counts(F.col("classification")).alias("pii_counts")
    )
    return reports.category_totals(counted, ["source"], rollup=True)


def parsed_responses(spark, sf_dir):
    parsed = classify.parse_responses(inputs.responses(spark, sf_dir))
    found = F.col("classification")
    masked = parsed.withColumn("classification", found.withField("ssns", F.transform(found["ssns"], mask_ssn)))
    return masked.select(
        "c_custkey",
        *joined_lists(found),
        found["parse_error"].cast("string").alias("parse_error"),
        "error_type",
        "error",
    )


def sample_model(system: str, prompt: str) -> str:
    """Stands in for a model: plain, fenced, chatty and failing answers by text length."""
    text = prompt[len(USER_PREFIX):]
    if len(text) % 7 == 0:
        raise ValueError("refused")
    if len(text) % 5 == 0:
        return "I cannot process this."
    answer = json.dumps(
        {
            "emails": re.findall(rules.EMAIL, text),
            "ssns": [f"123-45-{len(text) % 10000:04d}"],
            "other_pii": ["loose", {"type": "LENGTH", "value": str(len(text))}],
        }
    )
    return f"```json\n{answer}\n```" if len(text) % 2 else answer


def model_classified(spark, sf_dir):
    """Each document once through a plugged-in model, its answer parsed and masked."""
    outcomes, _ = process_messages(
        inputs.messages(spark, sf_dir, damaged=False),
        inputs.documents(spark, sf_dir),
        SETTINGS,
        model=sample_model,
    )
    return answer_rows(outcomes)


def answer_rows(outcomes: DataFrame) -> DataFrame:
    found = F.col("classification")
    return outcomes.select(
        "source_key",
        *joined_lists(found),
        found["parse_error"].cast("string").alias("parse_error"),
        "stage",
        "error_type",
        "error",
    )


def answers_by_content(spark, sf_dir):
    """Copies of all documents, answered from what a model said of the originals.

    The model of the second batch refuses everything, so only the stored answers can fill it.
    """
    place = work_dir(spark, "answers")
    known = Answers(f"{place}/known", "sample-1")
    valid, _ = split_valid(requests_of(inputs.messages(spark, sf_dir, damaged=False), SETTINGS))
    valid = kept(valid, "requests")
    originals = inputs.documents(spark, sf_dir)
    copies = originals.withColumn("source_key", F.concat("source_key", F.lit(".copy")))
    wanted = valid.withColumn("source_key", F.concat("source_key", F.lit(".copy")))
    rounds = [(valid, originals, sample_model), (wanted, copies, refusing_model)]
    for batch_id, (requests, documents, model) in enumerate(rounds):
        now = F.to_timestamp(F.lit(inputs.AS_OF))
        ask = partial(answered, model=model, answers=known, settings=SETTINGS, batch_id=batch_id, now=now)
        results = kept(results_of(requests, documents, SETTINGS, whole_table=True, classify=ask), "results")
    original = F.regexp_replace("source_key", r"\.copy$", "")
    return answer_rows(outcomes_of(wanted, results)).withColumn("source_key", original)


# --- masking and privacy ---------------------------------------------------------------------


def masked_ssns(spark, sf_dir):
    return inputs.ssns(spark, sf_dir).select("o_orderkey", mask_ssn(F.col("raw")).alias("masked"))


def unmasked_rows(spark, sf_dir):
    """Orders with a number in the clear, beside a masked one."""
    raw = inputs.ssns(spark, sf_dir)
    shown = F.when(F.col("o_orderstatus") == "F", F.col("raw")).otherwise(mask_ssn(F.col("raw")))
    lists = {c: no_strings() for c in LIST_CATEGORIES} | {"ssns": F.array(mask_ssn(F.col("raw")), shown)}
    found = make_classification(lists, no_items(), F.lit(False))
    rows = raw.select("o_orderkey", found.alias("classification"))
    return privacy.check_masked(rows).select("o_orderkey")


def leak_scan(spark, sf_dir):
    """Summaries, audit rows, failures of all stages, and log lines that wrongly carry the texts."""
    place = work_dir(spark, "records")
    document_records(spark, sf_dir).write.parquet(place)
    records = spark.read.parquet(place)
    values = reports.explode_pii(vault.with_classification(records), ["document_id"])
    logs = inputs.documents(spark, sf_dir).select(
        document_id(F.col("source_key")).alias("document_id"), F.col("text").alias("message")
    )
    outward = (
        privacy.outward_texts(vault.output_rows(records), "output")
        .unionByName(privacy.outward_texts(vault.audit_rows(records), "audit"))
        .unionByName(privacy.outward_texts(failures(spark, sf_dir), "failure"))
        .unionByName(privacy.outward_texts(logs, "log"))
    )
    leaks = privacy.scan_for_leaks(values, outward)
    return leaks.groupBy("document_id", "record_kind").agg(F.count_distinct("value").alias("leaked_forms"))


# --- vault, summaries and reads --------------------------------------------------------------


def vault_records(spark, sf_dir):
    return records_of(clean_outcomes(spark, sf_dir), SETTINGS, inputs.AS_OF)


def size_guarded(spark, sf_dir):
    """Whole texts as values, with a limit small enough to matter."""
    lists = {c: no_strings() for c in LIST_CATEGORIES} | {
        "names": F.array("text"),
        "addresses": F.array("lang", "source"),
    }
    docs = inputs.documents(spark, sf_dir).select(
        "doc_id", make_classification(lists, no_items(), F.lit(False)).alias("found")
    )
    docs = compute_once(docs, {"json": classification_to_json(F.col("found"))})
    return docs.select(
        "doc_id",
        stored_bytes(F.col("found"), F.col("json")).cast("bigint").alias("stored_bytes"),
        (guard_size(F.col("found"), F.col("json"), SMALL_JSON) != F.col("json")).alias("replaced"),
    )


def masked_vault_records(spark, sf_dir):
    """Vault rows of texts with social security numbers, which only the vault step masks."""
    rows = classify.classify_rules(
        sentences(spark, sf_dir).select(
            F.lit(inputs.BUCKET).alias("source_bucket"),
            F.concat(F.lit("incoming/orders/"), F.col("o_orderkey").cast("string")).alias("source_key"),
            F.col("o_orderkey").alias("version"),
            "text",
        ),
        SETTINGS,
    )
    return vault.vault_rows(rows, SETTINGS, inputs.AS_OF).select("source_key", "version", "pii_counts", "pii_data")


def identities(docs: DataFrame) -> DataFrame:
    return docs.select(
        document_id(F.col("source_key")).alias("document_id"),
        "source_bucket",
        version_ms(F.col("received_at")).alias("version"),
        "source_key",
    )


def appended(spark, sf_dir) -> DataFrame:
    """Every document delivered twice to a vault that already has the labelled ones."""
    docs = inputs.documents(spark, sf_dir)
    labelled = inputs.table(spark, sf_dir, "labels").select("doc_id").distinct()
    delivered = F.explode(F.array(F.lit(1), F.lit(2))).alias("_delivery")
    candidates = identities(docs).select("*", delivered).drop("_delivery")
    stored_before = identities(docs.join(labelled, "doc_id", "left_semi"))
    fresh = vault.append_new_only(candidates, stored_before)
    found = rule_classified(spark, sf_dir).select(*lookup.KEY, "classification")
    return vault.vault_rows(fresh.join(found, lookup.KEY), SETTINGS, inputs.AS_OF)


def vault_append(spark, sf_dir):
    return appended(spark, sf_dir).select("document_id", "version", "source_key", "pii_counts")


def output_records(spark, sf_dir):
    return wide_counts(vault.output_rows(appended(spark, sf_dir)), "output_key", "document_id", "version")


def audit_records(spark, sf_dir):
    audit = vault.audit_rows(appended(spark, sf_dir)).withColumn(
        "audit_date", F.col("audit_date").cast("string")
    )
    carry = [c for c in audit.columns if c != "pii_counts"]
    return wide_counts(audit, *carry)


def versioned(spark, sf_dir) -> DataFrame:
    """Up to four versions per document: all, then labelled ones again, some within the hour."""
    first = rule_classified(spark, sf_dir).withColumn("version", version_ms(F.col("received_at")))
    labels = inputs.table(spark, sf_dir, "labels").groupBy("doc_id").agg(
        F.lit(True).alias("labelled"),
        F.bool_or(F.col("toxic") == 0).alias("harmless"),
        F.bool_or(F.col("quality") == 1).alias("good"),
    )

    def later(condition, milliseconds, cleared):
        return F.when(
            condition, F.struct(F.lit(milliseconds).alias("after"), F.lit(cleared).alias("cleared"))
        )

    runs = F.array_compact(
        F.array(
            later(F.lit(True), 0, False),
            later(F.col("labelled"), 1, True),
            later(F.col("harmless"), DAY_S * 1000, False),
            later(F.col("good"), 2 * DAY_S * 1000, True),
        )
    )
    rows = first.join(labels, "doc_id", "left").select(
        "source_bucket", "source_key", "version", "classification", F.inline(runs)
    )
    found = F.when(F.col("cleared"), inputs.empty_classification()).otherwise(F.col("classification"))
    again = rows.withColumns({"version": F.col("version") + F.col("after"), "classification": found})
    return vault.vault_rows(again, SETTINGS, inputs.AS_OF)


def version_history(spark, sf_dir):
    history = vault.version_history(versioned(spark, sf_dir)).drop("source_bucket")
    return as_text(history, "previous_version", "items_change")


def latest_in_two_buckets(spark, sf_dir):
    """Toxic documents have lain in a second bucket, too, and changed there a minute later."""
    rows = versioned(spark, sf_dir)
    toxic = inputs.table(spark, sf_dir, "labels").filter("toxic = 1").select("doc_id")
    keys = inputs.documents(spark, sf_dir).join(toxic, "doc_id", "left_semi").select("source_key").distinct()
    moved = {"source_bucket": F.lit("other-bucket"), "version": F.col("version") + 60_000}
    both = rows.unionByName(vault.find_by_source_keys(rows, keys).withColumns(moved).select(rows.columns))
    return vault.latest_version(both).select("source_bucket", "source_key", "version")


def output_latest(spark, sf_dir):
    latest = vault.latest_version(vault.output_rows(versioned(spark, sf_dir)), "output_key")
    return wide_counts(latest, "output_key", "version")


def records_of_toxic_documents(spark, sf_dir):
    toxic = inputs.table(spark, sf_dir, "labels").filter("toxic = 1").select("doc_id")
    keys = inputs.documents(spark, sf_dir).join(toxic, "doc_id", "left_semi").select("source_key")
    found = vault.find_by_source_keys(versioned(spark, sf_dir), keys)
    return found.select("source_key", "version", "pii_counts")


def indexed_records(spark, sf_dir):
    """Records of toxic documents, found through the index that two batches have kept."""
    tables = Tables(f"{work_dir(spark, 'indexed')}/tables")
    messages, docs = inputs.messages(spark, sf_dir), inputs.documents(spark, sf_dir)
    for batch_id in (0, 1, 0):
        own = messages.filter(F.unix_seconds("received_at") % 2 == batch_id)
        process_batch(own, docs, tables, batch_id, inputs.AS_OF, SETTINGS, whole_table=True)
    toxic = inputs.table(spark, sf_dir, "labels").filter("toxic = 1").select("doc_id")
    found = find_records_of(spark, tables, docs.join(toxic, "doc_id", "left_semi").select("source_key"))
    return found.select("source_key", "version", "pii_counts")


def expiry_moment():
    return "2024-12-31 00:01:40"


def expiring(spark, sf_dir) -> DataFrame:
    """When the record of each document expires, if it is stored as the document arrives."""
    docs = inputs.documents(spark, sf_dir)
    return identities(docs).withColumn(
        "expires_at", expires_at(F.timestamp_millis("version"), SETTINGS.ttl_days)
    )


def active_records(spark, sf_dir):
    records = expiring(spark, sf_dir)
    return vault.active_records(records, expiry_moment()).select("document_id", "version", "expires_at")


def expired_records(spark, sf_dir):
    records = expiring(spark, sf_dir)
    return vault.expired_records(records, expiry_moment()).select("document_id", "version", "expires_at")


def audit_history(spark, sf_dir):
    """Documents of seven days, each taking as many milliseconds as it has characters."""
    day = F.pmod("doc_id", F.lit(7)) * DAY_S * 1000
    rows = rule_classified(spark, sf_dir).withColumn("version", version_ms(F.col("received_at")) + day)
    done = F.timestamp_millis(F.col("version") + F.col("n_chars"))
    history = reports.audit_history(vault.audit_rows(vault.vault_rows(rows, SETTINGS, done)))
    return history.withColumns(
        {
            "audit_date": F.col("audit_date").cast("string"),
            "p99_duration_ms": F.round("p99_duration_ms", 6),
        }
    )


# --- delivery and monitoring -----------------------------------------------------------------


def retry_messages(spark, sf_dir):
    """Failed messages; those of even seconds have failed three times and are dead letters."""
    failed = kept(failures(spark, sf_dir), "failures")
    times = F.when(F.col("version") % 2000 == 0, F.sequence(F.lit(0), F.lit(2))).otherwise(F.array(F.lit(0)))
    attempts = failed.select("*", F.explode(times).alias("batch_id"))
    dead = delivery.dead_letters(delivery.attempt_ledger(attempts), SETTINGS.max_deliveries)
    retry = delivery.select_for_retry(inputs.messages(spark, sf_dir), attempts, dead)
    return retry.select("message_id", F.unix_millis("received_at").alias("received_ms"))


def attempts(spark, sf_dir) -> DataFrame:
    """Error events as failed attempts: users are messages, each about many documents; some
    events name none and are told apart by what stands for their body."""
    events = inputs.table(spark, sf_dir, "events").filter("event_type = 'error'")
    named = F.when(F.col("event_id") % 11 != 0, F.sha2((F.col("event_id") % 40).cast("string"), 256))
    body = F.concat(F.lit("body:"), (F.col("event_id") % 3).cast("string"))
    return events.select(
        F.col("user_id").cast("string").alias("message_id"),
        F.coalesce(named, body).alias("message_key"),
        named.alias("document_id"),
        F.lit("classify").alias("stage"),
        F.lit("ClassificationError").alias("error_type"),
        F.col("props").alias("error"),
        "event_id",
    )


def ledger(spark, sf_dir) -> DataFrame:
    return delivery.attempt_ledger(attempts(spark, sf_dir), order="event_id")


def incremental_ledger(spark, sf_dir):
    """Four batches of failures merged one by one, out of order, two of them again.

    Batch 2 comes first with wrong errors and one failure in two missing; batch 0 runs twice.
    """
    tables = Tables(f"{work_dir(spark, 'ledger')}/tables")
    failures = attempts(spark, sf_dir).withColumn("batch_id", F.col("event_id") % 4)
    broken = failures.filter("event_id % 8 = 2").withColumn("error", F.lit("wrong"))
    for batch_id, rows, again in ((2, broken, False), (0, failures, False), (3, failures, False), (1, failures, False), (2, failures, True), (0, failures, True)):
        add_failures(rows.filter(F.col("batch_id") == batch_id), tables, batch_id, again)
    return read_ledger(spark, tables)


def dead_letters(spark, sf_dir):
    return delivery.dead_letters(ledger(spark, sf_dir), SETTINGS.max_deliveries)


def messages_still_retrying(spark, sf_dir):
    return delivery.still_retrying(ledger(spark, sf_dir), SETTINGS.max_deliveries)


def dlq_alarm(spark, sf_dir):
    return monitor.dlq_alarm(dead_letters(spark, sf_dir))


def in_ms(windows: DataFrame) -> DataFrame:
    """Window bounds as epoch milliseconds and quantiles without their last binary digits."""
    quantiles = [c for c in windows.columns if c.endswith("p99_ms")]
    return windows.withColumns(
        {c: F.unix_millis(c) for c in ("window_start", "window_end")}
        | {c: F.round(c, 6) for c in quantiles}
    )


def parsed_logs(spark, sf_dir):
    logs = monitor.parse_logs(inputs.event_logs(spark, sf_dir))
    return logs.select(
        "event_id",
        "level",
        F.unix_micros("timestamp").alias("ts_us"),
        "message",
        F.try_variant_get("ctx", "$.duration_ms", "double").alias("duration_ms"),
        F.try_variant_get("ctx", "$.user_id", "bigint").alias("user_id"),
    )


def error_alarm(spark, sf_dir):
    return in_ms(monitor.error_alarm(monitor.parse_logs(inputs.event_logs(spark, sf_dir))))


def durations(spark, sf_dir) -> DataFrame:
    return inputs.table(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp").alias("timestamp"), F.col("value").alias("duration_ms")
    )


def duration_windows(spark, sf_dir):
    return in_ms(monitor.duration_windows(durations(spark, sf_dir)))


def slow_alarm(spark, sf_dir):
    windows = monitor.duration_windows(durations(spark, sf_dir))
    return in_ms(monitor.slow_alarm(windows, slow_ms=SETTINGS.slow_ms / 1000))


# --- streams ---------------------------------------------------------------------------------


def stream_table(spark, sf_dir, name):
    """A table as a stream; the trailing glob also matches a single file."""
    schema = inputs.table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parquet*")


def finish(query) -> None:
    """Wait until an availableNow stream has gone through its input, however long that takes."""
    query.awaitTermination()


def inbox(spark, sf_dir, copies: int = 1) -> tuple[str, int]:
    """A folder with the damaged messages as JSON lines in several files, and a quarter of their number."""
    raw = inputs.announced(inputs.table(spark, sf_dir, "documents"), damaged=True)
    raw = raw.select("*", F.explode(F.sequence(F.lit(1), F.lit(copies))).alias("_copy"))
    quarter = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // 4)
    place = work_dir(spark, "inbox")
    files = raw.repartition(4 * quarter, F.xxhash64("body", "receivedAt", "_copy")).drop("_copy")
    files.write.json(place)
    return place, quarter


def run_message_stream(spark, sf_dir, runs: int = 1) -> Tables:
    """The message stream over four micro-batches and more, once or again from the start."""
    place = work_dir(spark, "stream")
    tables = Tables(f"{place}/tables")
    files, quarter = inbox(spark, sf_dir)
    for run in range(runs):
        finish(
            run_stream(
                stream_notifications(spark, files, quarter, inputs.AS_OF),
                inputs.documents(spark, sf_dir),
                tables,
                f"{place}/checkpoint-{run}",
                SETTINGS,
                as_of=inputs.AS_OF if run == 0 else LATER,
                trigger={"availableNow": True},
            )
        )
    return tables


def streamed_records(spark, sf_dir):
    """The vault after the message stream has run to its end."""
    tables = run_message_stream(spark, sf_dir)
    return read_table(spark, tables, "vault").select(
        "document_id", "version", "source_key", "source_bucket", "pii_counts", "processed_at", "duration_ms"
    )


def streamed_failures(spark, sf_dir):
    tables = run_message_stream(spark, sf_dir)
    return reports.failure_breakdown(read_table(spark, tables, "failures"))


def streamed_audit(spark, sf_dir):
    """The audit table after the stream was run, its checkpoint lost, and all delivered again a day later."""
    tables = run_message_stream(spark, sf_dir, runs=2)
    audit = read_table(spark, tables, "audit")
    return audit.select("audit_key", "source_key_hash", item_total(F.col("pii_counts")).alias("items"))


def streamed_output(spark, sf_dir):
    """The newest summary per output key from the table that the stream wrote."""
    tables = run_message_stream(spark, sf_dir)
    latest = vault.latest_version(read_table(spark, tables, "output"), "output_key")
    return wide_counts(latest, "output_key", "version")


def refusing_model(system: str, prompt: str) -> str:
    raise ValueError("refused")


def replayed_batch(spark, sf_dir):
    """A batch whose model refused everything, run again a day later with the built-in patterns."""
    tables = Tables(f"{work_dir(spark, 'replay')}/tables")
    messages, docs = inputs.messages(spark, sf_dir), inputs.documents(spark, sf_dir)
    process_batch(messages, docs, tables, 0, inputs.AS_OF, SETTINGS, model=refusing_model)
    process_batch(messages, docs, tables, 0, LATER, SETTINGS, whole_table=True)
    parts = {"vault": ("document_id", "processed_at"), "audit": ("audit_key", "processed_at"), "failures": ("message_id", "error")}
    rows = [
        read_table(spark, tables, name).select(
            F.lit(name).alias("table_name"), F.col(key).alias("key"), F.col(detail).alias("detail")
        )
        for name, (key, detail) in parts.items()
    ]
    return rows[0].unionAll(rows[1]).unionAll(rows[2])


def purged_tables(spark, sf_dir):
    """Two batches, the first of which has expired; rows of every table before and after a snapshot."""
    place = work_dir(spark, "purge")
    tables, target = Tables(f"{place}/tables"), Tables(f"{place}/snapshot")
    messages, docs = inputs.messages(spark, sf_dir), inputs.documents(spark, sf_dir)
    for batch_id, moment in enumerate((inputs.AS_OF, "2024-06-01 00:00:00")):
        own = messages.filter(F.unix_seconds("received_at") % 2 == batch_id)
        process_batch(own, docs, tables, batch_id, moment, SETTINGS, whole_table=True)
    write_snapshot(spark, tables, target, "2025-02-15 00:00:00", SETTINGS, merge_before=1)
    return snapshot_counts(spark, tables, target)


def streamed_distinct(spark, sf_dir):
    """Every message delivered twice, often in different batches; the first goes through."""
    place = work_dir(spark, "distinct")
    files, quarter = inbox(spark, sf_dir, copies=2)
    tables = Tables(f"{place}/tables")
    messages = stream_notifications(spark, files, quarter, inputs.AS_OF)
    finish(dedupe_stream(messages, tables, f"{place}/checkpoint", SETTINGS, trigger={"availableNow": True}))
    return read_table(spark, tables, "distinct").select("source_key", "document_id", "version")


def event_levels(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.when(F.col("event_type") == "error", F.lit("ERROR")).otherwise(F.lit("INFO")).alias("level"),
    )


def streamed_error_alarm(spark, sf_dir):
    """Windows that a five-minute watermark has closed by the end of the events."""
    place = work_dir(spark, "errors")
    events = event_levels(stream_table(spark, sf_dir, "events"))
    finish(run_error_alarm(events, f"{place}/rows", f"{place}/checkpoint", trigger={"availableNow": True}))
    return in_ms(read_windows(spark, f"{place}/rows", ERROR_WINDOWS))


def corrected_error_alarm(spark, sf_dir):
    """One event in seven comes when its window is closed; corrections, appended twice, bring it in."""
    place, events = work_dir(spark, "late"), inputs.table(spark, sf_dir, "events")
    late = F.col("event_id") % 7 == 3
    stream = spark.readStream.schema(events.schema).parquet(f"{place}/events/*")
    for part, rows in (("first", events.filter(~late)), ("second", events.filter(late))):
        rows.write.parquet(f"{place}/events/{part}")
        finish(run_error_alarm(event_levels(stream), f"{place}/rows", f"{place}/checkpoint", trigger={"availableNow": True}))
    whole = monitor.error_alarm(event_levels(events))
    for name in ("late-1", "late-2"):
        append_corrections(whole, f"{place}/rows", ERROR_WINDOWS, name)
    return in_ms(read_windows(spark, f"{place}/rows", ERROR_WINDOWS))


def streamed_slow_alarm(spark, sf_dir):
    place = work_dir(spark, "slow")
    events = stream_table(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp").alias("timestamp"), F.col("value").alias("duration_ms")
    )
    finish(run_duration_windows(events, f"{place}/rows", f"{place}/checkpoint", trigger={"availableNow": True}))
    closed = read_windows(spark, f"{place}/rows", DURATION_WINDOWS)
    return in_ms(monitor.slow_alarm(closed, slow_ms=SETTINGS.slow_ms / 1000))


QUERIES = [
    document_pii_counts,
    document_ids,
    parsed_notifications,
    validated_inputs,
    valid_requests,
    all_event_records,
    failure_list,
    failure_breakdown,
    batch_summary,
    delivered_messages,
    document_lookup,
    bucketed_lookup,
    assembled_lines,
    assembled_blocks,
    extracted_texts,
    classification_prompts,
    nonblank_text,
    rule_matches,
    page_matches,
    labelled_text_matches,
    long_text_matches,
    pii_items,
    category_totals,
    parsed_responses,
    model_classified,
    answers_by_content,
    masked_ssns,
    unmasked_rows,
    leak_scan,
    vault_records,
    masked_vault_records,
    size_guarded,
    vault_append,
    output_records,
    audit_records,
    version_history,
    output_latest,
    latest_in_two_buckets,
    records_of_toxic_documents,
    indexed_records,
    active_records,
    expired_records,
    audit_history,
    retry_messages,
    incremental_ledger,
    dead_letters,
    messages_still_retrying,
    dlq_alarm,
    parsed_logs,
    error_alarm,
    duration_windows,
    slow_alarm,
    streamed_records,
    streamed_failures,
    streamed_audit,
    streamed_output,
    replayed_batch,
    purged_tables,
    streamed_distinct,
    streamed_error_alarm,
    corrected_error_alarm,
    streamed_slow_alarm,
]


def registered(query: Callable) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(configure(spark), sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: registered(q) for q in QUERIES}
