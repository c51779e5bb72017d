import json
import random
import re

import pytest
from pyspark.sql import functions as F

from docvault.functions import rules
from docvault.functions.text import SYSTEM_PROMPT, USER_PREFIX, text_pieces
from docvault.operators.classify import (
    TransientError,
    classify_in_pieces,
    classify_rules,
    classify_with,
    extract_with,
    parse_responses,
    with_retries,
)
from docvault.schemas import LIST_CATEGORIES
from docvault.settings import JobSettings

SETTINGS = JobSettings(max_attempts=3, retry_base_ms=1)
FULL = {"names": ["Jane Smith"], "ssns": ["123-45-6789"], "other_pii": [{"type": "ID", "value": "X"}]}


def parse(spark, responses):
    rows = spark.createDataFrame(list(enumerate(responses)), "i int, response string")
    return sorted(parse_responses(rows).collect(), key=lambda r: r["i"])


@pytest.mark.parametrize(
    "wrap",
    ["{}", "```json\n{}\n```", "```\n{}```", "```JSON {} ``` \n", "  {}\n", " {}\x1c"],
)
def test_fences_are_removed(spark, wrap):
    row = parse(spark, [wrap.replace("{}", json.dumps(FULL))])[0]
    assert row["error"] is None and not row["classification"]["parse_error"]
    assert row["classification"]["names"] == ["Jane Smith"]
    assert row["classification"]["emails"] == []


def test_text_that_is_not_json_is_stored_as_parse_error(spark):
    answers = ["I cannot process this.", "", "{} and more", '{"names": ["a"]', '{"other_pii": null}', '{"other_pii": 3}']
    for row in parse(spark, answers):
        assert row["error"] is None and row["classification"]["parse_error"]
        assert all(row["classification"][c] == [] for c in [*LIST_CATEGORIES, "other_pii"])


def test_json_of_the_wrong_shape_fails_the_record(spark):
    for row in parse(spark, ["[1]", "null", '"text"', '{"names": null}', '{"ssns": "1"}', '{"emails": {}}']):
        assert row["classification"] is None and row["error"] == "malformed_classification"


def test_other_items(spark):
    answers = [
        {"other_pii": ["not-a-dict", {"type": "ID", "value": "X"}]},
        {"other_pii": [{"value": 5}, {"type": None, "value": "y"}, []]},
        {"other_pii": "text"},
        {"other_pii": {}},
        {"parse_error": True, "ssns": [None, 5]},
    ]
    rows = [r["classification"] for r in parse(spark, list(map(json.dumps, answers)))]
    assert [tuple(i) for i in rows[0]["other_pii"]] == [("ID", "X")]
    assert [tuple(i) for i in rows[1]["other_pii"]] == [("", "5"), (None, "y")]
    assert rows[2]["other_pii"] == rows[3]["other_pii"] == []
    assert rows[4]["parse_error"] and rows[4]["ssns"] == [None, "5"]


@pytest.fixture
def fake_model():
    def model(system, prompt):
        assert system == SYSTEM_PROMPT
        text = prompt[len(USER_PREFIX):]
        if text == "busy":
            raise TransientError("429")
        if text == "refused":
            raise ValueError("401")
        return json.dumps({"names": [text]})

    return model


def test_model_calls(spark, fake_model):
    texts = [("a", None), ("busy", None), ("refused", None), (None, None), ("b", "document_not_found")]
    rows = spark.createDataFrame(texts, "text string, error string").withColumn("key", F.col("text"))
    answers = {r["key"]: r for r in classify_with(rows, fake_model, SETTINGS).collect()}
    assert json.loads(answers["a"]["response"])["names"] == ["a"] and answers["a"]["error"] is None
    assert answers["busy"]["error_type"] == "ClassificationError"
    assert answers["busy"]["error"] == "attempts_exhausted"
    assert answers["refused"]["error"] == "ValueError"
    assert answers[None]["response"] is None and answers[None]["error"] is None
    assert answers["b"]["error"] == "document_not_found" and answers["b"]["response"] is None


def test_long_text_is_cut_before_the_call(spark, fake_model):
    rows = spark.createDataFrame([("A" * 50,)], "text string")
    answer = classify_with(rows, fake_model, JobSettings(max_text_chars=10)).first()
    assert json.loads(answer["response"])["names"] == ["A" * 10 + "\n[TEXT TRUNCATED]"]


def test_long_texts_go_out_in_pieces(spark):
    def model(system, prompt):
        text = prompt[len(USER_PREFIX):]
        if "stop" in text:
            raise ValueError("refused")
        return json.dumps({"names": re.findall("[A-Z][a-z]+", text), "emails": ["x"] * text.count("@")})

    texts = [("long", "." * 95 + "Ann" + "." * 100 + "Bob" + "." * 30 + "Ann@"), ("short", "Ann Ann @@"), ("none", None), ("bad", "." * 150 + "stop")]
    rows = spark.createDataFrame(texts, "key string, text string").withColumn("blank", F.lit(False))
    settings = JobSettings(piece_chars=100, piece_overlap=10, retry_base_ms=1)
    got = {r["key"]: r for r in classify_in_pieces(rows, ["key"], model, settings).collect()}
    assert len(got) == 4
    # As in a short text, a value that stands twice is there twice; the overlap shows one Ann to two pieces.
    assert got["long"]["classification"]["names"] == ["Ann", "Bob", "Ann"] and got["long"]["classification"]["emails"] == ["x"]
    assert got["short"]["classification"]["names"] == ["Ann", "Ann"] and got["short"]["classification"]["emails"] == ["x", "x"]
    assert got["bad"]["classification"] is None and got["bad"]["error"] == "ValueError"


@pytest.mark.parametrize("length", [0, 1, 99, 100, 101, 190, 191, 1000])
def test_pieces_cover_the_text(spark, length):
    text = "".join(chr(97 + i % 26) for i in range(length))
    row = spark.createDataFrame([(text,)], "x string").select(text_pieces(F.col("x"), 100, 10).alias("p")).first()
    whole = row["p"][0] + "".join(p[10:] for p in row["p"][1:])
    assert whole == text and all(len(p) <= 100 for p in row["p"]) and (len(row["p"]) == 1) == (length <= 100)


def test_matches_behind_the_old_limit(spark):
    rows = spark.createDataFrame([("x " * 100_000 + "SSN: 123-45-6789",)], "text string")
    assert classify_rules(rows, SETTINGS).first()["classification"]["ssns"] == ["123-45-6789"]


def test_retries_wait_twice_as_long(monkeypatch):
    waits, calls = [], []
    monkeypatch.setattr("time.sleep", waits.append)

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise TransientError
        return "done"

    assert with_retries(flaky, 3, 500)() == "done"
    assert waits == [0.5, 1.0]


def test_extractor(spark):
    def extractor(content):
        if content == b"bad":
            raise OSError("unreadable")
        return [{"BlockType": "LINE", "Text": content.decode()}, {"BlockType": "PAGE", "Text": None}]

    objects = spark.createDataFrame([("k1", b"hello"), ("k2", b"bad")], "source_key string, content binary")
    rows = {r["source_key"]: r for r in extract_with(objects, extractor, SETTINGS).collect()}
    assert rows["k1"]["blocks"][0]["Text"] == "hello" and rows["k1"]["error"] is None
    assert rows["k2"]["blocks"] is None and rows["k2"]["error_type"] == "ExtractionError"


def rule_lists(text):
    """The same rules in plain Python."""
    plain = re.sub(rules.SECRET, "", text)
    found = {
        "names": re.findall(rules.NAME, plain),
        "emails": re.findall(rules.EMAIL, plain),
        "phones": re.findall(rules.PHONE, plain),
        "ssns": re.findall(rules.SSN, plain),
        "addresses": re.findall(rules.ADDRESS, plain),
        "dates_of_birth": re.findall(rules.BIRTH_DATE, plain),
    }
    other = [("CARD", v) for v in re.findall(rules.CARD, plain)]
    other += [("IP", v) for v in re.findall(rules.IP, plain)]
    other += [("SECRET", v) for v in re.findall(rules.SECRET, text)]
    return found, other


def test_rules_equal_plain_search(spark):
    rng = random.Random(7)
    parts = [
        "Name: Jane Smith. ", "SSN: 123-45-6789 ", "a@b.co", ".uk_", "x@", "@y.org", "+1 (555) 123-4567",
        "+1-555-555-5555", "12 Main Street", "9 Elm Ave ", "7 Oak Rd", "01/15/1980", "1999-12-31", "4111111111111111",
        "10.0.0.1", 'token = "abc0123456789012345678"', 'token = "', "99999999999", "-", " ", "é", "\n", "St", "name: A",
    ]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(400)]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    for row in classify_rules(rows, SETTINGS).collect():
        found, other = rule_lists(texts[row["i"]])
        got = row["classification"]
        assert {c: got[c] for c in LIST_CATEGORIES} == found, texts[row["i"]]
        assert [tuple(i) for i in got["other_pii"]] == other, texts[row["i"]]


def test_long_runs_stay_linear(spark):
    texts = [("a" * 170_000 + "@",), ("1" * 170_000 + " St",)]
    rows = spark.createDataFrame(texts, "text string")
    found = [r["classification"] for r in classify_rules(rows, SETTINGS).collect()]
    assert all(c["emails"] == [] and c["addresses"] == [] for c in found)
