"""Pipeline inputs derived from the analytics tables, every row of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docvault.schemas import LIST_CATEGORIES
from docvault.functions.classification import make_classification, no_items, no_strings

BUCKET = "docs-in"
START_S = 1_704_067_200  # 2024-01-01 00:00:00 UTC
AS_OF = "2024-02-01 00:00:00"
DAMAGE_KINDS = 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrival(number: Column) -> Column:
    """One arrival per second from the start date on."""
    return F.timestamp_seconds(F.lit(START_S) + number)


def object_key(source: Column, doc_id: Column) -> Column:
    return F.concat(F.lit("incoming/"), source, F.lit("/é "), doc_id.cast("string"), F.lit(".txt"))


def encoded_key(source: Column, doc_id: Column) -> Column:
    """The same key as an event notification spells it."""
    return F.concat(
        F.lit("incoming/"), source, F.lit("/%C3%A9+"), doc_id.cast("string"), F.lit(".txt")
    )


def keyed(documents: DataFrame) -> DataFrame:
    """Documents with the bucket, key and arrival time they would have in an object store."""
    return documents.withColumns(
        {
            "source_bucket": F.lit(BUCKET),
            "source_key": object_key(F.col("source"), F.col("doc_id")),
            "received_at": arrival(F.col("doc_id")),
        }
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed(table(spark, sf_dir, "documents"))


def event_body(bucket: Column, key: Column) -> Column:
    record = F.struct(
        F.struct(
            F.struct(bucket.alias("name")).alias("bucket"), F.struct(key.alias("key")).alias("object")
        ).alias("s3")
    )
    return F.to_json(F.struct(F.array(record).alias("Records")))


def direct_body(bucket: Column, key: Column) -> Column:
    return F.to_json(F.struct(bucket.alias("bucket"), key.alias("key")), {"ignoreNullFields": "false"})


def announced(docs: DataFrame, damaged: bool) -> DataFrame:
    """One raw message per document (messageId, body, receivedAt).

    With damaged set, the number of the document decides on one of 32 shapes: 13 kinds of
    broken message, and good ones in both forms.
    """
    number = F.col("doc_id").cast("string")
    bucket, source = F.lit(BUCKET), F.col("source")
    event = event_body(bucket, encoded_key(source, F.col("doc_id")))
    direct = direct_body(bucket, object_key(source, F.col("doc_id")))
    good = F.when(F.col("doc_id") % 2 == 0, event).otherwise(direct)
    message_id = F.concat(F.lit("m"), number)
    if not damaged:
        return docs.select(
            message_id.alias("messageId"), good.alias("body"), arrival(F.col("doc_id")).alias("receivedAt")
        )
    kind = F.pmod(F.col("doc_id"), F.lit(DAMAGE_KINDS))
    shapes = [
        F.lit('{"Records": ['),
        direct_body(F.lit("other-bucket"), object_key(source, F.col("doc_id"))),
        direct_body(bucket, F.concat(F.lit("incoming/../"), number)),
        direct_body(bucket, F.concat(F.lit("uploads/"), number)),
        F.lit("null"),
        F.lit('{"Records": {"s3": 1}}'),
        F.lit('{"unexpected": "format"}'),
        event_body(bucket, F.col("doc_id")),
        F.concat(event, F.lit(" {}")),
        event_body(bucket, F.concat(F.lit("incoming/none/"), number)),
        F.lit('{"Records": [{"s3": {"object": {"key": "incoming/x"}}}]}'),
        direct_body(bucket, F.concat(F.lit("incoming/"), F.repeat(F.lit("a"), F.lit(1016)))),
        direct_body(bucket, F.lit(None).cast("string")),
    ]
    body = F.when(kind == 0, shapes[0])
    for n, shape in enumerate(shapes[1:], start=1):
        body = body.when(kind == n, shape)
    return docs.select(
        F.when(kind != DAMAGE_KINDS - 1, message_id).alias("messageId"),
        body.otherwise(good).alias("body"),
        arrival(F.col("doc_id")).alias("receivedAt"),
    )


def messages(spark: SparkSession, sf_dir: str, damaged: bool = True) -> DataFrame:
    from docvault.sources.notifications import normalize_messages

    raw = announced(table(spark, sf_dir, "documents"), damaged)
    return normalize_messages(raw, AS_OF)


def empty_classification() -> Column:
    return make_classification(
        {c: no_strings() for c in LIST_CATEGORIES}, no_items(), F.lit(False)
    )


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One model answer per customer: plain, fenced, chatty, malformed."""
    key = F.col("c_custkey")
    number = key.cast("string")
    full = F.to_json(
        F.struct(
            F.array("c_name").alias("names"),
            F.array(F.lpad(number, 9, "0")).alias("ssns"),
            F.array(F.struct(F.lit("SEGMENT").alias("type"), F.col("c_mktsegment").alias("value"))).alias(
                "other_pii"
            ),
        )
    )
    mixed = F.concat(
        F.lit('{"emails": ["a@b.example", 5], "other_pii": ["loose", {"value": "'),
        F.col("c_name"),
        F.lit('"}, {"type": null, "value": "x"}], "ssns": [null, "'),
        number,
        F.lit('"]}'),
    )
    answer = (
        F.when(key % 9 == 0, F.concat(F.lit("I cannot process "), F.col("c_name")))
        .when(key % 9 == 1, mixed)
        .when(key % 9 == 2, F.concat(F.lit("```json\n"), full, F.lit("\n```  ")))
        .when(key % 9 == 3, F.concat(F.lit("```\n"), full, F.lit("```")))
        .when(key % 9 == 4, F.lit('{"names": null}'))
        .when(key % 9 == 5, F.lit('{"other_pii": 7}'))
        .when(key % 9 == 6, F.concat(F.lit("["), number, F.lit("]")))
        .when(key % 9 == 7, F.concat(full, F.lit(" That is all.")))
        .otherwise(full)
    )
    return table(spark, sf_dir, "customer").select("c_custkey", answer.alias("response"))


def ssns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One written social security number per order, in several shapes."""
    digits = F.lpad(F.col("o_orderkey").cast("string"), 9, "0")
    hyphenated = F.concat_ws("-", F.substring(digits, 1, 3), F.substring(digits, 4, 2), F.substring(digits, 6, 4))
    raw = (
        F.when(F.col("o_orderkey") % 10 == 0, F.substring(digits, -3, 3))
        .when(F.col("o_orderkey") % 2 == 1, hyphenated)
        .otherwise(digits)
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", raw.alias("raw"))


def event_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON log line per event; errors become ERROR lines, values become durations."""
    ts = F.col("ts").cast("timestamp")
    level = F.when(F.col("event_type") == "error", F.lit("ERROR")).otherwise(F.lit("INFO"))
    line = F.to_json(
        F.struct(
            level.alias("level"),
            F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias("timestamp"),
            F.col("event_type").alias("message"),
            F.col("value").alias("duration_ms"),
            F.col("user_id").alias("user_id"),
        )
    )
    return table(spark, sf_dir, "events").select("event_id", line.alias("line"))
