"""Line deduplication across documents with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docvault.llm.frames import NO_ID, boxed, pick, stored, unboxed

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BLANKS = " \t\n\x0b\x0c\r"


def text_lines(text: Column) -> Column:
    """The lines of a text; a null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """The line without ASCII white space at its ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, UPPER.lower())


def text_name(text: Column) -> list[Column]:
    """Two hashes that stand for a text."""
    return [F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2")]


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """Drop lines that many documents share, and put the rest together in their order.

    A line counts by its key (see `line_key`), told by 128 hash bits. Keys of at least
    `min_chars` code points that are in at least `min_docs` documents lose all their lines
    except in the largest doc_id that holds them.

    Returns the columns of `docs` with `text` changed, plus `n_lines` (before dropping) and
    `n_dropped`; input columns of these two names are replaced. A null text stays null, as one
    empty line. Rows with equal doc_id are one document when documents are counted; rows
    without a doc_id are together one document below all others. A document that loses every
    line has an empty text. No rows give no rows.

    Hashes and positions are exchanged by line; texts once, by document. A line that most
    documents hold is counted in part before the exchange, and its join with the one row that
    says who keeps it is split by Spark.
    """
    names = docs.columns
    lines = F.posexplode(F.transform(text_lines(F.col("text")), line_key)).alias("pos", "key")
    found = pick(docs, "doc_id", "text").select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), *text_name(F.col("text")), lines
    )
    hashes = stored(
        found.where(F.length("key") >= min_chars).select(
            "doc", "t1", "t2", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2")
        ),
        "lines",
    )
    # Stored, so that both sides of the join are exchanged for it alone and Spark can split them.
    common = stored(
        hashes.groupBy("h1", "h2", "doc")
        .agg(F.lit(1).alias("one"))
        .groupBy("h1", "h2")
        .agg(F.count("one").alias("n_docs"), F.max("doc").alias("keeper"))
        .where(F.col("n_docs") >= min_docs)
        .select("h1", "h2", "keeper"),
        "common-lines",
    )
    dropped = (
        hashes.join(common, ["h1", "h2"])
        .where(F.col("doc") != F.col("keeper"))
        .groupBy("doc", "t1", "t2")
        .agg(F.collect_set("pos").alias("gone"))
    )
    rows = boxed(docs, "row", "doc_id", "text").select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), *text_name(F.col("text")), "text", "row"
    )
    both = rows.join(dropped, ["doc", "t1", "t2"], "left")
    split = text_lines(F.col("text"))
    stay = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col("gone"))
    kept = F.array_join(F.transform(stay, lambda i: F.get(split, i)), "\n")
    return unboxed(
        both,
        "row",
        names,
        text=F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept),
        n_lines=F.size(split).cast("bigint"),
        n_dropped=F.coalesce(F.size("gone"), F.lit(0)).cast("bigint"),
    )
