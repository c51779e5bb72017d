"""Fixity audit of archived web records with Merkle trees over ordered offset ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docvault.llm.frames import NO_ID, pick, stored

#: Bytes of an archive file that one leaf range covers, by where its records start.
RANGE_BYTES = 65_536
#: Children of an inner node.
FANOUT = 16
#: Page numbers that share an archive file.
PAGES_PER_ARCHIVE = 1000


def record_text(page_id: Column, url: Column, html: Column) -> Column:
    """A WARC resource record: header, empty line, payload, two empty lines."""
    body = F.coalesce(html, F.lit(""))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(page_id.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "),
        F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
        body,
        F.lit("\r\n\r\n"),
    )


def archive_records(pages: DataFrame) -> DataFrame:
    """`archive, offset, length, record_id, hash` of the records of page archives.

    An archive holds PAGES_PER_ARCHIVE page numbers in order; pages without a number are one
    archive (NO_ID). Null urls and pages are empty. Repeated rows are records one after the
    other. The content is hashed where it is read; names, lengths and hashes are exchanged.
    """
    rows = pick(pages, "page_id", "url", "html")
    record = record_text(F.col("page_id"), F.col("url"), F.col("html"))
    hashed = rows.select(
        F.coalesce(F.floor(F.col("page_id") / PAGES_PER_ARCHIVE).cast("bigint"), F.lit(NO_ID)).alias("archive"),
        F.col("page_id").alias("record_id"),
        F.octet_length(record).cast("bigint").alias("length"),
        F.sha2(record, 256).alias("hash"),
    )
    order = Window.partitionBy("archive").orderBy(F.coalesce("record_id", F.lit(NO_ID)), "hash")
    end = F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return hashed.select("archive", (end - F.col("length")).alias("offset"), "length", "record_id", "hash")


def joined_hash(*columns: str) -> Column:
    """The hash of the group's children in order."""
    children = F.sort_array(F.collect_list(F.struct(*columns)))
    return F.sha2(F.array_join(F.transform(children, lambda c: F.concat_ws(":", *[c[n].cast("string") for n in columns])), ","), 256)


def merkle_tree(records: DataFrame) -> DataFrame:
    """`archive, level, node, hash, n_records, first, last` of the trees over stored records.

    Level 0 are the ranges of RANGE_BYTES, each the hash of its records with their offsets and
    lengths; above, FANOUT nodes make one, up to a single root for each archive. `first` and
    `last` are the bytes that a node covers. A group has at most the records that start in a
    range, or FANOUT nodes.
    """
    level = records.groupBy("archive", F.floor(F.col("offset") / RANGE_BYTES).cast("bigint").alias("node")).agg(
        joined_hash("offset", "length", "hash").alias("hash"),
        F.count("hash").alias("n_records"),
        F.min("offset").alias("first"),
        F.max(F.col("offset") + F.col("length")).alias("last"),
    )
    columns = ["archive", "level", "node", "hash", "n_records", "first", "last"]
    number, tree = 0, stored(level.withColumn("level", F.lit(0)).select(columns), "merkle")
    level = tree
    while not level.where("node > 0").isEmpty():
        number += 1
        above = level.groupBy("archive", F.floor(F.col("node") / FANOUT).cast("bigint").alias("node")).agg(
            joined_hash("node", "hash").alias("hash"),
            F.sum("n_records").alias("n_records"),
            F.min("first").alias("first"),
            F.max("last").alias("last"),
        )
        level = stored(above.withColumn("level", F.lit(number)).select(columns), "merkle")
        tree = tree.unionAll(level)
    return tree


def height(tree: DataFrame) -> int:
    return tree.agg(F.coalesce(F.max("level"), F.lit(0))).first()[0]


def mismatching_ranges(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """`archive, node` of the leaf ranges that differ between two trees.

    Compares the roots, then level by level only the children of nodes that differ. Trees of
    different height (archives of very different length) are compared from the lower one's top.
    """
    bad = None
    for level in range(min(height(ours), height(theirs)), -1, -1):
        sides = []
        for tree, name in ((ours, "a"), (theirs, "b")):
            nodes = tree.where(F.col("level") == level).select("archive", "node", F.col("hash").alias(name))
            if bad is not None:
                nodes = nodes.withColumn("above", F.floor(F.col("node") / FANOUT).cast("bigint"))
                nodes = nodes.join(bad, ["archive", "above"], "left_semi").drop("above")
            sides.append(nodes)
        differing = sides[0].join(sides[1], ["archive", "node"], "full").where(~F.col("a").eqNullSafe(F.col("b")))
        differing = stored(differing.select("archive", "node"), "differing")
        bad = differing.withColumnRenamed("node", "above")
    return differing


def audit(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """Records that differ between two replicas of the same archives, found through their trees.

    Both need the columns of `archive_records`; they are read several times, so pass stored
    tables. Only ranges whose hash differs, in nodes that differ up to the root, are opened. There, records
    are told apart by archive, record_id and their turn among records of the same id.

    Returns `archive, record_id, status, our_offset, their_offset, our_length, their_length,
    our_hash, their_hash`; status is `changed` (other content), `moved` (same content, other
    offset), `lost` (not in theirs) or `added`. A lost record moves all that follow in its
    archive. Equal replicas, and empty ones, give no rows.
    """
    ranges = mismatching_ranges(merkle_tree(ours), merkle_tree(theirs))
    turn = Window.partitionBy("archive", "record_id").orderBy("offset")
    sides = []
    for records, whose in ((ours, "our"), (theirs, "their")):
        numbered = records.withColumn("turn", F.row_number().over(turn))
        opened = numbered.withColumn("node", F.floor(F.col("offset") / RANGE_BYTES).cast("bigint"))
        opened = opened.join(ranges, ["archive", "node"], "left_semi")
        values = [F.col(c).alias(f"{whose}_{c}") for c in ("offset", "length", "hash")]
        sides.append(opened.select("archive", F.coalesce("record_id", F.lit(NO_ID)).alias("record_id"), "turn", *values))
    both = sides[0].join(sides[1], ["archive", "record_id", "turn"], "full")
    status = (
        F.when(F.col("their_hash").isNull(), "lost")
        .when(F.col("our_hash").isNull(), "added")
        .when(F.col("our_hash") != F.col("their_hash"), "changed")
        .when(F.col("our_offset") != F.col("their_offset"), "moved")
    )
    return both.withColumn("status", status).where("status IS NOT NULL").select(
        "archive",
        F.nullif("record_id", F.lit(NO_ID)).alias("record_id"),
        "status",
        *[f"{w}_{c}" for c in ("offset", "length", "hash") for w in ("our", "their")],
    )


def replica_audit(pages: DataFrame, replica: DataFrame) -> DataFrame:
    """Audit the archives of two tables of pages (page_id, url, html); see `audit`."""
    return audit(stored(archive_records(pages), "records"), stored(archive_records(replica), "records"))
