"""Shards along a Hilbert curve through quantised metadata."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docvault.llm.frames import NO_ID, partitions, pick, stored, with_position

#: Bits of the order within one cell of the curve: first by text, then by row.
TEXT_BITS, ROW_BITS = 20, 20
#: Bits that remain for the curve index in a positive bigint.
CURVE_BITS = 63 - TEXT_BITS - ROW_BITS
#: Columns that the operator adds.
ADDED = ("curve", "size", "text_crc32", "shard", "slot")


def hilbert_index(points: Sequence[np.ndarray], bits: int) -> np.ndarray:
    """Places of points with coordinates below 2**bits on the Hilbert curve.

    Transposes the axes bit by bit, from the top: where a coordinate's bit is set, the lower
    bits of the first coordinate are inverted, else exchanged with the coordinate's; then the
    Gray code is undone and the bits are interleaved.
    """
    x = [np.asarray(p, np.int64).copy() for p in points]
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for axis in x:
            bit = (axis >> level) & 1
            swap = np.where(bit == 0, (x[0] ^ axis) & low, 0)
            x[0] ^= np.where(bit == 1, low, swap)
            if axis is not x[0]:
                axis ^= swap
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] >> level) & 1 == 1, (1 << level) - 1, 0)
    index = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for axis in x:
            index = (index << 1) | (((axis ^ flip) >> level) & 1)
    return index


def ordered_value(column: Column, kind: T.DataType) -> Column:
    """A value that keeps the column's order: numbers as they are, all else as text; a null text is empty."""
    if isinstance(kind, T.NumericType):
        return column.cast("double")
    return F.coalesce(column.cast("string"), F.lit(""))


def text_quantiles(rows: DataFrame, column: str, bits: int) -> list[str]:
    """The 2**bits - 1 quantiles of a text column over all rows, by whole values.

    The distinct values are counted, dealt into runs of their order and the counts cumulated in
    each run; only the quantiles and a number for each run reach the driver.
    """
    runs = partitions(rows.sparkSession)
    counts = rows.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    counts = counts.repartitionByRange(runs, "value").withColumn("run", F.spark_partition_id())
    counts = stored(counts, "value-counts")
    sizes = {r["run"]: r["n"] for r in counts.groupBy("run").agg(F.sum("n").alias("n")).collect()}
    starts = [0]
    for run in range(max(sizes, default=-1) + 1):
        starts.append(starts[-1] + sizes.get(run, 0))
    total = starts[-1]
    if not total:
        return []
    first = F.element_at(F.array(*[F.lit(n).cast("bigint") for n in starts]), F.col("run") + 1)
    cumulated = counts.withColumn("to", first + F.sum("n").over(Window.partitionBy("run").orderBy("value")))
    # Quantile i is the value of the row at i * total / 2**bits.
    upto = lambda n: F.floor(n / F.lit(total) * F.lit(2**bits))
    times = (F.least(upto(F.col("to")), F.lit(2**bits - 1)) - upto(F.col("to") - F.col("n"))).alias("times")
    found = cumulated.select("value", times).where("times > 0").collect()
    return [r["value"] for r in found for _ in range(r["times"])]


def hilbert_shards(
    docs: DataFrame,
    dimensions: Sequence[str] = ("lang", "source", "n_chars"),
    shards: int = 40,
    bits: int = 7,
    carry: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """Cut the documents, ordered along a Hilbert curve, into runs with row counts at most one apart.

    Each dimension is quantised at up to 2**bits - 1 quantiles over all rows (approximate ones
    of numbers, exact ones of whole texts), so that cells have like numbers of rows; null goes
    to the lowest level. Neighbours on the curve are neighbours in every dimension, which makes
    each shard's range of every dimension narrow. Within a cell equal texts stand together, and
    after them the row's hash decides, so a cell with very many rows is numbered by many tasks.

    Returns the columns `carry` of `docs` plus `curve` (index on the curve), `size` (UTF-8
    bytes and 16), `text_crc32`, `shard`, `slot` (gapless from 0 in a shard); carried columns
    of these names are replaced. `docs` needs `doc_id`, `text` and the dimensions. A null text
    has no bytes. Fewer rows than shards leave shards empty. Ties are broken by doc_id and
    text; repeated rows get a slot each. No rows give no rows. `bits` times the number of
    dimensions is at most CURVE_BITS.
    """
    if len(dimensions) * bits > CURVE_BITS:
        raise ValueError(f"dimensions times bits must be at most {CURVE_BITS}")
    kinds = {f.name: f.dataType for f in docs.schema.fields}
    carried = [n for n in carry if n not in ADDED]
    axes = [f"d{i}" for i in range(len(dimensions))]
    wanted = list(dict.fromkeys(["doc_id", "text", *dimensions, *carried]))
    rows = pick(docs, *wanted).select(
        F.struct(*carried).alias("row"),
        F.coalesce("doc_id", F.lit(NO_ID)).alias("id"),
        F.coalesce("text", F.lit("")).alias("body"),
        *[ordered_value(F.col(d), kinds[d]).alias(a) for a, d in zip(axes, dimensions, strict=True)],
    )
    share = 2.0**-bits
    numbers = [a for a, d in zip(axes, dimensions, strict=True) if isinstance(kinds[d], T.NumericType)]
    quantiles = rows.approxQuantile(numbers, [i * share for i in range(1, 2**bits)], share / 4) if numbers else []
    cuts = dict(zip(numbers, quantiles, strict=True))
    cuts |= {a: text_quantiles(rows, a, bits) for a in axes if a not in cuts}

    @F.pandas_udf("bigint")
    def curve(cells: pd.DataFrame) -> pd.Series:
        return pd.Series(hilbert_index([cells[c].to_numpy() for c in cells.columns], bits))

    cells = F.struct(*[level(F.col(a), cuts[a], "double" if a in numbers else "string").alias(a) for a in axes])
    placed = rows.select(
        "row",
        "id",
        curve(cells).alias("curve"),
        (F.octet_length("body") + F.lit(16)).cast("bigint").alias("size"),
        F.crc32(F.encode("body", "UTF-8")).alias("text_crc32"),
        F.xxhash64("body").alias("text_hash"),
        F.xxhash64("id", "body").alias("row_hash"),
    )
    place = (
        F.shiftleft("curve", TEXT_BITS + ROW_BITS)
        + F.shiftleft(F.shiftrightunsigned("text_hash", 64 - TEXT_BITS), ROW_BITS)
        + F.shiftrightunsigned("row_hash", 64 - ROW_BITS)
    )
    placed = stored(placed.withColumn("place", place), "shard-places")
    total = placed.count()
    ordered = with_position(placed, "place", [F.col("id"), F.col("text_hash")])
    shard = f"(position * {shards} div {max(total, 1)})"
    return ordered.select(
        *[F.col(f"row.{n}").alias(n) for n in carried],
        "curve",
        "size",
        "text_crc32",
        F.expr(shard).cast("int").alias("shard"),
        # Shard s starts at the first position with position * shards >= s * total.
        (F.col("position") - F.expr(f"({shard} * {total} + {shards - 1}) div {shards}")).alias("slot"),
    )


def level(value: Column, points: Sequence[float] | Sequence[str], kind: str) -> Column:
    """How many of the quantiles lie below the value; null lies below all.

    A value with many rows spans several quantiles, so levels are as far apart as rows are many.
    """
    found = F.array(*[F.lit(p) for p in points]).cast(f"array<{kind}>")
    return F.coalesce(F.size(F.filter(found, lambda p: p < value)), F.lit(0))


def write_shards(docs: DataFrame, path: str, **options) -> DataFrame:
    """Write whole documents as Parquet files, one folder per shard, in slot order; returns the manifest.

    The manifest has for each shard its rows, bytes and the least and greatest value of every
    dimension, by which a reader skips shards.
    """
    dimensions = options.get("dimensions", ("lang", "source", "n_chars"))
    placed = hilbert_shards(docs, carry=docs.columns, **options)
    placed.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    ranges = [f(d).alias(f"{n}_{d}") for d in dimensions for n, f in (("min", F.min), ("max", F.max))]
    written = docs.sparkSession.read.parquet(path)
    return written.groupBy("shard").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("size").alias("n_bytes"), *ranges)
