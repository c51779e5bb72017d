"""Exact Jaccard join of documents on word shingles, with prefix filters under several token orders."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docvault.llm.components import components
from docvault.llm.frames import pick, stored, tasks_for
from docvault.llm.words import column_bytes, hashed, mixed, shingles, words

#: Two documents link when 100 * common shingles >= PERCENT * all shingles of both.
PERCENT = 75
#: Words of a shingle.
WORDS = 5
#: Counters of the frequency sketch, and of one row of it.
CELLS, CHUNK = 1 << 18, 1 << 13
#: A counter this many times the mean (and this much above it) marks frequent tokens.
FREQUENT, MARGIN = 1.5, 30
#: Salts of the further token orders.
ORDERS = (2, 3)
#: Cells of the table of shared tokens, for each of them; and at most.
TOKEN_CELLS, MOST_TOKEN_CELLS = 16, 1 << 25
#: Cells of the table that travel in one row.
TABLE_CHUNK = 1 << 16
#: Bits of the filter for the texts that are read again, for each of them; and at most.
FILTER_BITS, MOST_FILTER_BITS = 16, 1 << 27
#: Parts that a frequent token's rows are dealt into.
SALTS = 64
#: Tokens of more sets than this are compared in blocks of about so many sets.
FEW, BLOCK = 32, 256
#: Tokens whose common counts a block makes at once.
COLUMNS = 4096
#: Sets whose tokens one task remembers to have sent.
REMEMBERED = 100_000
#: Pairs that one task compares, where there are many.
TASK_PAIRS = 2_000


def token_set(text: bytes | None) -> np.ndarray:
    """The distinct shingles of a text, sorted, as 64-bit hashes."""
    return np.unique(shingles(hashed(words(text)), WORDS))


def set_id(tokens: np.ndarray) -> int:
    """A signed 64-bit name of a set; with its size it stands for the set."""
    return xxhash.xxh3_64_intdigest(tokens.tobytes()) - 2**63


def prefix_size(n: int) -> int:
    """Two sets that link share a token among the first so many of each, under any one order."""
    return n - (PERCENT * n + 99) // 100 + 1


def levels(sketch: np.ndarray) -> np.ndarray:
    """0 for usual counters, then the doublings above the mean."""
    mean = max(sketch.mean(), 1.0)
    over = (sketch > FREQUENT * mean) & (sketch > mean + MARGIN)
    return np.where(over, 1 + np.log2(np.maximum(sketch / mean, 1)).astype(np.int64), 0).astype(np.uint64)


def ordered_prefix(tokens: np.ndarray, level: np.ndarray, table: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The prefix under the first order, rare tokens first, and each token's level in the sketch.

    Tokens that the sketch does not tell apart are ordered by the table of shared tokens, if there
    is one. Frequent ones keep a hash order, so that near copies of a large group agree in it.
    """
    own = level[(tokens >> np.uint64(46)).astype(np.int64)]
    key = (own << np.uint64(58)) | (mixed(tokens) >> np.uint64(11))
    if table is not None:
        shared = table[(tokens & np.uint64(len(table) - 1)).astype(np.int64)].astype(np.uint64)
        key |= np.where(own == 0, shared, np.uint64(0)) << np.uint64(53)
    order = np.argsort(key, kind="stable")[: prefix_size(len(tokens))]
    return tokens[order], own[order]


def further_prefix(tokens: np.ndarray, salt: int) -> np.ndarray:
    """The prefix under a hash order, by the keys of that order."""
    keys = mixed(tokens, salt)
    n = prefix_size(len(tokens))
    return np.partition(keys, n - 1)[:n] if n < len(keys) else keys


def surveyed(docs: DataFrame) -> DataFrame:
    """One pass over the texts: a row for each document, and each task's part of the frequency sketch.

    Document rows have `doc_id, n, sid` (no sid for an empty set), sketch rows `chunk, counts`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(CELLS, np.uint32)
        for batch in batches:
            sets = [token_set(t) for t in column_bytes(batch, "text")]
            if sets:
                np.add.at(sketch, (np.concatenate(sets) >> np.uint64(46)).astype(np.int64), 1)
            sizes = [len(s) for s in sets]
            sids = [set_id(s) if len(s) else None for s in sets]
            nulls = pa.nulls(len(sets))
            yield batch_of(batch.column("doc_id"), sizes, sids, nulls.cast(pa.int32()), nulls.cast(pa.binary()))
        chunks = range(CELLS // CHUNK)
        parts = [sketch[c * CHUNK : (c + 1) * CHUNK].astype("<u4").tobytes() for c in chunks]
        nulls = [None] * len(parts)
        yield batch_of(nulls, nulls, nulls, list(chunks), parts)

    def batch_of(ids, sizes, sids, chunks, counts) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
        arrays = [c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip((ids, sizes, sids, chunks, counts), kinds, strict=True)]
        return pa.record_batch(arrays, names=["doc_id", "n", "sid", "chunk", "counts"])

    return docs.mapInArrow(run, "doc_id bigint, n bigint, sid bigint, chunk int, counts binary")


def summed_sketch(survey: DataFrame) -> np.ndarray:
    """The tasks' sketches added up, chunk by chunk; CELLS numbers reach the driver."""

    def add(kind: str):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, np.ndarray] = {}
            for batch in batches:
                columns = batch.column("chunk").to_pylist(), batch.column("counts").to_pylist()
                for chunk, counts in zip(*columns, strict=True):
                    own = np.frombuffer(counts, kind).astype("<u8")
                    sums[chunk] = sums[chunk] + own if chunk in sums else own
            arrays = [pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())]
            yield pa.record_batch(arrays, names=["chunk", "counts"])

        return run

    parts = survey.where("chunk IS NOT NULL").select("chunk", "counts")
    schema = "chunk int, counts binary"
    # Added up where they were made, then once more by chunk.
    rows = parts.mapInArrow(add("<u4"), schema).repartition("chunk").mapInArrow(add("<u8"), schema).collect()
    sketch = np.zeros(CELLS, np.uint64)
    for chunk, counts in rows:
        sketch[chunk * CHUNK : (chunk + 1) * CHUNK] = np.frombuffer(counts, "<u8")
    return sketch


def new_sets(batch: pa.RecordBatch, sent: set[int]) -> Iterator[tuple[int, np.ndarray]]:
    """Name and tokens of a batch's sets that are not empty and that the task remembers not to have sent."""
    for text in column_bytes(batch, "text"):
        own = token_set(text)
        if not len(own) or (sid := set_id(own)) in sent:
            continue
        if len(sent) >= REMEMBERED:
            sent.clear()
        sent.add(sid)
        yield sid, own


def token_table(docs: DataFrame, level: np.ndarray) -> np.ndarray:
    """A byte for each cell of tokens: 0, or the doublings of the most sets that share one of its tokens.

    Counts the tokens of all prefixes under the sketch's order. The table grows with the tokens
    that several sets share, up to a fixed size; beyond it the tokens of fewest sets are left
    out, until the rest fill a quarter of the cells at most. The table only orders tokens, the
    same way for all sets, so what it holds saves work and changes no result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        for batch in batches:
            found = [(sid, ordered_prefix(own, level)[0]) for sid, own in new_sets(batch, sent)]
            if found:
                tokens = np.concatenate([p for _, p in found]).view(np.int64)
                marks = np.repeat(np.array([sid for sid, _ in found], np.int64).astype(np.int16), [len(p) for _, p in found])
                yield pa.record_batch([pa.array(tokens), pa.array(marks)], names=["token", "mark"])

    # Copies of one set have one mark, so they do not make a token shared.
    counted = docs.mapInArrow(run, "token bigint, mark smallint").groupBy("token")
    counted = counted.agg(F.count("mark").alias("k"), F.min("mark").alias("low"), F.max("mark").alias("high"))
    shared = stored(counted.where("low < high").select("token", F.floor(F.log2("k")).cast("tinyint").alias("level")), "token-levels")
    held = {row["level"]: row["count"] for row in shared.groupBy("level").count().collect()}  # 64 rows at most
    least = 1
    while (n := sum(k for at, k in held.items() if at >= least)) * 4 > MOST_TOKEN_CELLS:
        least += 1
    cells = 1 << min(MOST_TOKEN_CELLS.bit_length() - 1, max(TABLE_CHUNK.bit_length() - 1, (TOKEN_CELLS * n).bit_length()))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks: dict[int, np.ndarray] = {}
        for batch in batches:
            cell, most = (batch.column(c).to_numpy() for c in ("cell", "level"))
            for chunk in np.unique(cell // TABLE_CHUNK).tolist():
                own = chunks.setdefault(chunk, np.zeros(TABLE_CHUNK, np.uint8))
                here = cell // TABLE_CHUNK == chunk
                np.maximum.at(own, cell[here] % TABLE_CHUNK, most[here].astype(np.uint8))
        arrays = [pa.array(list(chunks), pa.int64()), pa.array([c.tobytes() for c in chunks.values()], pa.binary())]
        yield pa.record_batch(arrays, names=["chunk", "levels"])

    placed = shared.where(F.col("level") >= least).select(F.col("token").bitwiseAND(cells - 1).alias("cell"), "level")
    filled = placed.repartition(F.expr(f"cell div {TABLE_CHUNK}")).mapInArrow(fill, "chunk bigint, levels binary")
    table = np.zeros(cells, np.uint8)
    for chunk, levels_held in filled.collect():  # MOST_TOKEN_CELLS bytes at most
        table[chunk * TABLE_CHUNK : (chunk + 1) * TABLE_CHUNK] = np.frombuffer(levels_held, np.uint8)
    return table


def prefix_tokens(docs: DataFrame, level: np.ndarray, table: np.ndarray) -> DataFrame:
    """`token, sid, spot, hot` for the prefix of each set; a task sends a repeated set once.

    `spot` is the place in the prefix; hot tokens are frequent by the sketch.
    """
    shared = docs.sparkSession.sparkContext.broadcast(table)  # MOST_TOKEN_CELLS at most, 32 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        for batch in batches:
            tokens, sids, spots, hot = [], [], [], []
            for sid, own in new_sets(batch, sent):
                prefix, own_level = ordered_prefix(own, level, shared.value)
                tokens.append(prefix.view(np.int64))
                sids.append(np.full(len(prefix), sid, np.int64))
                spots.append(np.arange(len(prefix), dtype=np.int32))
                hot.append(own_level > 0)
            if tokens:
                arrays = [pa.array(np.concatenate(x)) for x in (tokens, sids, spots, hot)]
                yield pa.record_batch(arrays, names=["token", "sid", "spot", "hot"])

    return docs.mapInArrow(run, "token bigint, sid bigint, spot int, hot boolean")


def shared_tokens(prefixes: DataFrame) -> DataFrame:
    """`token, sid, spot, pivot` of the tokens that several sets have in their prefix.

    Usual tokens are few rows each, as the sketch bounds their share of all rows, and are
    gathered by token; their pivot is the least set. Frequent ones are dealt out by token and
    set; their pivot, the set in which they stand first, is found by an aggregation with partial
    results and joined back, which Spark splits.
    """
    salt = F.when(F.col("hot"), F.pmod(F.hash("sid"), F.lit(SALTS))).otherwise(F.lit(0))
    group = Window.partitionBy("token", "salt")
    seen = (
        prefixes.withColumn("salt", salt)
        .withColumns({"low": F.min("sid").over(group), "high": F.max("sid").over(group)})
        .where("low < high OR hot")
    )
    seen = stored(seen.select("token", "sid", "spot", "hot", "low"), "prefix-tokens")
    usual = seen.where("NOT hot").select("token", "sid", "spot", F.col("low").alias("pivot"))
    frequent = seen.where("hot").groupBy("token", "sid").agg(F.min("spot").alias("spot"))
    place = F.shiftleft(F.col("spot").cast("bigint"), 40) + F.shiftrightunsigned("sid", 24)
    pivots = (
        frequent.groupBy("token")
        .agg(F.min_by("sid", place).alias("pivot"), F.min("sid").alias("low"), F.max("sid").alias("high"))
        .where("low < high")
        .select("token", "pivot")
    )
    return usual.unionAll(frequent.join(pivots, "token"))


def wanted_filter(ids: DataFrame) -> tuple[np.ndarray, int]:
    """A bit for the hash of each doc_id; the bits grow with the ids up to a fixed size.

    Texts whose bit is set are read again. Some others pass, the more so beyond the fixed
    size; they cost time and change nothing.
    """
    n = ids.count()
    bits = 1 << min(MOST_FILTER_BITS.bit_length() - 1, max(10, (FILTER_BITS * n).bit_length()))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(bits))
    parts = ids.select(F.shiftrightunsigned(place, 6).alias("word"), F.expr("1L").alias("one"), (place % 64).cast("int").alias("bit"))
    found = parts.groupBy("word").agg(F.bit_or(F.expr("shiftleft(one, bit)")).alias("bits"))
    held = np.zeros(bits >> 6, np.int64)
    for batch in found.toLocalIterator(prefetchPartitions=True):
        held[batch["word"]] = batch["bits"]
    return held, bits


def token_sets(docs: DataFrame, ids: DataFrame, marked: bool = False) -> DataFrame:
    """`sid, tokens, marks` of the documents in `ids(sid, doc_id)`; texts are not exchanged.

    Marks, null unless asked for, are the prefixes under the further orders, see `order_marks`.
    """
    held, bits = wanted_filter(ids)
    shared = docs.sparkSession.sparkContext.broadcast(held)  # MOST_FILTER_BITS at most, 16 MB
    place = F.pmod(F.xxhash64("doc_id"), F.lit(bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_held = shared.value.view(np.uint64)
        for batch in batches:
            at = batch.column("place").to_numpy()
            hit = (words_held[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)
            texts = batch.filter(pa.array(hit.astype(bool)))
            sets = [token_set(t) for t in column_bytes(texts, "text")]
            arrays = [
                texts.column("doc_id"),
                pa.array([set_id(s) if len(s) else None for s in sets], pa.int64()),
                pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                pa.array([order_marks(s) if marked and len(s) else None for s in sets], pa.binary()),
            ]
            yield pa.record_batch(arrays, names=["doc_id", "sid", "tokens", "marks"])

    schema = "doc_id bigint, sid bigint, tokens array<bigint>, marks binary"
    found = docs.withColumn("place", place).mapInArrow(run, schema)
    return found.join(ids, ["doc_id", "sid"]).select("sid", "tokens", "marks")


def sizes_allow(a: Column, b: Column) -> Column:
    return (100 * F.least(a, b)) >= PERCENT * F.greatest(a, b)


def enough(common: Column, a: Column, b: Column) -> Column:
    """Whether so many common tokens make sets of these sizes link."""
    return common * (100 + PERCENT) >= PERCENT * (a + b)


def possible(pairs: DataFrame, prefixes: DataFrame) -> DataFrame:
    """Pairs `a, b` that may link by their sizes and by the tokens that both have in their prefix.

    The set whose prefix ends first in the order shares with the other one what both prefixes
    share and at most all of its other tokens. `prefixes` has `sid, n, shared`: the tokens of
    each prefix that any other set has in its own.
    """
    for side in ("a", "b"):
        pairs = pairs.join(prefixes.select(*[F.col(c).alias(f"{side}_{c}" if c != "sid" else side) for c in ("sid", "n", "shared")]), side)
    a, b = F.col("a_n"), F.col("b_n")
    common = F.size(F.array_intersect("a_shared", "b_shared"))
    return pairs.where(sizes_allow(a, b)).where(enough(common + others("a_n", "b_n"), a, b)).select("a", "b")


def others(a: str, b: str) -> Column:
    """The tokens behind the prefix of the larger set."""
    return F.expr(f"({PERCENT} * greatest({a}, {b}) + 99) div 100 - 1")


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets link."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common * (100 + PERCENT) >= PERCENT * (len(a) + len(b))


def order_marks(tokens: np.ndarray) -> bytes:
    """The size of a set, then its prefix under each further order, sorted, by 16 bits of each key."""
    prefixes = [np.sort((further_prefix(tokens, salt) & np.uint64(0xFFFF)).astype("<u2")) for salt in ORDERS]
    return len(tokens).to_bytes(8, "little") + b"".join(p.tobytes() for p in prefixes)


def orders_allow(a: bytes, b: bytes) -> bool:
    """Whether sets with these marks may link by their prefixes under every further order.

    As in `possible`: what both prefixes share and all behind the prefix of the larger set must
    be enough. Prefixes have no more common tokens than common marks.
    """
    n, m = (int.from_bytes(x[:8], "little") for x in (a, b))
    need = (PERCENT * (n + m) + 99 + PERCENT) // (100 + PERCENT) - ((PERCENT * max(n, m) + 99) // 100 - 1)
    for x, y in zip(order_parts(a, n), order_parts(b, m), strict=True):
        (u, i), (v, j) = np.unique(x, return_counts=True), np.unique(y, return_counts=True)
        _, p, q = np.intersect1d(u, v, assume_unique=True, return_indices=True)
        if int(np.minimum(i[p], j[q]).sum()) < need:
            return False
    return True


def order_parts(marks: bytes, n: int) -> list[np.ndarray]:
    held = np.frombuffer(marks, "<u2", offset=8)
    return [held[k * prefix_size(n) : (k + 1) * prefix_size(n)] for k in range(len(ORDERS))]


def both_sides(pairs: DataFrame, sets: DataFrame, column: str) -> DataFrame:
    """Pairs with a column of both sets; it travels once for each pair, to the partner."""
    left, right = (sets.select(F.col("sid").alias(x), F.col(column).alias(f"{x}_{column}")) for x in ("a", "b"))
    return pairs.join(right, "b").join(left, "a")


def verified(pairs: DataFrame, docs: DataFrame, members: DataFrame) -> DataFrame:
    """The pairs `a, b` (a stored table) of sets that link; the sets are made anew from the texts of their members.

    The prefixes under the further orders, an eighth of the size, leave out nearly all pairs that
    do not; whole sets travel only for pairs that every order lets through.
    """
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("sid")).distinct()
    ids = stored(members.join(wanted, "sid").select("sid", "doc_id"), "wanted")
    sets = stored(token_sets(docs, ids, marked=True), "sets")

    def by_orders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = (batch.column(c).to_pylist() for c in ("a_marks", "b_marks"))
            yield batch.select(["a", "b"]).filter(pa.array([orders_allow(x, y) for x, y in zip(*sides, strict=True)], pa.bool_()))

    def by_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch.column(c) for c in ("a_tokens", "b_tokens"))
            sides = [[x.values.to_numpy(zero_copy_only=False).view(np.uint64) for x in c] for c in columns]
            yield batch.select(["a", "b"]).filter(pa.array([linked(x, y) for x, y in zip(*sides, strict=True)], pa.bool_()))

    schema = "a bigint, b bigint"
    # Few pairs are few tasks, as each call of Python has its price.
    several = lambda pairs, column: both_sides(pairs, sets, column).coalesce(tasks_for(docs.sparkSession, pairs.count(), TASK_PAIRS))
    close = stored(several(pairs, "marks").mapInArrow(by_orders, schema), "close-pairs")
    return several(close, "tokens").mapInArrow(by_tokens, schema)


def linked_sets(docs: DataFrame, survey: DataFrame) -> DataFrame:
    """`sid, component` of the sets that link with another one.

    Two steps. First every set is compared with the pivot of each token that it shares, and
    the links make components. Then tokens whose sets are not all in one component are taken
    again, and the sets of different components are compared. So a large group of near copies
    costs one comparison for each member, and no link between components is missed.
    """
    level = levels(summed_sketch(survey))
    table = token_table(docs, level)
    shared = stored(shared_tokens(prefix_tokens(docs, level, table)), "shared-tokens")
    members = survey.where("sid IS NOT NULL").groupBy("sid", "n").agg(F.min("doc_id").alias("doc_id"))
    in_order = F.sort_array(F.collect_set(F.struct("spot", "token")))  # at most the set's own prefix
    by_set = shared.groupBy("sid").agg(F.transform(in_order, lambda x: x["token"]).alias("shared"))
    members = stored(members.join(by_set, "sid"), "members")
    stars = shared.where("sid <> pivot").select(F.col("pivot").alias("a"), F.col("sid").alias("b")).distinct()
    stars = stored(possible(stars, members), "stars")
    edges = stored(verified(stars, docs, members), "star-links")
    found = stored(components(edges), "star-components")
    labelled = (
        shared.select("token", "sid", "spot")
        .join(found.select(F.col("node").alias("sid"), "component"), "sid", "left")
        .withColumn("component", F.coalesce("component", "sid"))
    )
    open_tokens = (
        labelled.groupBy("token")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low < high")
        .select("token")
    )
    rest = labelled.join(open_tokens, "token", "left_semi").distinct()
    place = Window.partitionBy("sid").orderBy(F.col("spot").desc())
    rest = rest.withColumn("c", F.row_number().over(place))  # a set's own prefix at most
    rest = stored(rest.join(members.select("sid", "n"), "sid"), "open-tokens")
    pairs = stored(pairs_across(rest, members).join(tried(stars), ["a", "b"], "left_anti"), "other-pairs")
    if pairs.isEmpty():
        return found.select(F.col("node").alias("sid"), "component")
    merged = components(edges.unionAll(verified(pairs, docs, members)))
    return merged.select(F.col("node").alias("sid"), "component")


def tried(stars: DataFrame) -> DataFrame:
    return stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def pairs_across(rest: DataFrame, members: DataFrame) -> DataFrame:
    """Distinct pairs `a, b` that share a token, lie in different components and may link.

    `rest` has `token, sid, spot, component, n, c` (c: how many of the set's rows there are
    from this token on). Of a pair that links, the first common token stands far enough in front
    in both sets: only tokens behind it can be common, too, and those in both prefixes are rows. Tokens of at most FEW sets are joined with
    themselves. A larger group is cut into blocks of about BLOCK sets, those outside of its
    largest component against all, and a block counts the common tokens of its pairs as a
    product of two matrices; a pair comes out at its first common token only, if it has
    enough of them.
    """
    by_component = rest.groupBy("token", "component").agg(F.count("sid").alias("k"))
    sizes = by_component.groupBy("token").agg(F.sum("k").alias("all"), F.max("k").alias("largest"))
    main = by_component.join(sizes, "token").where("k = largest").groupBy("token").agg(
        F.min("component").alias("main"), F.first("all").alias("all"), F.first("largest").alias("largest")
    )
    main = stored(main, "token-sizes")
    sized = rest.join(main, "token")
    few = sized.where(F.col("all") <= FEW)
    one, two = (
        few.select("token", *[F.col(c).alias(f"{side}_{c}") for c in ("sid", "spot", "component", "n", "c")])
        for side in ("a", "b")
    )
    bound = enough(F.least("a_c", "b_c") + others("a_n", "b_n"), F.col("a_n"), F.col("b_n"))
    close = (F.col("a_sid") < F.col("b_sid")) & (F.col("a_component") != F.col("b_component"))
    behind = F.least(F.col("a_n") - F.col("a_spot"), F.col("b_n") - F.col("b_spot"))
    close = close & sizes_allow(F.col("a_n"), F.col("b_n")) & bound & enough(behind, F.col("a_n"), F.col("b_n"))
    joined = one.join(two, "token").where(close).select(F.col("a_sid").alias("a"), F.col("b_sid").alias("b")).distinct()
    joined = possible(joined, members.select("sid", "n", "shared"))

    many = sized.where(F.col("all") > FEW).join(members.select("sid", "shared"), "sid")
    many = many.withColumn("out", F.col("component") != F.col("main"))
    parts = {"outs": F.col("all") - F.col("largest"), "mains": F.col("largest")}
    many = many.withColumns({n: F.ceil(k / BLOCK).cast("int") for n, k in parts.items()})
    own = F.pmod(F.hash("sid"), F.when(F.col("out"), F.col("outs")).otherwise(F.col("mains")))
    many = many.withColumn("own", own)

    def block(kind: int, i: Column, j: Column, left: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"), left.alias("left"))

    up_to = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    mine = F.col("own")
    against_main = F.transform(up_to("mains"), lambda j: block(0, mine, j, F.lit(True)))
    among = F.transform(up_to("outs"), lambda j: block(1, F.least(mine, j), F.greatest(mine, j), mine <= j))
    places = F.when(F.col("out"), F.concat(against_main, among)).otherwise(
        F.transform(up_to("outs"), lambda i: block(0, i, mine, F.lit(False)))
    )
    dealt = many.select("token", F.inline(places), "sid", "spot", "component", "n", "shared")
    found = dealt.groupBy("token", "kind", "i", "j").applyInPandas(block_pairs, "a bigint, b bigint")
    return joined.unionAll(found).distinct()


def block_pairs(rows: pd.DataFrame) -> pd.DataFrame:
    """The pairs of a block's left and right sets whose first common token is the group's and that may link.

    The shared tokens of a set are in the first order, so what two sets have in common before
    the group's token stands before it in both.
    """
    token = rows["token"].iloc[0]
    lists = rows["shared"].to_list()
    owner = np.repeat(np.arange(len(rows)), [len(t) for t in lists])
    ahead = np.concatenate([np.arange(len(t)) < np.flatnonzero(t == token)[0] for t in lists])
    left = rows["left"].to_numpy()
    same = rows["kind"].iloc[0] == 1 and rows["i"].iloc[0] == rows["j"].iloc[0]
    x = np.arange(len(rows)) if same else np.flatnonzero(left)
    y = x if same else np.flatnonzero(~left)
    counts, earlier = common_counts(owner, np.concatenate(lists), ahead, len(rows), x, y)
    n, sid, component, spot = (rows[c].to_numpy() for c in ("n", "sid", "component", "spot"))
    low, high = np.minimum.outer(n[x], n[y]).astype(np.int64), np.maximum.outer(n[x], n[y]).astype(np.int64)
    may = (100 * low >= PERCENT * high) & not_equal(component[x], component[y]) & not_equal(sid[x], sid[y])
    may &= earlier == 0
    may &= np.minimum.outer((n - spot)[x], (n - spot)[y]) * (100 + PERCENT) >= PERCENT * (low + high)
    may &= (counts + (PERCENT * high + 99) // 100 - 1) * (100 + PERCENT) >= PERCENT * (low + high)
    i, j = np.nonzero(may)
    a, b = sid[x[i]], sid[y[j]]
    return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)}).drop_duplicates()


def common_counts(owner: np.ndarray, tokens: np.ndarray, ahead: np.ndarray, size: int, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many tokens the sets at `x` have in common with those at `y`, and how many that are marked
    `ahead` in the first ones; by products of 0/1 matrices of at most COLUMNS tokens at a time."""
    _, column, held = np.unique(tokens, return_inverse=True, return_counts=True)
    kept = held[column] > 1
    owner, ahead, column = owner[kept], ahead[kept], (np.cumsum(held > 1) - 1)[column[kept]]
    order = np.argsort(column, kind="stable")
    owner, ahead, column = owner[order], ahead[order], column[order]
    counts = np.zeros((2, len(x), len(y)), np.int64)
    total = int(column[-1]) + 1 if len(column) else 0
    for first in range(0, total, COLUMNS):
        part = slice(*np.searchsorted(column, (first, first + COLUMNS)))
        held_by, front = np.zeros((2, size, min(COLUMNS, total - first)), np.float32)
        held_by[owner[part], column[part] - first] = 1
        front[owner[part], column[part] - first] = ahead[part]
        counts[0] += (held_by[x] @ held_by[y].T).astype(np.int64)
        counts[1] += (front[x] @ held_by[y].T).astype(np.int64)
    return counts[0], counts[1]


def not_equal(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a[:, None] != b[None, :]


def jaccard_components(docs: DataFrame) -> DataFrame:
    """`doc_id, n_shingles, component_id` for every row of `docs`.

    A document's set are its distinct WORDS-word shingles (words: runs without ASCII white
    space, A-Z in lower case); a text with fewer words is one shingle. Null texts and texts
    without words have none and link with nothing. Documents link when 100 * common shingles
    >= PERCENT * shingles of both; `component_id` is the least doc_id that links reach. Equal
    sets are one set all the way, so copies cost no comparisons. Rows without a doc_id link with
    nothing and have no component. Repeated rows are copies. No rows give no rows. Shingles
    and sets are told by 64-bit hashes.
    """
    texts = pick(docs, "doc_id", "text")
    named = texts.where("doc_id IS NOT NULL")
    survey = stored(surveyed(texts), "survey")
    linked = stored(linked_sets(named, survey.where("doc_id IS NOT NULL OR chunk IS NOT NULL")), "linked-sets")
    rows = survey.where("chunk IS NULL").select("doc_id", "n", "sid")
    labelled = rows.join(linked, "sid", "left").withColumn("component", F.coalesce("component", "sid"))
    least = labelled.where("sid IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    least = stored(least, "least-ids")  # so that Spark can split the join with a large component
    out = labelled.join(least, "component", "left")
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("sid").isNull() | F.col("doc_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents, all columns, that have the least doc_id of their component.

    Of repeated rows one stays. Rows without doc_id all stay, as nothing tells them apart.
    """
    found = jaccard_components(docs).where("doc_id = component_id").select(F.col("doc_id").alias("kept__")).distinct()
    named = docs.where(F.col("doc_id").isNotNull()).join(found, docs["doc_id"] == F.col("kept__"), "left_semi")
    return named.dropDuplicates(["doc_id", "text"]).unionAll(docs.where(F.col("doc_id").isNull()))
