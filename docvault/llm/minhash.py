"""Near-duplicate classes by MinHash: banded universal minima, signature and exact checks, star contraction."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docvault.llm.components import components
from docvault.llm.frames import pick, stored, tasks_for
from docvault.llm.jaccard_join import both_sides, set_id, token_set, token_sets
from docvault.llm.words import column_bytes

#: Two documents link when 100 * common shingles >= PERCENT * all shingles of both.
PERCENT = 85
#: Bands of a signature, and minima of a band: two sets that link at the threshold agree in no
#: band with a probability of (1 - 0.85 ** 5) ** 32 < 1e-8.
BANDS, ROWS = 32, 5
MINIMA = BANDS * ROWS
#: The signature check drops a pair that links with less than this probability.
RISK = 1e-9
#: Shingles whose hashes are made at once.
CHUNK = 4096
#: Buckets of more sets are compared in blocks of about so many sets, or shingles.
FEW, BLOCK, BLOCK_TOKENS = 32, 512, 1 << 20
#: Shingles whose common counts are made at once.
COLUMNS = 4096
#: Sets, pairs by their signatures, and pairs by their full sets that one task takes, where there are many.
TASK_SETS, TASK_PAIRS, TASK_FULL = 10_000, 5_000, 2_000


def hash_family(count: int = MINIMA, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Factors (odd) and offsets of the universal hashes x -> a * x + b modulo 2 ** 32."""
    rng = np.random.default_rng(seed)
    a, b = rng.integers(0, 2**32, (2, count), dtype=np.uint32)
    return a | np.uint32(1), b


def set_minima(sets: list[np.ndarray], family: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """One row of minima for each set (no set is empty), by the low 16 bits.

    All sets are one run of hashes, taken CHUNK at a time, so a long text needs no more memory.
    """
    a, b = family
    out = np.full((len(sets), len(a)), 2**32 - 1, np.uint32)
    if not sets:
        return out.astype("<u2")
    codes = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    for low in range(0, len(codes), CHUNK):
        part = codes[low : low + CHUNK, None] * a + b
        first = np.searchsorted(starts, low, "right") - 1
        last = np.searchsorted(starts, low + len(part), "left")
        cuts = np.maximum(starts[first:last] - low, 0)
        np.minimum(out[first:last], np.minimum.reduceat(part, cuts, axis=0), out=out[first:last])
    return out.astype("<u2")


def least_agreement(minima: int = MINIMA, percent: int = PERCENT, risk: float = RISK) -> int:
    """Sets that link agree in fewer minima with a probability of at most `risk`."""
    s, below, k = percent / 100, 0.0, 0
    while (below := below + math.comb(minima, k) * s**k * (1 - s) ** (minima - k)) <= risk:
        k += 1
    return k


def signatures(docs: DataFrame) -> DataFrame:
    """`doc_id, n, sid, minima` of each document; no sid and no minima without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family = hash_family()
        for batch in batches:
            sets = [token_set(t) for t in column_bytes(batch, "text")]
            minima = iter(set_minima([s for s in sets if len(s)], family))
            arrays = [
                batch.column("doc_id"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([set_id(s) if len(s) else None for s in sets], pa.int64()),
                pa.array([next(minima).tobytes() if len(s) else None for s in sets], pa.binary()),
            ]
            yield pa.record_batch(arrays, names=["doc_id", "n", "sid", "minima"])

    return docs.mapInArrow(run, "doc_id bigint, n bigint, sid bigint, minima binary")


def shared_buckets(sets: DataFrame) -> DataFrame:
    """`key, sid, pivot` for the buckets that hold several sets; the pivot is the least.

    Buckets are counted and their pivots found with partial results, so a bucket with very many
    sets is never gathered; Spark splits the join that hands the pivot out.
    """
    width = 2 * ROWS
    keys = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda i: F.xxhash64(i, F.substring("minima", i * width + 1, F.lit(width))),
    )
    buckets = sets.select("sid", F.explode(keys).alias("key"))
    pivots = buckets.groupBy("key").agg(F.min("sid").alias("pivot"), F.max("sid").alias("high"))
    return buckets.join(pivots.where("pivot < high").select("key", "pivot"), "key").select("key", "sid", "pivot")


def sizes_allow(a: Column, b: Column) -> Column:
    return 100 * F.least(a, b) >= PERCENT * F.greatest(a, b)


def minima_of(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(-1, MINIMA)


def agreeing(pairs: DataFrame, sets: DataFrame, tasks: int) -> DataFrame:
    """The pairs `a, b` whose sizes allow a link and whose signatures agree often enough."""
    least = least_agreement()
    left, right = (sets.select(F.col("sid").alias(x), F.col("n").alias(f"{x}_n"), F.col("minima").alias(f"{x}_minima")) for x in "ab")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same = (minima_of(batch.column("a_minima")) == minima_of(batch.column("b_minima"))).sum(axis=1)
            yield batch.select(["a", "b"]).filter(pa.array(same >= least))

    both = pairs.join(right, "b").join(left, "a").where(sizes_allow(F.col("a_n"), F.col("b_n")))
    return both.select("a", "b", "a_minima", "b_minima").coalesce(tasks).mapInArrow(run, "a bigint, b bigint")


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common * (100 + PERCENT) >= PERCENT * (len(a) + len(b))


def full_sets(docs: DataFrame, sets: DataFrame, wanted: DataFrame, tasks: int) -> DataFrame:
    """`sid, tokens` of the wanted sets, stored; made anew from one text of each set."""
    ids = stored(sets.join(wanted.distinct(), "sid").select("sid", "doc_id"), "wanted", tasks)
    return stored(token_sets(docs, ids).select("sid", "tokens"), "full-sets")


def both_of(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("sid"))


def confirmed(pairs: DataFrame, full: DataFrame) -> DataFrame:
    """The pairs `a, b` (a stored table) that link, by their full sets."""
    tasks = tasks_for(pairs.sparkSession, pairs.count(), TASK_FULL)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch.column(c) for c in ("a_tokens", "b_tokens"))
            sides = [[x.values.to_numpy(zero_copy_only=False).view(np.uint64) for x in c] for c in columns]
            yield batch.select(["a", "b"]).filter(pa.array([linked(x, y) for x, y in zip(*sides, strict=True)], pa.bool_()))

    return both_sides(pairs, full, "tokens").coalesce(tasks).mapInArrow(run, "a bigint, b bigint")


def common_counts(tokens: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many tokens the sets at `x` have in common with those at `y`, by products of 0/1
    matrices of at most COLUMNS tokens at a time."""
    owner = np.repeat(np.arange(len(tokens)), [len(t) for t in tokens])
    _, column, held = np.unique(np.concatenate(tokens), return_inverse=True, return_counts=True)
    shared = held[column] > 1
    owner, column = owner[shared], (np.cumsum(held > 1) - 1)[column[shared]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    counts = np.zeros((len(x), len(y)), np.int64)
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        part = slice(*np.searchsorted(column, (low, low + COLUMNS)))
        matrix = np.zeros((len(tokens), COLUMNS), np.float32)
        matrix[owner[part], column[part] - low] = 1
        counts += (matrix[x] @ matrix[y].T).astype(np.int64)
    return counts


def block_links(rows: pd.DataFrame) -> pd.DataFrame:
    """Links between a block's left and right sets that join components, as a forest.

    All pairs are compared on their full sets; of the links found those come out that join
    parts which no link before them has joined, fewer than there are sets.
    """
    n, sid, component, left = (rows[c].to_numpy() for c in ("n", "sid", "component", "left"))
    same = rows["kind"].iloc[0] == 1 and rows["i"].iloc[0] == rows["j"].iloc[0]
    x = np.arange(len(rows)) if same else np.flatnonzero(left)
    y = x if same else np.flatnonzero(~left)
    common = common_counts(rows["tokens"].to_list(), x, y)
    link = common * (100 + PERCENT) >= PERCENT * np.add.outer(n[x], n[y])
    i, j = np.nonzero(link & (component[x][:, None] != component[y][None, :]))
    parent: dict[int, int] = {}

    def root(c: int) -> int:
        while (above := parent.get(c, c)) != c:
            parent[c] = c = parent.get(above, above)
        return c

    found = []
    for p, q in zip(x[i].tolist(), y[j].tolist(), strict=True):
        a, b = root(int(component[p])), root(int(component[q]))
        if a != b:
            parent[a] = b
            found.append((int(sid[p]), int(sid[q])))
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64")


def links_across(
    shared: DataFrame, labels: DataFrame, docs: DataFrame, sets: DataFrame, tried: DataFrame, tasks: int
) -> DataFrame:
    """Links `a, b` between sets of one bucket that lie in different components.

    Buckets of one component are done. Pairs of buckets of at most FEW sets are compared by their
    signatures, then by their full sets, unless they were tried. Of larger buckets the sets
    outside of the largest component are compared with all, in blocks of about BLOCK sets or
    BLOCK_TOKENS shingles, on their full sets; no pairs but only joining links come out.
    """
    labelled = shared.join(labels, "sid", "left").withColumn("component", F.coalesce("component", "sid"))
    labelled = labelled.join(sets.select("sid", "n"), "sid")
    parts = labelled.groupBy("key", "component").agg(F.count("sid").alias("k"), F.sum("n").alias("tokens"))
    sizes = parts.groupBy("key").agg(
        F.sum("k").alias("all"),
        F.sum("tokens").alias("all_tokens"),
        F.max(F.struct("k", "component", "tokens")).alias("main"),
        F.count("k").alias("parts"),
    )
    # A bucket of two sets is its pivot and the other one.
    sizes = sizes.where("parts > 1 AND all > 2").select("key", "all", "all_tokens", "main")
    rest = stored(labelled.select("key", "sid", "n", "component").join(sizes, "key"), "open-buckets", tasks)

    few = rest.where(F.col("all") <= FEW).select("key", "sid", "component")
    one, two = (few.select("key", F.col("sid").alias(x), F.col("component").alias(f"{x}_part")) for x in "ab")
    joined = one.join(two, "key").where("a < b AND a_part <> b_part").select("a", "b").distinct()
    open_tasks = tasks_for(docs.sparkSession, rest.count(), TASK_PAIRS)
    pairs = stored(agreeing(joined.join(tried, ["a", "b"], "left_anti"), sets, open_tasks), "other-pairs")

    many = rest.where(F.col("all") > FEW)
    full = full_sets(docs, sets, both_of(pairs).unionAll(many.select("sid")), tasks)

    def blocks(k: Column, tokens: Column) -> Column:
        return F.ceil(F.greatest(k / BLOCK, tokens / BLOCK_TOKENS)).cast("int")

    many = many.withColumns(
        {
            "out": F.col("component") != F.col("main.component"),
            "outs": blocks(F.col("all") - F.col("main.k"), F.col("all_tokens") - F.col("main.tokens")),
            "mains": blocks(F.col("main.k"), F.col("main.tokens")),
        }
    )
    many = many.withColumn("own", F.pmod(F.hash("sid"), F.when(F.col("out"), F.col("outs")).otherwise(F.col("mains"))))

    def block(kind: int, i: Column, j: Column, left: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"), left.alias("left"))

    def each(count: str, f) -> Column:
        return F.transform(F.sequence(F.lit(0), F.col(count) - 1), f)

    own = F.col("own")
    against_main = each("mains", lambda j: block(0, own, j, F.lit(True)))
    among_outs = each("outs", lambda j: block(1, F.least(own, j), F.greatest(own, j), own <= j))
    from_main = each("outs", lambda i: block(0, i, own, F.lit(False)))
    places = F.when(F.col("out"), F.concat(against_main, among_outs)).otherwise(from_main)
    dealt = many.select("key", F.inline(places), "sid", "component", "n").join(full, "sid")
    found = dealt.groupBy("key", "kind", "i", "j").applyInPandas(block_links, "a bigint, b bigint")
    return confirmed(pairs, full).unionAll(found.coalesce(open_tasks))


def linked_sets(docs: DataFrame, survey: DataFrame) -> DataFrame:
    """`sid, component` of the sets that link with another one.

    First each set is compared with the pivots of its buckets, and the links make components:
    a large group of near copies costs few comparisons a member. Then the sets of a bucket that
    lie in different components are compared.
    """
    sets = survey.where("sid IS NOT NULL").groupBy("sid", "n").agg(F.min("doc_id").alias("doc_id"), F.first("minima").alias("minima"))
    spark = docs.sparkSession
    tasks = tasks_for(spark, survey.count(), TASK_SETS)
    sets = stored(sets, "sets", tasks)
    shared = stored(shared_buckets(sets), "buckets", tasks)
    stars = shared.where("sid <> pivot").select(F.col("pivot").alias("a"), F.col("sid").alias("b")).distinct()
    stars = stored(stars, "stars", tasks)
    close = stored(agreeing(stars, sets, tasks_for(spark, stars.count(), TASK_PAIRS)), "agreeing")
    full = full_sets(docs, sets, both_of(close), tasks)
    edges = stored(confirmed(close, full), "links")
    found = stored(components(edges), "components", tasks).select(F.col("node").alias("sid"), "component")
    more = stored(links_across(shared, found, docs, sets, stars, tasks), "other-links")
    if more.isEmpty():
        return found
    merged = components(edges.unionAll(more))
    return merged.select(F.col("node").alias("sid"), "component")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """`doc_id, n_shingles, component_id, kept` for every row of `docs`.

    A document's set are its distinct five-word shingles (words: runs without ASCII white space,
    A-Z in lower case); a text with fewer words is one shingle. Null texts and texts without
    words have none and link with nothing. Documents link when 100 * common shingles >= PERCENT
    * shingles of both, confirmed on full sets; `component_id` is the least doc_id that links
    reach, and that document is kept. Equal sets are one set all the way, so copies cost no
    comparisons. Rows without a doc_id link with nothing, have no component and are kept.
    Repeated rows are copies. No rows give no rows.

    A pair at the threshold is missed with a probability below 1e-8, pairs above it with less.
    Shingles and sets are told by 64-bit hashes.
    """
    texts = pick(docs, "doc_id", "text")
    survey = stored(signatures(texts), "signatures")
    named = texts.where("doc_id IS NOT NULL")
    links = linked_sets(named, survey.where("doc_id IS NOT NULL"))
    tasks = tasks_for(texts.sparkSession, survey.count(), TASK_SETS)
    links = stored(links, "linked-sets", tasks)
    labelled = survey.select("doc_id", "n", "sid").join(links, "sid", "left").withColumn("component", F.coalesce("component", "sid"))
    least = labelled.where("sid IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("least"))
    least = stored(least, "least-ids", tasks)  # so that Spark can split the join with a large component
    alone = F.col("sid").isNull() | F.col("doc_id").isNull()
    out = labelled.join(least, "component", "left")
    out = out.select("doc_id", F.col("n").alias("n_shingles"), F.when(alone, F.col("doc_id")).otherwise(F.col("least")).alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
