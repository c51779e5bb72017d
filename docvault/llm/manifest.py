"""Merkle manifest of a dataset as a persistent tree: a changed leaf copies its ancestors and shares the rest."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docvault.llm.frames import numbered, pick, stored

#: Children of a node.
FANOUT = 16
#: Levels above the leaves that a task builds by itself, and the leaves below such a block.
BLOCK_LEVELS = 3
BLOCK = FANOUT**BLOCK_LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: The columns that tell a source: null is not the empty name.
SOURCE = ["named", "name"]


def encoded(value: Column) -> Column:
    """`-` for null, otherwise the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(*values: Column) -> Column:
    return F.sha2(F.concat(*map(encoded, values)), 256)


def digest(*parts: bytes) -> bytes:
    """SHA-256 over parts, in hexadecimal."""
    return hashlib.sha256(b"".join(parts)).hexdigest().encode()


def levels_of(leaves: int, most: int = BLOCK_LEVELS) -> int:
    """Levels above so many leaves until one node is left, at most `most`."""
    levels = 0
    while leaves > 1 and levels < most:
        leaves, levels = -(-leaves // FANOUT), levels + 1
    return levels


def built(leaves: list[bytes], levels: int) -> list[list[bytes]]:
    """The nodes of each level, leaves first; every FANOUT consecutive ones make one above."""
    tree = [leaves]
    for _ in range(levels):
        below = tree[-1]
        tree.append([digest(*below[i : i + FANOUT]) for i in range(0, len(below), FANOUT)])
    return tree


def siblings(tree: list[list[bytes]], place: int) -> Iterator[tuple[bytes, bytes]]:
    """What stands left and right of a leaf's path, level by level; shared by all versions."""
    for nodes in tree[:-1]:
        first = place - place % FANOUT
        yield b"".join(nodes[first:place]), b"".join(nodes[place + 1 : first + FANOUT])
        place //= FANOUT


def version(leaf: bytes, path: list[tuple[bytes, bytes]]) -> list[bytes]:
    """The nodes that a version with this leaf has of its own: the leaf and its copied ancestors."""
    own = [leaf]
    for left, right in path:
        own.append(digest(left, own[-1], right))
    return own


def leaves(docs: DataFrame, changed: Column, text: Column) -> DataFrame:
    """`doc_id, named, name, leaf, other` of each row, as bytes; `other` is the leaf with `text` in
    place of the text where `changed` holds, else null."""
    fields = [F.col(c) for c in FIELDS]
    other = F.when(F.coalesce(changed, F.lit(False)), F.unhex(leaf_hash(*fields[:-1], text)))
    return pick(docs, *FIELDS).select(
        "doc_id",
        F.col("source").isNotNull().alias("named"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("name"),
        F.unhex(leaf_hash(*fields)).alias("leaf"),
        other.alias("other"),
    )


def by_block(rows: DataFrame, columns: list[str], head: str, work, schema: str, names: list[str]) -> DataFrame:
    """Run `work(list of columns)` on the rows of each block, in their order.

    A block (at most BLOCK leaves, and rows before them that `head` puts first) lies in one
    partition; a task holds one block at a time.
    """
    dealt = rows.repartition(*SOURCE, "block").sortWithinPartitions(*SOURCE, "block", F.expr(head), "position")
    key = [*SOURCE, "block"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[list] = [[] for _ in columns]
        now = None

        def done():
            out = work([now[0], now[1], now[2], *kept])
            return pa.record_batch([pa.array(v, t) for v, t in zip(out, types, strict=True)], names=names)

        types = pa_types(schema)
        for batch in batches:
            keys = list(zip(*[batch.column(c).to_pylist() for c in key], strict=True))
            values = [batch.column(c).to_pylist() for c in columns]
            low = 0
            for i, k in enumerate(keys):
                if k != now:
                    if now is not None:
                        for store, v in zip(kept, values, strict=True):
                            store.extend(v[low:i])
                        yield done()
                        kept = [[] for _ in columns]
                    now, low = k, i
            for store, v in zip(kept, values, strict=True):
                store.extend(v[low:])
        if now is not None:
            yield done()

    return dealt.select(*key, *columns).mapInArrow(run, schema)


def pa_types(schema: str) -> list[pa.DataType]:
    known = {"bigint": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "array<string>": pa.list_(pa.string())}
    return [known[field.split()[1]] for field in schema.split(", ")]


def hexes(values: list[bytes | None]) -> list[bytes | None]:
    return [v.hex().encode() if v is not None else None for v in values]


def block_roots(placed: DataFrame) -> DataFrame:
    """`named, name, idx, hash, k`: the top node of each block, and the source's number of blocks."""

    def work(c: list) -> list[list]:
        named, name, block, leaf, total = c
        top = built(hexes(leaf), levels_of(total[0]))[-1][0]
        return [[named], [name], [block], [top.decode()], [-(-total[0] // BLOCK)]]

    schema = "named boolean, name string, idx bigint, hash string, k bigint"
    return by_block(placed, ["leaf", "total"], "position", work, schema, ["named", "name", "idx", "hash", "k"])


def climbed(nodes: DataFrame, groups: list[str]) -> DataFrame:
    """Build the levels above stored nodes `groups, idx, hash, k` until each group has one node.

    Returns `groups, idx, path, top`: the siblings left and right of each node's path, level by
    level, and the root of its group. A node is made from FANOUT children; nodes, not rows
    below them, are exchanged, a FANOUT-th of them on each level.
    """
    size = F.lit(FANOUT)
    level = nodes.select(*groups, "idx", "hash", "k")
    paths = nodes.select(
        *groups, "idx", F.col("idx").alias("at"), F.expr("array()").cast("array<struct<left:string,right:string>>").alias("path"), F.col("hash").alias("top")
    )
    while not (opened := level.where("k > 1")).isEmpty():
        runs = opened.groupBy(*groups, F.floor(F.col("idx") / size).alias("run"), "k").agg(
            F.sort_array(F.collect_list(F.struct("idx", "hash"))).alias("children")
        )
        runs = runs.withColumn("hash", F.sha2(F.array_join(F.col("children.hash"), ""), 256))
        runs = stored(runs, "runs")

        def beside(test) -> Column:
            return F.array_join(F.transform(F.filter("children", test), lambda c: c["hash"]), "")

        both = paths.withColumn("run", F.floor(F.col("at") / size)).join(
            runs.select(*groups, "run", "children", F.col("hash").alias("above")), [*groups, "run"], "left"
        )
        # `at` changes after the step: inside a lambda it would name the new column of a select.
        step = F.struct(beside(lambda c: c["idx"] < F.col("at")).alias("left"), beside(lambda c: c["idx"] > F.col("at")).alias("right"))
        grown = F.when(F.col("above").isNull(), F.col("path")).otherwise(F.concat("path", F.array(step)))
        both = both.withColumns({"path": grown, "top": F.coalesce("above", "top")})
        paths = stored(both.select(*groups, "idx", F.col("run").alias("at"), "path", "top"), "paths")
        level = runs.select(*groups, F.col("run").alias("idx"), "hash", F.ceil(F.col("k") / size).alias("k"))
    return paths.select(*groups, "idx", "path", "top")


def roots_and_paths(blocks: DataFrame) -> DataFrame:
    """`named, name, block, subroot, root, path`: what stands above each block, up to the root."""
    inner = stored(climbed(blocks, SOURCE), "source-paths")
    tops = stored(inner.where("idx = 0").select(F.lit(0).alias("one"), *SOURCE, F.col("top").alias("hash")), "subroots")
    # Null sorts first, names by their bytes.
    ranked = numbered(tops, ["one"], SOURCE, "idx", "k")
    outer = stored(climbed(stored(ranked, "ranked"), ["one"]), "dataset-paths")
    above = ranked.select(*SOURCE, F.col("idx").alias("rank")).join(outer.withColumnRenamed("idx", "rank"), "rank")
    above = stored(above.select(*SOURCE, F.col("path").alias("outer"), F.col("top").alias("root")), "above")
    joined = inner.join(above, SOURCE)
    return joined.select(
        *SOURCE, F.col("idx").alias("block"), F.col("top").alias("subroot"), "root", F.concat("path", "outer").alias("path")
    )


def verified_versions(docs: DataFrame, changed: Column, text: Column) -> DataFrame:
    """The Merkle tree over all rows, and for each row the version of it that the row's change makes.

    A leaf is the hash of doc_id, source, lang, n_chars and text (see `encoded`). In each source
    the leaves ascend by doc_id, null first (equal ids: by their hash); every FANOUT consecutive
    nodes make one until one is left, the subroot. Subroots in the order of their sources, null
    first, likewise make the root.

    Where `changed` holds, the row reads `text` for its text. Its version shares all nodes with
    the tree but the leaf and its ancestors, which are copied: first inside the aligned block
    of BLOCK leaves that one task holds, then along the distributed levels above. A row that is
    not changed folds its own leaf the same way, which proves that it belongs to the root.

    Returns per row `doc_id, leaf, subroot, root, proof_sha256` of the tree (the hash of all
    siblings, level by level), `folded_root` of the version, `verified` (it equals the root) and
    `copied`, the nodes from leaf to root that the version has of its own (null: not changed).
    Repeated rows are leaves of their own. No rows give no rows.

    Texts are hashed where they are read; leaves are 32 bytes. A source of any size is dealt out
    by ranges of doc_id and then by blocks.
    """
    rows = stored(leaves(docs, changed, text), "leaves")
    placed = numbered(rows, SOURCE, ["doc_id", "leaf"])
    placed = stored(placed.withColumn("block", F.floor(F.col("position") / BLOCK)), "placed")
    above = roots_and_paths(stored(block_roots(placed), "block-roots"))
    none = {"doc_id": "bigint", "leaf": "binary", "other": "binary", "total": "bigint", "position": "bigint"}
    heads = above.select(*SOURCE, "block", *[F.lit(None).cast(t).alias(c) for c, t in none.items()], "subroot", "root", "path")
    kinds = {"subroot": "string", "root": "string", "path": "array<struct<left:string,right:string>>"}
    body = placed.select(*SOURCE, "block", *none, *[F.lit(None).cast(t).alias(c) for c, t in kinds.items()])

    def work(c: list) -> list[list]:
        _, _, _, doc_id, leaf, other, total, subroot, root, path = c
        first, last = subroot[0], root[0]
        upper = [(s["left"].encode(), s["right"].encode()) for s in path[0]]
        tree = built(hexes(leaf[1:]), levels_of(total[1]))
        out = [doc_id[1:], [x.decode() for x in tree[0]], [first] * len(tree[0]), [last] * len(tree[0]), [], [], [], []]
        for place, new in enumerate(hexes(other[1:])):
            way = [*siblings(tree, place), *upper]
            proof = hashlib.sha256(b"".join(side for step in way for side in step)).hexdigest()
            own = version(new or tree[0][place], way)
            folded = own[-1].decode()
            for column, value in zip(out[4:], (proof, folded, folded == last, [x.decode() for x in own] if new else None), strict=True):
                column.append(value)
        return out

    columns = ["doc_id", "leaf", "other", "total", "subroot", "root", "path"]
    schema = (
        "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
        "verified boolean, copied array<string>"
    )
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "copied"]
    return by_block(heads.unionByName(body), columns, "subroot IS NULL", work, schema, names)


def lower_cased(text: Column) -> Column:
    """A-Z in lower case; null stays."""
    return F.translate(text, UPPER, UPPER.lower())
