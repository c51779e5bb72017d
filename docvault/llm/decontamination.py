"""Benchmark passages in documents: SimHash windows, multi-index Hamming blocks, shingle probes, exact similarity."""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docvault.llm.frames import pick
from docvault.llm.words import STEP, column_bytes, hashed, mixed, shingles, words

#: Greatest Hamming distance of two fingerprints that are compared further.
RADIUS = 11
#: Words of a shingle.
K = 5
#: A fingerprint has this many blocks of 16 bits.
BLOCKS = 4
#: So many fingerprints are compared with each window; more have tables, of 256 kB for a size.
FEW = 8
#: Bits of a shingle's hash that are tested before it is looked up.
PROBE_BITS = 20
#: Benchmark items are searched for in blocks of so many items and so many bytes of text.
BLOCK_ITEMS = 2000
BLOCK_BYTES = 8_000_000
#: Words that are handled at once; longer texts are cut into overlapping stretches.
STRETCH = 16_384


class Items:
    """One block of benchmark items: shingle counts, probes, and tables of fingerprints by window size."""

    def __init__(self, items: list[tuple[int, list[bytes]]], radius: int = RADIUS, threshold: float = 0.75):
        self.radius = radius
        self.ids = [i for i, _ in items]
        codes = [hashed(w) for _, w in items]
        self.sizes = np.array([len(c) for c in codes])
        self.shingles = [Counter(shingles(c, min(K, len(c))).tolist()) for c in codes]
        self.prints = np.array([text_print(c) for c in codes], np.uint64)
        self.classes = []
        for size in np.unique(self.sizes).tolist():
            members = np.flatnonzero(self.sizes == size)
            marked = block_tables(self.prints[members], radius) if len(members) > FEW else None
            self.classes.append((size, members, marked))
        self.probes = Probes(self.shingles, threshold)

    def longest(self) -> int:
        return int(self.sizes.max())


class Probes:
    """The shingles of each item of which a window needs one, to reach the threshold.

    The common weight of a window and an item is at least the threshold of the item's, so when
    shingles that weigh more than the rest are left, each such window holds one of them. The
    ones that fewest items have are taken.
    """

    def __init__(self, counts: list[Counter], threshold: float):
        held = Counter(code for wanted in counts for code in wanted)
        self.holders: dict[int, list[int]] = defaultdict(list)
        for item, wanted in enumerate(counts):
            least = max(1, math.ceil(threshold * wanted.total() - 1e-9))
            spare = wanted.total() - least + 1
            for code in sorted(wanted, key=lambda c: (held[c], c)):
                if spare <= 0:
                    break
                self.holders[code].append(item)
                spare -= wanted[code]
        self.marked = np.zeros(1 << PROBE_BITS, bool)
        self.marked[np.fromiter(self.holders, np.uint64, len(self.holders)) >> np.uint64(64 - PROBE_BITS)] = True

    def hits(self, codes: np.ndarray) -> Iterator[tuple[int, int]]:
        """(item, place) for all places of a probe."""
        at = np.flatnonzero(self.marked.take(codes >> np.uint64(64 - PROBE_BITS)))
        for place, code in zip(at.tolist(), codes[at].tolist(), strict=True):
            for item in self.holders.get(code, ()):
                yield item, place


def feature_bits(codes: np.ndarray, kind: type) -> np.ndarray:
    """For each word and each of 64 bits, how many of the word's features set the bit.

    A word and the pair that it makes with the word before it are a feature each; so a
    replaced word changes three features, and common words alone make no two windows alike.
    """
    pairs = codes * STEP + np.concatenate((codes[:1], codes[:-1]))
    bits = np.unpackbits(mixed(codes).view(np.uint8), bitorder="little")
    bits += np.unpackbits(mixed(pairs).view(np.uint8), bitorder="little")
    return bits.reshape(-1, 64).astype(kind, copy=False)


class Buffers:
    """Arrays that are used again for every stretch of a task; new memory costs more than the sums."""

    def __init__(self):
        self.held: dict[object, np.ndarray] = {}

    def get(self, name: object, rows: int, kind: type) -> np.ndarray:
        held = self.held.get(name)
        if held is None or len(held) < rows or held.dtype != kind:
            held = self.held[name] = np.empty((rows + rows // 4, 64), kind)
        return held[:rows]


def window_sums(bits: np.ndarray, sizes: list[int], buffers: Buffers) -> Iterator[tuple[int, np.ndarray]]:
    """The sums of all windows of each of the rising sizes, each size from the one before it.

    The difference between two sizes is put together from windows of 1, 2, 4... words. The
    sums of a size are overwritten by the next.
    """
    n, last, sums = len(bits), 0, None
    doubled = [bits]
    for size in sizes:
        if size > n:
            return
        while len(doubled) < (size - last).bit_length():
            part, step = doubled[-1], 1 << (len(doubled) - 1)
            rows = len(part) - step
            doubled.append(np.add(part[:-step], part[step:], out=buffers.get(len(doubled), rows, bits.dtype)))
        windows, at = n - size + 1, last
        out = buffers.get("sums", n, bits.dtype)[:windows]
        new = None if sums is None else sums[:windows]
        for k, part in enumerate(doubled):
            if (size - last) >> k & 1:
                piece = part[at : at + windows]
                new = piece if new is None else np.add(new, piece, out=out)
                at += 1 << k
        last, sums = size, new
        yield size, sums


def prints_of(sums: np.ndarray, size: int, buffers: Buffers) -> np.ndarray:
    """SimHashes from the sums of windows: the bits that more than half of the features set.

    The first pair of a window reaches one word out of it.
    """
    flags = np.greater(sums, size, out=buffers.get("flags", len(sums), np.bool_))
    return np.packbits(flags.ravel(), bitorder="little").view("<u8")


def text_print(codes: np.ndarray) -> int:
    sums = feature_bits(codes, np.uint32).sum(0, dtype=np.uint32)
    return int(prints_of(sums[None], len(codes), Buffers())[0])


def block_tables(prints: np.ndarray, radius: int) -> np.ndarray:
    """For each block of 16 bits, which values are near enough to an item's block.

    Two fingerprints within `radius` have a block in which they differ in at most
    radius // BLOCKS bits, so a window none of whose blocks is marked is in reach of no item.
    """
    flips = [sum(1 << b for b in bits) for n in range(radius // BLOCKS + 1) for bits in combinations(range(16), n)]
    marked = np.zeros((BLOCKS, 1 << 16), bool)
    blocks = prints.astype("<u8").view("<u2").reshape(-1, BLOCKS)
    for b in range(BLOCKS):
        marked[b, (blocks[:, b, None] ^ np.array(flips, np.uint16)).ravel()] = True
    return marked


def near_windows(
    codes: np.ndarray, ends: np.ndarray, items: Items, buffers: Buffers
) -> Iterator[tuple[int, int]]:
    """(item, start) for all windows within reach of the item; `ends` says where a word's text ends."""
    bits = feature_bits(codes, np.uint8 if items.longest() < 128 else np.uint32)
    room = ends - np.arange(len(codes))
    sums_by_size = window_sums(bits, [c[0] for c in items.classes], buffers)
    for (size, sums), (_, members, marked) in zip(sums_by_size, items.classes, strict=False):
        own = prints_of(sums, size, buffers)
        hit = room[: len(own)] >= size
        if marked is not None:
            blocks = own.view("<u2").reshape(-1, BLOCKS)
            near = marked[0].take(blocks[:, 0])
            for b in range(1, BLOCKS):
                near |= marked[b].take(blocks[:, b])
            hit &= near
        at = np.flatnonzero(hit)
        own = own[at]
        for member in members.tolist():
            for window in np.flatnonzero(np.bitwise_count(own ^ items.prints[member]) <= items.radius).tolist():
                yield member, int(at[window])


def find_items(
    texts: list[np.ndarray], items: Items, threshold: float, buffers: Buffers
) -> dict[tuple[int, int], tuple[float, int, int]]:
    """(text, item) to (similarity, first word, words) of the most similar window."""
    sizes = np.array([len(t) for t in texts])
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    codes = np.concatenate(texts)
    row_of = np.repeat(np.arange(len(texts)), sizes)
    near: dict[tuple[int, int], set[int]] = defaultdict(set)
    for item, start in near_windows(codes, np.repeat(bounds[1:], sizes), items, buffers):
        near[int(row_of[start]), item].add(start - int(bounds[row_of[start]]))
    for row in np.flatnonzero(sizes < items.longest()).tolist():  # one window where a text is shorter
        close = np.bitwise_count(items.prints ^ np.uint64(text_print(texts[row]))) <= items.radius
        for item in np.flatnonzero(close & (items.sizes > sizes[row])).tolist():
            near[row, item].add(0)
    spans = {key: [(start - 2, start + 2) for start in starts] for key, starts in near.items()}
    by_size = text_shingles(codes, np.repeat(bounds[1:], sizes), items)
    for at, found_codes in by_size:
        for item, place in items.probes.hits(found_codes):
            row = int(row_of[at[place]])
            start = int(at[place] - bounds[row])
            spans.setdefault((row, item), []).append((start - int(items.sizes[item]) + 1, start))
    found = {}
    kept: dict[tuple[int, int], np.ndarray] = {}
    for (row, item), some in spans.items():
        n = len(texts[row])
        k = min(K, int(items.sizes[item]))
        length = min(int(items.sizes[item]), n)
        if (row, k) not in kept:
            kept[row, k] = shingles(texts[row], k)
        best = None
        for low, high in united(some, n - length):
            one = best_window(kept[row, k], low, high, max(1, length - k + 1), items.shingles[item], threshold)
            if one and (best is None or one[0] > best[0]):
                best = one
        if best:
            found[row, item] = (*best, length)
    return found


def text_shingles(codes: np.ndarray, ends: np.ndarray, items: Items) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, hashes) of the shingles that do not leave their text, for each shingle size of the items."""
    for k in sorted({min(K, size) for size, *_ in items.classes}):
        if k <= len(codes):
            at = np.arange(len(codes) - k + 1)
            inside = at + k <= ends[: len(at)]
            yield at[inside], shingles(codes, k)[inside]


def united(spans: list[tuple[int, int]], last: int) -> Iterator[tuple[int, int]]:
    """Runs of starts from 0 to `last` that lie in one of the spans, both ends counted."""
    low = high = None
    for a, b in sorted(spans):
        a, b = max(0, a), min(last, b)
        if a > b:
            continue
        if high is not None and a <= high + 1:
            high = max(high, b)
            continue
        if high is not None:
            yield low, high
        low, high = a, b
    if high is not None:
        yield low, high


def best_window(
    codes: np.ndarray, low: int, high: int, size: int, wanted: Counter, threshold: float
) -> tuple[float, int] | None:
    """(similarity, start) of the most similar run of `size` shingles that starts from low to high.

    The similarity is common weight over united weight; a shingle weighs as often as it occurs.
    The first of equals; None below the threshold.
    """
    stretch = codes[low : high + size].tolist()
    both = wanted.total() + size
    held, common, best = dict.fromkeys(wanted, 0), 0, None
    for at, code in enumerate(stretch):
        if at >= size and (old := stretch[at - size]) in held:
            common -= held[old] <= wanted[old]
            held[old] -= 1
        if code in held:
            held[code] += 1
            common += held[code] <= wanted[code]
        if at >= size - 1 and common:
            similarity = common / (both - common)
            if similarity >= threshold and (best is None or similarity > best[0]):
                best = (similarity, low + at - size + 1)
    return best


def stretches(rows: list[np.ndarray], overlap: int) -> Iterator[list[tuple[int, int, np.ndarray]]]:
    """Lists of (row, first word, words) that have about STRETCH words together.

    A longer row is cut into stretches that overlap by more than any window.
    """
    size = max(STRETCH, 4 * overlap)
    part, held = [], 0
    for row, codes in enumerate(rows):
        start = 0
        while start < len(codes):
            piece = codes[start : start + size]
            part.append((row, start, piece))
            held += len(piece)
            if held >= size:
                yield part
                part, held = [], 0
            if start + size >= len(codes):
                break
            start += size - overlap
    if part:
        yield part


def search_block(docs: DataFrame, items: Items, threshold: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        overlap = 2 * items.longest() + 8
        buffers = Buffers()
        for batch in batches:
            rows = [hashed(words(t)) for t in column_bytes(batch, "text")]
            best: dict[tuple[int, int], tuple[float, int, int]] = {}
            for part in stretches(rows, overlap):
                for (k, item), (similarity, first, n) in find_items([p[2] for p in part], items, threshold, buffers).items():
                    row, start, _ = part[k]
                    if similarity > best.get((row, item), (0.0,))[0]:
                        best[row, item] = (similarity, start + first, n)
            ids = batch.column("doc_id").to_pylist()
            columns = [
                [ids[row] for row, _ in best],
                [items.ids[item] for _, item in best],
                *([v[i] for v in best.values()] for i in range(3)),
            ]
            types = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
            names = ["doc_id", "item_id", "similarity", "first_word", "n_words"]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    schema = "doc_id bigint, item_id bigint, similarity double, first_word bigint, n_words bigint"
    return docs.mapInArrow(run, schema)


def item_blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, list[bytes]]]]:
    """The items with words, in blocks whose number of items and bytes are bounded."""
    block, size = [], 0
    rows = pick(benchmark, "item_id", "text").where("text IS NOT NULL").orderBy("item_id", "text")
    for row in rows.toLocalIterator():
        found = words(row["text"].encode())
        if not found:
            continue
        if block and (len(block) >= BLOCK_ITEMS or size + len(row["text"]) > BLOCK_BYTES):
            yield block
            block, size = [], 0
        block.append((row["item_id"], found))
        size += len(row["text"])
    if block:
        yield block


def find_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.75, radius: int = RADIUS) -> DataFrame:
    """Passages of documents that are near a benchmark item: one row per document and item.

    For every item, the windows of the item's size at every word of every whole text get a
    SimHash over their words. Tables of Hamming blocks find all windows whose fingerprint is
    within `radius` of the item's. So that none is lost, the windows that hold one of the item's
    probes (see `Probes`) are taken beside these. The windows are compared by their 5-word
    shingles, weighted by how often they occur, and count from `threshold` on. An item of fewer
    words is one shingle of all its words. Words are lower-cased runs without white space.

    Returns `doc_id, item_id, similarity` (of the best window), `first_word, n_words` (where it
    is). Texts shorter than an item are one window. Null texts, texts and items without words
    match nothing. Equal items each match; repeated rows give repeated results; rows without
    doc_id are searched too. Extra columns are ignored. An empty benchmark gives no rows.

    Documents are read once for each block of items and are not exchanged; a block has at most
    BLOCK_ITEMS items and BLOCK_BYTES of text (one longer item is a block of its own).
    """
    texts = pick(docs, "doc_id", "text").where("text IS NOT NULL")
    found = None
    for block in item_blocks(benchmark):
        part = search_block(texts, Items(block, radius, threshold), threshold)
        found = part if found is None else found.unionAll(part)
    if found is None:
        empty = "cast(null as bigint) item_id", "0D similarity", "0L first_word", "0L n_words"
        return texts.where("false").selectExpr("doc_id", *empty)
    return found


def decontaminate(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.75) -> DataFrame:
    """The documents, all columns, without those that hold a benchmark passage (see `find_leaks`).

    A document without doc_id stays: a match could not be told from another's.
    """
    leaks = find_leaks(docs, benchmark, threshold).select(F.col("doc_id").alias("leak__")).distinct()
    return docs.join(leaks, docs["doc_id"] == F.col("leak__"), "left_anti")
