"""Packing of documents into token sequences: dominance reduction, then best fit."""

from __future__ import annotations

import gc
import os
import re
import sys
import types
import zlib
from array import array
from bisect import bisect_left, insort
from codecs import charmap_decode
from collections.abc import Iterator
from string import punctuation

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docvault.llm.frames import NO_ID, pick, stored

#: Words remembered by a Python worker, with their ids, in each of two generations.
CACHED_WORDS = 250_000
#: About so many characters of a text are split into words at a time.
SLICE = 1 << 20
#: A length of more pieces is numbered in parts of about so many, so that no common length is a single task.
PART_PIECES = 50_000


#: Words of letters whose lower case is letter by letter, with ASCII punctuation behind them.
SIMPLE = re.compile(rf"([A-Za-zÀ-ÖØ-öø-ÿĀ-ĮıĲ-ɏЀ-џ]+)([{re.escape(punctuation)}]{{0,8}})")
#: Byte-level tokenizers write printable bytes as themselves, the others as the code points from 256 on.
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_SIGNS = {b: chr(b) for b in PRINTABLE} | {b: chr(256 + i) for i, b in enumerate(sorted({*range(256)} - {*PRINTABLE}))}
#: The signs of a byte-level tokenizer, in the order of the bytes.
SIGNS = "".join(BYTE_SIGNS[b] for b in range(256))
#: A tokenizer that does not give this text's ids word by word is used on whole texts.
PROBE = "It's The ÉTÉ of  ein-zwei\n\nWörter, (naïve) Ж\tx2 3.14!? foo_bar's \"DON'T\" été. été, ...and 日本 end"


class WordIds(dict):
    """Text without blanks and line ends to its ids as little-endian bytes, found when first asked for.

    The tokenizer drops white space between words, so the ids of a text are those of its words
    one after the other. ASCII punctuation at the end of a word that ends in a letter is a run
    of its own; a word of letters is one run, whose lower case goes to the tokenizer's model
    directly. All other words go through the whole tokenizer. When there are too many words,
    those not seen since the last time that happened are forgotten. `by_words` says whether
    the tokenizer works like that (see PROBE); if not, whole texts go through it.
    """

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer, self.model = tokenizer, tokenizer.model
        self.older: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {"": b""}
        self.by_words = self.joined(PROBE) == self.whole(PROBE)

    def whole(self, text: str) -> bytes:
        return as_bytes(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids)

    def joined(self, text: str) -> bytes:
        """The ids of a text word by word; blanks beside each other leave empty words, which have none."""
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))

    def make_room(self) -> None:
        if len(self) >= CACHED_WORDS:
            self.older = dict(self)
            self.clear()

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            core = word.rstrip(punctuation)
            if core.isascii() and core.isalpha() and len(word) - len(core) <= 8:
                tail = word[len(core) :]
            else:
                core, tail = m.groups() if (m := SIMPLE.fullmatch(word)) else ("", "")
            if not core:
                ids = self.whole(word)
            elif (lower := core.lower()) == word:
                ids = self.core_ids(lower)
            else:
                ids = self[lower] + self.tail_ids(tail) if tail else self[lower]
        self[word] = ids
        return ids

    def core_ids(self, core: str) -> bytes:
        signs = core if core.isascii() else charmap_decode(core.encode(), "strict", SIGNS)[0]
        return as_bytes([t.id for t in self.model.tokenize(signs)])

    def tail_ids(self, tail: str) -> bytes:
        if tail not in self.tails:
            if len(self.tails) >= CACHED_WORDS:
                self.tails = {"": b""}
            self.tails[tail] = self.whole(tail)
        return self.tails[tail]


def worker_state() -> types.ModuleType:
    """A place for what the tasks of one Python worker share."""
    return sys.modules.setdefault("docvault_worker_state", types.ModuleType("docvault_worker_state"))


def known_words(tokenizer_path: str) -> WordIds:
    """The tokenizer and the words of this worker; it is loaded once for all of its tasks."""
    from tokenizers import Tokenizer

    state = worker_state()
    if getattr(state, "tokenizer_path", None) != tokenizer_path:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks are the parallelism
        state.tokenizer_path, state.words = tokenizer_path, WordIds(Tokenizer.from_file(tokenizer_path))
        gc.freeze()  # the words are many and make no cycles: the collector leaves them alone
    return state.words


def as_bytes(ids: list[int]) -> bytes:
    found = array("I", ids)
    if sys.byteorder == "big":
        found.byteswap()
    return found.tobytes()


def slices(text: str) -> Iterator[str]:
    """A text in parts of about SLICE characters, cut in front of blanks and line ends."""
    start = 0
    while start < len(text):
        end = start + SLICE
        if end < len(text):
            ends = [x for x in (text.find(" ", end), text.find("\n", end)) if x >= 0]
            end = min(ends, default=len(text))
        yield text[start:end]
        start = end


def text_ids(text: str | None, known: WordIds, end_id: int) -> bytes:
    """All ids of a text and the end id, four bytes each."""
    text, end = text or "", as_bytes([end_id])
    if not known.by_words:
        return known.whole(text) + end
    parts = []
    for part in slices(text):
        known.make_room()
        parts.append(known.joined(part))
    return b"".join(parts) + end


def many_text_ids(texts: list[str | None], known: WordIds, end_id: int) -> Iterator[bytes]:
    return (text_ids(text, known, end_id) for text in texts)


def token_pieces(
    docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1, with_ids: bool = False
) -> DataFrame:
    """Each document's ids, cut into pieces of `capacity` where there are more.

    Rows: `doc_id, piece, start, length, ids_crc32`, with `with_ids` also `ids` (array of int).
    A null or empty text has the end id only.
    """
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    if with_ids:
        schema += ", ids array<int>"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = known_words(tokenizer_path)
        for batch in batches:
            columns = [[], [], [], [], [], []]
            found = many_text_ids(batch.column("text").to_pylist(), known, end_id)
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), found, strict=True):
                for piece, start in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[start : start + 4 * capacity]
                    row = (doc_id, piece, start // 4, len(part) // 4, zlib.crc32(part))
                    for column, value in zip(columns, row, strict=False):
                        column.append(value)
                    if with_ids:
                        columns[5].append(np.frombuffer(part, "<i4"))
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            n = 6 if with_ids else 5
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][:n]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns[:n], types, strict=False)], names=names)

    return pick(docs, "doc_id", "text").mapInArrow(cut, schema)


class Supply:
    """How many pieces of each length are left."""

    def __init__(self, counts: dict[int, int]):
        self.count = {w: n for w, n in counts.items() if n > 0}
        self.lengths = sorted(self.count)

    def take(self, w: int, n: int) -> None:
        self.count[w] -= n
        if not self.count[w]:
            del self.count[w]
            del self.lengths[bisect_left(self.lengths, w)]

    def put_back(self, w: int) -> None:
        if w not in self.count:
            insort(self.lengths, w)
        self.count[w] = self.count.get(w, 0) + 1

    def largest(self, room: int) -> int | None:
        """The largest length that fits."""
        at = bisect_left(self.lengths, room + 1)
        return self.lengths[at - 1] if at else None

    def smallest_two(self) -> int:
        """What the two smallest pieces need together; endless when there are not two."""
        if not self.lengths:
            return 2**62
        first = self.lengths[0]
        if self.count[first] > 1:
            return 2 * first
        return first + self.lengths[1] if len(self.lengths) > 1 else 2**62


def reduce_by_dominance(supply: Supply, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Sequences that some best packing contains: (lengths, how many such sequences).

    For the longest piece j and the room r that it leaves, in this order:
    - nothing fits beside j: j alone;
    - a piece fills r exactly, or no two pieces fit into r: j and the longest piece that fits
      dominate every other set with j, as whatever else stands beside j fits into that piece's
      place;
    - at most two pieces fit into r, and the longest piece k that fits is at least as long as
      any two that fit together: j and k;
    - at most two fit, and beside k the longest piece b that then fits is at least as long as
      the shorter piece of any pair that fits: j, k and b.
    The same set is fixed for as many pieces as have the same lengths at once. Lengths for
    which none holds stay for best fit.
    """
    fixed = []
    for j in reversed(list(supply.lengths)):
        while supply.count.get(j):
            chosen = dominating_set(supply, j, capacity - j)
            if chosen is None:
                break
            if chosen == (j,):
                n = supply.count[j]
            elif chosen[1] == capacity - j:
                n = repeats(supply, chosen, spare=0)
            else:
                n = max(1, repeats(supply, chosen, spare=3))
            for w in set(chosen):
                supply.take(w, n * chosen.count(w))
            fixed.append((chosen, n))
    return fixed


def dominating_set(supply: Supply, j: int, room: int) -> tuple[int, ...] | None:
    """A set with j that dominates all sets with j, or None; see `reduce_by_dominance`."""
    supply.take(j, 1)
    try:
        k = supply.largest(room)
        if k is None:
            return (j,)
        two = supply.smallest_two()
        if k == room or two > room:
            return (j, k)
        if two + supply.lengths[0] <= room:
            return None
        if k >= longest_pair(supply, room):
            return (j, k)
        supply.take(k, 1)
        b = supply.largest(room - k)
        supply.put_back(k)
        return (j, k, b) if b is not None and b >= (supply.largest(room // 2) or 0) else None
    finally:
        supply.put_back(j)


def repeats(supply: Supply, lengths: tuple[int, ...], spare: int) -> int:
    """How often a set can be taken and leave `spare` pieces of each of its lengths.

    With three to spare, no test of `dominating_set` can have changed meanwhile: they ask which
    lengths there are, and whether a length is there twice beside j.
    """
    return min((supply.count[w] - spare) // lengths.count(w) for w in set(lengths))


def longest_pair(supply: Supply, room: int) -> int:
    """The largest sum of two pieces that fits."""
    best, low, high = 0, 0, len(supply.lengths) - 1
    while low <= high:
        a, b = supply.lengths[low], supply.lengths[high]
        if a + b > room:
            high -= 1
        elif low == high and supply.count[a] < 2:
            break
        else:
            best = max(best, a + b)
            low += 1
    return best


def best_fit(supply: Supply, capacity: int) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Longest pieces first, each into the open sequence that it leaves least room in.

    Pieces of one length and sequences of one content are handled together. Returns
    (((length, how many of it), ...), how many such sequences).
    """
    rooms: list[int] = []
    groups: dict[int, list[tuple[tuple[tuple[int, int], ...], int]]] = {}
    done = []

    def put(content: tuple[tuple[int, int], ...], n: int, room: int) -> None:
        if room == 0:
            done.append((content, n))
            return
        if room not in groups:
            groups[room] = []
            insort(rooms, room)
        groups[room].append((content, n))

    for w in reversed(supply.lengths):
        left = supply.count[w]
        while left:
            at = bisect_left(rooms, w)
            if at < len(rooms):
                room = rooms[at]
                content, n = groups[room].pop()
                if not groups[room]:
                    del groups[room], rooms[at]
            else:
                content, n, room = (), left, capacity
            fit = min(room // w, left)
            used = min(n, left // fit)
            put((*content, (w, fit)), used, room - fit * w)
            if content and n > used:
                put(content, n - used, room)
            left -= used * fit
    return done + [group for found in groups.values() for group in found]


def placement(counts: dict[int, int], capacity: int) -> tuple[dict[int, tuple[np.ndarray, ...]], int]:
    """For each length the runs of piece ranks and where they go, and how many sequences there are.

    Runs of a length: first rank, first sequence, pieces per sequence, offset. The size of the
    answer depends on the number of different lengths (at most `capacity`), not on the pieces.
    """
    supply = Supply(counts)
    plan = [(tuple((w, 1) for w in lengths), n) for lengths, n in reduce_by_dominance(supply, capacity)]
    plan += best_fit(supply, capacity)
    runs: dict[int, list[tuple[int, int, int, int]]] = {}
    next_rank = dict.fromkeys(counts, 0)
    sequence = 0
    for content, n in plan:
        offset = 0
        for w, fit in content:
            runs.setdefault(w, []).append((next_rank[w], sequence, fit, offset))
            next_rank[w] += n * fit
            offset += w * fit
        sequence += n
    return {w: tuple(np.array(x, np.int64) for x in zip(*r, strict=True)) for w, r in runs.items()}, sequence


def pack(pieces: DataFrame, capacity: int = 4096) -> DataFrame:
    """Put pieces into as few sequences of at most `capacity` tokens as the method finds.

    `pieces` needs a bigint `length` from 1 to `capacity` (others raise) plus `doc_id` and
    `piece`, which break ties; it is read three times, so pass a stored table. Returns its
    columns plus `sequence_id` and `offset` (gapless from 0 in each sequence); columns of these
    names are replaced. Repeated rows are packed as often as they occur. No rows give no rows.

    Only the number of pieces of each length reaches the driver (at most `capacity` numbers).
    The plan made there says, for ranks within a length, where they go; pieces are ranked in
    `RANK_PARTS` parts of a length, so no length is numbered by one task.
    """
    names = [n for n in pieces.columns if n not in ("sequence_id", "offset")]
    pieces = pick(pieces, *names)
    found = pieces.groupBy("length").count().collect()  # at most `capacity` rows
    counts = {r["length"]: r["count"] for r in found}
    if any(w is None or not 1 <= w <= capacity for w in counts):
        raise ValueError(f"piece lengths must be from 1 to {capacity}")
    runs, _ = placement(counts, capacity)
    common = {w: -(-n // PART_PIECES) for w, n in counts.items() if n > PART_PIECES}
    count = F.lit(1)
    if common:
        count = F.coalesce(F.create_map(*[F.lit(x).cast("bigint") for pair in common.items() for x in pair])[F.col("length")], F.lit(1))
    parts = pieces.withColumn("part__", F.pmod(F.xxhash64("doc_id", "piece"), count.cast("bigint")).cast("int"))
    before = (
        parts.groupBy("length", "part__")
        .count()
        .withColumn(
            "before__",
            F.sum("count").over(Window.partitionBy("length").orderBy("part__")) - F.col("count"),
        )
        .select("length", "part__", "before__")
    )
    order = Window.partitionBy("length", "part__").orderBy(F.coalesce("doc_id", F.lit(NO_ID)), "piece")
    ranked = parts.withColumn("in_part__", F.row_number().over(order) - 1).join(before, ["length", "part__"])
    ranked = ranked.withColumn("rank__", F.col("before__") + F.col("in_part__"))
    placed = ranked.select("length", "rank__", F.struct(*names).alias("row__"))

    @F.pandas_udf("sequence_id bigint, offset bigint")
    def place(length, rank):
        import pandas as pd

        sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
        ranks = rank.to_numpy()
        lengths = length.to_numpy()
        order = np.argsort(lengths, kind="stable")
        found, firsts = np.unique(lengths[order], return_index=True)
        for w, at in zip(found.tolist(), np.split(order, firsts[1:]), strict=True):
            first, base, fit, start = runs[w]
            own = ranks[at]
            run = np.searchsorted(first, own, "right") - 1
            within = own - first[run]
            sequence[at] = base[run] + within // fit[run]
            offset[at] = start[run] + within % fit[run] * w
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    return placed.withColumn("place__", place("length", "rank__")).select(
        *[F.col(f"row__.{n}").alias(n) for n in names], "place__.sequence_id", "place__.offset"
    )


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """Tokenize documents and pack their pieces; see `token_pieces` and `pack`."""
    return pack(stored(token_pieces(docs, tokenizer_path, capacity, end_id), "pieces"), capacity)
