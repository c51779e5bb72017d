"""Merkle fingerprints of documents over sections, paragraphs and pieces."""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import zip_longest

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docvault.llm.frames import NO_ID, partitions, pick, run_of, split_points

#: A word whose checksum is divisible by this ends a piece; a paragraph's, a section.
PIECE_EVERY = 5
SECTION_EVERY = 4
#: Hexadecimal digits of an inner node that the fingerprint shows; the root has all 64.
SHOWN = 8
#: Words with the white space after them; a longer run without white space is cut.
WORD = re.compile(rb"[^\x09-\x0D\x20]{1,256}[\x09-\x0D\x20]*|[\x09-\x0D\x20]+")


def node(kind: bytes, children: bytes) -> bytes:
    return hashlib.sha256(kind + children).digest()


def pieces(paragraph: bytes) -> list[bytes]:
    """A paragraph cut after the words that its content marks, so that an edit moves few cuts."""
    words = WORD.findall(paragraph)
    ends = [i for i, crc in enumerate(map(zlib.crc32, words), 1) if not crc % PIECE_EVERY]
    if not ends or ends[-1] < len(words):
        ends.append(len(words))
    cut, start = [], 0
    for end in ends:
        cut.append(b"".join(words[start:end]))
        start = end
    return cut


def tree(text: bytes) -> list[list[list[bytes]]]:
    """The leaf hashes of a text by section and paragraph.

    Paragraphs are lines. A paragraph ends a section if its hash says so; so sections, too,
    are cut by content and an inserted paragraph changes one section.
    """
    sections: list[list[list[bytes]]] = [[]]
    for paragraph in text.split(b"\n"):
        sections[-1].append([node(b"w", piece) for piece in pieces(paragraph)])
        if not zlib.crc32(paragraph) % SECTION_EVERY:
            sections.append([])
    return sections if sections[-1] else sections[:-1]


def fingerprint(text: bytes | None) -> str:
    """root;section,section... where a section is hash=paragraph/paragraph, a paragraph hash:leaf.leaf.

    Every inner node is the SHA-256 of its kind and its children; the root is shown whole, so
    roots are equal for equal texts only. A null text is an empty one.
    """
    shown, tops = [], []
    for section in tree(text or b""):
        inner, parts = [], []
        for leaves in section:
            own = node(b"p", b"".join(leaves))
            inner.append(own)
            parts.append(f"{own.hex()[:SHOWN]}:{'.'.join([leaf.hex()[:SHOWN] for leaf in leaves])}")
        top = node(b"s", b"".join(inner))
        tops.append(top)
        shown.append(f"{top.hex()[:SHOWN]}={'/'.join(parts)}")
    return f"{node(b'r', b''.join(tops)).hex()};{','.join(shown)}"


def root(print_: str) -> str:
    return print_[:64]


def leaves(print_: str) -> Counter:
    """How often each leaf occurs in a fingerprint."""
    return Counter(re.findall(r"(?<=[:.])[0-9a-f]+", print_))


def likeness(a: str, b: str, in_a: Counter | None = None, in_b: Counter | None = None) -> float:
    """Twice the common leaves over all leaves; 1 exactly when the roots are equal."""
    if root(a) == root(b):
        return 1.0
    in_a, in_b = in_a or leaves(a), in_b or leaves(b)
    total = in_a.total() + in_b.total()
    common = sum(min(n, in_b[leaf]) for leaf, n in in_a.items() if leaf in in_b)
    return min(2 * common / total, 1 - 1 / (total + 1))


Branch = tuple[int, int]


def branches(print_: str) -> tuple[list[str], list[list[tuple[Branch, str]]]]:
    """The hashes of the sections, and of each section's paragraphs with their (section, paragraph)."""
    tops, inner = [], []
    for i, section in enumerate(print_.partition(";")[2].split(",")):
        top, _, parts = section.partition("=")
        tops.append(top)
        inner.append([((i, k), part.partition(":")[0]) for k, part in enumerate(parts.split("/"))])
    return tops, inner


def common(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Places of a longest common subsequence of two lists of hashes, in order.

    For each length it keeps the common subsequence that ends earliest in `b`; so the work goes
    with the number of equal pairs, not with the product of the lengths.
    """
    places: dict[str, list[int]] = {}
    for j, hash_ in enumerate(b):
        places.setdefault(hash_, []).append(j)
    ends: list[int] = []
    chains: list[tuple] = []
    for i, hash_ in enumerate(a):
        for j in reversed(places.get(hash_, ())):
            k = bisect_left(ends, j)
            ends[k : k + 1] = [j]
            chains[k : k + 1] = [(i, j, chains[k - 1] if k else None)]
    pairs, chain = [], chains[-1] if chains else None
    while chain:
        pairs.append(chain[:2])
        chain = chain[2]
    return pairs[::-1]


def unequal_runs(a: list[str], b: list[str]) -> Iterator[tuple[slice, slice]]:
    """The stretches of both lists between what is common to them."""
    i = j = 0
    for next_i, next_j in [*common(a, b), (len(a), len(b))]:
        if i < next_i or j < next_j:
            yield slice(i, next_i), slice(j, next_j)
        i, j = next_i + 1, next_j + 1


def differing_branches(a: str, b: str) -> list[tuple[str, Branch | None, Branch | None]]:
    """What turns the paragraphs of `a` into those of `b`: (kind, branch of a, branch of b).

    A branch is (section, paragraph). The children of the roots are aligned by their hashes, and
    only sections that find no partner are entered, where the paragraphs are aligned likewise.
    `changed` paragraphs stand in each other's place, `moved` ones are equal in two places,
    `lost` ones are in `a` only and `new` ones in `b` only. Equal roots give nothing. Should
    the short inner hashes agree under unequal roots, all paragraphs count as changed.
    """
    if root(a) == root(b):
        return []
    (tops_a, inner_a), (tops_b, inner_b) = branches(a), branches(b)
    runs = []
    for sections_a, sections_b in unequal_runs(tops_a, tops_b):
        in_a = [p for section in inner_a[sections_a] for p in section]
        in_b = [p for section in inner_b[sections_b] for p in section]
        for there, here in unequal_runs([h for _, h in in_a], [h for _, h in in_b]):
            runs.append((in_a[there], in_b[here]))

    arrived: dict[str, list[Branch]] = {}
    for _, here in runs:
        for place, hash_ in here:
            arrived.setdefault(hash_, []).append(place)
    found, targets = [], set()
    left_over = []
    for there, here in runs:
        stay = []
        for place, hash_ in there:
            if arrived.get(hash_):
                target = arrived[hash_].pop(0)
                targets.add(target)
                found.append(("moved", place, target))
            else:
                stay.append(place)
        left_over.append((stay, here))
    for gone, here in left_over:
        come = [place for place, _ in here if place not in targets]
        for old, new in zip_longest(gone, come):
            kind = "new" if old is None else "lost" if new is None else "changed"
            found.append((kind, old, new))
    if not found:
        pairs = zip_longest(*([p for section in inner for p, _ in section] for inner in (inner_a, inner_b)))
        found = [("changed", old, new) for old, new in pairs]
    return sorted(found, key=lambda e: (e[1] is None, e[1] or e[2], e[2] is None, e[2] or e[1]))


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """`doc_id, n_chars, fingerprint` of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            sizes = pa.array([len(t or "") for t in texts], pa.int64())
            prints = pa.array([fingerprint((t or "").encode()) for t in texts], pa.string())
            yield pa.record_batch([batch.column("doc_id"), sizes, prints], names=["doc_id", "n_chars", "fingerprint"])

    return pick(docs, "doc_id", "text").mapInArrow(run, "doc_id bigint, n_chars bigint, fingerprint string")


def edited(text: str, other: str) -> str:
    """The last half of a text replaced by as much of the start of another."""
    half = len(text) // 2
    return text[: len(text) - half] + other[:half]


def in_descending_runs(docs: DataFrame) -> DataFrame:
    """`run, guest, ord, doc_id, text`: documents in runs by descending doc_id, one run in one partition.

    Each run ends with a guest, the first row of the run after it (of the first run, after the
    last), so that each document meets its next one in its own partition. Rows without a doc_id
    come last; equal ids are ordered by text. Texts are exchanged once.
    """
    rows = pick(docs, "doc_id", "text").withColumn("ord", F.coalesce("doc_id", F.lit(NO_ID)))
    ids = rows.select("ord")
    cuts = split_points(ids, "ord", 4 * partitions(docs.sparkSession))
    run = F.lit(len(cuts)) - run_of(F.col("ord"), cuts)
    heads = ids.groupBy(run.alias("run")).agg(F.max("ord").alias("head")).collect()  # one row for each run
    order = sorted((r["run"], r["head"]) for r in heads)
    if not order:
        return rows.select(F.lit(0).alias("run"), F.lit(False).alias("guest"), "ord", "doc_id", "text").where(F.lit(False))
    known = {run: (head, order[i - 1][0]) for i, (run, head) in enumerate(order)}
    by_run = [known.get(r, (None, None)) for r in range(len(cuts) + 1)]
    head, host = (
        F.get(F.array(*[F.lit(x[i]).cast(kind) for x in by_run]), run) for i, kind in ((0, "bigint"), (1, "int"))
    )
    places = F.array(
        F.struct(run.alias("run"), F.lit(False).alias("guest")),
        F.struct(F.when(F.col("ord") == head, host).alias("run"), F.lit(True).alias("guest")),
    )
    dealt = rows.select(F.inline(F.filter(places, lambda p: p["run"].isNotNull())), "ord", "doc_id", "text")
    return dealt.repartition("run").sortWithinPartitions("run", "guest", F.desc("ord"), "text")


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprint each text, its edit with the next document's text, and how alike they are.

    Returns `doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next`. The next document is the one after it by descending doc_id, for the last the
    first. A null text is empty; rows without a doc_id come last; equal ids follow each other
    by text; a single row is its own next. No rows give no rows. Other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None
        for batch in batches:
            out = [[], [], [], [], [], [], []]
            columns = [batch.column(n).to_pylist() for n in ("run", "guest", "doc_id", "text")]
            for run, guest, doc_id, text in zip(*columns, strict=True):
                text = text or ""
                own = fingerprint(text.encode())
                found = leaves(own)
                if waiting and waiting[0] == run:
                    _, was_guest, last_id, last_text, last, last_leaves = waiting
                    if not was_guest:
                        new = edited(last_text, text).encode()
                        changed = fingerprint(new)
                        values = (
                            last_id, len(last_text), hashlib.sha256(new).hexdigest(), last, changed,
                            likeness(last, changed, last_leaves), likeness(last, own, last_leaves, found),
                        )
                        for column, value in zip(out, values, strict=True):
                            column.append(value)
                waiting = (run, guest, doc_id, text, own, found)
            arrays = [pa.array(c, t) for c, t in zip(out, types, strict=True)]
            yield pa.record_batch(arrays, names=names)

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    schema = (
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )
    return in_descending_runs(docs).mapInArrow(run, schema)
