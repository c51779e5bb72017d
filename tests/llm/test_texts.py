"""Fingerprints, shards, line dedup, Jaccard join, decontamination, packing."""

import random
import zlib
from bisect import bisect_left, insort
from collections import Counter

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from llm_data import corpus, documents, messy, nothing  # noqa: F401
from plain import best_similarity, components, fewest_bins, kept_lines, sha, shingle_list, words
from pyspark.sql import functions as F

from docvault.llm import components as contraction
from docvault.llm import decontamination, fingerprints, jaccard_join, line_dedup, packing, sharding
from docvault.llm import words as task_words
from docvault.llm.frames import pick, stored

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def test_words_and_shingles(corpus):
    for _, text in corpus:
        raw = None if text is None else text.encode()
        assert [w.decode() for w in task_words.words(raw)] == words(text)
        hashes = task_words.shingles(task_words.hashed(task_words.words(raw)))
        assert len(hashes) == len(shingle_list(text))
        assert len(set(hashes.tolist())) == len(set(shingle_list(text)))


# --- fingerprints


def test_fingerprints(corpus):
    prints = {t: fingerprints.fingerprint(None if t is None else t.encode()) for _, t in corpus}
    assert prints[None] == prints[""]
    assert len({fingerprints.root(p) for p in prints.values()}) == len({t or "" for t in prints})
    text = "\n".join(f"paragraph {i} of the text with some words in it" for i in range(60))
    changed = text.replace("paragraph 30 ", "passage 30 ")
    a, b = fingerprints.fingerprint(text.encode()), fingerprints.fingerprint(changed.encode())
    assert len(fingerprints.differing_branches(a, b)) == 1 and fingerprints.differing_branches(a, a) == []
    assert fingerprints.likeness(a, a) == 1 and 0.9 < fingerprints.likeness(a, b) < 1
    assert fingerprints.likeness(a, prints["one"]) == 0


def edits(a, b):
    return fingerprints.differing_branches(fingerprints.fingerprint(a.encode()), fingerprints.fingerprint(b.encode()))


def test_edits_are_located_on_both_sides():
    lines = [f"paragraph number {i} of this text" for i in range(60)]
    places = [place for section in fingerprints.branches(fingerprints.fingerprint("\n".join(lines).encode()))[1] for place, _ in section]

    def kinds(changed):
        return Counter(kind for kind, _, _ in edits("\n".join(lines), "\n".join(changed)))

    def one(changed):
        (found,) = edits("\n".join(lines), "\n".join(changed))
        return found

    kind, old, new = one([*lines[:20], "something else", *lines[20:]])
    assert kind == "new" and old is None and new is not None
    assert one([*lines[:20], *lines[21:]]) == ("lost", places[20], None)
    assert one([*lines[:20], "something else", *lines[21:]])[:2] == ("changed", places[20])
    kind, old, new = one([*lines[:20], lines[20], lines[20], *lines[21:]])
    assert kind == "new" and old is None
    kind, old, new = one([*lines[:5], *lines[6:40], lines[5], *lines[40:]])
    assert kind == "moved" and old == places[5] and new > places[30]
    assert kinds([lines[1], lines[0], *lines[2:]]) == {"moved": 1}
    assert kinds([]) == {"lost": 59, "changed": 1}
    assert edits("", "") == [] and edits("", "x") == [("changed", (0, 0), (0, 0))]


def test_edits_explain_the_whole_difference():
    """What no edit names is the same sequence of paragraphs on both sides; moves join equal ones."""
    rng = random.Random(3)
    for _ in range(300):
        a, b = (["w%d v" % rng.randint(0, 9) if rng.random() < 0.8 else "" for _ in range(rng.randint(1, 25))] for _ in range(2))
        if rng.random() < 0.5:
            b = [*a[: rng.randint(0, len(a))], *b[:3], *a[rng.randint(0, len(a)) :]] or [""]
        prints = [fingerprints.fingerprint("\n".join(x).encode()) for x in (a, b)]
        found = fingerprints.differing_branches(*prints)
        assert bool(found) == (a != b)
        texts, rest = [], []
        for side, (print_, lines) in enumerate(zip(prints, (a, b)), 1):
            places = [place for section in fingerprints.branches(print_)[1] for place, _ in section]
            named = [edit[side] for edit in found if edit[side] is not None]
            assert len(places) == len(lines) and len(named) == len(set(named)) and set(named) <= set(places)
            texts.append(dict(zip(places, lines)))
            rest.append([text for place, text in texts[-1].items() if place not in named])
        assert rest[0] == rest[1]
        for kind, old, new in found:
            assert (old is None, new is None) == (kind == "new", kind == "lost")
            if old and new:
                assert (texts[0][old] == texts[1][new]) == (kind == "moved")


def test_common_is_longest():
    def longest(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last = row[:]
            for j, y in enumerate(b, 1):
                row[j] = last[j - 1] + 1 if x == y else max(row[j - 1], last[j])
        return row[-1]

    rng = random.Random(4)
    for _ in range(300):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(0, 12))] for _ in range(2))
        pairs = fingerprints.common(a, b)
        assert len(pairs) == longest(a, b) and all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))


def compared(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    for (doc, text), (_, other) in zip(order, [*order[1:], order[0]], strict=True):
        text, other = text or "", other or ""
        half = len(text) // 2
        yield doc, len(text), sha(text[: len(text) - half] + other[:half]), fingerprints.fingerprint(text.encode())


def test_compare_with_next(documents, messy, nothing):
    for docs in (documents, messy):
        rows = [(r["doc_id"], r["text"]) for r in pick(docs, "doc_id", "text").collect()]
        got = fingerprints.compare_with_next(docs).collect()
        found = Counter((r["doc_id"], r["n_chars"], r["edited_sha256"], r["fingerprint"]) for r in got)
        assert found == Counter(compared(rows))
        for r in got:
            assert 0 <= r["near_next"] <= 1 and 0 <= r["near_edited"] <= 1
            assert (r["near_edited"] == 1) == (r["fingerprint"] == r["edited_fingerprint"])
    long = [r for r in got if r["n_chars"] > 200]
    assert np.mean([r["near_edited"] for r in long]) > 0.4
    assert fingerprints.compare_with_next(nothing).count() == 0
    alone = fingerprints.compare_with_next(documents.where("doc_id = 6")).collect()
    assert len(alone) == 1 and alone[0]["near_next"] == 1


# --- sharding


@pytest.mark.parametrize("dimensions, bits", [(2, 4), (3, 3)])
def test_hilbert_curve(dimensions, bits):
    points = np.indices([1 << bits] * dimensions).reshape(dimensions, -1)
    index = sharding.hilbert_index(list(points), bits)
    assert sorted(index) == list(range(points.shape[1]))
    steps = np.abs(np.diff(points[:, np.argsort(index)], axis=1)).sum(0)
    assert (steps == 1).all()


def test_shards(spark, documents, messy, nothing, tmp_path):
    for docs in (documents, messy):
        got = sharding.hilbert_shards(docs, shards=8, carry=("doc_id", "text", "shard", "size") if docs is messy else ("doc_id", "text"))
        rows = got.collect()
        sizes = Counter(r["shard"] for r in rows)
        assert len(rows) == docs.count() and set(sizes) == set(range(8)) and max(sizes.values()) - min(sizes.values()) <= 1
        for shard, n in sizes.items():
            assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(n))
        for r in rows:
            raw = (r["text"] or "").encode()
            assert (r["size"], r["text_crc32"]) == (len(raw) + 16, zlib.crc32(raw))
    few = sharding.hilbert_shards(documents.limit(3), shards=8).collect()
    assert [r["slot"] for r in few] == [0, 0, 0] and len({r["shard"] for r in few}) == 3
    assert sharding.hilbert_shards(nothing).count() == 0
    manifest = sharding.write_shards(documents, str(tmp_path / "s"), shards=8).collect()
    assert sum(r["n_rows"] for r in manifest) == documents.count()
    spread = np.mean([int(r["max_source"][3:]) - int(r["min_source"][3:]) for r in manifest])
    assert spread < 2.5  # of 3, were rows dealt out at random
    with pytest.raises(ValueError):
        sharding.hilbert_shards(documents, bits=8)


def test_shards_by_sources_that_begin_alike(spark):
    rows = [(i, f"text {i}", "en", f"https://site.org/{'abcd'[i % 4]}" if i % 9 else None, 5) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(3)
    got = sharding.hilbert_shards(docs, shards=5, carry=("source",)).collect()
    cells = {}
    for r in got:
        cells.setdefault(r["source"], set()).add(r["curve"])
    assert len(got) == 200 and len(cells) == 5 and all(len(c) == 1 for c in cells.values())
    assert len(set().union(*cells.values())) == 5
    points = sharding.text_quantiles(docs.where("source IS NOT NULL"), "source", 3)
    values = sorted(r[3] for r in rows if r[3])
    assert sorted(points) == [values[-(-i * len(values) // 8) - 1] for i in range(1, 8)]


# --- line dedup


def test_line_dedup(spark, corpus, documents, messy, nothing):
    got = {r["doc_id"]: r for r in line_dedup.dedup_lines(documents).collect()}
    for (doc, text), want in zip(corpus, kept_lines(corpus), strict=True):
        row = got[doc]
        assert (row["n_lines"], row["n_dropped"], row["text"] or "") == want
        assert (row["text"] is None) == (text is None)
    assert sum(r["n_dropped"] for r in got.values()) > 20
    kept = line_dedup.dedup_lines(messy)
    assert kept.columns == [*messy.columns, "n_dropped"]
    rows = [(r["doc_id"], r["text"]) for r in pick(messy, "doc_id", "text").collect()]
    as_one = [(-1 if d is None else d, t) for d, t in rows]
    want = Counter((d, *k) for (d, _), k in zip(rows, kept_lines(as_one), strict=True))
    found = pick(kept, "doc_id", "n_lines", "n_dropped", "text").collect()
    assert Counter((r[0], r[1], r[2], r[3] or "") for r in found) == want
    assert line_dedup.dedup_lines(nothing).count() == 0


# --- Jaccard join


def test_small_tables_are_few_files(spark, documents, monkeypatch):
    """With very many shuffle partitions a small graph is no crowd of tasks and files."""
    from docvault.llm import minhash

    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = spark.sparkContext.defaultParallelism
        path = spark.range(1, 200).selectExpr("id AS a", "id + 1 AS b")
        found = contraction.components(path)
        assert len(found.inputFiles()) <= tasks and {r["component"] for r in found.collect()} == {1}
        written = []
        keep = lambda rows, name, tasks=None: written.append((name, stored(rows, name, tasks))) or written[-1][1]
        monkeypatch.setattr(minhash, "stored", keep)
        minhash.near_duplicates(documents).collect()
        assert {name: len(t.inputFiles()) for name, t in written if name in ("sets", "buckets", "agreeing", "wanted", "links") and len(t.inputFiles()) > tasks} == {}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(170)] + [(i, i + 1) for i in range(400, 460)] + [(7, 7)]
    found = contraction.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    touched = {x for a, b in edges for x in (a, b) if a != b}
    assert {r["node"]: r["component"] for r in found} == {x: root(x) for x in touched} and len(found) == len(touched)


def test_jaccard(corpus, documents, messy, nothing):
    want = components(corpus)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_components(documents).collect()}
    assert got == want and len({c for _, c in want.values()}) < len(want) - 10
    rows = jaccard_join.jaccard_components(messy).collect()
    assert len(rows) == messy.count()
    for r in rows:
        if r["doc_id"] is None:
            assert r["component_id"] is None
        else:
            assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]]
    assert jaccard_join.jaccard_components(nothing).count() == 0
    kept = jaccard_join.one_of_each(messy)
    assert kept.columns == messy.columns
    ids = [r[0] for r in kept.select("doc_id").collect()]
    assert sorted(i for i in ids if i is not None) == sorted(d for d, (_, c) in want.items() if d == c)


def test_jaccard_at_the_threshold_and_in_a_hot_group(spark, monkeypatch):
    """Chains of near copies around 0.75, with tokens that count as frequent."""
    monkeypatch.setattr(jaccard_join, "MARGIN", 2)
    rng = random.Random(8)
    base = [f"b{i}" for i in range(60)]
    rows = []
    for i in range(150):
        own = list(base)
        for _ in range(rng.randint(0, 4)):
            own[rng.randrange(60)] = f"u{rng.randint(0, 30)}"
        rows.append((i, " ".join(own[rng.randint(0, 6) : rng.randint(50, 60)])))
    want = components(rows)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_components(docs).collect()}
    assert got == want and len({c for _, c in want.values()}) > 3


def block(token, *sets):
    """Rows of a group's block: sets of 20 with these shared tokens, one in each component."""
    names = list(range(7, 7 + len(sets)))
    return pd.DataFrame({
        "token": token, "kind": 1, "i": 0, "j": 0, "left": True, "sid": names, "component": names, "n": 20,
        "spot": [list(s).index(token) for s in sets], "shared": [np.array(s, np.int64) for s in sets],
    })


def test_tokens_with_the_same_half_lose_no_pair():
    """Two sets of 20 that may link with 4 common tokens in the prefixes, not with 3."""
    high = 1 << 32
    for shared, pairs in (([1, 2, 3, 4], 1), ([1, high + 1, 2, 3], 1), ([1, high + 1, 2 * high + 1, 3 * high + 1], 1), ([1, 2, 3], 0), ([1, high + 1, 2], 0)):
        assert len(jaccard_join.block_pairs(block(1, shared, shared))) == pairs


def test_a_pair_comes_out_at_its_first_common_token_only(monkeypatch):
    sets = [1, 2, 3, 4, 5], [1, 2, 3, 4, 5], [9, 2, 3, 4, 5]
    for columns in (4096, 2):
        monkeypatch.setattr(jaccard_join, "COLUMNS", columns)
        found = {t: {tuple(p) for p in jaccard_join.block_pairs(block(t, *[s for s in sets if t in s])).values.tolist()} for t in (1, 2, 3)}
        assert found == {1: {(7, 8)}, 2: {(7, 9), (8, 9)}, 3: set()}


def test_further_orders_drop_pairs_and_no_link():
    rng = np.random.default_rng(3)
    dropped = 0
    for _ in range(600):
        n = int(rng.integers(30, 120))
        tokens = rng.integers(0, 2**63, 2 * n + 80).astype(np.uint64)
        cut, more = int(rng.integers(0, n)), int(rng.integers(0, n // 3 + 1))
        a, b = np.unique(tokens[:n]), np.unique(tokens[cut : cut + n + more])  # sizes that may link
        allowed = jaccard_join.orders_allow(jaccard_join.order_marks(a), jaccard_join.order_marks(b))
        assert allowed or not jaccard_join.linked(a, b)
        dropped += not allowed
    assert dropped > 100


def test_table_of_shared_tokens(spark, monkeypatch):
    """Tokens of several sets go behind those of one, copies do not count, and links stay when cells are few."""
    common = " ".join(f"c{i}" for i in range(30))
    rows = [(i, " ".join(f"d{i}x{j}" for j in range(10)) + " " + common) for i in range(40)] + [(100 + i, "copy " * 3 + "of one text here") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    level = np.zeros(jaccard_join.CELLS, np.uint64)
    table = jaccard_join.token_table(docs, level)
    cell = lambda text: table[(jaccard_join.token_set(text.encode()) & np.uint64(len(table) - 1)).astype(np.int64)]
    assert (cell(common) >= 3).sum() >= 5 and cell(rows[-1][1]).max() <= 1
    monkeypatch.setattr(jaccard_join, "MOST_TOKEN_CELLS", 64)
    monkeypatch.setattr(jaccard_join, "TABLE_CHUNK", 32)
    assert len(jaccard_join.token_table(docs, level)) <= 64
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.jaccard_components(docs).collect()}
    assert got == {d: c for d, (_, c) in components(rows).items()}


# --- decontamination


def passages(rng):
    vocabulary = [f"v{i}" for i in range(2000)]
    return [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(8, 60))) for _ in range(30)], vocabulary


def test_leaks(spark, messy, nothing):
    rng = random.Random(6)
    items, vocabulary = passages(rng)
    texts = []
    for i in range(160):
        own = [rng.choice(vocabulary) for _ in range(rng.randint(0, 150))]
        if i % 2:
            passage = items[rng.randrange(30)].split()
            for _ in range(i % 4):
                passage[rng.randrange(len(passage))] = rng.choice(vocabulary)
            own[5:5] = [w.upper() if i % 5 == 0 else w for w in passage]
        texts.append(" ".join(own) if i % 40 != 39 else items[i % 30])
    texts += [None, "", items[0], "\n".join(items[1].split())]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    bench = spark.createDataFrame([*enumerate(items), (30, None), (31, ""), (32, items[2])], "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in decontamination.find_leaks(docs, bench).collect()}
    want = {}
    for d, text in enumerate(texts):
        for i, item in [*enumerate(items), (32, items[2])]:
            if text and (s := best_similarity(text, item)) >= 0.75:
                want[d, i] = s
    assert got.keys() <= want.keys() and len(want) > 30
    assert len(got) >= 0.97 * len(want)
    assert all(abs(got[k] - want[k]) < 1e-9 for k in got)
    exact = [k for k, s in want.items() if s == 1]
    assert exact and all(k in got for k in exact)
    assert decontamination.find_leaks(nothing, bench).count() == 0
    assert decontamination.find_leaks(docs, bench.where("false")).columns == ["doc_id", "item_id", "similarity", "first_word", "n_words"]
    clean = decontamination.decontaminate(docs, bench)
    assert {r["doc_id"] for r in clean.collect()} == set(range(len(texts))) - {d for d, _ in got}
    assert decontamination.decontaminate(messy, bench).columns == messy.columns


def test_leaks_in_very_long_texts_and_item_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_ITEMS", 7)
    monkeypatch.setattr(decontamination, "STRETCH", 500)
    rng = random.Random(9)
    items, vocabulary = passages(rng)
    items.append(" ".join(rng.choice(vocabulary) for _ in range(300)))
    own = [rng.choice(vocabulary) for _ in range(8000)]
    for item, at in zip(items, range(100, 7900, 250), strict=False):
        own[-at:-at] = item.split()
    docs = spark.createDataFrame([(1, " ".join(own))], "doc_id bigint, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    got = {r["item_id"]: r["similarity"] for r in decontamination.find_leaks(docs, bench).collect()}
    assert got == dict.fromkeys(range(len(items)), 1.0)


def test_no_near_copy_is_lost():
    """Copies with words replaced and edges cut, items of many sizes, common words."""
    rng = random.Random(12)
    vocabulary = [f"v{int(300 * rng.random() ** 3)}" for _ in range(3000)]
    items = [[rng.choice(vocabulary) for _ in range(n)] for n in [*range(15, 60, 2), 100, 111, 200, 222]]
    texts = []
    for i in range(500):
        copy = list(items[i % len(items)])
        for _ in range(rng.randint(0, max(1, len(copy) // 40))):
            copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
        cut = copy[rng.randint(0, len(copy) // 12) :]
        own = [rng.choice(vocabulary) for _ in range(rng.choice([0, 40, 120]))]
        texts.append(own[:60] + cut + own[60:])
    want = {}
    for t, text in enumerate(texts):
        for i, item in enumerate(items):
            if abs(t % len(items) - i) <= 2 and (s := best_similarity(" ".join(text), " ".join(item))) >= 0.75:
                want[t, i] = s
    block = decontamination.Items([(i, [w.encode() for w in item]) for i, item in enumerate(items)])
    hashes = [task_words.hashed([w.encode() for w in text]) for text in texts]
    got = decontamination.find_items(hashes, block, 0.75, decontamination.Buffers())
    assert len(want) > 300 and len(set(want.values())) > 20
    assert {k: round(v[0], 9) for k, v in got.items()} == {k: round(v, 9) for k, v in want.items()}


def test_items_of_few_words():
    items = ["one", "two words", "now three words", "here are four words", "and here are five words"]
    texts = [f"some text before {i} and some behind it" for i in items] + items + ["two one words", "words", "two", "ONE\tone"]
    block = decontamination.Items([(i, task_words.words(item.encode())) for i, item in enumerate(items)])
    hashes = [task_words.hashed(task_words.words(text.encode())) for text in texts]
    got = decontamination.find_items(hashes, block, 0.75, decontamination.Buffers())
    want = {(t, i): 1.0 for t, text in enumerate(texts) for i, item in enumerate(items) if best_similarity(text, item) == 1}
    assert {k: v[0] for k, v in got.items()} == want
    assert [got[i, i][1:] for i in range(5)] == [(3, n) for n in range(1, 6)]


def test_every_near_fingerprint_is_found():
    rng = np.random.default_rng(1)
    prints = rng.integers(0, 2**63, 40).astype(np.uint64)
    marked = decontamination.block_tables(prints, 11)
    for p in prints:
        for _ in range(50):
            near = p
            for bit in rng.choice(64, 11, replace=False):
                near ^= np.uint64(1) << np.uint64(bit)
            blocks = np.array([near], "<u8").view("<u2")
            assert any(marked[b][blocks[b]] for b in range(4))


# --- packing


def test_ids_are_the_tokenizers_own(spark, corpus, messy):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    odd = [
        "it's 'sword don't!! a.b, c., \"quoted.\" x--y 12ab 3.14 ÀÉ é ́x ﬁ ΣΑΣ İ",
        "tab\tand nbsp em\x1c\x85\r\nline", "THE\n\n  end.  ", "日本語 テキスト", "<|endoftext|> a<|startoftext|>.", "😀👍🏽,", "'s 't", "a'.s",
        "Été, ÀÖØÞßÿ. Ĳssel ŁÓDŹ! ʼn İstanbul ıssız Ǆ ǅ ǈ Ж, ЁЛКА. Џ ѐ cafe\u0301 e\u0301t ſt K ªº µ",
    ]
    rows = [*corpus, *enumerate(odd, 1000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {}
    for r in packing.token_pieces(docs, TOKENIZER, capacity=64, with_ids=True).orderBy("doc_id", "piece").collect():
        assert r["start"] == len(got.get(r["doc_id"], [])) and r["length"] == len(r["ids"])
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        got[r["doc_id"]] = got.get(r["doc_id"], []) + r["ids"]
    for doc, text in rows:
        assert got[doc] == [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], text


def check_placed(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by)


def test_packing(spark, messy, nothing):
    packed = packing.pack_documents(messy, TOKENIZER, capacity=128)
    rows = packed.collect()
    pieces = packing.token_pieces(messy, TOKENIZER, capacity=128).collect()
    key = lambda r: tuple(str(r[c]) for c in ("doc_id", "piece", "start", "length", "ids_crc32"))
    assert Counter(map(key, rows)) == Counter(map(key, pieces))
    sequences = check_placed(rows, 128)
    assert sequences <= 1.02 * sum(r["length"] for r in rows) / 128 + 1
    assert packing.pack_documents(nothing, TOKENIZER).count() == 0
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([(1, 0, 300)], "doc_id bigint, piece int, length bigint"), 128)


def plain_best_fit(sizes, capacity):
    """Best fit decreasing, one piece after the other; how many bins."""
    rooms, bins = [], 0
    for size in sorted(sizes, reverse=True):
        at = bisect_left(rooms, size)
        if at < len(rooms):
            room = rooms.pop(at)
        else:
            room, bins = capacity, bins + 1
        insort(rooms, room - size)
    return bins


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_any_tokenizer_gives_its_own_ids(corpus, name):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    known = packing.WordIds(tokenizer)
    assert known.by_words == (name == "word_bpe_49k.json")
    texts = [t for _, t in corpus]
    for text, ids in zip(texts, packing.many_text_ids(texts, known, 1), strict=True):
        assert ids == packing.as_bytes([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1])


def test_words_are_learnt_when_first_asked_for(monkeypatch):
    from tokenizers import Tokenizer

    known = packing.WordIds(Tokenizer.from_file(TOKENIZER))
    for word in ("Plain", "ÉTÉ,", "don't!", "x2", "...", "Ende\"!?)]};:.,", "", "日本"):
        assert known[word] == known.whole(word)
    monkeypatch.setattr(packing, "CACHED_WORDS", 20)
    text = " ".join(f"Word{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]}, x{i}" for i in range(100))
    assert packing.text_ids(text, known, 1) == known.whole(text) + packing.as_bytes([1])
    assert packing.text_ids("one", known, 1) == packing.as_bytes([*known.tokenizer.encode("one").ids, 1]) and len(known) == 1


def test_texts_longer_than_a_slice(corpus, monkeypatch):
    from tokenizers import Tokenizer

    texts = [t for _, t in corpus]
    known = packing.WordIds(Tokenizer.from_file(TOKENIZER))
    want = list(packing.many_text_ids(texts, known, 1))
    monkeypatch.setattr(packing, "SLICE", 100)
    assert list(packing.many_text_ids(texts, known, 1)) == want == [packing.text_ids(t, known, 1) for t in texts]


@pytest.mark.parametrize("part", [500, 50_000])
def test_hot_length(spark, monkeypatch, part):
    monkeypatch.setattr(packing, "PART_PIECES", part)
    pieces = spark.range(0, 30_000, 1, 4).select(
        F.col("id").alias("doc_id"), F.lit(0).alias("piece"), F.when(F.col("id") % 3 > 0, 40).otherwise(F.col("id") % 100 + 1).cast("bigint").alias("length"),
        F.lit("kept").alias("offset"),
    )
    rows = packing.pack(pieces, 100).collect()
    assert len(rows) == 30_000
    assert check_placed(rows, 100) <= plain_best_fit([r["length"] for r in rows], 100) * 1.001 + 1


def test_dominance_keeps_the_optimum():
    rng = random.Random(3)
    for _ in range(150):
        capacity = rng.choice([10, 20, 30])
        sizes = [rng.randint(1, capacity) for _ in range(rng.randint(1, 9))]
        supply = packing.Supply(Counter(sizes))
        fixed = packing.reduce_by_dominance(supply, capacity)
        taken = Counter()
        for lengths, n in fixed:
            assert sum(lengths) <= capacity and n > 0
            for w in lengths:
                taken[w] += n
        rest = Counter(sizes) - taken
        assert taken + rest == Counter(sizes) and Counter(supply.count) == rest
        left = fewest_bins(list(rest.elements()), capacity) if rest else 0
        assert sum(n for _, n in fixed) + left == fewest_bins(sizes, capacity), (capacity, sizes, fixed)


def test_placement_places_every_rank_once():
    rng = random.Random(5)
    counts = {rng.randint(1, 500): rng.randint(1, 4000) for _ in range(120)}
    runs, sequences = packing.placement(counts, 500)
    used = Counter()
    for w, n in counts.items():
        first, base, fit, offset = runs[w]
        ranks = np.arange(n)
        run = np.searchsorted(first, ranks, "right") - 1
        within = ranks - first[run]
        at = offset[run] + within % fit[run] * w
        for s, o in zip(base[run] + within // fit[run], at, strict=True):
            used[int(s)] += w
            assert o + w <= 500
    assert len(used) == sequences and max(used.values()) <= 500
    plain = plain_best_fit([w for w, n in counts.items() for _ in range(n)], 500)
    assert sequences <= 1.001 * plain + 1
