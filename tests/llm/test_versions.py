"""MinHash classes, the persistent Merkle manifest, conversation repair."""

import hashlib
import random
import re
import zlib
from itertools import product

import numpy as np
import pytest
from llm_data import corpus, documents, messy, nothing  # noqa: F401
from plain import UPPER, shingle_list
from pyspark.sql import functions as F

from docvault.llm import conversations, manifest, minhash, queries
from docvault.llm.frames import pick
from docvault.llm.jaccard_join import token_set

# --- MinHash ---


def classes(rows, percent=85):
    sets = {d: set(shingle_list(t)) for d, t in rows}
    reach = {d: {d} for d in sets}
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                union = reach[a] | reach[b]
                for x in union:
                    reach[x] = union
    return {d: (len(sets[d]), min(reach[d]), min(reach[d]) == d) for d in ids}


def test_minhash(corpus, documents, messy, nothing):
    want = classes(corpus)
    for table in (documents, messy):
        got = minhash.near_duplicates(table).collect()
        assert len(got) == table.count()
        for row in got:
            if row["doc_id"] is not None:
                assert tuple(row[1:]) == want[row["doc_id"]]
            else:
                assert row["component_id"] is None and row["kept"]
    assert minhash.near_duplicates(nothing).count() == 0


def test_minhash_of_large_groups_in_several_classes(spark, monkeypatch):
    """Buckets that are cut into blocks, with links that no pivot shows."""
    monkeypatch.setattr(minhash, "FEW", 3)
    monkeypatch.setattr(minhash, "BLOCK", 7)
    monkeypatch.setattr(minhash, "COLUMNS", 50)
    rng = random.Random(5)
    rows = []
    for group in range(3):
        base = [f"g{group}w{i}" for i in range(150)]
        for _ in range(45):
            text = base[:]
            for _ in range(rng.choice((1, 2, 3, 4))):
                text[rng.randrange(len(text))] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(text)))
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r[0]: tuple(r[1:]) for r in got} == classes(rows)


def test_signatures():
    rng = np.random.default_rng(3)
    family = minhash.hash_family()
    sets = [np.unique(rng.integers(0, 2**64, n, dtype=np.uint64)) for n in (1, 5, minhash.CHUNK + 3, 40, 2 * minhash.CHUNK)]
    together = minhash.set_minima(sets, family)
    for row, tokens in zip(together, sets, strict=True):
        codes = (tokens >> np.uint64(32)).astype(np.uint32)
        assert row.tolist() == [int((codes * a + b).min()) % 2**16 for a, b in zip(*family, strict=True)]
    # The share of agreeing minima is the similarity.
    base = np.unique(rng.integers(0, 2**64, 2000, dtype=np.uint64))
    x, y = minhash.set_minima([base[:1850], base[150:]], family)
    assert abs((x == y).mean() - 1700 / 2000) < 0.12
    assert 0.6 < minhash.least_agreement() / minhash.MINIMA < 0.75


def test_common_counts(monkeypatch):
    monkeypatch.setattr(minhash, "COLUMNS", 16)
    rng = np.random.default_rng(8)
    sets = [np.unique(rng.integers(0, 200, n)) for n in (0, 1, 30, 90, 120, 150, 7)]
    x, y = np.array([1, 3, 5, 0]), np.array([2, 4, 6])
    want = [[len(np.intersect1d(sets[i], sets[j])) for j in y] for i in x]
    assert minhash.common_counts(sets, x, y).tolist() == want


def test_every_link_at_the_threshold_is_a_candidate():
    """Of 400 pairs just at 85 percent each shares a band and passes the signature check."""
    rng = np.random.default_rng(4)
    family, width = minhash.hash_family(), minhash.ROWS
    for _ in range(400):
        n = int(rng.integers(20, 300))
        common = rng.integers(0, 2**64, -(-85 * n // 100), dtype=np.uint64)
        more = rng.integers(0, 2**64, n - len(common), dtype=np.uint64)
        half = len(more) // 2
        x, y = minhash.set_minima([np.concatenate([common, more[:half]]), np.concatenate([common, more[half:]])], family)
        same = x == y
        assert same.sum() >= minhash.least_agreement()
        assert same.reshape(-1, width).all(axis=1).any()


def test_few_words_link_as_one_shingle():
    assert len(token_set(b"Two words")) == 1 and len(token_set(b" ")) == 0


# --- Merkle manifest ---


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_manifest(rows):
    """rows of (doc_id, source, lang, n_chars, text) -> sorted result rows."""
    by_source = {}
    for row in rows:
        by_source.setdefault(row[1], []).append(row)

    def grow(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([sha(*levels[-1][i : i + 16]) for i in range(0, len(levels[-1]), 16)])
        return levels

    def way(levels, at):
        out = []
        for nodes in levels[:-1]:
            low = at - at % 16
            out.append((nodes[low:at], nodes[at + 1 : low + 16]))
            at //= 16
        return out

    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in order:
        own = sorted((r[0] is not None, r[0] or 0, sha(*map(field, r)), r) for r in by_source[source])
        trees[source] = (own, grow([x[2] for x in own]))
    top = grow([trees[s][1][-1][0] for s in order])
    root, out = top[-1][0], []
    for i, source in enumerate(order):
        own, levels = trees[source]
        for at, (_, _, leaf, row) in enumerate(own):
            steps = way(levels, at) + way(top, i)
            node = leaf
            changed = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
            if changed:
                node = sha(*map(field, (*row[:4], row[4].translate(UPPER) if row[4] is not None else None)))
            for left, right in steps:
                node = sha(*left, node, *right)
            proof = sha(*[x for left, right in steps for x in (*left, *right)])
            out.append((row[0], leaf, levels[-1][0], root, proof, node, node == root, len(steps) + 1 if changed else None))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def spark_manifest(docs):
    found = manifest.verified_versions(docs, queries.id_part(5) == 0, manifest.lower_cased(F.col("text")))
    return sorted((tuple(r) for r in found.select(*COLUMNS, F.size("copied")).collect()), key=str)


FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def test_manifest(documents, messy, nothing):
    for table in (documents, messy):
        rows = [tuple(r) for r in pick(table, *FIELDS).collect()]
        assert spark_manifest(table) == plain_manifest(rows)
    assert spark_manifest(nothing) == []


@pytest.mark.parametrize("block_levels", [1, 2])
def test_manifest_of_many_levels(spark, monkeypatch, block_levels):
    """Levels above the blocks, a hot source, more sources than a node has children, null and empty."""
    monkeypatch.setattr(manifest, "BLOCK_LEVELS", block_levels)
    monkeypatch.setattr(manifest, "BLOCK", 16**block_levels)
    rows = [(i, "hot", "en", i, f"Text {i}") for i in range(16 * 16 + 18)]
    rows += [(1000 + i, f"s{i % 20}", None, None, f"Other {i}") for i in range(57)]
    rows += [(2000, None, "", 0, None), (2001, "", "de", -1, "ÄÖ A"), (None, "é", "de", 1, "X"), (-5, "hot", None, None, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string").repartition(5)
    monkeypatch.setattr(manifest, "levels_of", lambda n, most=block_levels, f=manifest.levels_of: f(n, most))
    assert spark_manifest(docs) == plain_manifest(rows)


def test_version_shares_all_but_its_path():
    leaves = [sha(str(i)).encode() for i in range(300)]
    tree = manifest.built(leaves, 3)
    path = list(manifest.siblings(tree, 77))
    assert manifest.version(leaves[77], path) == [leaves[77], tree[1][4], tree[2][0], tree[3][0]]
    changed = [*leaves[:77], b"new", *leaves[78:]]
    own, other = manifest.version(b"new", path), manifest.built(changed, 3)
    assert own == [b"new", other[1][4], other[2][0], other[3][0]]
    assert sum(x != y for a, b in zip(tree, other, strict=True) for x, y in zip(a, b, strict=True)) == len(own)


# --- conversations ---


def best_edits(rows):
    """(cost, audit, lines) of rows (fault, role, text), by whole suffixes."""
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    names = {"u": "user", "a": "assistant"}
    best = {s: (0, "", []) for s in ("", "a")}

    def with_insertions(table):
        for _ in range(4):
            for s, r in (("", "u"), ("s", "u"), ("u", "a"), ("a", "u")):
                if r in table:
                    cost, audit, lines = table[r]
                    new = (cost + 5, "I" + audit, [f"{names[r]}:", *lines])
                    table[s] = min(table.get(s, new), new, key=lambda x: x[:2])
        return table

    best = with_insertions(best)
    for fault, role, text in reversed(rows):
        table = {}
        for s in ("", "s", "u", "a"):
            ways = []
            if s in best:
                ways.append((best[s][0] + 2, "D" + best[s][1], best[s][2]))
            if fault not in ("blank", "duplicate"):
                extra = 5 if fault == "truncated" else 0
                if role and (t := after.get((s, role[0]))) in best:
                    ways.append((best[t][0] + extra, "K" + best[t][1], [f"{role}:{text}", *best[t][2]]))
                for r in "ua":
                    if (t := after.get((s, r))) in best:
                        ways.append((best[t][0] + extra + 1, "R" + best[t][1], [f"{names[r]}:{text}", *best[t][2]]))
            if ways:
                table[s] = min(ways, key=lambda x: x[:2])
        best = with_insertions(table)
    return best[""]


def plain_repairs(rows):
    """conv_id -> result of rows (conv_id, turn, role, text)."""
    held = {conv: [] for conv, *_ in rows}
    for conv, turn, role, text in rows:
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        code = zlib.crc32(name.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        held[conv] += [(turn, "user" if code == 4 else role, text)] * {0: 0, 3: 2}.get(code, 1)
    out = {}
    for conv, own in held.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0))  # the fixtures have no other ties
        seen, marked, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0, None: 0}
        for _, role, text in own:
            visible = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not visible else "duplicate" if (role, text) in seen else "truncated" if visible[-1] not in ".!?" else None
            seen.add((role, text))
            counts[fault] += 1
            marked.append((fault, role, text))
        illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(own, own[1:], strict=False))
        turns = {t for t, _, _ in own if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        cost, audit, lines = best_edits(marked)
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, digest)
    return out


def chats(seed, count, longest):
    rng = random.Random(seed)
    rows = []
    for conv in range(count):
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "", "User"])
            text = rng.choice([f"Hello {rng.randrange(30)}.", "Same answer!", "cut off", " \t", "", None, "Really?\n", "ends é"])
            rows.append((conv if conv else None, None if turn == 0 and conv % 7 == 0 else turn * (1 + (rng.random() < 0.1)), role, text))
    unique = {}
    for row in rows:
        unique.setdefault(row[:2], row)
    return list(unique.values())


CHAT = "conv_id bigint, turn bigint, role string, text string"


@pytest.mark.parametrize("segment", [4096, 4])
def test_repair(spark, monkeypatch, segment):
    """Against whole suffixes; with small segments, longer conversations are repaired in parts."""
    monkeypatch.setattr(conversations, "SEGMENT", segment)
    rows = chats(9, 60, 14)
    table = spark.createDataFrame(rows, CHAT).withColumn("text2", F.lit(1)).withColumn("h1", F.lit("x")).repartition(3)
    got = {r["conv_id"]: tuple(r)[1:] for r in conversations.repair_damaged(table).collect()}
    assert got == plain_repairs(rows)


def test_repair_on_nothing_and_on_lost_rows(spark):
    assert conversations.repair_damaged(spark.createDataFrame([], CHAT)).count() == 0
    lost = next((c, t) for c, t in product(range(50), range(50)) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0)
    row = conversations.repair_damaged(spark.createDataFrame([(*lost, "user", "a")], CHAT)).first()
    assert tuple(row) == (lost[0], 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_repaired_turns_are_legal_and_repeat_the_digest(spark):
    rows = conversations.damaged(spark.createDataFrame(chats(3, 30, 9), CHAT))
    turns, digests = conversations.repair(rows)
    held = {}
    for r in sorted(turns.collect(), key=lambda r: (r["conv_id"] or 0, r["place"])):
        held.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    for r in digests.collect():
        own = held.get(r["conv_id"], [])
        assert re.fullmatch("(s?(ua)+)?", "".join(role[0] for role, _ in own))
        assert hashlib.sha256("\n".join(f"{a}:{b}" for a, b in own).encode()).hexdigest() == r["repaired_sha256"]


def test_audits_of_all_short_conversations():
    """Hirschberg's way equals the search over whole audits for every sequence of up to four kinds."""
    faults = {**{k: None for k in conversations.INITIALS}, **{k: "truncated" for k in conversations.CUT}, "1": "blank"}
    for n in range(5):
        for kinds in product("suaoSUA1", repeat=n):
            rows = [(faults[k], "blank" if k == "1" else k.lower(), "") for k in kinds]
            assert conversations.audit_of("".join(kinds)) == best_edits(rows)[:2], kinds


def test_segments_give_the_same_audit():
    rng = random.Random(2)
    for _ in range(150):
        kinds = "".join(rng.choice("suauauaoSUA1234") for _ in range(rng.randint(1, 60)))
        cuts = [kinds[i : i + 9] for i in range(0, len(kinds), 9)]
        steps = [*map(conversations.segment_step, cuts), conversations.step("")]
        cost, end = conversations.best_end(steps)
        states = conversations.crossings(steps, conversations.START, end)
        pieces = [conversations.segment_audit(k, *states[i : i + 2]) for i, k in enumerate(cuts)]
        assert (cost, "".join(pieces) + conversations.written(steps[-1:], states[-2:])) == conversations.audit_of(kinds)


def test_a_long_conversation_needs_no_recursion():
    kinds = "suauauauSUA1" * 300
    cost, audit = conversations.audit_of(kinds)
    assert cost > 0 and len(audit) >= len(kinds)


def test_copied_only_where_changed(documents):
    found = manifest.verified_versions(documents, F.col("doc_id") == 12, F.lit("other"))
    rows = {r["doc_id"]: r for r in found.collect()}
    assert not rows[12]["verified"] and rows[12]["copied"][-1] == rows[12]["folded_root"]
    assert all(r["verified"] and r["copied"] is None for d, r in rows.items() if d != 12)
