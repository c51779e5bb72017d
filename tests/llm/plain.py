"""Plain versions of the operators for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(UPPER)) if w]


def shingle_list(text, k=5):
    found = words(text)
    if not found:
        return []
    return [tuple(found[i : i + k]) for i in range(max(1, len(found) - k + 1))]


def components(rows):
    """doc_id -> component of (doc_id, text) rows, all pairs compared."""
    sets = {d: set(shingle_list(t)) for d, t in rows}
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {d: (len(sets[d]), root(d)) for d in ids}


def line_key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(UPPER)


def kept_lines(rows, min_chars=20, min_docs=3):
    """(doc_id, text) rows -> (n_lines, n_dropped, kept text) in the order of the rows."""
    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            holders[line_key(line)].add(doc)
    keeper = {k: max(d) for k, d in holders.items() if len(k) >= min_chars and len(d) >= min_docs}
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        stay = [x for x in lines if keeper.get(line_key(x), doc) == doc]
        out.append((len(lines), len(lines) - len(stay), "\n".join(stay)))
    return out


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def best_similarity(text, item):
    """The greatest weighted shingle similarity of a window of the item's size."""
    wanted = Counter(shingle_list(item))
    found, size = words(text), len(words(item))
    best = 0.0
    for start in range(max(1, len(found) - size + 1)):
        window = Counter(shingle_list(" ".join(found[start : start + size])))
        common = (window & wanted).total()
        best = max(best, common / max(1, (window | wanted).total()))
    return best


def fewest_bins(sizes, capacity):
    """The least number of bins, by trying everything."""
    sizes = sorted(sizes, reverse=True)
    best = len(sizes)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(sizes):
            best = len(rooms)
            return
        for room in sorted(set(rooms)):
            if room >= sizes[i]:
                rooms.remove(room)
                rooms.append(room - sizes[i])
                place(i + 1, rooms)
                rooms.remove(room - sizes[i])
                rooms.append(room)
        place(i + 1, [*rooms, capacity - sizes[i]])

    place(0, [])
    return best
