"""Words, word hashes and word shingles inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

STEP = np.uint64(0x9E3779B97F4A7C15)
#: An odd multiplier for each place in a shingle.
PLACES = np.array([pow(0x9E3779B97F4A7C15, i, 2**64) for i in range(1, 33)], np.uint64)


def words(text: bytes | None) -> list[bytes]:
    """Runs without ASCII white space, A-Z in lower case; null has none.

    bytes.lower and bytes.split know ASCII only: the white space is x20 and x09 to x0D.
    """
    return text.lower().split() if text else []


def hashed(found: list[bytes]) -> np.ndarray:
    """A 64-bit hash for each word."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection on 64-bit numbers; each salt gives another order."""
    x = x + np.uint64((salt * 0xD1B54A32D192ED03 + 0x632BE59BD9B4E019) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(codes: np.ndarray, k: int = 5) -> np.ndarray:
    """Hashes of the k-word shingles in order; fewer than k words are one shingle, none are none.

    A sum of the words' hashes, each times the number of its place, mixed once.
    """
    n = len(codes)
    if n == 0:
        return codes
    size = min(n, k)
    value = codes[: n - size + 1] * PLACES[0]
    for i in range(1, size):
        value += codes[i : n - size + 1 + i] * PLACES[i % len(PLACES)]
    return mixed(value, salt=k - size)


def column_bytes(batch, name: str) -> list:
    """A text column of an Arrow batch as UTF-8 bytes."""
    return batch.column(name).cast("binary").to_pylist()
