"""Quality classifier: hashed word and character n-gram vectors, averaged, with a softmax on top."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docvault.llm.frames import pick

#: Hash buckets of the words, and of the character n-grams.
WORD_BUCKETS = GRAM_BUCKETS = 1 << 15
GRAMS = (2, 3, 4)
DIM = 16
#: At most so many labelled documents are used for training, those with the smallest id hashes.
TRAINING_ROWS = 4000
EPOCHS = 8
RATE = 0.4
CACHED_WORDS = 300_000
#: Scores from here on count as label 1.
THRESHOLD = 0.3


class WordBuckets(dict):
    """Word to bucket, remembered for the words seen last."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = zlib.crc32(word) % WORD_BUCKETS
        return value


def features(text: bytes, known: WordBuckets) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and weights of a text: words weigh half, n-grams of its bytes the other half."""
    words = text.split()
    counts = np.zeros(WORD_BUCKETS + GRAM_BUCKETS)
    if words:
        found = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        counts[:WORD_BUCKETS] = np.bincount(found, minlength=WORD_BUCKETS) * (0.5 / len(words))
    codes = np.frombuffer(text, np.uint8).astype(np.uint32)
    grams = []
    value = codes
    for n in range(2, max(GRAMS) + 1):
        if len(codes) < n:
            break
        value = value[:-1] * np.uint32(0x01000193) ^ codes[n - 1 :]
        if n in GRAMS:
            grams.append((value * np.uint32(0x9E3779B1) + np.uint32(n * 0x85EBCA6B % 2**32)) * np.uint32(0xC2B2AE35) >> np.uint32(17))
    if grams:
        found = np.concatenate(grams).astype(np.int64)
        counts[WORD_BUCKETS:] = np.bincount(found, minlength=GRAM_BUCKETS) * (0.5 / len(found))
    at = np.flatnonzero(counts)
    return at, counts[at]


class Model:
    """Vectors of the buckets, and the softmax layer over their weighted mean."""

    def __init__(self, vectors: np.ndarray, weights: np.ndarray, bias: np.ndarray):
        self.vectors, self.weights, self.bias = vectors, weights, bias

    def score(self, at: np.ndarray, share: np.ndarray) -> float:
        """The probability of label 1."""
        logits = (share @ self.vectors[at]) @ self.weights + self.bias
        return float(1 / (1 + np.exp(np.clip(logits[0] - logits[1], -50, 50))))


def train(examples: list[tuple[np.ndarray, np.ndarray, int]], seed: int = 7) -> Model:
    """Stochastic gradient descent with a falling rate; one class only, or none, gives its share."""
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 0.3, (WORD_BUCKETS + GRAM_BUCKETS, DIM)).astype(np.float32)
    weights = np.zeros((DIM, 2), np.float32)
    ones = sum(label for _, _, label in examples)
    prior = (ones + 1) / (len(examples) + 2)
    bias = np.log(np.array([1 - prior, prior], np.float32))
    steps, step = EPOCHS * len(examples), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(examples)):
            at, share, label = examples[i]
            rate = RATE * (1 - step / steps)
            step += 1
            if not len(at):
                continue
            hidden = share @ vectors[at]
            logits = hidden @ weights + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[label] -= 1
            back = weights @ p
            weights -= rate * np.outer(hidden, p)
            bias -= 0.1 * rate * p
            # The shares of a text are small, so its vectors move with a larger rate.
            vectors[at] -= (rate * 50) * np.outer(share, back)
    return Model(vectors, weights, bias)


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> DataFrame:
    """At most `rows` labelled documents, `text` and `quality` (0 or 1), by the hash of the id.

    Rows without id, text or label are left out; of several labels of a document the greatest
    holds.
    """
    marked = pick(labels, "doc_id", "quality").where("doc_id IS NOT NULL AND quality IN (0, 1)")
    marked = marked.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    chosen = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = pick(docs, "doc_id", "text").where("text IS NOT NULL")
    return texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> Model:
    """Train on a bounded sample (see `training_rows`); texts become bucket counts in the tasks."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordBuckets()
        for batch in batches:
            at, share = [], []
            for text in batch.column("text").cast("binary").to_pylist():
                a, s = features(text, known)
                at.append(a.astype(np.int32).tobytes())
                share.append(s.astype(np.float32).tobytes())
            arrays = [batch.column("doc_id"), batch.column("quality"), pa.array(at, pa.binary()), pa.array(share, pa.binary())]
            yield pa.record_batch(arrays, names=["doc_id", "quality", "at", "share"])

    found = training_rows(docs, labels, rows).mapInArrow(extract, "doc_id bigint, quality int, at binary, share binary")
    examples = [
        (r["doc_id"], np.frombuffer(r["at"], np.int32), np.frombuffer(r["share"], np.float32), r["quality"])
        for r in found.toLocalIterator()
    ]
    return train([e[1:] for e in sorted(examples, key=lambda e: e[0])])


def score(docs: DataFrame, model: Model, *carry: str) -> DataFrame:
    """The columns `carry` of `docs`, `score` (0 to 1, higher: label 1 likelier) and `predicted`.

    Whole texts are scored. A null or empty text gets the score of no evidence. Other columns
    of the input play no part; carried columns named `score` or `predicted` are replaced.
    No rows give no rows.
    """
    kept = [n for n in carry if n not in ("score", "predicted")]
    at = {name: f"c{i}" for i, name in enumerate(docs.columns)}
    rows = docs.toDF(*at.values())  # names of the input that differ in case only are no trouble
    shared = docs.sparkSession.sparkContext.broadcast((model.vectors, model.weights, model.bias))  # fixed size, 4 MB

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own, known = Model(*shared.value), WordBuckets()
        for texts in batches:
            yield pd.Series([own.score(*features((t or "").encode(), known)) for t in texts], dtype=float)

    scored = rows.select(*[at[n] for n in kept], run(F.col(at["text"])).alias("score"))
    return scored.select(
        *[F.col(at[n]).alias(n) for n in kept], "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
