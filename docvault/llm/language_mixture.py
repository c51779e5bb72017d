"""Language proportions of documents by expectation-maximisation over n-gram likelihoods."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docvault.llm.frames import pick

#: Hash buckets of the character trigrams.
BUCKETS = 1 << 14
#: Added to every count, as a share of the counts if all buckets were alike.
SMOOTHING = 0.5
ROUNDS = 12
#: A language below this share of a document is not considered further.
LEAST_SHARE = 0.01
UNKNOWN = "und"


def trigram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The trigram buckets of a text and how often each occurs.

    Characters are lower-cased; what is no letter counts as one kind of gap, and trigrams
    without a letter are left out.
    """
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    codes = np.where((codes >= 97) & (codes <= 122) | (codes >= 170) & (codes != 215) & (codes != 247), codes, 0)
    codes = np.concatenate(([0], codes, [0])).astype(np.uint64)
    if len(codes) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    a, b, c = codes[:-2], codes[1:-1], codes[2:]
    mixed = (a * np.uint64(0x9E3779B97F4A7C15)) ^ (b * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (c * np.uint64(0x165667B19E3779F9))
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    buckets = (mixed >> np.uint64(50))[(a | b | c) > 0].astype(np.int64)
    counts = np.bincount(buckets, minlength=BUCKETS)
    found = np.flatnonzero(counts)
    return found, counts[found]


def learn(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """The languages and log probabilities (language x bucket) from all rows with text and lang.

    Each task adds up its rows, languages x BUCKETS numbers at most; the sums over the tasks are
    a table of that size too, which is what the driver gets.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
                found, counts = trigram_counts(text)
                own = sums.setdefault(lang, np.zeros(BUCKETS, np.int64))
                own[found] += counts
        for lang, own in sums.items():
            found = np.flatnonzero(own)
            langs = pa.array([lang] * len(found), pa.string())
            yield pa.record_batch([langs, pa.array(found), pa.array(own[found])], names=["lang", "bucket", "n"])

    rows = pick(docs, "text", "lang").where("text IS NOT NULL AND lang IS NOT NULL")
    counted = rows.mapInArrow(count, "lang string, bucket bigint, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    sums = counted.groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("counts"))  # BUCKETS each at most
    found = sorted((r["lang"], r["counts"]) for r in sums.toLocalIterator())
    table = np.zeros((len(found), BUCKETS))
    for i, (_, counts) in enumerate(found):
        for bucket, n in counts:
            table[i, bucket] = n
    table += SMOOTHING * np.maximum(table.sum(1, keepdims=True), 1) / BUCKETS * 0.02 + 1e-3
    return [lang for lang, _ in found], np.log(table / table.sum(1, keepdims=True))


def fit_mixture(likelihood: np.ndarray, counts: np.ndarray, shares: np.ndarray) -> tuple[np.ndarray, float]:
    """Maximum-likelihood shares of the languages (rows of likelihood), and the log likelihood."""
    total = counts.sum()
    for _ in range(ROUNDS):
        joint = shares @ likelihood
        new = shares * (likelihood @ (counts / joint)) / total
        done = np.abs(new - shares).max() < 1e-4
        shares = new
        if done:
            break
    return shares, float(counts @ np.log(shares @ likelihood))


def language_shares(text: str, log_p: np.ndarray) -> np.ndarray | None:
    """Shares of the languages in a text; None without a letter.

    Starts from all languages. As long as it raises the penalised likelihood (the log
    likelihood less half the log of the number of trigrams for each free share), the language
    with the least share leaves the set and the rest is fitted anew.
    """
    found, counts = trigram_counts(text)
    if not len(found) or not any(map(str.isalpha, text)):
        return None
    counts = counts.astype(float)
    logs = log_p[:, found]
    likelihood = np.exp(logs - logs.max(0))
    n = len(likelihood)
    active = np.arange(n)
    shares, score = fit_mixture(likelihood, counts, np.full(n, 1 / n))
    penalty = 0.5 * np.log(counts.sum() + 1)
    while len(active) > 1:
        keep = np.ones(len(active), bool)
        keep[np.argmin(shares)] = False
        keep &= (shares >= LEAST_SHARE) | (shares == shares.max())
        left = shares[keep] / shares[keep].sum()
        fewer, fewer_score = fit_mixture(likelihood[active[keep]], counts, left)
        if fewer_score + penalty * (len(active) - keep.sum()) < score:
            break
        active, shares, score = active[keep], fewer, fewer_score
    full = np.zeros(n)
    full[active] = shares / shares.sum()
    return full


def predict(docs: DataFrame, languages: list[str], log_p: np.ndarray) -> DataFrame:
    """`doc_id, lang_pred, score, mixture` of every whole text.

    `mixture` has the selected languages with their shares; `lang_pred` is the one with the
    greatest share (the first by name if there are several), `score` its share. A null text or
    one without a letter, or a model without languages, gives UNKNOWN, 0 and no mixture.
    """
    packed = base64.b64encode(log_p.astype(np.float32).tobytes())
    share = pa.struct([("lang", pa.string()), ("share", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(base64.b64decode(packed), np.float32).reshape(-1, BUCKETS).astype(float)
        for batch in batches:
            best, scores, mixtures = [], [], []
            for text in batch.column("text").to_pylist():
                shares = language_shares(text, table) if text and languages else None
                if shares is None:
                    best.append(UNKNOWN)
                    scores.append(0.0)
                    mixtures.append([])
                    continue
                top = int(shares.argmax())
                best.append(languages[top])
                scores.append(min(1.0, float(shares[top])))
                mixtures.append([{"lang": languages[i], "share": float(shares[i])} for i in np.flatnonzero(shares)])
            arrays = [batch.column("doc_id"), pa.array(best, pa.string()), pa.array(scores), pa.array(mixtures, pa.list_(share))]
            yield pa.record_batch(arrays, names=["doc_id", "lang_pred", "score", "mixture"])

    schema = "doc_id bigint, lang_pred string, score double, mixture array<struct<lang:string,share:double>>"
    return pick(docs, "doc_id", "text").mapInArrow(run, schema)


def identify(docs: DataFrame, training: DataFrame) -> DataFrame:
    """Learn from all rows of `training` (text, lang) and predict for all rows of `docs`."""
    return predict(docs, *learn(training))
