"""Fixtures of the operators' tests."""

import random
from pathlib import Path

import pytest

TESTDATA = Path("/root/testdata/sf0.001")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that operators use inside, or add.
CLASHING = ["row", "run", "key", "pos", "token", "sid", "n", "shard", "slot", "score", "size", "c0", "TEXT", "n_lines", "length"]


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text): copies, near copies, shared lines, short, empty, long and null texts."""
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(400)]

    def prose(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    license_line = "Licensed under some Licence, Version 2, see the file for more of it."
    texts = [None, "", " \n\t", "one", "ONE", "two words", "a b c d e", "a b c d e f", "x" * 5000, "\n\n\n"]
    base = prose(120)
    for i in range(25):
        cut = base.split()
        for _ in range(i % 5):
            cut[rng.randrange(len(cut))] = rng.choice(vocabulary)
        texts.append(" ".join(cut) + ("\n" + license_line if i % 2 else ""))
    texts += [base] * 6
    for _ in range(30):
        texts.append("\n".join(prose(rng.randint(3, 60)) for _ in range(rng.randint(1, 5))))
    for i in range(12):
        texts.append(f"  {license_line.upper() if i % 3 == 0 else license_line}\r\n{prose(6)}\n{license_line}")
    for i in range(8):
        texts.append(license_line + f" tail {i}")
    texts.append("\n".join(prose(500) for _ in range(40)))
    return list(enumerate(texts))


@pytest.fixture(scope="session")
def documents(spark, corpus):
    rows = [(i, t, ["en", "fr", None][i % 3], f"src{i % 4}", len(t or "")) for i, t in corpus]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def messy(spark, documents):
    """The same documents with repeated rows, rows without an id, and columns of many names."""
    from pyspark.sql import functions as F

    null = documents.where("doc_id IN (12, 50)").withColumn("doc_id", F.lit(None).cast("bigint"))
    rows = documents.unionAll(documents.where("doc_id IN (0, 1, 11, 40)")).unionAll(null)
    for i, name in enumerate(CLASHING):
        rows = rows.select("*", F.lit(i if i % 2 else None).cast("bigint").alias(name))
    return rows


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
