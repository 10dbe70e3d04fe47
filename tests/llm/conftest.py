import random

import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # columns that operators use themselves
    T.StructField("size", T.StringType()), T.StructField("copies", T.StringType()), T.StructField("n", T.StringType()),
    T.StructField("hash", T.StringType()), T.StructField("score", T.StringType()), T.StructField("other_id", T.StringType()), T.StructField("mix_copies", T.StringType()),
])

WORDS = "amber birch cedar delta ember flint grove heath inlet jetty knoll larch marsh north olive pearl quartz ridge shore tulip".split()


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(f"{r.choice(WORDS)}{r.choice(['', 's', 'er', 'ing'])}" for _ in range(n))


def awkward_rows():
    """Nulls, empty and blank texts, a very long one, copies, near copies, shared passages, odd characters."""
    base, passage = prose(1, 120), prose(2, 60)
    near = base.split()
    near[60] = "changed"
    texts = [
        base, base, " ".join(near), base.upper(), None, "", " \n\t ", "one", "one two three four", "x" * 40,
        prose(3, 80) + "\n" + passage, passage + "\n" + prose(4, 200), prose(5, 30_000), "ab " * 300, "é漢😀▁ \x00 ﬁ", base, None,
        "Mail joe.doe7@mail.example.com or call +1 (389) 555-5010, card 4929583550668540, born 1987-03-21. " + prose(6, 60),
    ]
    rows = [(k, t, "en", ["b", "a", None, "c"][k % 4], len(t or ""), *["x"] * 7) for k, t in enumerate(texts)]
    rows.append(rows[0])  # a row twice
    rows.append((None, base, None, None, 0, *["x"] * 7))
    return rows


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), DOCUMENTS).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
