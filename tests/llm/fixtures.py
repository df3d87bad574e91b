import random

import pytest
from pyspark.sql import types as T

#: documents with an extra columns whose names clash with those the operators use inside.
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("digest", T.StringType()), T.StructField("fp", T.LongType()),
                       T.StructField("kept", T.BooleanType()), T.StructField("row", T.StringType()),
                       T.StructField("prefix", T.LongType()), T.StructField("_row", T.StringType()),
                       T.StructField("n_chars", T.LongType())])


def prose(seed: int, words: int) -> str:
    r = random.Random(seed)
    syllables = ["ka", "lo", "mer", "tin", "sa", "vo", "del", "ri", "pan", "su", "ne", "gor"]
    out = []
    for i in range(words):
        w = "".join(r.choice(syllables) for _ in range(r.randint(1, 4)))
        out.append(w.capitalize() + "" if i % 11 == 0 else w + ("." if i % 11 == 10 else ""))
    return " ".join(out)


@pytest.fixture
def docs(spark):
    """Make documents from (doc_id, text) pairs; the other columns are filled, null in every second row."""
    def make(pairs, partitions=3):
        rows = [(i, t, *((None,) * 7 if k % 2 else ("x", 7, True, "r", 1, "q", -1))) for k, (i, t) in enumerate(pairs)]
        return spark.createDataFrame(rows, SCHEMA).repartition(partitions) if rows else spark.createDataFrame([], SCHEMA)
    return make


@pytest.fixture
def corner(docs):
    """Null ids and texts, empty, blank and very long texts, ties, repeated rows, odd characters."""
    long = prose(1, 60_000)
    pairs = [(1, None), (2, ""), (3, " \t\n "), (4, long), (5, prose(5, 80)), (5, prose(5, 80)), (6, prose(5, 80)), (None, prose(7, 60)),
             (None, None), (8, "naïve café 日本語 ▁ x y \x1c z 😀"), (9, long), (10, prose(5, 80) + " tail"), (-3, prose(5, 80)),
             (11, "a" * 5000), (12, "7 " * 3000), (13, "<|endoftext|> I'm you'LL\r\n\r\n x")]
    return docs(pairs), pairs
