import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])
#: Names that operators use for results or on the way, as columns of the input.
CLASHING = ["size", "key", "row", "shard", "slot", "block", "copies", "ids", "start", "a", "b", "label", "kind", "value", "score", "sig"]


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 7))) for _ in range(words))


@pytest.fixture(scope="session")
def make(spark):
    def build(rows: list[tuple], clash: bool = True):
        """Documents from (doc_id, text, source) rows, with extra columns of clashing names."""
        frame = spark.createDataFrame([(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows], DOCS)
        if clash:
            from pyspark.sql import functions as F
            for name in CLASHING:
                frame = frame.withColumn(name, F.lit(f"extra {name}"))
        return frame.repartition(3)
    return build


@pytest.fixture(scope="session")
def odd():
    """Nulls, empty texts, repeated rows, ties, equal texts, a long text, odd white space, signs beyond ASCII."""
    long = prose(1, 6000)
    near = prose(2, 300)
    return [
        (1, prose(3, 120), "s1"), (2, prose(3, 120), "s1"), (2, prose(3, 120), "s1"), (3, None, "s2"), (4, "", None), (5, " \n\t ", "s2"),
        (6, long, "s1"), (7, long + " tail", None), (8, near, "s3"), (9, near + " more words here", "s3"), (None, "no id here", "s1"),
        (10, "one two three", "s2"), (11, "one two three", "s2"), (12, "é ü ß  double  spaces\n\nlines É", "s4"), (13, prose(5, 80), None),
        (14, "x" * 3000, "s4"), (15, None, None), (16, prose(6, 700) + " " + near[:900] + " " + prose(7, 50), "s2"),
    ]
