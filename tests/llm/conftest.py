import random

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    # Names that operators use inside.
    *(T.StructField(n, T.StringType()) for n in ("row", "line", "key", "body", "score", "ids", "print", "a", "e", "first", "block", "home", "n", "label")),
])


def make(spark, rows, partitions=3):
    """Documents (doc_id, text) with many extra columns."""
    return spark.createDataFrame([(i, t, *("x" for _ in SCHEMA.names[2:])) for i, t in rows], SCHEMA).repartition(partitions)


@pytest.fixture(scope="session")
def odd_rows():
    """Null and empty texts, blanks, long texts and words, copies, near copies, unusual characters."""
    rng = random.Random(7)
    vocabulary = ["".join(rng.choice("abcdeéß日") for _ in range(rng.randrange(1, 9))) for _ in range(400)]

    def prose(n):
        words = [rng.choice(vocabulary) for _ in range(n)]
        return "".join(w + (".\n" if k % 13 == 12 else " ") for k, w in enumerate(words)).strip()

    passage, long_text = prose(150), prose(6000)
    texts = [
        None, "", " ", "\n\n", "a", "word", "Two Words", prose(30), prose(200), long_text, long_text, "x" * 5000, "ab " * 900,
        passage, "Intro. " + passage + " Outro here.", prose(40) + "\n" + passage, prose(60).upper(), "tab\tand\x0bother\x0cwhite\r\nspace",
        "😀 emoji ▁ mark <|endoftext|> <s> \x00 nul", "ﬁ İ é. ﷺ", None, "",
    ]
    near = prose(120)
    texts += [near, near.replace(" ", "  ", 1), near + " tail", near[:-1], near, near]
    line = "a line that many documents share"
    texts += [line + "\n" + prose(10), prose(5) + "\n" + line, line[:5] + "X" + line[6:], line + "s", "s" + line, line, line]
    return [(3 * k - 20, t) for k, t in enumerate(texts)]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return make(spark, odd_rows).cache()


@pytest.fixture(scope="session")
def none(spark):
    return make(spark, [], 1)


@pytest.fixture
def documents():
    return make
