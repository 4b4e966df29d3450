import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, words, vocabulary=400):
    return " ".join(f"w{min(rng.randrange(vocabulary), rng.randrange(vocabulary))}" for _ in range(words))


@pytest.fixture(scope="session")
def rows():
    """Nulls in every column, empty and very long texts, repeated rows, copies, near copies, shared passages, odd characters."""
    rng = random.Random(5)
    out = []
    passage, base = prose(rng, 70), prose(rng, 300)
    for i in range(60):
        out.append((i, prose(rng, rng.randrange(1, 120)), rng.choice(["en", "de", None]), rng.choice(["a", "b", "c", None])))
    for i in range(60, 75):
        out.append((i, prose(rng, 30) + " " + passage + "\n" + prose(rng, 20), "en", "a"))
    for i in range(75, 85):
        words = base.split()
        words[rng.randrange(300)] = "changed"
        out.append((i, " ".join(words), "de", "b"))
    out += [(90, None, "en", "a"), (91, "", "en", "a"), (92, "  \t\n", None, None), (93, "1234 -- !!", "en", "b"), (None, passage, "en", "a"), (None, "Ünïcödé \x1c\x85 x　y", "en", None)]
    out += [(94, "a" * 20000, "en", "a"), (95, prose(rng, 8000), "de", "c"), (96, out[3][1], "en", "a"), (96, out[3][1], "en", "a"), (97, "<|endoftext|> it's  DON'T \n\n x 12345", "en", "a")]
    return [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in out]


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The rows with more columns whose names clash with result columns."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return df.withColumns({x: F.lit("clash") for x in ("Score", "n_words", "ids", "fp", "labels", "kept", "_t")})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
