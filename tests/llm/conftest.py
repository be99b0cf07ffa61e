import random

import pytest
from pyspark.sql import types as T

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Columns whose names the operators use themselves.
CLASHING = DOCUMENTS + ", topic string, fp string, row string, key string, score double, probability double, label string, weight int, chosen_id int, label_id int, rank int, share int, node int, token int, least int, piece string, bytes binary, text_key int, no_id int, id int, row_id int"


def words(seed, n, alphabet="abcdefghij"):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(alphabet, k=rng.randint(2, 7))) for _ in range(n))


def documents():
    """Nulls in every column, empty and long texts, copies, near copies and repeated rows."""
    long = words(5, 30_000)
    near = words(1, 120).split()
    near[60] = "changed"
    rows = [
        (1, words(1, 120), "en", "s0"), (2, words(1, 120), "en", "s0"), (3, " ".join(near), "en", "s1"),
        (4, words(2, 80), "de", "s0"), (5, None, None, None), (6, "", "en", "s0"), (7, "   \n", "en", None),
        (8, "12 34 !!", "en", "s0"), (None, words(3, 50), "fr", "s2"), (9, long, "en", "s0"), (10, long + " tail", "en", "s0"),
        (11, "One", "en", "s0"), (12, "one TWO", "de", "s2"), (13, "one two", None, "s2"), (4, words(2, 80), "de", "s0"),
        (14, "é" * 150 + "\x00" + "日本" * 60, "fr", "s1"), (15, "é" * 150, "fr", "s1"),
    ]
    return [(i, t, lang, s, len(t) if t is not None else None) for i, t, lang, s in rows]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(documents(), DOCUMENTS).repartition(3)


@pytest.fixture(scope="session")
def clashing(spark):
    return spark.createDataFrame([(*r, *("x",) * 4, 0.5, 0.5, "x", *(1,) * 8, "x", b"x", *(1,) * 4) for r in documents()], CLASHING)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], T._parse_datatype_string(DOCUMENTS))
