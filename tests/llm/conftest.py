from __future__ import annotations

import pytest

#: Texts that meet the awkward cases: nulls, empties, ties, repeats, one very long.
PASSAGE = " ".join(f"word{i} and thing{i}," for i in range(40))
BASE = [
    (1, "The cat of the house and the garden in the sun\nsecond line here\nthird line", "en", "a", 3),
    (2, None, None, None, None),
    (3, "", "en", "a", 0),
    (4, "   \n\t \n", "en", "b", 6),
    (5, PASSAGE, "en", "a", 1),
    (6, PASSAGE, "en", "a", 1),
    (7, "Prefix text before it. " + PASSAGE + " And a tail after it.", "en", "a", 1),
    (8, "Über naïve café — “quotes” and 日本語 text, naïve again; ñandú", "fr", "c", 1),
    (9, "The cat of the house and the garden in the sun\nsecond line here\nanother ending", "en", "a", 3),
    (9, "The cat of the house and the garden in the sun\nsecond line here\nanother ending", "en", "a", 3),
    (None, "no id but some words in the text of it", "en", "a", 1),
    (11, "short", "en", "a", 1),
    (12, " ".join(f"long{i % 977}x{i}" for i in range(30000)), "en", "a", 1),
    (13, "x " * 600, "en", "a", 1),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def awkward(spark):
    """The awkward documents with extra columns whose names the operators might use themselves."""
    from pyspark.sql import functions as F
    docs = spark.createDataFrame(BASE, SCHEMA)
    for name in ("_k", "_d", "_row", "rk", "fp", "h", "n", "key", "told", "spans", "score", "gone", "root", "n_lines_", "bucket", "length", "anchor"):
        docs = docs.withColumn(name, F.lit("own"))
    return docs


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def texts():
    return [(d, t) for d, t, *_ in BASE]
