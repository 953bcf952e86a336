from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from oddities import CLASHING

LAYOUT = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 977} and{i % 31}" for i in range(20_000))

# nulls in every column, empty, blank and very long texts, ties and repeated rows
ODD = [
    (1, "the cat sat on the mat and the dog lay down. it rained.", "en", "a", 5),
    (1, "the cat sat on the mat and the dog lay down. it rained.", "en", "a", 5),
    (2, None, "en", "a", None),
    (3, "", None, "b", 0),
    (4, "   \n \t ", "de", None, 7),
    (None, "no id here, but words enough to be read by all.", "en", "c", 1),
    (5, "ein kurzer satz über öl und käse, sehr schön.", "de", "c", 3),
    (6, "12345 67890 !!! ???", "de", "c", 3),
    (7, LONG, "en", "a", len(LONG)),
    (8, LONG, "en", None, len(LONG)),
    (9, "one", "en", "b", 3),
    (-3, "line one\nline two\n\n\nline  three   spaced", "en", "a", 4),
    (10, "snow ☃ 雪 😀 é é </s>[INST] \\ x", "fr", "", 4),
]

@pytest.fixture(scope="session")
def odd(spark):
    docs = spark.createDataFrame(ODD, LAYOUT)
    return docs.withColumns({name: F.lit("x") for name in CLASHING})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], LAYOUT)


@pytest.fixture(scope="session")
def documents(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")
