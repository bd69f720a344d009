import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int"
LONG = "lorem ipsum dolor sit amet " * 30_000


@pytest.fixture(scope="session")
def messy(spark):
    """Nulls in any column, empty and very long texts, repeated rows, a repeated id, and extra
    columns named like the operators' own."""
    rows = [
        (1, "one two three four five six", "en", "a", 27), (1, "one two three four five six", "en", "a", 27),
        (1, "another text under the same id", "en", "a", 30), (2, None, None, None, None), (3, "", "en", "a", 0),
        (4, " \t\n ", "en", None, 4), (None, "a row without an id", "en", "a", 19), (None, None, None, None, None),
        (9, LONG, "en", "a", len(LONG)), (8, "x" * 200_000, "en", "a", 200_000), (7, "ünï ☃ 漢字 \U0001f600 token", "xx", "b", 18),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    for name in ("fp", "score", "row", "part", "length", "rank", "sketch", "anchors", "h", "root", "size", "label",
                 "low", "n", "head", "next_id", "item_id", "spans", "component_id", "_score", "tie"):
        docs = docs.withColumn(name, F.lit("mine"))
    return docs


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
