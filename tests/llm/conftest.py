import os
import sys

import pytest
from pyspark.sql import types as T

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))]

LONG = "lorem ipsum dolor sit amet, consectetur adipiscing elit " * 4000
# NULLs in any column, empty and very long texts, ties and repeated rows.
DOCS = [
    (1, "The quick brown fox jumps over the lazy dog and runs into the dark green forest again.", "en", "a"),
    (2, "The quick brown fox jumps over the lazy dog and runs into the dark green forest again.", "en", "b"),
    (2, "The quick brown fox jumps over the lazy dog and runs into the dark green forest again.", "en", "b"),
    (3, None, "en", "a"),
    (4, "", None, None),
    (5, LONG, "la", "a"),
    (6, LONG + "tail", "la", None),
    (7, " \t\n\x0b\x0c\r ", "en", "c"),
    (8, "one two", "en", "c"),
    (9, "ONE two", "en", "c"),
    (None, "no id here but some words for all to count and to keep", None, "a"),
    (10, "über straße wörter und ÄÖÜ 'tis 東京 🙂 <|endoftext|> done", "de", "é"),
]
# Columns that results or helper steps might be named like.
EXTRA = ("size", "score", "kept", "slot", "shard", "_c0", "_r0", "_block", "digest", "n_tokens", "unit", "copies", "_t")
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        *(T.StructField(c, T.StringType()) for c in EXTRA),
    ]
)


@pytest.fixture(scope="session")
def odd(spark):
    """A small table with everything that may go wrong."""
    return spark.createDataFrame([(*d, *EXTRA) for d in DOCS], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")
