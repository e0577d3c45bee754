"""Fixtures: documents that no operator may stumble over. Test modules import them by name."""

from __future__ import annotations

import pytest

ODD = [
    (1, "The quick brown fox jumps over the lazy dog and runs away from the big bad wolf today", "en", "a"),
    (2, None, "en", "a"),
    (3, "", None, None),
    (4, " \n\t ", "de", "b"),
    (5, "one", "fr", "b"),
    (6, "É ß 日本語 𝒳 ' \" ; -- %", "de", "a"),
    (7, "Mail a.b@c.de or 10.0.0.256 and 10.0.0.25, card 4111 1111 1111 1111, +1 (555) 010-9999", "en", "a"),
    (8, "The quick brown fox jumps over the lazy dog and runs away from the big bad wolf today", "en", "a"),
    (8, "The quick brown fox jumps over the lazy dog and runs away from the big bad wolf today", "en", "a"),
    (9, "word " * 30_000, "en", "hot"),
    (None, "a row without an id, and some words to fill it up to a little more", None, "a"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty, blank, tiny and very long texts, ties, repeated rows, and columns with clashing names."""
    from pyspark.sql import functions as F

    rows = spark.createDataFrame(ODD, SCHEMA)
    return rows.select("*", F.lit(1).alias("score"), F.lit("x").alias("shard"), F.lit(2).alias("n_words"), F.lit("s").alias("spans"), F.lit(0).alias("component_id"), F.lit(0).alias("chunk"))


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.where("1 = 0")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
