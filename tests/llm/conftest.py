from __future__ import annotations

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def real(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text, lang, source), cut into two partitions."""

    def make(rows):
        full = [(i, t, lang, source, len(t) if t is not None else None) for i, t, lang, source in rows]
        return spark.createDataFrame(full, DOCUMENTS).repartition(2)

    return make


@pytest.fixture
def messy(documents):
    """Nulls in every column, empty and blank texts, a very long one, repeated rows, and names that operators use themselves."""
    prose = "the quick fox and the slow dog went over the hill to see what was there and came back at night "
    rows = documents(
        [
            (1, prose, "en", "a"),
            (1, prose, "en", "a"),
            (2, None, "en", "a"),
            (3, "", None, "b"),
            (4, " \t\n ", "xx", None),
            (None, prose + "again", "en", "b"),
            (6, prose * 3000, "en", "a"),
            (7, "12 34 !!", "en", ""),
            (8, "日本語 \U0001f600 ▁ \0 ﬁn", "ja", "b"),
            (9, "x" * 5000, None, None),
        ]
    )
    clashing = ["score", "size", "label", "bits", "taken", "window", "row", "word", "ids", "shard", "held_out", "mix_key"]
    return rows.withColumns({name: F.lit("own") for name in clashing})


@pytest.fixture
def nothing(documents):
    return documents([])
