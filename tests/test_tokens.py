"""Tokens replaced by a mapping table, against the regular expression of the same mapping."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from asset_catalog.functions.text import multi_replace
from asset_catalog.operators.tokens import mapping_keys, replace_tokens
from asset_catalog.schemas import ConfigError

LETTERS = ["a", "B", "é", "_", "1", ".", " ", "-", "$", "\n", "日"]
WORD = st.text(st.sampled_from(LETTERS), max_size=7)


def pairs_of(spark, mapping):
    return spark.createDataFrame(list(mapping.items()), "old string, new string")


def replaced(spark, values, mapping, **options):
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, raw string")
    made = replace_tokens(rows, "raw", pairs_of(spark, mapping), "made", **options)
    expected = rows.select("k", multi_replace(F.col("raw"), mapping, match="token", **options).alias("made"))
    return sorted(made.select("k", "made").collect()), sorted(expected.collect())


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.text(st.sampled_from(LETTERS), max_size=25), min_size=30, max_size=40),
    st.dictionaries(WORD.map(str.lower), WORD, min_size=1, max_size=8),
    st.booleans(),
)
def test_same_as_the_expression(spark, values, mapping, preserve_case):
    got, expected = replaced(spark, values, mapping, preserve_case=preserve_case)
    assert got == expected


@pytest.mark.parametrize("preserve_case", [True, False])
def test_overlaps_ends_and_odd_texts(spark, preserve_case):
    mapping = {"a.b": "1", "a.b.c": "2", "b.c.d": "3", "c": "4", "x y": "5", "-": "minus", "raw_zone.orders": "$lake\\.o", "d": ""}
    values = ["a.b.c.d", "a.b.b.c.d", "A.B", "aa.b.c", "x y y", "x  y", "-c-", "c-c", "b-c", "", None, "Raw_Zone.Orders t, raw_zone.orders2", "a.b.c " * 300, "\x01c\x01"]
    got, expected = replaced(spark, values, mapping, preserve_case=preserve_case)
    assert got == expected


def test_keys(spark):
    held = mapping_keys(pairs_of(spark, {"A.b": "x", "": "y", "c": None}))
    assert sorted(map(tuple, held.collect())) == [("a.b", "x", 3), ("c", "", 1)]
    with pytest.raises(ConfigError, match="two values for 'a'"):
        mapping_keys(pairs_of(spark, {"a": "1", "A": "2"}))


def test_without_keys_and_without_rows(spark):
    rows = spark.createDataFrame([("Text",), (None,)], "raw string")
    assert replace_tokens(rows, "raw", pairs_of(spark, {"a": "b"}).limit(0), "made").collect() == [("Text", "Text"), (None, None)]
    assert replace_tokens(rows.limit(0), "raw", pairs_of(spark, {"a": "b"}), "made").collect() == []


def test_other_columns_stay_and_equal_texts_are_done_once(spark):
    rows = spark.createDataFrame([(k, "the old one", "id", "pieces") for k in range(50)], "k int, raw string, id string, source string")
    made = replace_tokens(rows, "raw", pairs_of(spark, {"old": "new"}), "made")
    assert made.columns == ["k", "raw", "id", "source", "made"]
    assert [r["made"] for r in made.collect()] == ["the new one"] * 50


def test_queries_take_mappings_that_are_tables(spark, texts):
    from asset_catalog.operators.assets import read_assets
    from asset_catalog.operators.rewrite import rewrite_query
    from tests.conftest import dumps, query

    rows = read_assets(texts([dumps(query(name="a")), dumps(query(name="b", query="select 1")), dumps(query(name="c", query=None))]), "query")
    tables, functions = {"raw_zone.ordersv1": "lake.orders"}, {"strpos": "instr"}
    both = rewrite_query(rows, pairs_of(spark, tables), functions, match="token")
    expected = rewrite_query(rows, tables, functions, match="token")
    assert sorted(both.select("name", "query", "new_query").collect()) == sorted(expected.select("name", "query", "new_query").collect())
    assert both.columns == expected.columns
    with pytest.raises(ConfigError, match="whole identifiers only"):
        rewrite_query(rows, pairs_of(spark, tables), None, match="substring")
