from __future__ import annotations

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from asset_catalog.functions.mappings import FUNCTIONS
from asset_catalog.functions.text import (
    clean_mapping,
    longest_first_pattern,
    multi_replace,
    rewrite_text,
)
from asset_catalog.schemas import ConfigError

TABLES = {"raw_zone": "lake.sales", "ordersv1": "orders_v2"}


def scan(text, mapping):
    """The plain way: at each position the longest key, else one character."""
    if text is None or not mapping:
        return text
    mapping = {k.lower(): v for k, v in mapping.items()}
    keys = sorted(mapping, key=len, reverse=True)
    text, out, at = text.lower(), [], 0
    while at < len(text):
        key = next((k for k in keys if text.startswith(k, at)), None)
        out.append(text[at] if key is None else mapping[key])
        at += 1 if key is None else len(key)
    return "".join(out)


def run(frame, column):
    return [row[0] for row in frame.select(column.alias("out")).collect()]


def test_golden_pair(texts):
    before = "SELECT strpos(title) AS A, 'Too Late' AS S FROM raw_zone.OrdersV1"
    after = "select instr(title) as a, 'too late' as s from lake.sales.orders_v2"
    assert run(texts([before]), rewrite_text(F.col("raw"), TABLES, FUNCTIONS)) == [after]


def test_longest_key_wins_and_values_are_not_looked_at_again(texts):
    mapping = {"ab": "abc", "abc": "X", "abcd": "ab", "b": "", "d": "\\", "e": "$1"}
    values = ["ab abc abcd abcde b be", "dabcbabx", "", None, "xyz"]
    assert run(texts(values), multi_replace(F.col("raw"), mapping)) == [
        scan(v, mapping) for v in values
    ]


def test_signs_of_patterns_are_plain_text(texts):
    mapping = {"a.c": "1", "c+": "2", "(x)": "3", "[y]": "4", "^": "5", "$": "6", "\\": "7", "|": "8",
               "-": "9", " ": "_", "#": "h", "\n": "<br>", "{2}": "two", "*": "s", "?": "q"}
    values = ["a.c abc c+ cc (x) [y] ^$\\|-#\n{2}*?", "a-b", "...."]
    assert run(texts(values), multi_replace(F.col("raw"), mapping)) == [
        scan(v, mapping) for v in values
    ]


def test_marks_in_the_text_survive(texts):
    values = ["\x01", "a\x01\x01ab\x01", "\x02\x01\x02a", "x\x01"]
    mapping = {"a": "[\x01]", "b\x01": "B"}
    assert run(texts(values), multi_replace(F.col("raw"), mapping)) == [
        scan(v, mapping) for v in values
    ]


def test_non_ascii(texts):
    mapping = {"größe": "size", "été": "summer", "表": "table", "ñ": "n"}
    values = ["GRÖSSE Größe GRÖßE", "ÉTÉ été", "FROM 表_1 😀表", "Ñandú"]
    assert run(texts(values), multi_replace(F.col("raw"), mapping)) == [
        scan(v, mapping) for v in values
    ]


@settings(max_examples=25, deadline=None)
@given(
    mapping=st.dictionaries(
        st.text("abAB.+$\\\x01é", min_size=1, max_size=4), st.text("abx$1\\\x01", max_size=3), max_size=8
    ),
    values=st.lists(st.one_of(st.none(), st.text("abAB.+$\\\x01é \n", max_size=20)), min_size=1, max_size=30),
)
def test_equal_to_a_scanner(spark, mapping, values):
    try:
        cleaned = clean_mapping(mapping)
    except ConfigError:
        return
    frame = spark.createDataFrame([(v,) for v in values], "raw string")
    assert run(frame, multi_replace(F.col("raw"), mapping)) == [scan(v, cleaned) for v in values]


def test_many_keys_use_buckets(texts):
    mapping = {f"name_{n}": f"lake.t{n}" for n in range(3000)}
    values = [" ".join(f"Name_{n}x" for n in range(0, 4000, 7)), "name_", "name_12345"]
    assert run(texts(values), multi_replace(F.col("raw"), mapping)) == [
        scan(v, mapping) for v in values
    ]


def test_without_mapping_nothing_changes(texts):
    values = ["Select X", None]
    for nothing in (None, {}, {"": "x"}):
        assert run(texts(values), multi_replace(F.col("raw"), nothing)) == values


def test_functions_without_tables(texts):
    assert run(texts(["STRPOS(a)"]), rewrite_text(F.col("raw"), None, FUNCTIONS)) == ["instr(a)"]


def test_functions_see_what_tables_put_in(texts):
    column = rewrite_text(F.col("raw"), {"t": "strpos_t"}, {"strpos": "instr"})
    assert run(texts(["T"]), column) == ["instr_t"]


def test_whole_words_only(texts):
    column = multi_replace(F.col("raw"), {"old": "new", "old_t": "n2"}, match="token")
    values = ["old old_t old_tx gold olds a.OLD(old)", "Éold oldé"]
    assert run(texts(values), column) == ["new n2 old_tx gold olds a.new(new)", "éold oldé"]


def test_case_kept(texts):
    column = multi_replace(F.col("raw"), {"OrdersV1": "ordersV2"}, preserve_case=True)
    values = ["SELECT 'Above' FROM ORDERSV1, ordersv1", None]
    assert run(texts(values), column) == ["SELECT 'Above' FROM ordersV2, ordersV2", None]


def test_mapping_is_cleaned():
    assert clean_mapping({"Ab": "x", "": "y", "c": None}) == {"ab": "x", "c": ""}
    assert clean_mapping([("A", "x"), ("a", "x")]) == {"a": "x"}
    with pytest.raises(ConfigError):
        clean_mapping([("A", "x"), ("a", "y")])
    with pytest.raises(ConfigError):
        multi_replace(F.lit("a"), {"a": "b"}, match="words")


def test_pattern_finds_the_longest_key():
    keys = ["a", "ab", "abc", "b.c", "bcd"]
    pattern = re.compile(longest_first_pattern(keys))
    assert [m.group() for m in pattern.finditer("abcabaab.cbcdb")] == ["abc", "ab", "a", "ab", "bcd"]
