from __future__ import annotations

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from asset_catalog.llm import langid


def reads(table, symbols):
    state = 0
    for s in symbols:
        state = table[state, s]
        if state < 0:
            return False
    return True


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=1, max_size=30), st.lists(st.integers(0, 2), max_size=6))
def test_automaton_knows_all_substrings(symbols, probe):
    table = langid.suffix_automaton(symbols, 3)
    assert len(table) <= 2 * len(symbols)
    joined = "".join(map(str, symbols))
    assert reads(table, probe) == ("".join(map(str, probe)) in joined)


def naive_phrases(text, sample):
    """Longest matches one after the other; a symbol that never occurs is a phrase of its own."""
    count = at = 0
    while at < len(text):
        end = at
        while end < len(text) and text[at : end + 1] in sample:
            end += 1
        if end == at:
            end += 1
        count += 1
        at = end
    return count


def test_phrases_match_naive_parsing():
    samples = {"x": ["abcabdabe", "cab dab"], "y": ["eeddcc bbaa"]}
    automata = langid.build(samples)
    for text in ("abcabe", "ab eedd", "aaaa", "dabecab", "cabdabe bbaac", "zab", "zqa zz"):
        found, sizes = automata.read(pa.array([text]))
        got = automata.phrases(found, sizes)[0]
        for k, language in enumerate(automata.languages):
            sample = "".join(s + " " for s in sorted(samples[language]))
            assert got[k] == naive_phrases(text, sample)


def test_long_texts_are_read_whole():
    automata = langid.build({"x": ["abcabc"], "y": ["xyzxyz"]})
    names, _ = automata(pa.array(["abc " * 100 + "xyz " * 2000, "abc " * 2000 + "xyz " * 100]))
    assert names == ["y", "x"]


def test_long_texts_are_parsed_in_parts(monkeypatch):
    automata = langid.build({"x": ["abcabc abd"], "y": ["xyzxyz xy"]})
    texts = pa.array(["abc abd " * 50 + "xyz", None, "", "xyz " * 60, "12"])
    expected = automata(texts)
    monkeypatch.setattr(langid, "PART", 64)
    names, scores = automata(texts)
    assert names == expected[0] == ["x", "und", "und", "y", "und"] and np.allclose(scores, expected[1], atol=0.05)


def test_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    named = langid.identify(docs, langid.learn(docs)).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r.lang == r.lang_pred for r in named]) > 0.99
    assert all(0 <= r.score <= 1 for r in named)


def test_undetermined_and_messy(messy, nothing, documents):
    teach = documents([(k, "the cat sat on the mat and the dog was there", "en", "s") for k in range(20)] + [(k, "der hund und die katze sind nicht da gewesen", "de", "s") for k in range(20, 40)])
    automata = langid.learn(teach)
    assert automata.languages == ["de", "en"]
    rows = langid.identify(messy, automata).collect()
    assert len(rows) == 10
    named = {r.doc_id: r for r in rows}
    for i in (2, 3, 4, 7):
        assert (named[i].lang_pred, named[i].score) == ("und", 0.0)
    assert named[1].lang_pred == named[6].lang_pred == "en" and named[8].lang_pred in ("de", "en")
    kept = langid.drop_unexplained(messy, automata)
    assert kept.columns == messy.columns and {r.doc_id for r in kept.collect()}.isdisjoint({2, 3, 4, 7})
    assert langid.identify(nothing, automata).collect() == []
    blank = langid.learn(nothing)
    assert {r.lang_pred for r in langid.identify(messy, blank).collect()} == {"und"}


def test_given_languages_do_not_decide(documents):
    rows = [(k, "the cat sat on the mat and the dog was there", "en", "s") for k in range(20)] + [(k, "der hund und die katze sind nicht da gewesen", "de", "s") for k in range(20, 40)]
    automata = langid.learn(documents(rows))
    told = langid.identify(documents([(1, "the dog sat there", "de", "s"), (2, "the dog sat there", None, "t")]), automata).collect()
    assert {(r.lang_pred, round(r.score, 9)) for r in told} == {("en", round(told[0].score, 9))}


def test_ties_go_to_the_first():
    assert langid.build({"b": ["same"], "a": ["same"]})(pa.array(["same"]))[0] == ["a"]
