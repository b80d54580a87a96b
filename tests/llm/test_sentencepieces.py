from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from asset_catalog.llm import sentencepieces as sp


@pytest.fixture(scope="module")
def vocabulary():
    return sp.load()


@pytest.fixture(scope="module")
def tiny():
    """Pieces of a and b, with every byte as a piece."""
    weights = {"▁": 0.3, "a": 0.2, "b": 0.1, "ab": 0.15, "▁a": 0.25, "ba": 0.05}
    raw = [bytes([k]) for k in range(256)] + [p.replace("▁", " ").encode() for p in weights]
    ids = {p: 256 + k for k, p in enumerate(weights)}
    return sp.Vocabulary(weights, ids, raw, list(range(256)), 0.01, "▁+[^▁]*|[^▁]+")


def cuts(text, vocabulary):
    """Every segmentation of the text with its weight."""
    if not text:
        return {(): 1.0}
    out = {}
    for end in range(1, len(text) + 1):
        at = vocabulary.index.get(text[:end])
        if at is not None:
            for rest, weight in cuts(text[end:], vocabulary).items():
                out[(text[:end], *rest)] = vocabulary.weights[at] * weight
    return out


def test_frequencies_are_those_of_the_lattice(tiny):
    sampler = sp.Sampler(tiny)
    text = "abab"
    weights = cuts("▁" + text, tiny)
    total = sum(weights.values())
    ids = sampler.encode([text] * 20_000, sp.row_keys(list(range(20_000)), 1))
    found = Counter(tuple(tiny.raw[i].decode().replace(" ", "▁") for i in row.tolist()) for row in ids)
    assert set(found) == set(weights)
    for cut, weight in weights.items():
        share = weight / total
        assert abs(found[cut] / 20_000 - share) < 5 * np.sqrt(share / 20_000) + 1e-4


def test_long_units_are_filtered_alike(tiny):
    units = ["▁abab", "▁" + "ab" * 15, "▁zab\ud800"]
    short = sp.lattice(units, tiny)
    parts = [sp._filter_long(u, k, tiny) for k, u in enumerate(units)]
    assert np.allclose(short.shares, np.concatenate([p[4] for p in parts]))
    assert (short.pieces == np.concatenate([p[3] for p in parts])).all()
    assert np.isfinite(sp.lattice(["▁" + "ab" * 5000], tiny).shares).all()


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=40), max_size=5), st.integers(0, 1 << 40))
def test_round_trip(texts, seed):
    sampler = sp.Sampler(VOCABULARY)
    ids = sampler.encode(texts, sp.row_keys(texts, seed))
    assert [sampler.decode(i).decode() for i in ids] == texts


VOCABULARY = sp.load()


def test_long_texts_in_parts_get_the_same_pieces(monkeypatch):
    text = "The quick fox, ▁ and so on\n\n" * 200 + "x" * 900 + " end"
    keys = sp.row_keys([7, 8], 0)
    whole = sp.Sampler(VOCABULARY).encode([text, "short"], keys)
    monkeypatch.setattr(sp, "AT_ONCE", 400)
    parts = sp.Sampler(VOCABULARY).encode([text, "short"], keys)
    assert all((a == b).all() for a, b in zip(whole, parts, strict=True)) and len(whole[0]) > 1000


def test_most_likely_piece_wins_when_sharp():
    sharp = sp.load(sharpness=3.0)
    sampler = sp.Sampler(sharp)
    ids = sampler.encode(["the house and the garden"] * 50, sp.row_keys(list(range(50)), 0))
    assert Counter(map(len, ids)).most_common(1)[0][0] <= 6


def test_same_pieces_however_rows_are_dealt(real, vocabulary):
    first = sorted(map(tuple, sp.round_trip(real, vocabulary).collect()))
    assert first == sorted(map(tuple, sp.round_trip(real.repartition(7), vocabulary).collect()))
    other = sp.round_trip(real, vocabulary, seed=1).collect()
    assert sum(a[2] != b.ids_md5 for a, b in zip(first, sorted(other), strict=True)) > 150
    assert all(r[4] for r in first)


def test_encode_and_decode(real, vocabulary):
    encoded = sp.encode(real, vocabulary)
    texts = {r.doc_id: r.text for r in real.collect()}
    rows = sp.decode(encoded, vocabulary).collect()
    assert len(rows) == len(texts) and all(texts[r.doc_id] == r.text for r in rows)
    assert all(0 <= i < len(vocabulary.raw) for r in rows for i in r.ids)


def test_messy_rows(messy, nothing, vocabulary):
    rows = sp.round_trip(messy, vocabulary).collect()
    assert len(rows) == 10
    for r in rows:
        assert (r.lossless, r.ids_md5 is None) == ((None, True) if r.doc_id == 2 else (True, False))
    assert {r.n_pieces for r in rows if r.doc_id in (2, 3)} == {0}
    assert sp.round_trip(nothing, vocabulary).collect() == []
    back = {r.doc_id: r.text for r in sp.decode(sp.encode(messy, vocabulary), vocabulary).collect()}
    assert back[2] is None and back[3] == "" and back[8] == "日本語 \U0001f600 ▁ \0 ﬁn"


def test_arcs_are_small_and_free_memory_is_given_back(monkeypatch):
    """The numbers of a lattice's arcs have 32 bits, and after a batch the worker keeps nothing that is free."""
    import pyarrow as pa

    from asset_catalog.llm import common, sentencepieces

    net = sentencepieces.lattice(["▁the", "▁" + "long" * 20, "▁é"], sentencepieces.load())
    assert net.pieces.dtype == np.int32
    given_back = []
    monkeypatch.setattr(common, "release", lambda: given_back.append(1))
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * 10, None, "b" * 10])], names=["text"])
    assert sum(part.num_rows for part in common.slices(batch, 0, 10)) == 3 and given_back == [1]
