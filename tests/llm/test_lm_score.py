from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from asset_catalog.llm import lm_score as lm
from asset_catalog.llm.common import fold


def learns():
    return fold(F.col("doc_id"), 7) != 2


def small_mixer(texts):
    keys, n = np.unique(lm.windows(texts)[0], return_counts=True)
    tree = lm.Tree(*lm.huffman(np.bincount((keys & lm._MASK).astype(int), n, lm.END + 1).astype(int)))
    _, _, bits, slots = tree.expand(keys)
    owner = tree.expand(keys)[0]
    counts = np.zeros((lm.ORDERS, 1 << lm.TABLE_BITS, 2), np.float32)
    for k in range(lm.ORDERS):
        for b in (0, 1):
            counts[k, :, b] = np.bincount(slots[k], np.where(bits == b, n[owner], 0), 1 << lm.TABLE_BITS)
    return lm.learn_weights(tree, counts, texts)


@pytest.fixture(scope="module")
def mixer():
    return small_mixer([b"the cat sat on the mat. " * 20, b"a dog and a cat were there. " * 20])


def test_windows_hold_the_last_symbols():
    texts = [b"abcdef", b"", None, b"x\0y"]
    keys, sizes = lm.windows(texts)
    assert sizes.tolist() == [7, 1, 1, 4]
    expected = []
    for text in texts:
        symbols = [lm.END] * lm.ORDERS + list(text or b"") + [lm.END]
        for at in range(lm.ORDERS, len(symbols)):
            expected.append(sum(symbols[at - k] << 9 * k for k in range(lm.ORDERS + 1)))
    assert keys.tolist() == expected


def test_codes_are_free_of_prefixes_and_short_for_the_frequent():
    counts = np.zeros(lm.END + 1, int)
    counts[97] = 1000
    first, nodes, bits = lm.huffman(counts)
    codes = ["".join(map(str, bits[a:b].astype(int))) for a, b in zip(first, first[1:], strict=False)]
    assert sum(2.0 ** -len(c) for c in codes) == 1 and len(set(codes)) == lm.END + 1
    assert len(codes[97]) == 1 and nodes.max() < lm.END


def test_predictions_sum_to_one(mixer):
    for context in (b"the ", b"cat ", b"\xff\x00zz"):
        base = sum(s << 9 * (k + 1) for k, s in enumerate(reversed(context)))
        logs = mixer.predict(np.array([base + s for s in range(lm.END + 1)], np.uint64))
        assert np.allclose(np.exp2(logs).sum(axis=1), 1)


def test_text_is_scored_block_by_block(mixer):
    """The weights of the three predictions follow the blocks before, one after the other."""
    text = b"the dog sat on the cat and there was a mat, and so on " * 5
    keys, _ = lm.windows([text])
    logs = mixer.predict(keys)
    trust, total = np.zeros(3), 0.0
    for at in range(0, len(keys), lm.BLOCK):
        gain = logs[:, at : at + lm.BLOCK].sum(axis=1)
        share = np.exp2(trust - trust.max())
        total += math.log2((share / share.sum() * np.exp2(gain)).sum())
        trust = lm.FADING * trust + gain
    bits, sizes = lm.Scorer(mixer).bits([b"", text, None])
    assert bits[1] == pytest.approx(-total, rel=1e-5) and sizes.tolist() == [0, len(text), 0]
    assert bits[0] == bits[2] > 0


def test_forgetting_changes_nothing(mixer, monkeypatch):
    texts = [bytes(np.random.default_rng(k).integers(97, 123, 300).tolist()) for k in range(6)]
    expected = lm.Scorer(mixer).bits(texts)[0]
    monkeypatch.setattr(lm, "REMEMBERED", 100)
    scorer = lm.Scorer(mixer)
    assert np.allclose([scorer.bits([t])[0][0] for t in texts], expected)


def test_long_texts_are_scored_in_parts(mixer, monkeypatch):
    texts = [b"the cat and the dog " * 40, b"", b"a mat there " * 64 + b"x" * 32, None, b"end"]
    expected = lm.Scorer(mixer).bits(texts)[0]
    for at_once in (32, 64, 800):
        monkeypatch.setattr(lm, "AT_ONCE", at_once)
        assert np.allclose(lm.Scorer(mixer).bits(texts)[0], expected)


def test_known_text_is_likelier(mixer):
    bits, _ = lm.Scorer(mixer).bits([b"the cat sat on the mat.", b"qzx vvk wjj pqz xxkz qq"])
    assert bits[0] < 0.3 * bits[1]


def brute_base(rows, learns):
    counts, ends = Counter(), 0
    for key, text in rows:
        if learns(key):
            counts.update((text or "").encode().lower().split())
            ends += 1
    total, kinds = sum(counts.values()) + ends, len(counts) + (ends > 0)
    out = []
    for key, text in rows:
        seen = [counts[w] for w in (text or "").encode().lower().split()] + [ends]
        out.append((key, len(seen), sum(c > 0 for c in seen), total, sum(math.log10((c + 1) / (total + kinds + 1)) for c in seen)))
    return out


def in_fold(key):
    return zlib.crc32(str("" if key is None else key).encode()) % 7 != 2


@pytest.mark.parametrize("common", [lm.COMMON, 0.01])
def test_baseline_matches_brute_force(real, monkeypatch, common):
    monkeypatch.setattr(lm, "COMMON", common)
    expected = {e[0]: e for e in brute_base([(r.doc_id, r.text) for r in real.collect()], in_fold)}
    rows = lm.score_all(real, learns()).collect()
    assert len(rows) == len(expected)
    for r in rows:
        _, tokens, known, total, base = expected[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (tokens, known, total)
        assert r.base_score == pytest.approx(base)
        assert 0 < r.bits < 9 * (r.n_bytes + 1)


def test_model_scores_do_not_depend_on_the_dealing(real):
    mixer = lm.learn(real, learns())
    first = {r.doc_id: r.bits for r in lm.score_texts(real, mixer).collect()}
    again = {r.doc_id: r.bits for r in lm.score_texts(real.repartition(5), lm.learn(real.repartition(3), learns())).collect()}
    assert all(again[k] == pytest.approx(v, rel=1e-6) for k, v in first.items())


def test_messy_rows(messy, nothing, documents):
    rows = lm.score_all(messy, learns()).collect()
    expected = sorted(map(repr, ((e[0], e[1], e[2], e[3]) for e in brute_base([(r.doc_id, r.text) for r in messy.collect()], in_fold))))
    assert sorted(repr((r.doc_id, r.n_tokens, r.n_known, r.train_tokens)) for r in rows) == expected
    own = [r for r in rows if r.doc_id == 1]
    assert len(own) == 2 and own[0] == own[1]
    assert lm.score_all(nothing, learns()).collect() == []
    untaught = lm.score_all(documents([(1, "a b", "en", "s"), (2, None, "en", "s")]), F.lit(False)).collect()
    assert [(r.n_known, r.train_tokens, r.base_score) for r in untaught] == [(0, 0, 0.0)] * 2


def test_weights_come_from_all_training_texts(real, monkeypatch):
    """Also without a sample to start from, and in many groups; rows that are not learned from change nothing."""
    monkeypatch.setattr(lm, "TOGETHER", 2000)
    untaught = lm.learn(real.limit(0), learns())
    taught = lm.learn(real, learns(), sample_rows=0)
    assert np.abs(taught.weights[0] - untaught.weights[0]).max() > 0.01
    assert np.abs(taught.refined - untaught.refined).max() > 0.1
    alone = lm.learn(real.where(learns()), F.lit(True), sample_rows=0)
    assert all(np.allclose(a, b) for a, b in zip(taught.weights, alone.weights, strict=True))
    texts = [bytes(r.text, "utf-8") for r in real.where(~learns()).collect() if r.text]
    assert lm.Scorer(taught).bits(texts)[0].sum() < lm.Scorer(untaught).bits(texts)[0].sum()
