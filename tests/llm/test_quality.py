from __future__ import annotations

from dataclasses import fields

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from asset_catalog.llm import quality
from asset_catalog.llm.common import fold


def small_model(seed=0):
    draw = np.random.default_rng(seed)
    shapes = [(quality.INPUTS, 4), (4,), (4, 3), (4, 3), (3,), (4,), (1,)]
    return quality.Attention(*[draw.normal(0, 0.5, s) for s in shapes])


def test_pairs_of_every_passage():
    text = "Ab1 " * 200 + "é!\n"
    encoded, passages = quality.encode(pa.array([text, "", None]))
    assert passages.tolist() == [2, 1, 1]
    raw = text.encode()
    for k in range(2):
        part = raw[k * quality.PASSAGE_BYTES : (k + 1) * quality.PASSAGE_BYTES]
        expected = np.zeros(quality.PAIRS, int)
        for a, b in zip(part, part[1:], strict=False):
            expected[quality._KIND[a] * quality._KINDS + quality._KIND[b]] += 1
        assert (encoded[k, : quality.PAIRS] == expected).all()
        assert encoded[k, quality.PAIRS] <= len({part[i : i + 6] for i in range(len(part) - 5)})
    assert not encoded[2:].any()


def test_long_texts_are_encoded_in_parts(monkeypatch):
    texts = pa.array(["word " * 700, "", "A|b " * 900, None, "end"])
    expected = quality.encode(texts)
    monkeypatch.setattr(quality, "PART", 2 * quality.PASSAGE_BYTES)
    found = quality.encode(texts)
    assert (found[1] == expected[1]).all()
    assert np.abs(found[0].astype(int) - expected[0].astype(int)).sum() == 0


def test_slopes_are_those_of_the_loss():
    draw = np.random.default_rng(4)
    x, passages, good = draw.random((7, quality.INPUTS)), np.array([3, 1, 3]), np.array([1.0, 0.0, 1.0])
    model = small_model()

    def loss():
        p = model.forward(x, passages)["score"]
        return -np.mean(good * np.log(p) + (1 - good) * np.log(1 - p))

    for field, slope in zip(fields(model), model.slopes(x, passages, good), strict=True):
        value = getattr(model, field.name)
        for at in list(np.ndindex(value.shape))[:: max(1, value.size // 5)]:
            keep = value[at]
            value[at] = keep + 1e-4
            up = loss()
            value[at] = keep - 1e-4
            down = loss()
            value[at] = keep
            assert np.isclose((up - down) / 2e-4, slope[at], rtol=1e-2, atol=1e-5), field.name


def test_attention_weighs_passages():
    model = small_model()
    weights = model.passage_weights("some words of prose " * 100 + "###$$$%%%" * 100)
    assert len(weights) == 6 and np.isclose(weights.sum(), 1, atol=1e-4) and weights.std() > 0


def test_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = quality.learn(docs, labels)
    scored = quality.score_quality(docs, model).join(labels, "doc_id").where(fold(F.col("doc_id"), 3) == 1)
    assert np.mean([(r.score >= 0.5) == (r.quality == 1) for r in scored.collect()]) > 0.95


def test_without_both_labels():
    counts = [np.zeros((1, quality.PAIRS + 1), np.uint16)] * 2
    assert np.allclose(quality.fit(counts, np.ones(2, np.float32))(pa.array(["a", None])), 1, atol=1e-6)
    assert np.allclose(quality.fit([], np.array([], np.float32))(pa.array(["a"])), 0.5)


def test_messy_rows(messy, nothing, labels, spark):
    given = spark.createDataFrame([(1, 1), (6, 0), (None, 1), (7, None), (9, 0)], "doc_id long, quality int")
    model = quality.learn(messy, given)
    rows = quality.score_quality(messy, model).collect()
    assert len(rows) == 10 and all(0 <= r.score <= 1 for r in rows)
    assert quality.drop_poor(messy, model).columns == messy.columns
    assert quality.score_quality(nothing, quality.learn(nothing, labels)).collect() == []
    same = quality.score_quality(messy.repartition(5), model).collect()
    assert np.allclose(sorted(r.score for r in rows), sorted(r.score for r in same), atol=1e-6)
