from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from asset_catalog.llm import toxicity
from asset_catalog.llm.common import fold


def bags(texts):
    return list(toxicity.text_terms(pa.array(texts, pa.string())))


def test_terms_are_a_set_without_case_and_marks():
    one, two, none, empty = bags(["You FOOL, you!", "fool you", None, ""])
    assert (one == two).all() and len(one) == 2 and len(none) == len(empty) == 0


def test_score_is_bias_terms_and_all_pairs():
    draw = np.random.default_rng(1)
    machine = toxicity.Machine(np.arange(toxicity.BUCKETS, dtype=np.int32), -0.3, draw.normal(size=toxicity.BUCKETS), draw.normal(size=(toxicity.BUCKETS, 3)))
    text = "five words stand in here"
    terms = bags([text])[0]
    pairs = sum(machine.vectors[a] @ machine.vectors[b] for a, b in itertools.combinations(terms, 2))
    expected = machine.bias + machine.weights[terms].sum() + pairs
    assert np.allclose(machine(pa.array([text, ""])), toxicity.sigmoid(np.array([expected, machine.bias])))


def test_learns_what_only_pairs_tell():
    draw = np.random.default_rng(2)
    fillers = [f"filler{k}" for k in range(30)]
    texts, labels = [], []
    for _ in range(1200):
        harsh, group = draw.random(2) < 0.5
        words = [*draw.choice(fillers, 6), *(["harsh"] if harsh else ["mild"]), *(["group"] if group else ["thing"])]
        texts.append(" ".join(words))
        labels.append(int(harsh and group))
    machine = toxicity.fit(bags(texts[:900]), np.array(labels[:900]))
    assert ((machine(pa.array(texts[900:])) >= 0.5) == np.array(labels[900:])).mean() > 0.98


def right(draw, label, words=("harsh", "group", "slur")):
    """Share of new texts judged rightly, where label(has) tells by which of the words a text has."""
    texts, labels = [], []
    for _ in range(1600):
        has = draw.random(len(words)) < 0.5
        texts.append(" ".join([*draw.choice([f"filler{k}" for k in range(30)], 6), *np.array(words)[has]]))
        labels.append(int(label(has)))
    machine = toxicity.fit(bags(texts[:1200]), np.array(labels[:1200]))
    return ((machine(pa.array(texts[1200:])) >= 0.5) == np.array(labels[1200:])).mean()


def test_learns_terms_that_tell_nothing_alone():
    assert right(np.random.default_rng(3), lambda has: has[0] != has[1]) > 0.98
    assert right(np.random.default_rng(4), lambda has: has[0] if has[1] else has[2]) > 0.98


def test_learns_a_rare_insult():
    draw = np.random.default_rng(5)
    texts = [" ".join(draw.choice([f"filler{k}" for k in range(40)], 8)) for _ in range(2000)]
    labels = np.arange(2000) % 10 == 0
    texts = [f"{t} {'vermin' if k < 40 else 'fool'}" if labels[k] else t for k, t in enumerate(texts)]
    machine = toxicity.fit(bags(texts), labels.astype(int))
    assert (machine(pa.array(["filler1 filler2 vermin", "filler1 filler2"])) >= 0.5).tolist() == [True, False]


def test_pairs_gain_what_counting_says():
    draw = np.random.default_rng(6)
    has, toxic = draw.random((5000, 6)) < 0.3, draw.random(5000) < 0.2
    toxic |= has[:, 1] & has[:, 4]
    rows, flat = np.nonzero(has)
    gain = toxicity.likelihood_gain(has.sum(axis=0).astype(float), has[toxic].sum(axis=0).astype(float), 5000, toxic.sum())
    assert toxicity.telling_pairs(rows, flat, toxic.astype(float), np.arange(6), gain, 30.0).tolist() == [1, 4]


def test_without_both_labels():
    assert np.allclose(toxicity.fit(bags(["a", "b"]), np.array([0, 0]))(pa.array(["a", None])), 0, atol=1e-6)
    assert np.allclose(toxicity.fit(bags(["a", "b"]), np.array([1, 1]))(pa.array(["c"])), 1, atol=1e-6)
    assert np.allclose(toxicity.fit([], np.array([]))(pa.array(["a"])), 0, atol=1e-6)


def test_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    machine = toxicity.learn(docs, labels)
    scored = toxicity.score_toxicity(docs, machine).join(labels, "doc_id").where(fold(F.col("doc_id"), 5) == 0)
    rows = [((r.score >= 0.5), r.toxic == 1) for r in scored.collect()]
    assert np.mean([a == b for a, b in rows]) > 0.93
    assert not any(a for a, b in rows if not b)


def test_same_scores_however_rows_are_dealt(real, labels):
    first = toxicity.learn(real, labels)
    again = toxicity.learn(real.repartition(5), labels.repartition(3))
    assert np.allclose(first.weights, again.weights)
    assert sorted(toxicity.score_toxicity(real, first).collect()) == sorted(toxicity.score_toxicity(real.repartition(7), first).collect())


def test_held_out_labels_teach_nothing(real, labels):
    turned = labels.withColumn("toxic", F.when(fold(F.col("doc_id"), 5) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert np.allclose(toxicity.learn(real, labels).weights, toxicity.learn(real, turned).weights)


def test_messy_rows(messy, nothing, labels, spark):
    given = spark.createDataFrame([(1, 1), (1, 0), (6, 0), (None, 1), (7, None), (99, 1)], "doc_id long, toxic int")
    machine = toxicity.learn(messy, given)
    rows = toxicity.score_toxicity(messy, machine).collect()
    assert len(rows) == 10 and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.drop_toxic(messy, machine).columns == messy.columns
    assert toxicity.drop_toxic(messy, machine).count() == sum(r.score < 0.5 for r in rows)
    empty = toxicity.learn(nothing, labels)
    assert toxicity.score_toxicity(nothing, empty).collect() == []
    assert all(r.score < 1e-6 for r in toxicity.score_toxicity(messy, empty).collect())
