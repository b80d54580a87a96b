from __future__ import annotations

import hashlib
import math
import re

import pytest
from pyspark.sql import functions as F

from asset_catalog.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, epochs=2):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    left, open_, target = share * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        stop = {s for s in open_ if level * weight[s] >= epochs * sizes[s]}
        if not stop:
            target |= {s: level * weight[s] for s in open_}
            break
        target |= {s: float(epochs * sizes[s]) for s in stop}
        left -= sum(epochs * sizes[s] for s in stop)
        open_ -= stop
    return target


def brute_taken(rows, targets):
    """Documents of a source in order of their keys, again and again, until the budget ends."""
    taken = [0] * len(rows)
    for source, target in targets.items():
        own = [k for k, r in enumerate(rows) if r["source"] == source]
        order = sorted(own, key=lambda k: hashlib.md5(f"mix{rows[k]['doc_id']}".encode()).hexdigest())
        left = math.floor(target)
        while left > 0 and any(rows[k]["size"] for k in own):
            for k in order:
                part = min(left, rows[k]["size"])
                taken[k] += part
                left -= part
    return taken


def sized(rows):
    return [{**r.asDict(), "size": len(WORD.findall(r.text or ""))} for r in rows]


def test_mix_matches_brute_force(real):
    rows = sized(real.collect())
    sizes = {}
    for r in rows:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
    targets = brute_targets(sizes)
    taken = brute_taken(rows, targets)
    got = {r.doc_id: r for r in mixing.mix(real).collect()}
    assert len(got) == len(rows)
    for r, words in zip(rows, taken, strict=True):
        g = got[r["doc_id"]]
        assert (g.size, g.taken, g.source_size) == (r["size"], words, sizes[r["source"]])
        assert g.target == pytest.approx(targets[r["source"]])


def test_same_mix_however_rows_are_dealt(real):
    again = real.repartition(7).orderBy(F.desc("doc_id"))
    assert sorted(mixing.mix(real).collect()) == sorted(mixing.mix(again).collect())


def test_mixed_documents_hold_the_words_taken(real):
    plan = mixing.mix(real).groupBy("doc_id").agg(F.sum("taken").alias("taken")).collect()
    rows = mixing.mixed_documents(real)
    assert rows.columns == real.columns
    words = rows.groupBy("doc_id").agg(F.sum(mixing.word_count(F.col("text"))).alias("words"))
    found = {r.doc_id: r.words for r in words.collect()}
    assert {r.doc_id: r.taken for r in plan if r.taken} == found


def test_messy_rows(messy):
    rows = mixing.mix(messy).collect()
    assert len(rows) == 10
    by_source = {}
    for r in rows:
        by_source.setdefault(r.source, []).append(r)
        assert 0 <= r.taken <= 2 * r.size
    for own in by_source.values():
        assert abs(sum(r.taken for r in own) - own[0].target) <= len(own)
        assert own[0].target <= 2 * own[0].source_size
    assert mixing.mixed_documents(messy).columns == messy.columns
    assert mixing.mixed_documents(messy).where("size != 'own'").count() == 0


def test_one_source_and_one_document(documents):
    assert [tuple(r) for r in mixing.mix(documents([(1, "a b c", "en", "s")])).collect()] == [(1, 3, 3, 4.5, 4, "s")]
    texts = [r.text for r in mixing.mixed_documents(documents([(1, "a b c", "en", "s")])).collect()]
    assert sorted(texts) == ["a", "a b c"]


def test_without_words_and_without_rows(documents, nothing):
    assert [r.taken for r in mixing.mix(documents([(1, "", "en", "s"), (2, None, "en", "t")])).collect()] == [0, 0]
    assert mixing.mix(nothing).collect() == []
    assert mixing.mixed_documents(nothing).collect() == []


def test_plan_is_native(real):
    plan = mixing.mix(real)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
