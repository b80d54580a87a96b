from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from asset_catalog.llm import simhash

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def brute_print(text, k=3):
    words = WORD.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not words:
        return 0
    spans = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in spans]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, most=2):
    """Smallest id reachable, by comparing all pairs."""
    ids = sorted(i for i in prints if i is not None)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= most:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


def test_matches_brute_force(real):
    prints = {r.doc_id: brute_print(r.text) for r in real.collect()}
    components = brute_components(prints)
    for r in simhash.near_duplicates(real).collect():
        assert r.fingerprint == f"{prints[r.doc_id]:016x}"
        assert r.component_id == components[r.doc_id]


def test_long_texts_are_cut_between_words(monkeypatch):
    texts = ["One two  three four\tfive six " * 9, "one", "one two", " a b c ", "", "x" * 50 + " y z w"]
    for part in (1, 7, 1 << 20):
        monkeypatch.setattr(simhash, "_PART", part)
        for shingle in (1, 3, 5):
            assert [simhash.fingerprint(t.encode(), shingle) for t in texts] == [brute_print(t, shingle) for t in texts]


def test_tree_of_many_shards_finds_every_pair(spark):
    draw = random.Random(5)
    seeds = [draw.getrandbits(64) for _ in range(60)]
    prints = {s ^ sum(1 << b for b in draw.sample(range(64), draw.randint(0, 3))) for s in seeds for _ in range(12)}
    prints = sorted(prints)
    expected = {(i, j) for i, a in enumerate(prints) for j, b in enumerate(prints) if i < j and (a ^ b).bit_count() <= 2}
    assert len(expected) > 300
    signed = [(int(np.uint64(p).astype(np.int64)), k) for k, p in enumerate(prints)]
    classes = spark.createDataFrame(signed, "bits long, class_id long")
    for shard_rows in (4, 40, 10_000):
        pairs = simhash.hamming_pairs(classes, 2, shard_rows).collect()
        assert len(pairs) == len(expected)
        assert {(min(p), max(p)) for p in map(tuple, pairs)} == expected


def test_rings_prune_without_loss(monkeypatch):
    monkeypatch.setattr(simhash, "_BLOCK", 64)
    draw = np.random.default_rng(3)
    bits = draw.integers(0, 1 << 63, 300, dtype=np.uint64)
    bits = np.concatenate((bits, bits[:100] ^ np.uint64(5)))
    rows = np.arange(len(bits))
    found = {(i, j) for a, b in simhash.ring_pairs(bits, rows, rows, 2) for i, j in zip(a.tolist(), b.tolist(), strict=True)}
    near = np.bitwise_count(bits[:, None] ^ bits[None]) <= 2
    assert found == set(zip(*map(np.ndarray.tolist, np.nonzero(near)), strict=True))


def test_chains_reach_the_smallest_id(spark):
    prints = [0b1, 0b111, 0b11111, 0b1111111, 0b111 << 40]
    classes = spark.createDataFrame([(p, 50 - k) for k, p in enumerate(prints)], "bits long, class_id long")
    pairs = simhash.hamming_pairs(classes, 2, shard_rows=1)
    found = simhash.connected_components(pairs, "a", "b")
    assert {tuple(r) for r in found.collect()} == {(50, 47), (49, 47), (48, 47)}


def test_messy_rows(messy):
    rows = {}
    for r in simhash.near_duplicates(messy).collect():
        rows.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, rows.values())) == 10 and len(rows[1]) == 2
    for i in (2, 3, 4):  # no words: fingerprint zero, linked like any other
        assert (rows[i][0].fingerprint, rows[i][0].component_id) == ("0" * 16, 2)
    texts = {r.doc_id: r.text for r in messy.collect()}
    for i, own in rows.items():
        assert own[0].fingerprint == f"{brute_print(texts[i]):016x}"
    kept = simhash.kept_documents(messy)
    assert kept.columns == messy.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(1) == 1 and {3, 4}.isdisjoint(ids) and 2 in ids and None in ids


def test_without_rows(nothing):
    assert simhash.near_duplicates(nothing).collect() == []
    assert simhash.kept_documents(nothing).collect() == []


def test_copies_leave_one(documents):
    text = " ".join(f"word{k}" for k in range(200))
    rows = documents([(i, text, "en", "s") for i in range(5, 25)] + [(100, "something else entirely here", "en", "s")])
    found = simhash.near_duplicates(rows)
    assert found.where(F.col("component_id") == 5).count() == 20
    assert sorted(r.doc_id for r in simhash.kept_documents(rows).collect()) == [5, 100]


def brute_kept(rows):
    """Fingerprints of all that stay, with their ids, by comparing all with all."""
    prints = {k: brute_print(r[1]) for k, r in enumerate(rows)}
    groups = {}
    for k, component in brute_components(prints).items():
        groups.setdefault(component, []).append((rows[k][0] is None, rows[k][0], prints[k]))
    return sorted((min(group, key=lambda m: (m[0], m[1] or 0, m[2]))[1:] for group in groups.values()), key=str)


def some_text(seed, words=60, changed=None):
    made = [f"w{(seed * 7919 + k * 104729) % 9973}" for k in range(words)]
    return " ".join([*made[:-1], changed] if changed else made)


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_rows_stay_not_ids(spark, documents, parts):
    """Two texts of id 1 that are no copies both stay; copies without an id go with the document they copy."""
    rows = [
        (1, some_text(1), "en", "s"),
        (1, some_text(2), "en", "s"),
        (5, some_text(3), "en", "s"),
        (None, some_text(3), "en", "s"),
        (None, some_text(3), "en", "t"),
        (None, some_text(4), "en", "s"),
        (None, some_text(4), "en", "s"),
        (None, some_text(4), None, "s"),
        (7, some_text(5), "en", "s"),
        (7, some_text(5), "en", "s"),
        (8, some_text(5), "en", "s"),
    ]
    table = documents(rows).repartition(parts)
    kept = simhash.kept_documents(table).collect()
    got = sorted(((r.doc_id, brute_print(r.text)) for r in kept), key=str)
    assert got == brute_kept(rows)
    assert got == sorted([(1, brute_print(some_text(1))), (1, brute_print(some_text(2))), (5, brute_print(some_text(3))), (None, brute_print(some_text(4))), (7, brute_print(some_text(5)))], key=str)
    again = simhash.kept_documents(documents(rows[::-1])).collect()
    assert sorted(map(tuple, kept), key=str) == sorted(map(tuple, again), key=str)


def test_rows_without_an_id_pass_links_on(spark, monkeypatch):
    """9 and 4 are two bits each from a fingerprint that only a row without an id holds."""
    prints = spark.createDataFrame([(9, 0b0), (None, 0b11), (4, 0b1111), (None, 0b111 << 40)], "doc_id long, bits long")
    monkeypatch.setattr(simhash, "fingerprints", lambda *_: prints)
    found = {(r.doc_id, r.fingerprint): r.component_id for r in simhash.near_duplicates(prints).collect()}
    assert found == {(9, f"{0:016x}"): 4, (None, f"{3:016x}"): 4, (4, f"{15:016x}"): 4, (None, f"{7 << 40:016x}"): None}


def test_nodes_of_any_64_bits_are_linked(spark):
    """Fingerprints are nodes, so their sum may leave 64 bits."""
    top = (1 << 63) - 1
    pairs = spark.createDataFrame([(top, top - 1), (top - 2, top - 1), (top - 8, top - 9), (-top, -top - 1)], "a long, b long")
    found = {tuple(r) for r in simhash.connected_components(pairs, "a", "b").collect()}
    assert found == {(top, top - 2), (top - 1, top - 2), (top - 8, top - 9), (-top, -top - 1)}
