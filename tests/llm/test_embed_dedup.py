from __future__ import annotations

import numpy as np
import pytest

from asset_catalog.llm import embed_dedup

SCHEMA = "vec_id long, embedding array<float>, label int, n_links string"


def brute(rows, least):
    """Links and components by comparing all pairs; rows: (id, vector, label)."""
    good = [(i, np.array(v, float), y) for i, v, y in rows if i is not None and y is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    links, root = {r[0]: 0 for r in rows}, {r[0]: r[0] for r in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, (i, v, y) in enumerate(good):
        for j, w, z in good[n + 1 :]:
            if y == z and len(v) == len(w) and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= least:
                links[i] += 1
                links[j] += 1
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (links[i], find(i), find(i) == i) if i is not None else (0, None, False) for i in links}


def answers(rows):
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in rows}


def clustered(draw, count, size, spread):
    rows, at = [], 0
    for _ in range(count):
        middle = draw.normal(size=16)
        for _ in range(draw.integers(1, size)):
            rows.append((at, (middle + draw.normal(0, spread, 16)).astype(np.float32).tolist(), int(draw.integers(2))))
            at += 1
    return rows


@pytest.mark.parametrize(("leaf_rows", "block_rows"), [(8, 5), (50, 1000), (100_000, 7)])
def test_matches_brute_force(spark, leaf_rows, block_rows):
    rows = clustered(np.random.default_rng(leaf_rows), 30, 25, 0.1)
    table = spark.createDataFrame([(*r, "own") for r in rows], SCHEMA).repartition(3)
    expected = brute(rows, 0.98)
    assert sum(e[0] for e in expected.values()) > 100
    got = embed_dedup.link_vectors(table, 0.98, leaf_rows, block_rows).collect()
    assert len(got) == len(rows) and answers(got) == expected


def test_any_number_of_labels(spark):
    draw = np.random.default_rng(9)
    rows = [(i, v, i % 150 if i % 3 else -1) for i, v, _ in clustered(draw, 40, 20, 0.05)]
    got = embed_dedup.link_vectors(spark.createDataFrame([(*r, "own") for r in rows], SCHEMA).repartition(3), 0.98, 10, 6).collect()
    expected = brute(rows, 0.98)
    assert sum(e[0] for e in expected.values()) > 50 and answers(got) == expected


def test_tree_is_nested_and_covers():
    sample = embed_dedup.unit(np.random.default_rng(1).normal(size=(200, 6)))
    tree = embed_dedup.grow(sample)
    assert tree.counts[-1] == 200 and tree.counts == sorted(tree.counts)
    for level, (count, parent) in enumerate(zip(tree.counts, tree.parents, strict=True)):
        radius = 2.0 / 2 ** (level - 1) if level else 2.0
        gaps = np.linalg.norm(tree.centres[:count] - tree.centres[parent], axis=1)
        assert (gaps <= radius + 1e-9).all()
        if level:
            assert (parent < tree.counts[level - 1]).all() and (parent[: tree.counts[level - 1]] == np.arange(tree.counts[level - 1])).all()


def test_traversal_drops_only_what_cannot_link():
    draw = np.random.default_rng(2)
    points = embed_dedup.unit(np.repeat(draw.normal(size=(40, 5)), 10, axis=0) + draw.normal(0, 0.05, (400, 5)))
    tree = embed_dedup.grow(points[::8])
    leaf = (points @ tree.centres.T).argmax(axis=1)
    gaps = np.linalg.norm(points - tree.centres[leaf], axis=1)
    radii = np.zeros(len(tree.centres))
    np.maximum.at(radii, leaf, gaps)
    kept = {tuple(p) for p in tree.pairs(radii, 0.2).tolist()}
    i, j = np.nonzero(np.linalg.norm(points[:, None] - points[None], axis=2) <= 0.2)
    assert {(min(a, b), max(a, b)) for a, b in zip(leaf[i].tolist(), leaf[j].tolist(), strict=True)} <= kept
    assert len(kept) < len(radii) * (len(radii) + 1) / 4 and all(a <= b for a, b in kept)


def test_copies_ties_and_scales(spark):
    v = [3.0, 4.0] + [0.0] * 3
    rows = [(k, [x * (1 + k % 3) for x in v], 1) for k in range(40)] + [(100, [-x for x in v], 1), (101, v, 2)]
    got = answers(embed_dedup.link_vectors(spark.createDataFrame([(*r, "own") for r in rows], SCHEMA), 0.98, 8, 6).collect())
    assert all(got[k] == (39, 0, k == 0) for k in range(40)) and got[100] == (0, 100, True) and got[101] == (0, 101, True)


def test_messy_rows(spark):
    rows = [
        (1, [1.0, 0.0], 1), (2, [1.0, 0.0], None), (3, None, 1), (4, [], 1), (5, [0.0, 0.0], 1), (6, [1.0, None], 1),
        (7, [float("nan"), 1.0], 1), (8, [float("inf"), 1.0], 1), (9, [1.0, 0.0, 0.0], 1), (10, [2.0, 0.0], 1), (None, [1.0, 0.0], 1), (10, [2.0, 0.0], 1),
    ]
    got = embed_dedup.link_vectors(spark.createDataFrame([(*r, "own") for r in rows], SCHEMA)).collect()
    assert len(got) == 11 and answers(got) == brute(rows[:-1], 0.98)
    assert embed_dedup.link_vectors(spark.createDataFrame([], SCHEMA)).collect() == []
    nothing_links = [(k, None, None, "own") for k in range(3)]
    assert answers(embed_dedup.link_vectors(spark.createDataFrame(nothing_links, SCHEMA)).collect()) == {k: (0, k, True) for k in range(3)}
