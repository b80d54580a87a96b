from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from asset_catalog.llm import merkle


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_leaf(row, **changes):
    values = {**{c: row[c] for c in merkle.COLUMNS}, **changes}
    shown = [None if v is None else str(v) for v in values.values()]
    return sha("".join("-" if v is None else f"{len(v.encode())}:{v}" for v in shown))


def climb(nodes, place):
    """The top of a tree over the nodes, and the siblings of the node at the place on the way there."""
    siblings = []
    while len(nodes) > 1:
        runs = [nodes[k : k + 16] for k in range(0, len(nodes), 16)]
        run, slot = divmod(place, 16)
        siblings.append(("".join(runs[run][:slot]), "".join(runs[run][slot + 1 :])))
        nodes, place = [sha("".join(r)) for r in runs], run
    return nodes[0], siblings


def brute(rows, change=lambda row: {}):
    """(doc_id, leaf, subroot, root, proof, folded) of every row, in any order."""
    ordered = sorted(rows, key=lambda r: (r.doc_id is not None, r.doc_id or 0, brute_leaf(r)))
    sources = sorted({r.source for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: [r for r in ordered if r.source == s] for s in sources}
    subroots = [climb([brute_leaf(r) for r in trees[s]], 0)[0] for s in sources]
    out = []
    for at, s in enumerate(sources):
        for place, r in enumerate(trees[s]):
            root, upper = climb(subroots, at)
            path = climb([brute_leaf(x) for x in trees[s]], place)[1] + upper
            folded = brute_leaf(r, **change(r))
            for left, right in path:
                folded = sha(left + folded + right)
            out.append((r.doc_id, brute_leaf(r), subroots[at], root, "".join(a + b for a, b in path), folded))
    return out


def proved(documents, claims=None):
    return sorted(map(tuple, merkle.prove(merkle.build(documents, claims)).collect()), key=str)


def test_messy_rows_and_sizes_around_a_run(documents, messy):
    """Sources of 1, 16, 17 and 300 rows, a third of all in one; equal ids, equal rows, null ids and sources."""
    sizes = {"a": 1, "b": 16, "ä": 17, None: 300, "": 33, "z/1": 257}
    rows = [(k, f"Text {k}\t{s}", "en" if k % 3 else None, s) for s, n in sizes.items() for k in range(n)]
    rows += [(None, "Lost", "en", "b"), (None, "Lost", "en", "b"), (5, None, None, "a"), (5, "", None, "a"), (10**15, "É" * 70_000, "fr", "b")]
    for table in (documents(rows), messy):
        held = table.collect()
        assert proved(table) == sorted(brute(held), key=str)


def test_tampering_shows(documents):
    table = documents([(k, "Abc" if k % 2 else None, "en", f"s{k % 40}") for k in range(700)])
    even = F.col("doc_id") % 4 == 1
    got = proved(table, {"text": F.when(even, F.lit("abc")).otherwise(F.col("text"))})
    assert got == sorted(brute(table.collect(), lambda r: {"text": "abc"} if r.doc_id % 4 == 1 else {}), key=str)
    assert all((folded == root) == (doc % 4 != 1) for doc, _, _, root, _, folded in got)


@pytest.mark.parametrize("rows", [[(1, "x", "en", "a")], [(k, "x", "en", "a") for k in range(16)]])
def test_one_source(documents, rows):
    assert proved(documents(rows)) == sorted(brute(documents(rows).collect()), key=str)


def test_no_rows(nothing):
    manifest = merkle.build(nothing)
    assert manifest.root is None and merkle.prove(manifest).count() == 0


def test_no_source_is_sorted_by_one_task(spark, documents):
    """The rows of a source that holds nearly all are dealt over the tasks."""
    table = documents([(k, "x", "en", "a") for k in range(4000)]).select(F.lit("=a").alias("tree"), "doc_id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        held = merkle.placed(table, ["doc_id"], "test")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = [spark.read.parquet(f).count() for f in held.inputFiles()]
    assert len(files) == 4 and max(files) < 2000
    assert [(r.doc_id, r.n) for r in held.orderBy("pos").collect()] == [(k, 4000) for k in range(4000)]
