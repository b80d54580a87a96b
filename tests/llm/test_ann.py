from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from asset_catalog.llm import ann
from asset_catalog.llm.common import Rounds

SCHEMA = "vec_id long, embedding array<float>, label int, score string"


def table(spark, ids, vectors):
    rows = [(i, None if v is None else [float(x) if x is not None else None for x in v], 0, "own") for i, v in zip(ids, vectors, strict=True)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def brute(ids, vectors, is_query, most):
    vectors = np.asarray(vectors, np.float32).astype(float)
    out = {}
    for q, v in zip(ids, vectors, strict=True):
        if is_query(q):
            scores = vectors @ v
            order = sorted((k for k in range(len(ids)) if ids[k] != q), key=lambda k: (-scores[k], ids[k]))[:most]
            out[q] = [(ids[k], scores[k]) for k in order]
    return out


def test_small_table_is_searched_exactly(spark):
    draw = np.random.default_rng(1)
    ids, vectors = list(range(300)), draw.normal(size=(300, 8)).astype(np.float32)
    got = ann.nearest(table(spark, ids, vectors), F.col("vec_id") % 20 == 0).collect()
    expected = brute(ids, vectors, lambda i: i % 20 == 0, 20)
    assert len(got) == 15 * 20
    for q, best in expected.items():
        own = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in own] == list(range(1, 21)) and [r.vec_id for r in own] == [b[0] for b in best]
        assert np.allclose([r.score for r in own], [b[1] for b in best])


def test_recall_of_a_grown_graph(spark, longest=3):
    """Small cells, entries and beams, so that descent and search have to find the way."""
    searching = {"entries": 50, "entered": 4, "beam": 32}
    draw = np.random.default_rng(2)
    vectors = draw.normal(size=(3000, 16)) * draw.uniform(1, longest, (3000, 1))
    ids = list(range(3000))
    found = {}
    for rounds in (0, 3):
        got = ann.nearest(table(spark, ids, vectors), F.col("vec_id") % 50 == 0, most=20, growing={"cell_rows": 200, "deals": 2, "rounds": rounds}, searching=searching).collect()
        expected = brute(ids, vectors, lambda i: i % 50 == 0, 20)
        mine = {}
        for r in got:
            mine.setdefault(r.query_id, set()).add(r.vec_id)
        found[rounds] = np.mean([len({b[0] for b in best} & mine[q]) / 20 for q, best in expected.items()])
    assert found[3] >= 0.9 and found[3] > found[0], found


def test_copies_and_ties(spark):
    ids = list(range(0, 120))
    vectors = [[1.0, 0.0]] * 100 + [[0.0, 1.0]] * 20
    got = ann.nearest(table(spark, ids, vectors), F.col("vec_id").isin(0, 50, 110)).collect()
    expected = brute(ids, vectors, lambda i: i in (0, 50, 110), 20)
    for q, best in expected.items():
        assert [r.vec_id for r in sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)] == [b[0] for b in best]


def test_messy_rows(spark):
    vectors = [[1.0, 2.0], None, [], [0.0, 0.0], [1.0, None], [float("nan"), 1.0], [float("inf"), 0.0], [1.0, 2.0, 3.0], [2.0, 1.0], [3.0, 3.0], [1.0, 2.0], [9.0, 9.0]]
    ids = [0, 20, 40, 60, 80, 100, 120, 140, 1, 2, 0, None]
    got = ann.nearest(table(spark, ids, vectors), F.col("vec_id") % 20 == 0).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == [(0, 1, 2, 9.0), (0, 2, 1, 4.0)]


def test_every_length_is_served(spark):
    draw = np.random.default_rng(5)
    parts = {3: list(range(0, 60)), 8: list(range(60, 300)), 1: [300]}
    vectors = {width: draw.normal(size=(len(ids), width)).astype(np.float32) for width, ids in parts.items()}
    rows = [(i, v) for width, ids in parts.items() for i, v in zip(ids, vectors[width], strict=True)]
    got = ann.nearest(table(spark, *zip(*rows, strict=True)), F.col("vec_id") % 20 == 0).collect()
    expected = {}
    for width, ids in parts.items():
        expected |= brute(ids, vectors[width], lambda i: i % 20 == 0, 20)
    assert sorted((r.query_id, r.rank, r.vec_id) for r in got) == sorted((q, k + 1, b[0]) for q, best in expected.items() for k, b in enumerate(best))


def test_many_near_copies_are_ranked_by_their_vectors(spark):
    """Scores within a group differ by less than the codes can tell."""
    draw = np.random.default_rng(6)
    vectors = (draw.normal(size=16) + draw.normal(size=(400, 16)) * 1e-4).astype(np.float32)
    ids = list(range(400))
    got = ann.nearest(table(spark, ids, vectors), F.col("vec_id") % 100 == 0).collect()
    for q, best in brute(ids, vectors, lambda i: i % 100 == 0, 20).items():
        assert [r.vec_id for r in sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)] == [b[0] for b in best]


def test_a_node_that_all_have_as_neighbour(spark):
    """One very long vector: a meeting has few members, all find the hub, and offers to it are cut before the shuffle."""
    draw = np.random.default_rng(7)
    vectors = np.abs(draw.normal(size=(2000, 8)))
    vectors[0] *= 50
    state = ann.grow_graph(coded(spark, vectors).repartition(4), 8, cell_rows=200)
    assert state.where(F.array_contains("others", 0)).count() > 1900
    assert ann._members(state, 16).groupBy("place").count().agg(F.max("count")).first()[0] <= ann.KEPT + 16
    again = state.withColumn("fresh", F.transform("fresh", lambda _: F.lit(True))).withColumn("scores", F.transform("scores", lambda _: F.lit(-1e9).cast("float")))
    offered = ann.descend(again, ann.KEPT, 16, ann.TAKEN).where("node = 0").agg(F.sum(F.size("others"))).first()[0]
    assert ann.KEPT <= offered <= ann.KEPT * 2 * 8  # a list from each batch of each of eight tasks, not from some 1,900 meetings


@pytest.mark.parametrize("vectors", [[], [None, None], [[1.0, 1.0]]])
def test_without_candidates(spark, vectors):
    assert ann.nearest(table(spark, range(len(vectors)), vectors), F.col("vec_id") % 20 == 0).collect() == []


def coded(spark, vectors):
    return ann.encode(spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "node long, vector array<float>")).repartition(2)


def test_search_goes_on_while_nodes_are_open(spark):
    """A chain that leads to the best node one step a round."""
    vectors = [[1.0, 1.0 + i] for i in range(40)]
    nodes = coded(spark, vectors)
    links = spark.createDataFrame([(i, i + 1) for i in range(39)], "node long, member long")
    graph = ann.packed(links.join(nodes.withColumnRenamed("node", "member"), "member").groupBy("node").agg(F.collect_list(F.struct("member", "code", "scale")).alias("near")))
    queries = spark.createDataFrame([(7, [0.0, 1.0])], "query long, vector array<float>")
    chain = {"beam": 4, "entered": 1, "entries": 4}
    assert ann.search(queries, nodes, graph, **chain).first().ids[0] == 39
    with pytest.warns(UserWarning, match="open nodes after 2 rounds"):
        assert ann.search(queries, nodes, graph, **chain, steps=2).first().ids[0] < 39


def test_descent_goes_on_until_lists_settle(spark):
    nodes = coded(spark, np.random.default_rng(3).normal(size=(1500, 16)))
    state = ann.grow_graph(nodes, 16, cell_rows=100)
    new, total = state.agg(F.sum(F.size(F.filter("fresh", lambda f: f))), F.sum(F.size("others"))).first()
    assert new < 0.001 * total
    with pytest.warns(UserWarning, match="not settled after 1 rounds"):
        ann.grow_graph(nodes, 16, cell_rows=100, rounds=1)


def test_only_places_with_a_newcomer_meet(spark):
    """What descent moves shrinks with what is new; the places that meet have all their members."""
    state = ann.grow_graph(coded(spark, np.random.default_rng(8).normal(size=(600, 16))), 16, cell_rows=100)
    rows = lambda frame: sorted((r.place, r.member, r.fresh) for r in frame.collect())
    one = state.withColumn("fresh", F.transform("others", lambda _, i: (F.col("node") == 5) & (i == 0)))
    members = rows(ann._members(one, 16))
    places = {place for place, _, fresh in members if fresh}
    assert 1 <= len(places) <= 2 and rows(ann._meetings(one, 16)) == [m for m in members if m[0] in places]
    assert ann._meetings(state.withColumn("fresh", F.transform("fresh", lambda _: F.lit(False))), 16).isEmpty()


def test_groups_are_whole_where_batches_end_inside_of_them(spark):
    nodes = coded(spark, np.random.default_rng(9).normal(size=(400, 8)))
    state = ann.grow_graph(nodes, 8, cell_rows=50, rounds=0)

    def both():
        offers = ann.descend(state, ann.KEPT, 16, ann.TAKEN).select("node", F.explode(F.arrays_zip("others", "scores")).alias("o")).distinct()
        graph = ann.adjacency(state).select("node", F.array_sort("ids").alias("ids"), F.length("codes").alias("bytes"))
        return sorted((r.node, r.o.others, round(r.o.scores, 4)) for r in offers.collect()), sorted((r.node, *r.ids, r.bytes) for r in graph.collect())

    expected = both()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert both() == expected and len(expected[1]) == 400
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_rounds_leave_the_last_result_only(spark):
    rounds = Rounds(spark, "test-rounds")
    rows = spark.range(10)
    for _ in range(3):
        rows = rounds.put(rows.withColumn("id", F.col("id") + 1))
    assert [r.id for r in rows.orderBy("id").collect()] == list(range(3, 13))
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(rounds.path)
    assert [f.getPath().getName() for f in path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)] == ["2"]
