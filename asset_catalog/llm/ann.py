"""Approximate nearest neighbours by inner product: a neighbour graph grown by NN-descent, and greedy search in it.

Equal vectors are one node. Nodes are kept as 16-bit codes with a scale, which tell near copies apart; only the
last ranking reads the vectors as they came. Neighbours are those of the largest inner product, so long vectors, which answer many
queries, are neighbours of many nodes and found from everywhere.

Grow: nodes fall into cells by random hyperplanes, and each takes its best partners within a cell as first
neighbours, twice over. Then NN-descent: a neighbour's neighbour is likely a neighbour. Every round joins
each node's neighbours, and those that have it as one, with their codes; among those that meet at a node,
pairs with a newcomer are compared, and whoever finds a partner better than its last neighbour takes it.
Rounds end when hardly any list still changes. Search: every query starts at the best of a set of entry nodes, keeps a
beam of the best nodes met, and each round expands all that are not expanded yet: a join with their adjacency rows.
A query leaves the rounds when every node of its beam is expanded. Both come to an end by themselves: lists and full
beams only take what is better than their last. A limit to the rounds can be given; one that cuts them short is warned of.
Last, all of a beam that the codes' rounding leaves in the running are ranked by their vectors.

Rows, not tasks, grow with the data: lists, beams, entries and cells have fixed sizes, and a meeting has at most as
many members as a list and the reverse side that joins it. A node that very many have as a neighbour goes to all their
meetings: adaptive execution splits that join, and what such a node is offered is cut to its best before the shuffle.
The graph holds every vector; what it costs is recall, which tests measure against brute force.

Defined cases: null, empty and zero vectors and those with null or non-finite components are neither queries nor
candidates, nor are rows with a null id; vectors of different lengths have no product, so each length has a graph
of its own and answers its own queries; rows that share an id are one, the smallest by components; equal scores go
to the smaller id."""

from __future__ import annotations

import functools
import itertools
import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from asset_catalog.llm.common import Rounds, sampled, stored
from asset_catalog.llm.embed_dedup import usable

#: Neighbours that a node keeps, and reverse ones that join them.
KEPT, REVERSE = 24, 16
#: Rows of groups that are worked on at once; a node that is at so many of their meetings gets the best of its offers only.
MET, MANY = 20_000, 16
#: Partners that a node takes from one meeting: as many as it could keep.
TAKEN = KEPT
#: Nodes of a first cell, and how often nodes are dealt into cells.
CELL_ROWS, DEALS = 4096, 2
#: Descent ends when less than this share of all neighbours is new.
SETTLED = 0.001
#: Search: entry nodes, how many of them a beam starts with, and the beam.
ENTRIES, ENTERED, BEAM = 1024, 48, 512


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and lengths of a list column without nulls."""
    return column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())


def _listed(values: np.ndarray, lengths: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(lengths))), pa.int32()), pa.array(values))


def _decoded(codes: pa.Array | pa.ChunkedArray, scales: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Vectors of fixed-length binary codes; a value may hold the codes of several vectors."""
    if isinstance(codes, pa.ChunkedArray):
        codes = codes.combine_chunks()
    ends = np.frombuffer(codes.buffers()[1], np.int32)[codes.offset : codes.offset + len(codes) + 1]
    flat = np.frombuffer(codes.buffers()[2], np.int16, (ends[-1] - ends[0]) // 2, ends[0]).reshape(len(scales), -1)
    return flat * scales.to_numpy()[:, None]


def _best(owner: np.ndarray, other: np.ndarray, score: np.ndarray, mark: np.ndarray, most: int) -> np.ndarray:
    """Rows of the `most` best others of each owner, best first; of an other met twice, the one with the lowest mark."""
    order = np.lexsort((mark, other, owner))
    first = np.ones(len(order), bool)
    first[1:] = (owner[order][1:] != owner[order][:-1]) | (other[order][1:] != other[order][:-1])
    order = order[first]
    order = order[np.lexsort((other[order], -score[order], owner[order]))]
    owners = owner[order]
    start = np.flatnonzero(np.concatenate(([True], owners[1:] != owners[:-1]))) if len(owners) else np.empty(0, np.int64)
    rank = np.arange(len(owners)) - np.repeat(start, np.diff(np.append(start, len(owners))))
    return order[rank < most]


def _cut(owner: np.ndarray, others: np.ndarray, scores: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The `most` best offers of each owner, in order of owners."""
    rows = _best(owner, others, scores, np.zeros(len(owner)), most)
    return owner[rows], others[rows], scores[rows]


def encode(vectors: DataFrame) -> DataFrame:
    """(node, code, scale) of (node, vector): each component in 16 bits."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, -1)
            scale = np.abs(rows).max(axis=1) / 32767
            small = np.rint(rows / scale[:, None]).astype(np.int16)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in small], pa.binary()), pa.array(scale.astype(np.float32))], names=["node", "code", "scale"])

    return vectors.select("node", "vector").mapInArrow(code, "node long, code binary, scale float")


def first_neighbours(nodes: DataFrame, width: int, deal: int, cell_rows: int, kept: int) -> DataFrame:
    """(node, others, scores): best partners within cells of random hyperplanes. width: components."""
    count = nodes.count()
    planes = np.random.default_rng(100 + deal).normal(size=(width, max(0, int(np.ceil(np.log2(max(1, count) / cell_rows))))))

    def side(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cell = (_decoded(batch.column(1), batch.column(2)) @ planes > 0) @ (1 << np.arange(planes.shape[1], dtype=np.int64))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int64))], names=["node", "code", "scale", "cell"])

    celled = nodes.mapInArrow(side, "node long, code binary, scale float, cell long")
    sizes = celled.groupBy("cell").agg(F.count("*").alias("size"))
    parts = F.pmod(F.xxhash64("node", F.lit(deal)), F.ceil(F.col("size") / F.lit(cell_rows)).cast("long"))
    dealt = celled.join(sizes, "cell").select("cell", parts.alias("part"), "node", "code", "scale")

    def best(cell: pa.Table) -> pa.Table:
        table = cell.combine_chunks()
        ids = table.column("node").to_numpy()
        vectors = _decoded(table.column("code"), table.column("scale"))
        most = min(kept, len(ids) - 1)
        others, scores = [], []
        for at in range(0, len(ids), 512):
            near = vectors[at : at + 512] @ vectors.T
            near[np.arange(len(near)), at + np.arange(len(near))] = -np.inf
            some = np.argpartition(-near, most - 1, axis=1)[:, :most] if most else np.empty((len(near), 0), np.int64)
            others.append(ids[some].reshape(-1))
            scores.append(np.take_along_axis(near, some, axis=1).reshape(-1))
        lengths = np.full(len(ids), most)
        return pa.table({"node": ids, "others": _listed(np.concatenate(others), lengths), "scores": _listed(np.concatenate(scores), lengths)})

    return dealt.groupBy("cell", "part").applyInArrow(best, "node long, others array<long>, scores array<float>")


def _merged(candidates: DataFrame, old: DataFrame, kept: int) -> DataFrame:
    """(node, code, scale, others, scores, fresh): each node's best of its candidates and old neighbours."""
    met = candidates.select("node", F.lit(None).cast("binary").alias("code"), F.lit(None).cast("float").alias("scale"), "others", "scores", F.lit(True).alias("new"))
    met = met.unionByName(old.select("node", "code", "scale", "others", "scores", F.lit(False).alias("new")))
    grouped = met.groupBy("node").agg(
        F.max("code").alias("code"),
        F.max("scale").alias("scale"),
        F.flatten(F.collect_list("others")).alias("others"),
        F.flatten(F.collect_list("scores")).alias("scores"),
        F.flatten(F.collect_list(F.transform("others", lambda _: F.col("new")))).alias("fresh"),
    )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                others, lengths = _lists(part.column(3))
                scores, fresh = _lists(part.column(4))[0], _lists(part.column(5))[0]
                owner = np.repeat(np.arange(part.num_rows), lengths)
                rows = _best(owner, others, scores, fresh, kept)
                lengths = np.bincount(owner[rows], minlength=part.num_rows)
                yield pa.RecordBatch.from_arrays([*part.columns[:3], _listed(others[rows], lengths), _listed(scores[rows], lengths), _listed(fresh[rows], lengths)], names=names)

    names = ["node", "code", "scale", "others", "scores", "fresh"]
    return grouped.mapInArrow(merge, "node long, code binary, scale float, others array<long>, scores array<float>, fresh array<boolean>")


def _links(state: DataFrame, reverse: int) -> tuple[DataFrame, DataFrame]:
    """(place, member, fresh) of each node's neighbours, and of up to `reverse` nodes that have it as one."""
    edges = state.select("node", F.explode(F.arrays_zip("others", "fresh")).alias("edge")).select("node", "edge.others", "edge.fresh")
    luck = F.row_number().over(Window.partitionBy("others").orderBy(F.xxhash64("node", "others"), "node"))
    forward = edges.select(F.col("node").alias("place"), F.col("others").alias("member"), "fresh")
    backward = edges.withColumn("rank", luck).where(F.col("rank") <= reverse)
    return forward, backward.select(F.col("others").alias("place"), F.col("node").alias("member"), "fresh")


def _members(state: DataFrame, reverse: int) -> DataFrame:
    """(place, member, fresh): who meets at each node: its neighbours, and up to `reverse` that have it as one."""
    forward, backward = _links(state, reverse)
    return forward.unionByName(backward)


def _meetings(state: DataFrame, reverse: int) -> DataFrame:
    """_members of the places that a newcomer is at: no pair is compared at the others."""
    backward = _links(state, reverse)[1].groupBy("place").agg(F.collect_list(F.struct("member", "fresh")).alias("back"))
    own = F.transform(F.arrays_zip("others", "fresh"), lambda e: F.struct(e["others"].alias("member"), e["fresh"].alias("fresh")))
    places = state.select(F.col("node").alias("place"), own.alias("own")).join(backward, "place", "left")
    met = places.select("place", F.concat("own", F.coalesce("back", F.array().cast("array<struct<member:bigint,fresh:boolean>>"))).alias("members"))
    met = met.where(F.exists("members", lambda m: m["fresh"]))
    return met.select("place", F.explode("members").alias("met")).select("place", "met.member", "met.fresh")


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, pa.Table]]:
    """Sizes and rows of some groups at once, about MET rows. Rows come in order of their group, the first column; a batch may end
    inside of one."""
    held, count = [], 0
    for batch in itertools.chain(batches, [None]):
        if batch is not None:
            held.append(batch)
            count += batch.num_rows
        if not count or (batch is not None and count < MET):
            continue
        rows = pa.Table.from_batches(held).combine_chunks()
        groups = rows.column(0).to_numpy()
        starts = np.flatnonzero(np.concatenate(([True], groups[1:] != groups[:-1])))
        end = count if batch is None else int(starts[-1])
        if end:
            yield np.diff(np.append(starts[starts < end], end)), rows.slice(0, end)
        held = rows.slice(end).to_batches()
        count -= end


def descend(state: DataFrame, kept: int, reverse: int, taken: int) -> DataFrame:
    """One round: (node, others, scores), partners that nodes found where they met."""
    last = F.when(F.size("scores") < kept, F.lit(float("-inf"))).otherwise(F.array_min("scores")).cast("float")
    known = state.select(F.col("node").alias("member"), "code", "scale", last.alias("last"))
    met = _meetings(state, reverse).join(known, "member").select("place", "member", "fresh", "code", "scale", "last")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # What is offered to those who are at many meetings at once: the best of a whole task.
        often = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.float32)
        for sizes, rows in _whole(batches):
            ids, fresh, last = (rows.column(k).to_numpy() for k in ("member", "fresh", "last"))
            vectors = _decoded(rows.column("code"), rows.column("scale"))
            widest = int(sizes.max(initial=0))
            row = np.repeat(np.arange(len(sizes)), sizes)
            column = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            block = np.zeros((len(sizes), widest, vectors.shape[1]), np.float32)
            block[row, column] = vectors
            near = np.matmul(block, block.transpose(0, 2, 1))[row, column]  # [member, column]
            there = np.full((len(sizes), widest), -1, np.int64)
            there[row, column] = ids
            news = np.zeros((len(sizes), widest), bool)
            news[row, column] = fresh
            allowed = (there[row] >= 0) & (there[row] != ids[:, None]) & (fresh.astype(bool)[:, None] | news[row])
            near[~allowed | (near <= last[:, None])] = -np.inf
            most = min(taken, widest)
            some = np.argpartition(-near, most - 1, axis=1)[:, :most]
            scores = np.take_along_axis(near, some, axis=1)
            good = scores > -np.inf
            lengths = good.sum(axis=1)
            _, same, times = np.unique(ids, return_inverse=True, return_counts=True)
            many = times[same] >= MANY
            if many.any():
                there_of = np.take_along_axis(there[row], some, axis=1)
                hubs = good & many[:, None]
                more = np.repeat(ids, hubs.sum(axis=1)), there_of[hubs], scores[hubs]
                often = _cut(*map(np.concatenate, zip(often, more, strict=True)), kept)
                good &= ~many[:, None]
                lengths = good.sum(axis=1)
            keep = lengths > 0
            yield offers(ids[keep], np.take_along_axis(there[row], some, axis=1)[good], scores[good], lengths[keep])
        if len(often[0]):
            owner, others, scores = often
            each, lengths = np.unique(owner, return_counts=True)
            yield offers(each, others, scores, lengths)

    def offers(ids: np.ndarray, others: np.ndarray, scores: np.ndarray, lengths: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(ids), _listed(others, lengths), _listed(scores, lengths)], names=["node", "others", "scores"])

    return met.repartition("place").sortWithinPartitions("place").mapInArrow(compare, "node long, others array<long>, scores array<float>")


def grow_graph(nodes: DataFrame, width: int, kept: int = KEPT, reverse: int = REVERSE, taken: int = TAKEN, cell_rows: int = CELL_ROWS, deals: int = DEALS, rounds: int | None = None, settled: float = SETTLED) -> DataFrame:
    """(node, code, scale, others, scores, fresh): the neighbour graph of (node, code, scale).

    rounds: at most so many, None for no limit."""
    dealt = [first_neighbours(nodes, width, deal, cell_rows, kept) for deal in range(deals)]
    candidates = dealt[0]
    for more in dealt[1:]:
        candidates = candidates.unionByName(more)
    alone = nodes.select("*", F.array().cast("array<long>").alias("others"), F.array().cast("array<float>").alias("scores"))
    states = Rounds(nodes.sparkSession, "ann-graph")
    state = states.put(_merged(candidates, alone, kept))
    for done in itertools.count():
        if done == rounds:
            warnings.warn(f"the graph had not settled after {rounds} rounds", stacklevel=2)
            break
        state = states.put(_merged(descend(state, kept, reverse, taken), state, kept))
        new, all_of_them = state.agg(F.sum(F.size(F.filter("fresh", lambda f: f))), F.sum(F.size("others"))).first()
        if not all_of_them or new < settled * all_of_them:
            break
    return state


def adjacency(state: DataFrame, reverse: int = REVERSE) -> DataFrame:
    """(node, ids, codes, scales): each node's neighbours and some reverse ones, their codes in one value."""
    links = _members(state, reverse).select(F.col("place").alias("node"), "member").distinct()
    coded = links.join(state.select(F.col("node").alias("member"), "code", "scale"), "member")
    return Rounds(state.sparkSession, "ann-adjacency").put(_packed(coded))


def packed(graph: DataFrame) -> DataFrame:
    """(node, ids, codes, scales) of (node, near): what a search moves once for each query that comes by."""
    return _packed(graph.select("node", F.explode("near").alias("near")).select("node", "near.member", "near.code", "near.scale"))


def _packed(coded: DataFrame) -> DataFrame:
    """packed of (node, member, code, scale)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for sizes, rows in _whole(batches):
            ends = np.cumsum(sizes)
            codes = rows.column("code").to_pylist()
            joined = [b"".join(codes[a:b]) for a, b in itertools.pairwise([0, *ends])]
            nodes = rows.column("node").to_numpy()[ends - 1]
            yield pa.RecordBatch.from_arrays([pa.array(nodes), _listed(rows.column("member").to_numpy(), sizes), pa.array(joined, pa.binary()), _listed(rows.column("scale").to_numpy(), sizes)], names=["node", "ids", "codes", "scales"])

    rows = coded.select("node", "member", "code", "scale").repartition("node").sortWithinPartitions("node")
    return rows.mapInArrow(pack, "node long, ids array<long>, codes binary, scales array<float>")


def search(queries: DataFrame, nodes: DataFrame, graph: DataFrame, beam: int = BEAM, entered: int = ENTERED, steps: int | None = None, entries: int = ENTRIES) -> DataFrame:
    """(query, ids, scores): the beam of each query, best first. queries: (query, vector); graph: of adjacency; steps:
    at most so many rounds, None for no limit."""
    drawn = sampled(nodes, F.col("node"), entries, 8).orderBy("node").toArrow().combine_chunks()
    entry_ids = drawn.column("node").to_numpy()
    entry_vectors = _decoded(drawn.column("code"), drawn.column("scale")) if len(entry_ids) else np.zeros((0, 1), np.float32)
    schema = "query long, vector array<float>, ids array<long>, scores array<float>, done array<boolean>"
    names = ["query", "vector", "ids", "scores", "done"]

    def plain(column: pa.Array, count: int) -> np.ndarray:
        return column.flatten().to_numpy(zero_copy_only=False).reshape(count, -1)

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                vectors = plain(part.column(1), part.num_rows)
                scores = vectors @ entry_vectors.T
                most = min(entered, beam, scores.shape[1])
                best = np.argsort(-scores, axis=1, kind="stable")[:, :most]
                lengths = np.full(part.num_rows, most)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), _listed(entry_ids[best].reshape(-1), lengths), _listed(np.take_along_axis(scores, best, axis=1).reshape(-1).astype(np.float32), lengths), _listed(np.zeros(best.size, bool), lengths)], names=names)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                vectors = plain(part.column(1), part.num_rows)
                least = part.column(2).to_numpy()
                ids, sizes = _lists(part.column(3))
                row = np.repeat(np.arange(part.num_rows), sizes)
                coded = _decoded(part.column(4), part.column(5).flatten())
                scores = np.einsum("ij,ij->i", coded, vectors[row])
                good = scores > least[row]
                lengths = np.bincount(row[good], minlength=part.num_rows)
                yield pa.RecordBatch.from_arrays([part.column(0), _listed(ids[good], lengths), _listed(scores[good].astype(np.float32), lengths)], names=["query", "ids", "scores"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                count = part.num_rows
                ids, lengths = _lists(part.column(2))
                scores = _lists(part.column(3))[0]
                found, more = _lists(part.column(5))
                found_scores = _lists(part.column(6))[0]
                owner = np.concatenate((np.repeat(np.arange(count), lengths), np.repeat(np.arange(count), more)))
                ids, scores = np.concatenate((ids, found)), np.concatenate((scores, found_scores))
                # What was open in the last round has been expanded by now.
                done = np.concatenate((np.ones(lengths.sum(), bool), np.zeros(len(found), bool)))
                rows = _best(owner, ids, scores, ~done, beam)
                lengths = np.bincount(owner[rows], minlength=count)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), _listed(ids[rows], lengths), _listed(scores[rows], lengths), _listed(done[rows], lengths)], names=names)

    # Queries that have ended are read from their round's beams.
    rounds = Rounds(queries.sparkSession, "ann-beams", kept=None)
    beams = rounds.put(queries.select("query", F.col("vector").cast("array<float>").alias("vector")).mapInArrow(enter, schema))
    ended = []
    for step in itertools.count():
        is_open = F.exists("done", lambda d: ~d)
        ended.append(beams.where(~is_open))
        beams = beams.where(is_open)
        if beams.isEmpty():
            break
        if step == steps:
            warnings.warn(f"beams had open nodes after {steps} rounds", stacklevel=2)
            ended.append(beams)
            break
        still = F.filter(F.arrays_zip("ids", "done"), lambda t: ~t["done"])
        least = F.when(F.size("scores") >= beam, F.array_min("scores")).otherwise(F.lit(float("-inf"))).cast("float")
        front = beams.select("query", "vector", least.alias("least"), F.explode(still).alias("at")).select("query", "vector", "least", F.col("at.ids").alias("node"))
        found = front.join(graph, "node").select("query", "vector", "least", "ids", "codes", "scales").mapInArrow(score, "query long, ids array<long>, scores array<float>")
        per_query = found.groupBy("query").agg(F.flatten(F.collect_list("ids")).alias("found"), F.flatten(F.collect_list("scores")).alias("found_scores"))
        nothing = F.array().cast("array<long>"), F.array().cast("array<float>")
        joined = beams.join(per_query, "query", "left").select(*names, F.coalesce("found", nothing[0]).alias("found"), F.coalesce("found_scores", nothing[1]).alias("found_scores"))
        beams = rounds.put(joined.mapInArrow(merge, schema))
    return functools.reduce(DataFrame.unionByName, ended).select("query", "ids", "scores")


def nearest(embeddings: DataFrame, is_query: Column, most: int = 20, growing: dict | None = None, searching: dict | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the `most` nearest found for every row where is_query holds.

    growing and searching: settings of grow_graph and search. Each length of vectors has a graph of its own, one
    after the other: a table has a few."""
    one = embeddings.where(F.col("vec_id").isNotNull()).groupBy("vec_id").agg(F.min("embedding").alias("vector"))
    able = stored(one.where(usable(F.col("vector"))).select("*", F.size("vector").alias("length"), is_query.alias("asked")), "ann-vectors")
    lengths = able.groupBy("length").agg(F.max("asked").alias("asked")).where("asked").orderBy("length")
    found = [_nearest(able.where(F.col("length") == r.length), r.length, most, growing or {}, searching or {}) for r in lengths.collect()]
    nothing = embeddings.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return functools.reduce(DataFrame.unionByName, found) if found else nothing


def _nearest(able: DataFrame, length: int, most: int, growing: dict, searching: dict) -> DataFrame:
    """nearest of (vec_id, vector, asked), vectors of one length."""
    vectors = stored(able.groupBy("vector").agg(F.min("vec_id").alias("node")), "ann-nodes")
    nodes = stored(encode(vectors), "ann-codes")
    queries = stored(able.where("asked").select(F.col("vec_id").alias("query"), "vector"), "ann-queries")
    state = grow_graph(nodes, length, **growing)
    beams = search(queries, nodes, adjacency(state), **searching)

    # A code differs from its vector by half a scale in each component, so a score by no more than `off` (the small
    # part is for sums in 32 bits). What scores less than the best `most` beside the query's own by twice that is out.
    widest = nodes.agg(F.max("scale")).first()[0] or 0.0
    size = F.aggregate("vector", F.lit(0.0), lambda s, x: s + F.abs(x.cast("double")))
    off = size * F.lit(float(widest) * (0.5 + 32767 * 2.0**-23 * (length + 2)))
    least = F.when(F.size("scores") > most, F.element_at("scores", most + 1).cast("double") - 2 * off).otherwise(F.lit(float("-inf")))
    running = beams.join(queries, "query").withColumn("least", least)
    running = running.select("query", "vector", F.explode(F.filter(F.arrays_zip("ids", "scores"), lambda t: t["scores"] >= F.col("least"))).alias("at"))
    pairs = running.select("query", "vector", F.col("at.ids").alias("node"))

    # The nearest nodes in double precision, then the rows that share their vectors, `most` and the query's own at most.
    by_id = Window.partitionBy("vector").orderBy("vec_id")
    alike = able.withColumn("place", F.row_number().over(by_id)).where(F.col("place") <= most + 1).select("vec_id", "vector")
    candidates = alike.join(vectors, "vector").select("node", "vec_id", F.col("vector").alias("other"))
    product = F.aggregate(
        F.zip_with("vector", "other", lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x
    )
    scored = pairs.join(candidates, "node").where(F.col("vec_id") != F.col("query")).select("query", "vec_id", product.alias("score"))
    by_score = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    ranked = scored.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= most)
    return ranked.select(F.col("query").cast("long").alias("query_id"), F.col("rank").cast("int").alias("rank"), F.col("vec_id").cast("long").alias("vec_id"), "score")
