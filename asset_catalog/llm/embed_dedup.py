"""Near-duplicate vectors by a dual traversal of cover trees: all pairs with a cosine at or above a threshold.

Vectors of a label (and length) are unit vectors on a sphere, where a cosine is a distance. For each label a
cover tree is grown over a bounded sample: levels of centres with halving radii, each level within
the next, every centre within its parent's radius. Each vector belongs to its nearest centre; exact
covering radii come from all vectors. The dual traversal goes down from the root paired with itself,
level by level, and drops a pair of nodes as soon as the distance of the centres exceeds their covering radii
and the distance of a link together: no link can cross it. Pairs of leaves that survive are compared in
double precision, block by block; within a block pair, a centre's radius drops single vectors in the
same way. So every pair at the threshold is found, and none below it.

A block pair returns for each vector how many links it found, and the smallest vector that it reaches there;
links between thousands of copies are counted, never written out. Components come from those reaches.

Leaves hold about leaf_rows vectors, as the sample follows the density, and are cut into blocks by hash
where they hold more; so no task depends on a cluster's size. Labels with fewer vectors are one leaf, without
a tree, so any number of labels may occur.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components, and those with a null label or
id, link with nothing and are a component of their own; vectors of different lengths never link; rows that share an
id are one vector, the smallest by label and components."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asset_catalog.llm.common import stored
from asset_catalog.llm.graph import connected_components

LEAF_ROWS = 1024
MOST_LEAVES = 4096
#: Vectors of a block; a task holds two blocks.
BLOCK_ROWS = 2048


def usable(vector: Column) -> Column:
    """Whether a vector has a direction."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


@dataclass
class CoverTree:
    """Centres in the order in which they joined; level k has the first `counts[k]` of them. parents[k]:
    for each centre of level k its parent in level k - 1."""

    centres: np.ndarray
    counts: list[int]
    parents: list[np.ndarray]

    def pairs(self, radii: np.ndarray, reach: float) -> np.ndarray:
        """Pairs (a <= b) of leaves that may hold vectors within `reach`. radii: of the leaves' vectors."""
        covering = [radii]
        for level in range(len(self.counts) - 1, 0, -1):
            parent, child = self.parents[level], self.centres[: self.counts[level]]
            far = np.sqrt(np.maximum(0, ((child - self.centres[parent]) ** 2).sum(axis=1))) + covering[0]
            above = np.zeros(self.counts[level - 1])
            np.maximum.at(above, parent, far)
            covering.insert(0, above)
        pairs = np.zeros((1, 2), np.int64)
        for level in range(len(self.counts)):
            if level:
                order = np.argsort(self.parents[level], kind="stable")
                first = np.searchsorted(self.parents[level][order], np.arange(self.counts[level - 1] + 1))
                pairs = _children(pairs, order, first)
            kept = []
            for part in np.array_split(pairs, max(1, len(pairs) // 65536)):
                a, b = part.T
                apart = np.sqrt(np.maximum(0, 2 - 2 * np.einsum("ij,ij->i", self.centres[a], self.centres[b])))
                kept.append(part[apart <= covering[level][a] + covering[level][b] + reach + 1e-9])
            pairs = np.concatenate(kept)
        return pairs


def _children(pairs: np.ndarray, order: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Every child of a with every child of b, once for each unordered pair."""
    a, b = pairs.T
    wide, high = first[a + 1] - first[a], first[b + 1] - first[b]
    owner = np.repeat(np.arange(len(pairs)), wide * high)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(wide * high) - wide * high, wide * high)
    left = order[first[a][owner] + at // high[owner]]
    right = order[first[b][owner] + at % high[owner]]
    once = (a[owner] != b[owner]) | (left <= right)
    return np.column_stack((np.minimum(left, right), np.maximum(left, right)))[once]


def grow(sample: np.ndarray) -> CoverTree:
    """Nested nets of the sample, from radius 2, which covers the sphere, halving until every different vector is a centre."""
    sample = np.unique(sample, axis=0)
    order, counts, parents = [0], [1], [np.zeros(1, np.int64)]
    radius = 2.0
    gaps = np.linalg.norm(sample - sample[0], axis=1)
    nearest = np.zeros(len(sample), np.int64)  # place in order of the nearest centre
    while len(order) < len(sample):
        above = nearest.copy()
        radius /= 2
        while gaps.max() > radius or (radius < 1e-6 and len(order) < len(sample) and gaps.max() > 0):
            new = int(gaps.argmax())
            far = np.linalg.norm(sample - sample[new], axis=1)
            closer = far < gaps
            nearest[closer], gaps[closer] = len(order), far[closer]
            order.append(new)
        if gaps.max() <= 0 and len(order) < len(sample):
            break
        parent = np.arange(len(order))
        parent[counts[-1] :] = above[order[counts[-1] :]]
        counts.append(len(order))
        parents.append(parent)
    return CoverTree(sample[order], counts, parents)


def unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors.astype(np.float64)
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # so that squares neither vanish nor overflow
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def block_links(ids_a: np.ndarray, a: np.ndarray, ids_b: np.ndarray | None, b: np.ndarray | None, least: float) -> pa.Table:
    """Links among the unit vectors a, or between a and b: (vec_id, reached, links) of every linked vector."""
    alone = b is None
    other = a if alone else b
    found_i, found_j = [], []
    if not len(a) or not len(other):
        near = np.empty(0, np.int64)
    elif not alone:  # a ball around the other block: who is farther than its radius and a link has none in it
        middle = other.mean(axis=0)
        gap = lambda x: np.sqrt(np.maximum(0, ((x - middle) ** 2).sum(axis=1)))
        near = np.flatnonzero(gap(a) <= gap(other).max() + np.sqrt(2 - 2 * least) + 1e-9)
    else:
        near = np.arange(len(a))
    for at in range(0, len(near), 512):
        rows = near[at : at + 512]
        i, j = np.nonzero(a[rows] @ other.T >= least)
        i = rows[i]
        if alone:
            i, j = i[i < j], j[i < j]
        found_i.append(i)
        found_j.append(j if alone else j + len(a))
    i, j = np.concatenate([*found_i, np.empty(0, np.int64)]), np.concatenate([*found_j, np.empty(0, np.int64)])
    ids = ids_a if alone else np.concatenate((ids_a, ids_b))
    links = np.bincount(i, minlength=len(ids)) + np.bincount(j, minlength=len(ids))
    order = np.argsort(ids, kind="stable")
    rank = np.empty(len(ids), np.int64)
    rank[order] = np.arange(len(ids))
    label, i, j = np.arange(len(ids)), rank[i], rank[j]
    while True:
        low = np.minimum(label[i], label[j])
        after = label.copy()
        np.minimum.at(after, i, low)
        np.minimum.at(after, j, low)
        after = after[after]
        if (after == label).all():
            break
        label = after
    some = np.flatnonzero(links)
    return pa.table({"vec_id": ids[some], "reached": ids[order[label[rank[some]]]], "links": links[some]})


def link_vectors(embeddings: DataFrame, least: float = 0.98, leaf_rows: int = LEAF_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every vector."""
    spark = embeddings.sparkSession
    one = embeddings.groupBy("vec_id").agg(F.min(F.struct("label", "embedding")).alias("row"))
    rows = stored(one.select("vec_id", "row.label", "row.embedding"), "vectors")
    linkable = usable(F.col("embedding")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    able = rows.where(linkable).withColumn("family", F.concat_ws("/", F.col("label").cast("string"), F.size("embedding").cast("string")))

    # Families larger than a leaf, of which there are MOST_LEAVES at most, get a tree; the others are a leaf each.
    sizes = able.groupBy("family").agg(F.count("*").alias("n"))
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    per_leaf = max(leaf_rows, total / MOST_LEAVES)
    large = [r.family for r in sizes.where(F.col("n") > F.lit(per_leaf)).select("family").collect()]
    of_large = able.where(F.col("family").isin(large)) if large else able.where("false")
    drawn = F.pmod(F.xxhash64("vec_id", F.lit(6)), F.lit(1 << 30)) < int(1 / per_leaf * (1 << 30))
    first = of_large.groupBy("family").agg(F.min_by("embedding", "vec_id").alias("embedding"))
    samples: dict[str, list] = {}
    for row in [*of_large.where(drawn).select("family", "embedding").collect(), *first.collect()]:
        samples.setdefault(row.family, []).append(row.embedding)
    trees = {family: grow(unit(np.array(vectors, np.float64))) for family, vectors in sorted(samples.items())}
    centres = {family: tree.centres for family, tree in trees.items()}

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            families = batch.column(0).to_numpy(zero_copy_only=False)
            leaf, gap = np.full(batch.num_rows, -1, np.int32), np.zeros(batch.num_rows)
            for family in sorted(set(families) & set(centres)):
                rows = np.flatnonzero(families == family)
                vectors = unit(_matrix(batch.column(2).take(pa.array(rows))))
                leaf[rows] = (vectors @ centres[family].T).argmax(axis=1)
                gap[rows] = np.sqrt(((vectors - centres[family][leaf[rows]]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(leaf), pa.array(gap), batch.column(1), batch.column(2)], names=names)

    kinds = dict(able.dtypes)
    names = ["family", "leaf", "gap", "vec_id", "embedding"]
    schema = f"family string, leaf int, gap double, vec_id {kinds['vec_id']}, embedding {kinds['embedding']}"
    homes = stored(able.select("family", "vec_id", "embedding").mapInArrow(assign, schema), "vector-leaves")
    cuts = F.ceil(F.count("*") / F.lit(block_rows)).cast("int").alias("cuts")
    leaves = stored(homes.groupBy("family", "leaf").agg(cuts, F.max("gap").alias("radius")), "vector-leaf-sizes")

    of_trees: dict[str, dict[int, tuple]] = {family: {} for family in trees}
    for r in leaves.where("leaf >= 0").collect():
        of_trees[r.family][r.leaf] = (r.cuts, r.radius)
    pairs = []
    for family, tree in trees.items():
        held = of_trees[family]
        radii = np.array([held.get(k, (0, 0.0))[1] for k in range(len(tree.centres))])
        for a, b in tree.pairs(radii, float(np.sqrt(2 - 2 * least))).tolist():
            if a in held and b in held:
                pairs.append((family, a, held[a][0], b, held[b][0]))
    sides = spark.createDataFrame(pairs, "family string, a int, a_cuts int, b int, b_cuts int")
    sides = sides.repartition(max(1, min(len(pairs) // 1000, 1000)))
    small = leaves.where("leaf < 0").select("family", F.col("leaf").alias("a"), F.col("cuts").alias("a_cuts"), F.col("leaf").alias("b"), F.col("cuts").alias("b_cuts"))
    blocks = sides.unionByName(small)
    blocks = blocks.select("family", "a", "b", F.explode(F.sequence(F.lit(0), F.col("a_cuts") - 1)).alias("x"), "b_cuts")
    blocks = blocks.select("family", "a", "b", "x", F.explode(F.sequence(F.lit(0), F.col("b_cuts") - 1)).alias("y"))
    blocks = blocks.where("a != b or x <= y")
    pair = F.struct("family", "a", "x", "b", "y").alias("pair")
    left = blocks.select(pair, "family", F.col("a").alias("leaf"), F.col("x").alias("cut"), F.lit(False).alias("second"))
    right = blocks.where("a != b or x != y").select(pair, "family", F.col("b").alias("leaf"), F.col("y").alias("cut"), F.lit(True).alias("second"))

    placed = homes.join(leaves.select("family", "leaf", "cuts"), ["family", "leaf"])
    placed = placed.withColumn("cut", F.pmod(F.xxhash64("vec_id"), F.col("cuts")).cast("int"))
    work = placed.join(left.unionByName(right), ["family", "leaf", "cut"]).select("pair", "second", "vec_id", "embedding")

    def compare(block: pa.Table) -> pa.Table:
        pair, second = block.column("pair")[0].as_py(), block.column("second").to_numpy()
        ids, vectors = block.column("vec_id").to_numpy(), unit(_matrix(block.column("embedding")))
        if (pair["a"], pair["x"]) == (pair["b"], pair["y"]):
            return block_links(ids, vectors, None, None, least)
        return block_links(ids[~second], vectors[~second], ids[second], vectors[second], least)

    linked = stored(work.groupBy("pair").applyInArrow(compare, "vec_id long, reached long, links long"), "vector-links")
    counts = linked.groupBy("vec_id").agg(F.sum("links").alias("n_links"))
    components = connected_components(linked, "vec_id", "reached").withColumnRenamed("node", "vec_id")
    merged = rows.select("vec_id").join(counts, "vec_id", "left").join(components, "vec_id", "left")
    component = F.coalesce("component", F.col("vec_id").cast("long"))
    return merged.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
