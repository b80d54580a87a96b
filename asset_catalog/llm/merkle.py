"""A Merkle manifest of a table: one digest for all rows, and for each row a proof that climbs to it.

Every row is a leaf: the SHA-256 of its columns, each written as `-` if null, else as its number of
UTF-8 bytes, a colon and its value. The leaves of a source ascend by id; while several nodes remain, each
16 consecutive ones become the digest of their digests. What remains is the source's subroot, and the
subroots, ordered by source, give the root in the same way.

No source is sorted by one task: rows are dealt by ranges of (source, id), so that a source may spread over
any number of tasks, and a row's place follows from its place in its range and the sizes of the ranges before.

The levels are stored as rows that name their parent: a node holds the digests of its children
side by side, the id of the node above it and its slot in that node. A recursive query then climbs from the leaves:
each step joins the node above, appends it and the slot (which name the siblings) and folds the digest. The leaves of a run
have all siblings above the run in common, so they climb as one row, with a digest for each claim that folds to another; the
siblings' digests are put in where the path is known.

Defined cases: ids and sources may be null (first); equal ids are ordered by digest; a repeated row is a
leaf of its own; a lone leaf is its source's subroot, a lone subroot the root, and their proofs are empty; an empty table
has no root (null) and no rows; columns beyond the digested ones change nothing."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from asset_catalog.llm.common import stored

#: Columns of a leaf, in the order in which they are digested.
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")

#: Nodes that become one.
RUN = 16

#: Hexadecimal digits of a digest.
WIDTH = 64

#: The tree over the subroots; trees of sources are named `=source`, that of the null source is empty.
TOP = ">"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(values: Mapping[str, Column]) -> Column:
    fields = [v.cast("string") for v in values.values()]
    return digest(*(F.coalesce(F.concat(F.octet_length(f).cast("string"), F.lit(":"), f), F.lit("-")) for f in fields))


@dataclass(frozen=True)
class Manifest:
    """runs: the lowest nodes with their leaves, up to 16 side by side, linked to the node above; nodes: the levels
    above; root: the digest of everything, null without rows."""

    runs: DataFrame
    nodes: DataFrame
    root: str | None


def placed(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """Adds pos, a row's place in its `tree` by the order, from 0, and n, the number of the tree's rows.

    Ranges of all rows are sorted, each by one task; a summary row for each range and tree says where
    the tree's rows in a range begin. A tree may fill any number of ranges."""
    keys = ["tree", *order]
    marked = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("row", F.monotonically_increasing_id())
    kept = stored(marked.withColumn("range", F.shiftright("row", 33)), name)
    ranges = kept.groupBy("tree", "range").agg(F.min("row").alias("first"), F.count("*").alias("rows"))
    tree = Window.partitionBy("tree")
    earlier = tree.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select(
        "tree",
        "range",
        (F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("rows").over(tree).alias("n"),
    )
    return kept.join(starts, ["tree", "range"]).withColumn("pos", F.col("row") + F.col("shift")).drop("row", "range", "shift")


def _id(level: Column, pos: Column, tree: Column) -> Column:
    return F.concat_ws("/", level.cast("string"), pos.cast("string"), tree)


def _above(n: Column) -> Column:
    return F.floor((n + (RUN - 1)) / RUN).cast("long")


def _run(pos: Column) -> Column:
    return F.floor(pos / RUN).cast("long")


def _levels(first: DataFrame, most: int, name: str) -> DataFrame:
    """All levels above the rows (tree, pos, n, digests) of the first one, whose digests are side by side.

    Each level is stored, and has a sixteenth of the rows of the one below."""
    level = stored(first.withColumn("level", F.lit(1)).withColumn("digest", F.sha2("digests", 256)), f"{name}-1")
    levels, most, number = [level], -(-most // RUN), 1
    while most > 1:
        number += 1
        children = F.array_sort(F.collect_list(F.struct("pos", "digest")))
        joined = F.array_join(F.transform(children, lambda c: c["digest"]), "")
        level = (
            level.where("n > 1")
            .groupBy("tree", _run(F.col("pos")).alias("run"))
            .agg(_above(F.first("n")).alias("n"), joined.alias("digests"))
            .select("tree", F.col("run").alias("pos"), "n", "digests", F.lit(number).alias("level"), F.sha2("digests", 256).alias("digest"))
        )
        level = stored(level, f"{name}-{number}")
        levels.append(level)
        most = -(-most // RUN)
    made = levels[0]
    for level in levels[1:]:
        made = made.unionByName(level)
    return made


def build(documents: DataFrame, claims: Mapping[str, Column] | None = None) -> Manifest:
    """The manifest of the documents. `claims` replaces columns in a second digest of each row, the
    one that a holder of a possibly changed row would present; without it both are equal."""
    values = {c: F.col(c) for c in COLUMNS}
    leaves = documents.select(
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("tree"),
        "doc_id",
        leaf_digest(values).alias("leaf"),
        leaf_digest({**values, **(claims or {})}).alias("claimed"),
    )
    entry = F.struct("pos", "doc_id", "leaf", "claimed")
    runs = (
        placed(leaves, ["doc_id", "leaf"], "merkle-leaves")
        .groupBy("tree", _run(F.col("pos")).alias("pos"))
        .agg(F.first("n").alias("n"), F.array_sort(F.collect_list(entry)).alias("leaves"))
        .withColumn("digests", F.array_join(F.transform("leaves", lambda e: e["leaf"]), ""))
    )
    runs = stored(runs, "merkle-runs")
    most = runs.agg(F.max("n")).first()[0]
    below = _levels(runs.where("n > 1").select("tree", "pos", _above(F.col("n")).alias("n"), "digests"), most or 0, "merkle-nodes")
    lone = runs.where("n = 1").select("tree", F.col("digests").alias("digest"))
    subroots = placed(
        below.where("n = 1").select("tree", "digest").unionByName(lone).select(F.lit(TOP).alias("tree"), F.col("tree").alias("source"), "digest"),
        ["source"],
        "merkle-subroots",
    )
    subroots = stored(subroots, "merkle-placed-subroots")
    sources = subroots.count()
    top_runs = (
        subroots.where("n > 1")
        .groupBy("tree", _run(F.col("pos")).alias("pos"))
        .agg(_above(F.first("n")).alias("n"), F.array_sort(F.collect_list(F.struct(F.col("pos").alias("at"), "digest"))).alias("held"))
        .select("tree", "pos", "n", F.array_join(F.transform("held", lambda h: h["digest"]), "").alias("digests"))
    )
    top = _levels(top_runs, sources, "merkle-top")
    head = (top.where("n = 1") if sources > 1 else subroots).select("digest").first()
    from_source = subroots.select(
        F.col("source").alias("tree"),
        F.col("digest").alias("subroot"),
        F.when(F.col("n") > 1, _id(F.lit(1), _run(F.col("pos")), F.lit(TOP))).alias("top_parent"),
        F.when(F.col("n") > 1, (F.col("pos") % RUN).cast("int")).alias("top_slot"),
    )
    return Manifest(_linked_runs(runs, from_source), stored(_linked_nodes(below, top, from_source), "merkle-linked"), head and head["digest"])


#: What each leaf's claim folds to with the siblings in its run.
_FIRST_FOLDS = f"""
    CASE WHEN n = 1 THEN transform(leaves, e -> e.claimed)
         ELSE transform(leaves, (e, i) -> sha2(concat(substring(digests, 1, i * {WIDTH}), e.claimed,
                                                      substring(digests, (i + 1) * {WIDTH} + 1)), 256)) END"""


def _linked_runs(runs: DataFrame, from_source: DataFrame) -> DataFrame:
    """Runs with the node above what they become: that of their own node, or of the subroot if they are one. `folds` has the
    distinct digests that the leaves' claims fold to, `fold_of` says which is whose: unchanged leaves share one."""
    top = F.col("n") <= RUN
    own = _id(F.lit(2), _run(F.col("pos")), F.col("tree"))
    linked = runs.join(from_source, "tree").select(
        _id(F.lit(1), F.col("pos"), F.col("tree")).alias("run"),
        "leaves",
        "digests",
        F.when(top, F.col("top_parent")).otherwise(own).alias("parent"),
        F.when(top, F.col("top_slot")).otherwise((F.col("pos") % RUN).cast("int")).alias("slot"),
        "subroot",
        F.expr(_FIRST_FOLDS).alias("all_folds"),
    )
    linked = linked.withColumn("folds", F.array_distinct("all_folds"))
    return linked.withColumn("fold_of", F.expr("transform(all_folds, f -> array_position(folds, f))")).drop("all_folds")


def _linked_nodes(below: DataFrame, top: DataFrame, from_source: DataFrame) -> DataFrame:
    """(id, parent, slot, digests, digest) of the nodes above the runs; a subroot's parent is in the tree over the subroots."""
    nodes = below.where("level > 1").join(from_source, "tree").unionByName(top, allowMissingColumns=True)
    ends = F.col("n") == 1
    return nodes.select(
        _id(F.col("level"), F.col("pos"), F.col("tree")).alias("id"),
        F.when(ends, F.col("top_parent")).otherwise(_id(F.col("level") + 1, _run(F.col("pos")), F.col("tree"))).alias("parent"),
        F.when(ends, F.col("top_slot")).otherwise((F.col("pos") % RUN).cast("int")).alias("slot"),
        "digests",
        "digest",
    )


#: A climbing row is a run; `path` has the nodes above with the run's slot in each, `folds` the digests of its leaves' claims.
_CLIMB = f"""
    WITH RECURSIVE climb AS (
        SELECT run, parent, slot, folds, CAST(array() AS array<struct<id: string, slot: int>>) AS path FROM {{runs}}
        UNION ALL
        SELECT c.run, n.parent, n.slot,
               transform(c.folds, f -> sha2(concat(substring(n.digests, 1, c.slot * {WIDTH}), f,
                                                   substring(n.digests, (c.slot + 1) * {WIDTH} + 1)), 256)),
               concat(c.path, array(struct(n.id, c.slot)))
        FROM climb c JOIN {{nodes}} n ON n.id = c.parent)
    SELECT run, folds, path FROM (SELECT * FROM climb LIMIT ALL) WHERE parent IS NULL"""


def _beside(digests: str, slot: Column) -> Column:
    """The digests of a node without that in the slot."""
    return F.concat(F.substring(digests, F.lit(1), slot * WIDTH), F.substring(digests, (slot + 1) * WIDTH + 1, F.lit(RUN * WIDTH)))


def prove(manifest: Manifest) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof, folded_root) of every leaf: the siblings from its run up to the root, and what
    its claimed digest folds to with them."""
    spark = manifest.runs.sparkSession
    arrived = stored(spark.sql(_CLIMB, runs=manifest.runs.select("run", "parent", "slot", "folds"), nodes=manifest.nodes), "merkle-climbed")
    steps = arrived.select("run", F.posexplode("path").alias("step", "at")).select("run", "step", "at.id", "at.slot")
    siblings = steps.join(manifest.nodes.select("id", "digests"), "id").select("run", F.struct("step", _beside("digests", F.col("slot")).alias("siblings")).alias("s"))
    above = siblings.groupBy("run").agg(F.array_join(F.transform(F.array_sort(F.collect_list("s")), lambda s: s["siblings"]), "").alias("above"))
    runs = manifest.runs.drop("folds", "parent", "slot")
    rows = runs.join(arrived.select("run", "folds"), "run").join(above, "run", "left")
    rows = rows.select("digests", "subroot", "above", "folds", "fold_of", F.posexplode("leaves").alias("place", "e"))
    return rows.select(
        F.col("e.doc_id").alias("doc_id"),
        F.col("e.leaf").alias("leaf"),
        "subroot",
        F.lit(manifest.root).cast("string").alias("root"),
        F.concat(_beside("digests", F.col("place")), F.coalesce("above", F.lit(""))).alias("proof"),
        F.element_at("folds", F.element_at("fold_of", F.col("place") + 1).cast("int")).alias("folded_root"),
    )
