"""SimHash near-duplicates by a vantage-point tree over the fingerprints.

Every text gets a 64-bit fingerprint of its word shingles. Equal fingerprints become one class. A
vantage-point tree is grown on a bounded sample of the classes: a node holds a fingerprint and a
radius, those within the radius go to its inner branch and the others to the outer one. All classes
go down the tree; each has one home shard. By the triangle inequality two fingerprints of a link have
distances to the vantage point that differ by no more than the allowed bits, so an outer
class within that margin of the boundary also visits the inner branch. In a shard, homes are compared
with homes and visitors, by rings around further vantage points, which prune by the same bound. Every
linked pair is found exactly once, in the home shard of one of its ends.

Defined cases: null and empty texts have no words and fingerprint zero, which links like any
other; rows without an id get a fingerprint, link like any other and are no smallest id: a component of
only such rows has a null id; equal rows are returned as often as they occur."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asset_catalog.llm.common import sampled, slices, stored
from asset_catalog.llm.graph import connected_components

SEED = 42

#: Shingles whose bits are summed at once, and bytes of a text that are cut into words at once.
_AT_ONCE = 1 << 16
_PART = 4 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")

#: Pairs that are compared at once.
_BLOCK = 1 << 20


def fingerprint(text: bytes | None, shingle: int) -> int:
    """The 64-bit SimHash of a UTF-8 text; bytes.split() cuts at space and tab to carriage return."""
    ones, count, words = np.zeros(64, np.int64), 0, []
    for more in _words(text or b""):
        words += more
        if len(words) >= shingle:
            hashes = _hashes(words, shingle)
            count += len(hashes)
            for at in range(0, len(hashes), _AT_ONCE):
                bits = np.unpackbits(hashes[at : at + _AT_ONCE].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                ones += bits.sum(axis=0, dtype=np.int64)
            words = words[len(words) - shingle + 1 :]
    if not count:
        return int(_hashes(words, len(words))[0]) if words else 0
    return int(np.packbits(2 * ones > count, bitorder="little").view(np.uint64)[0])


def _words(text: bytes) -> Iterator[list[bytes]]:
    """The lower-cased words, part by part; a part ends with a word."""
    at = 0
    while at < len(text):
        end = _SPACE.search(text, at + _PART)
        stop = end.start() if end else len(text)
        yield text[at:stop].lower().split()
        at = stop


def _hashes(words: list[bytes], shingle: int) -> np.ndarray:
    flat = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    spans = zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    return np.array([digest(flat[s:e], SEED) for s, e in spans], np.uint64)


def fingerprints(documents: DataFrame, shingle: int = 3, beside: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, bits): the fingerprint of each row as a signed 64-bit number, with the columns beside."""
    rows = documents.select("doc_id", *beside, F.col("text").cast("binary").alias("text"))
    at, names = len(beside) + 1, ["doc_id", *beside, "bits"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, at):
                bits = np.array([fingerprint(t, shingle) for t in part.column(at).to_pylist()], np.uint64)
                yield pa.RecordBatch.from_arrays([*part.columns[:at], pa.array(bits.view(np.int64))], names=names)

    kinds = dict(rows.dtypes)
    return rows.mapInArrow(score, ", ".join([*(f"{name} {kinds[name]}" for name in names[:-1]), "bits long"]))


@dataclass
class VantageTree:
    """Nodes in arrays. A branch is the number of a node, or -1 - s for shard s."""

    points: np.ndarray
    radii: np.ndarray
    inner: np.ndarray
    outer: np.ndarray
    root: int
    shards: int

    def route(self, bits: np.ndarray, margin: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each shard the indices of its homes and of its visitors."""
        todo = [(self.root, np.arange(len(bits)), np.empty(0, np.int64))]
        while todo:
            node, homes, guests = todo.pop()
            if not len(homes) and not len(guests):
                continue
            if node < 0:
                yield -1 - node, homes, guests
                continue
            point, radius = self.points[node], self.radii[node]
            far = np.bitwise_count(bits[homes] ^ point).astype(np.int64)
            guests_far = np.bitwise_count(bits[guests] ^ point).astype(np.int64)
            near = np.concatenate((guests[guests_far <= radius + margin], homes[(far > radius) & (far <= radius + margin)]))
            todo.append((self.inner[node], homes[far <= radius], near))
            todo.append((self.outer[node], homes[far > radius], guests[guests_far > radius - margin]))


def grow_tree(sample: np.ndarray, depth: int, seed: int = 7) -> VantageTree:
    """A tree of at most `depth` levels, split at median distances of the sample."""
    draw = np.random.default_rng(seed)
    points, radii, branches, shards = [], [], [], 0

    def grow(rows: np.ndarray, levels: int) -> int:
        nonlocal shards
        if levels and len(rows) >= 4:
            point = rows[draw.integers(len(rows))]
            far = np.bitwise_count(rows ^ point)
            radius = int(np.median(far))
            inside = far <= radius
            if not inside.all():
                node = len(points)
                points.append(point)
                radii.append(radius)
                branches.append(None)
                branches[node] = (grow(rows[inside], levels - 1), grow(rows[~inside], levels - 1))
                return node
        shards += 1
        return -shards

    root = grow(np.sort(sample), depth)
    sides = np.array(branches, np.int64).reshape(-1, 2)
    return VantageTree(np.array(points, np.uint64), np.array(radii, np.int64), sides[:, 0], sides[:, 1], root, shards)


def _compared(a: np.ndarray, b: np.ndarray, most_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    step = max(1, _BLOCK // max(1, len(b)))
    for at in range(0, len(a), step):
        near = np.bitwise_count(a[at : at + step, None] ^ b[None, :]) <= most_bits
        i, j = np.nonzero(near)
        yield i + at, j


def ring_pairs(
    bits: np.ndarray, homes: np.ndarray, others: np.ndarray, most_bits: int, levels: int = 5
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Indices of (home, other) within most_bits: rings around a home, each against the rings that the
    triangle inequality allows, until few pairs are left to compare."""
    if not len(homes) or not len(others):
        return
    if not levels or len(homes) * len(others) <= _BLOCK:
        for i, j in _compared(bits[homes], bits[others], most_bits):
            yield homes[i], others[j]
        return
    point = bits[homes[len(homes) // 2]]
    far = np.bitwise_count(bits[homes] ^ point).astype(np.int64)
    others_far = np.bitwise_count(bits[others] ^ point).astype(np.int64)
    for ring in np.unique(far):
        allowed = others[np.abs(others_far - ring) <= most_bits]
        yield from ring_pairs(bits, homes[far == ring], allowed, most_bits, levels - 1)


def hamming_pairs(classes: DataFrame, most_bits: int = 2, shard_rows: int = 8192, sample_rows: int = 65536) -> DataFrame:
    """(a, b): ids of all classes whose fingerprints differ in at most most_bits bits, each pair once.

    `classes`: (bits, class_id) with distinct bits. The tree comes from sample_rows of them; its depth
    gives shards of about shard_rows homes as far as the sample can tell them apart."""
    count = classes.count()
    sample = np.array([r.bits for r in sampled(classes, F.col("bits"), sample_rows, 11).select("bits").collect()], np.int64)
    depth = max(0, int(np.ceil(np.log2(max(1, count) / shard_rows))))
    tree = grow_tree(sample.view(np.uint64), depth)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = batch.column(0).to_numpy().view(np.uint64)
            for shard, homes, guests in tree.route(bits, most_bits):
                rows = np.concatenate((homes, guests))
                at_home = np.arange(len(rows)) < len(homes)
                part = batch.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rows), shard, np.int32)), part.column(0), part.column(1), pa.array(at_home)],
                    names=["shard", "bits", "class_id", "at_home"],
                )

    def compare(shard: pa.Table) -> pa.Table:
        bits = shard.column("bits").to_numpy().view(np.uint64)
        ids = shard.column("class_id").to_numpy()
        at_home = shard.column("at_home").to_numpy()
        found_a, found_b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for i, j in ring_pairs(bits, np.flatnonzero(at_home), np.arange(len(bits)), most_bits):
            once = ~at_home[j] | (ids[i] < ids[j])
            found_a.append(ids[i[once]])
            found_b.append(ids[j[once]])
        return pa.table({"a": np.concatenate(found_a), "b": np.concatenate(found_b)})

    routed = classes.select("bits", "class_id").mapInArrow(route, "shard int, bits long, class_id long, at_home boolean")
    return routed.groupBy("shard").applyInArrow(compare, "a long, b long")


def _components(prints: DataFrame, most_bits: int) -> DataFrame:
    """(bits, component): for every fingerprint the smallest that its links reach, as a number."""
    classes = stored(prints.select("bits").distinct(), "simhash-classes")
    linked = hamming_pairs(classes.withColumn("class_id", F.col("bits")), most_bits)
    reached = connected_components(linked, "a", "b")
    return classes.join(reached, classes["bits"] == reached["node"], "left").select("bits", F.coalesce("component", "bits").alias("component"))


def near_duplicates(documents: DataFrame, shingle: int = 3, most_bits: int = 2) -> DataFrame:
    """(doc_id, fingerprint, component_id): component_id is the smallest id that links reach."""
    prints = stored(fingerprints(documents, shingle), "simhash-prints")
    held = prints.groupBy("bits").agg(F.min(F.col("doc_id").cast("long")).alias("least"))
    members = stored(_components(prints, most_bits).join(held, "bits"), "simhash-members")
    smallest = members.groupBy("component").agg(F.min("least").alias("component_id"))
    named = members.join(smallest, "component").select("bits", "component_id")
    hexadecimal = F.lower(F.lpad(F.hex("bits"), 16, "0"))
    return prints.join(named, "bits").select("doc_id", hexadecimal.alias("fingerprint"), "component_id")


def _row_key(documents: DataFrame) -> list[Column]:
    """Two hashes of 64 bits over all columns: rows that differ anywhere have different keys."""
    plain = [
        F.to_json(F.struct(F.col(f"`{name}`"))) if "map<" in kind or "variant" in kind else F.col(f"`{name}`")
        for name, kind in documents.dtypes
    ]
    # A hash leaves nulls out, so which columns are null is hashed too.
    nulls = F.concat(*(F.col(f"`{name}`").isNull().cast("int").cast("string") for name in documents.columns))
    return [F.xxhash64(F.lit(seed), nulls, *plain) for seed in (1, 2)]


def kept_documents(documents: DataFrame, shingle: int = 3, most_bits: int = 2) -> DataFrame:
    """One row of each group of linked rows; its columns stay.

    The row with the smallest id stays, rows without an id come last, and among rows of one id the smallest
    fingerprint, then the smallest hash of the row decides. Rows, not ids, are kept: rows of one id whose texts
    are no copies of each other all stay, and of equal rows one stays."""
    first, second = _row_key(documents)
    rows = documents.select("doc_id", "text", first.alias("first"), second.alias("second"))
    prints = stored(fingerprints(rows, shingle, beside=("first", "second")), "simhash-prints")
    order = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "bits", "first", "second")
    leaders = prints.groupBy("bits").agg(F.min(order).alias("leader")).join(_components(prints, most_bits), "bits")
    chosen = leaders.groupBy("component").agg(F.min("leader").alias("leader"))
    names = [f"row_key_{uuid.uuid4().hex}_{k}" for k in range(2)]  # no column of the table is called so
    keep = chosen.select(F.col("leader.first").alias(names[0]), F.col("leader.second").alias(names[1]))
    keyed = documents.withColumns(dict(zip(names, (first, second), strict=True)))
    return keyed.join(keep, names, "left_semi").dropDuplicates(names).select(*(F.col(f"`{name}`") for name in documents.columns))
