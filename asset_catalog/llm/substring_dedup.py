"""Removal of passages that occur more than once, found through anchors at the places of a difference cover.

A difference cover of a period is a set of remainders whose differences give every remainder. If two windows of
equal words start anywhere, some offset below the period brings both to places whose remainder is in the cover;
so it is enough to hash short windows, the anchors, at those places: five of 21 for windows of 35 words, which
share an anchor of 15 words. Only around anchors that occur again is the match extended to whole
windows: those that hold such an anchor are hashed (96 bits) and counted, and a word goes if a window
that covers it starts anywhere else as well.

Texts are written once to a table in buckets of chunks, some megabytes of documents each. Anchors and windows leave a chunk as distinct
hashes with their count, so a passage that every document holds is one row for a chunk, whatever
the number of its copies; and a count returns to the chunk as the rank of the hash there. The texts
themselves are never shuffled.

Defined cases: words are runs of bytes other than ASCII white space; a null or empty text, and one
shorter than a window, keeps all its words; repeated rows, null ids and equal ids are documents of
their own, so all words of a text that occurs twice go if it fills a window; windows may overlap those that they equal."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from asset_catalog.llm.common import bucket_number, bucketed, chunk_ids

WINDOW = 35

#: Bytes of text in a chunk; a longer text is a chunk of its own.
CHUNK_BYTES = 8 << 20

#: Perfect difference sets, the smallest covers of their periods.
COVERS = {1: (0,), 3: (0, 1), 7: (1, 2, 4), 13: (0, 1, 3, 9), 21: (3, 6, 7, 12, 14), 31: (1, 5, 11, 24, 25, 27), 57: (0, 1, 6, 15, 22, 26, 45, 55)}

#: Two odd multipliers for rolling hashes of words.
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def period_for(window: int) -> int:
    """The longest known period that leaves anchors of at least two fifths of the window."""
    return max(p for p in COVERS if window - p + 1 >= 2 * window / 5 or p == 1)


@dataclass
class Words:
    """The words of several documents in a row: their hashes, and for each its place in its document and what is left
    of the document from there on."""

    words: list[bytes]
    sizes: np.ndarray
    hashes: np.ndarray
    places: np.ndarray
    left: np.ndarray

    @classmethod
    def of(cls, texts: list[bytes | None]) -> Words:
        cut = [(t or b"").split() for t in texts]
        sizes = np.fromiter(map(len, cut), np.int64, len(cut))
        words = list(chain.from_iterable(cut))
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        ends = np.cumsum(sizes)
        at = np.arange(len(words))
        return cls(words, sizes, hashes, at - np.repeat(ends - sizes, sizes), np.repeat(ends, sizes) - at)

    def rolled(self, length: int, base: int) -> np.ndarray:
        """A hash of the `length` words from each word on; where fewer are left, its value has no meaning."""
        n = len(self.words)
        powers = np.cumprod(np.full(n, base, np.uint64))
        inverse = np.cumprod(np.full(n, pow(base, -1, 1 << 64), np.uint64))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.hashes * powers)])
        x = (sums[np.minimum(np.arange(n) + length, n)] - sums[:n]) * inverse
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(27))

    def anchors(self, window: int) -> tuple[np.ndarray, np.ndarray]:
        """Where anchors start, and their hashes; documents shorter than a window have none."""
        period = period_for(window)
        length = window - period + 1
        long_enough = (self.places + self.left >= window) & (self.left >= length)
        at = np.flatnonzero(np.isin(self.places % period, COVERS[period]) & long_enough)
        return at, self.rolled(length, _BASES[0])[at]

    def windows(self, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where windows start, and two hashes of each."""
        at = np.flatnonzero(self.left >= window)
        return at, self.rolled(window, _BASES[0])[at], self.rolled(window, _BASES[1])[at] >> np.uint64(32)


def ranked(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One index of each distinct pair, in order, the rank of each pair among these, and how often each occurs."""
    order = np.lexsort((second, first))
    a, b = first[order], second[order]
    starts = np.flatnonzero(np.concatenate([np.ones(min(1, len(a)), bool), (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
    counts = np.diff(np.append(starts, len(a)))
    ranks = np.empty(len(a), np.int64)
    ranks[order] = np.repeat(np.arange(len(starts)), counts)
    return order[starts], ranks, counts


def _again(hashes: DataFrame, keys: list[str]) -> DataFrame:
    """(chunk, k) of the hashes that occur more than once in all chunks together."""
    total = F.sum("n").over(Window.partitionBy(*keys))
    return hashes.withColumn("total", total).where("total > 1").select("chunk", "k")


def _flags(answers: pa.Table, size: int) -> np.ndarray:
    flags = np.zeros(size, bool)
    flags[answers.column("k").to_numpy()] = True
    return flags


def _texts(chunk: pa.Table) -> list[bytes | None]:
    return chunk.column("text").cast(pa.binary()).to_pylist()


def remove_repeats(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept, removed) of every row: its words that no repeated window covers, joined by one space,
    and the ranges of words [first, last) that went."""
    rows = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0

    def chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, part in chunk_ids(batches, 1, CHUNK_BYTES):
            chunks = pa.array(np.full(part.num_rows, chunk, np.int64))
            yield pa.RecordBatch.from_arrays([chunks, *part.columns], names=["chunk", "doc_id", "text"])

    texts = bucketed(rows.mapInArrow(chunked, f"chunk long, doc_id {kind}, text string"), "chunk", bucket_number(rows.sparkSession, size), "substring_texts")

    def emit_anchors(chunk: pa.Table) -> pa.Table:
        hashes = Words.of(_texts(chunk)).anchors(window)[1]
        distinct, counts = np.unique(hashes, return_counts=True)
        return pa.table(
            {
                "a": distinct.view(np.int64),
                "chunk": np.full(len(distinct), chunk.column("chunk")[0].as_py(), np.int64),
                "k": np.arange(len(distinct), dtype=np.int32),
                "n": counts.astype(np.int32),
            }
        )

    def emit_windows(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        none = pa.table({c: pa.array([], t) for c, t in (("a", pa.int64()), ("b", pa.int32()), ("chunk", pa.int64()), ("k", pa.int32()), ("n", pa.int32()))})
        if not answers.num_rows:
            return none
        words = Words.of(_texts(chunk))
        at, hashes = words.anchors(window)
        distinct, inverse = np.unique(hashes, return_inverse=True)
        found = np.zeros(len(words.words) + 1, np.int64)
        found[at + 1] = _flags(answers, len(distinct))[inverse]
        found = np.cumsum(found)
        at, first, second = words.windows(window)
        candidate = found[at + period_for(window)] > found[at]
        sample, ranks, counts = ranked(first, second)
        chosen = np.zeros(len(sample), bool)
        chosen[ranks[candidate]] = True
        sample = sample[chosen]
        return pa.table(
            {
                "a": first[sample].view(np.int64),
                "b": second[sample].astype(np.uint32).view(np.int32),
                "chunk": np.full(len(sample), chunk.column("chunk")[0].as_py(), np.int64),
                "k": np.flatnonzero(chosen).astype(np.int32),
                "n": counts[chosen].astype(np.int32),
            }
        )

    def cut(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        words = Words.of(_texts(chunk))
        change = np.zeros(len(words.words) + 1, np.int64)
        if answers.num_rows:
            at, first, second = words.windows(window)
            sample, ranks, _ = ranked(first, second)
            again = at[_flags(answers, len(sample))[ranks]]
            change[again] += 1
            change[again + window] -= 1
        gone = np.cumsum(change[:-1]) > 0
        ends = np.cumsum(words.sizes)
        removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[np.concatenate([[0], ends])])
        kept, start = [], 0
        for end, less in zip(ends.tolist(), removed.tolist(), strict=True):
            some = words.words[start:end]
            kept.append(b" ".join([w for w, out in zip(some, gone[start:end].tolist(), strict=True) if not out] if less else some))
            start = end
        opens = np.flatnonzero(gone & ((words.places == 0) | ~np.concatenate([[False], gone[:-1]])))
        closes = np.flatnonzero(gone & ((words.left == 1) | ~np.concatenate([gone[1:], [False]])))
        ranges = pa.StructArray.from_arrays([pa.array(words.places[opens], pa.int32()), pa.array(words.places[closes] + 1, pa.int32())], names=["first", "last"])
        offsets = np.searchsorted(opens, np.concatenate([[0], ends])).astype(np.int32)
        return pa.table(
            {
                "doc_id": chunk.column("doc_id"),
                "n_words": words.sizes,
                "n_removed": removed.astype(np.int64),
                "kept": pa.array(kept, pa.binary()).cast(pa.string()),
                "removed": pa.ListArray.from_arrays(pa.array(offsets), ranges),
            }
        )

    anchors = texts.groupBy("chunk").applyInArrow(emit_anchors, "a long, chunk long, k int, n int")
    candidates = texts.groupBy("chunk").cogroup(_again(anchors, ["a"]).groupBy("chunk"))
    windows = candidates.applyInArrow(emit_windows, "a long, b int, chunk long, k int, n int")
    result = f"doc_id {kind}, n_words long, n_removed long, kept string, removed array<struct<first int, last int>>"
    return texts.groupBy("chunk").cogroup(_again(windows, ["a", "b"]).groupBy("chunk")).applyInArrow(cut, result)
