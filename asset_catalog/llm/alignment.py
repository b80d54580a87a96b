"""Alignment of two tokenizers' tokens over the same bytes: a byte-level BPE (A) and a SentencePiece model (B).

Both give spans: A the characters of each token, B the bytes of each piece's surface in its proto. The ends of
these spans are coarse cuts. Where several tokens share a character, as parts of a multibyte
one or byte-fallback pieces do, their spans do not tell them apart; there the decoded bytes of the tokens, counted from
the cut before, give the ends. Offsets where tokens of both end cut a text into groups; each stretch
between two neighbouring ends of either lies in one token of A and one of B, and is a link.

A text is cut into units at spaces between two characters that are not white space. Neither tokenizer has a token across such a cut (A's
pattern starts a word there, no piece of B continues after a space; both are checked when the files are read, and where they
do not hold a text is one unit), so a unit is encoded once for many documents, side by side with
others, and the tokens of a text are those of its units. Links are counted for each chunk by pair of ids, added up
by a shuffle of these counts, and return to the chunk as the totals of its pairs. Documents wait in a table in
buckets of chunks and are not shuffled.

Defined cases: null and empty texts, and texts whose joined tokens are not a space and the text (a
text that holds U+2581, say), have no tokens, groups or links; repeated rows count as often as they occur; a
row's id may be null."""

from __future__ import annotations

import gc
import json
import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from asset_catalog.llm.common import bucket_number, bucketed, chunk_ids

BYTE_LEVEL = "/opt/tokenizers/byte_bpe_50k.json"
PIECES = "/opt/tokenizers/piece_bpe_32k.model"

#: Bytes of text in a chunk, and of units that are encoded as one text.
CHUNK_BYTES = 3 << 20
JOINED_BYTES = 1 << 14

#: Units that a task remembers; beyond, it goes on with those of the latest chunk.
REMEMBERED = 300_000

#: Stands for a space in pieces.
MARK = "▁"

_CUT = re.compile(r"(?<=\S) (?=\S)")
_BLANK_EDGE = re.compile(r"\s\s|\A\s|\s\Z")

_UNITS = "units array<int>, unit_links array<int>, unit_ends array<int>, pairs array<long>, counts array<long>"


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: itself if it shows, else one from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(0x100 + k): b for k, b in enumerate(hidden)}


@dataclass(frozen=True)
class Files:
    """Both vocabularies as read on the driver; they travel to the tasks, which build the tokenizers."""

    byte_level: str
    pieces: bytes


def load(byte_level: str = BYTE_LEVEL, pieces: str = PIECES) -> Files:
    with open(byte_level, encoding="utf-8") as a, open(pieces, "rb") as b:
        return Files(a.read(), b.read())


@dataclass
class Aligned:
    """What becomes of distinct units, in their order: counts, the written groups, whether the bytes agree, and the id pairs of all
    links, those of unit k in front of ends[k]."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    written: list[str]
    valid: np.ndarray
    links: np.ndarray
    ends: np.ndarray

    def some(self, at: np.ndarray) -> Aligned:
        """The units at the places, in that order."""
        sizes = np.diff(self.ends, prepend=0)[at]
        ends = np.cumsum(sizes)
        links = self.links[np.repeat(self.ends[at] - ends, sizes) + np.arange(int(sizes.sum()))]
        written = [self.written[k] for k in at.tolist()]
        return Aligned(self.n_a[at], self.n_b[at], self.n_groups[at], written, self.valid[at], links, ends)

    def and_more(self, other: Aligned) -> Aligned:
        pairs = ((self.n_a, other.n_a), (self.n_b, other.n_b), (self.n_groups, other.n_groups))
        counts = (np.concatenate(pair) for pair in pairs)
        ends = np.concatenate([self.ends, other.ends + len(self.links)])
        return Aligned(*counts, self.written + other.written, np.concatenate([self.valid, other.valid]), np.concatenate([self.links, other.links]), ends)


def refined(coarse: np.ndarray, exact: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Ends of tokens: the coarse ones where they are exact, else the decoded bytes since the last exact one."""
    decoded = np.cumsum(lengths)
    last = np.maximum.accumulate(np.where(exact, np.arange(len(exact)), -1))
    base, done = np.where(last >= 0, coarse[last], 0), np.where(last >= 0, decoded[last], 0)
    return base + decoded - done


class Aligner:
    def __init__(self, files: Files) -> None:
        import sentencepiece
        import tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = tokenizers.Tokenizer.from_str(files.byte_level)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=files.pieces)
        letters = byte_letters()
        entries = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(entries.values(), default=-1) + 1)
        for entry, i in entries.items():
            self.a_bytes[i] = bytes(letters[c] for c in entry)
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(names)]
        self.a_lengths = np.array([len(x) for x in self.a_bytes])
        self.b_lengths = np.array([len(x) for x in self.b_bytes])
        settings = json.loads(files.byte_level)
        words = settings.get("pre_tokenizer") or {}
        starts_words = words.get("type") == "ByteLevel" and words.get("use_regex", True) and not words.get("add_prefix_space") and not settings.get("normalizer")
        self.cuts = bool(starts_words) and not any(MARK in p.lstrip(MARK) for p in names)
        #: Ids as they are written, by the sign before them.
        self.signs = [[f"{sign}{i}" for i in range(max(len(self.a_bytes), len(names)))] for sign in ("", ",", ";", "|")]
        self.places: dict[str, int] = {}
        self.remembered = self.align([])

    def units(self, text: str) -> list[str]:
        if not text:
            return []
        if not self.cuts:
            return [text]
        return _CUT.split(text) if _BLANK_EDGE.search(text) else text.split(" ")

    def distinct_units(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The distinct units of all texts, by first occurrence, the place of each unit in them, and how many units each text has."""
        values = texts.to_pylist()
        plain = np.array([self.cuts and bool(t) and not _BLANK_EDGE.search(t) for t in values], bool)
        others = [self.units(values[k] or "") for k in np.flatnonzero(~plain).tolist()]
        lists = pc.split_pattern(texts.filter(pa.array(plain)), " ")
        if others:
            order = np.argsort(np.argsort(~plain, kind="stable"), kind="stable")
            lists = pa.concat_arrays([lists, pa.array(others, lists.type)]).take(pa.array(order))
        found = lists.flatten().dictionary_encode()
        return found.dictionary.to_pylist(), found.indices.to_numpy().astype(np.int64), lists.value_lengths().to_numpy().astype(np.int64)

    def _joins(self, units: list[str]) -> Iterator[list[int]]:
        """Runs of units that may be encoded as one text: none in them starts or ends with white space."""
        run, size = [], 0
        for k, unit in enumerate(units):
            if not self.cuts or unit[0].isspace() or unit[-1].isspace():
                yield [k]
                continue
            run.append(k)
            size += len(unit)
            if size >= JOINED_BYTES:
                yield run
                run, size = [], 0
        if run:
            yield run

    def _tokens(self, text: str, raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        """Ids and ends in bytes of A's and B's tokens of a space and the text; None if their bytes are others."""
        encoded = self.a.encode(" " + text, add_special_tokens=False)
        ids = encoded.ids
        if b"".join(map(self.a_bytes.__getitem__, ids)) != raw:
            return None
        a = np.array(ids, np.int64)
        spans = np.fromiter(chain.from_iterable(encoded.offsets), np.int64, 2 * len(a)).reshape(-1, 2)
        byte_at = np.append(np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80), len(raw))
        a_ends = refined(byte_at[spans[:, 1]], np.append(spans[1:, 0] >= spans[:-1, 1], True), self.a_lengths[a])
        pieces = self.b.encode(text, return_type="proto").pieces
        spans = np.fromiter(chain.from_iterable(map(attrgetter("id", "begin", "end"), pieces)), np.int64, 3 * len(pieces)).reshape(-1, 3)
        b = spans[:, 0]
        if b"".join(map(self.b_bytes.__getitem__, b.tolist())) != raw:
            return None
        b_ends = refined(spans[:, 2] + 1, (spans[:, 1] < spans[:, 2]) & np.append(spans[1:, 1] >= spans[:-1, 2], True), self.b_lengths[b])
        return a, a_ends, b, b_ends

    def _tokens_of(self, units: list[str], runs: Iterator[list[int]]) -> Iterator[tuple[list[int], np.ndarray, tuple | None]]:
        """Runs of units with the ends of the units in bytes and their tokens; a run whose bytes differ is done unit by unit."""
        for run in runs:
            raw = [units[k].encode() for k in run]
            ends = np.cumsum([len(x) + 1 for x in raw])
            found = self._tokens(" ".join([units[k] for k in run]), b" " + b" ".join(raw))
            if found is None and len(run) > 1:
                yield from self._tokens_of(units, iter([[k] for k in run]))
            else:
                yield run, ends, found

    def align(self, units: list[str]) -> Aligned:
        """Distinct units, none empty, aligned each for itself."""
        count = len(units)
        order: list[int] = []
        parts: dict[str, list[np.ndarray]] = {"ends": [], "a": [], "a_ends": [], "b": [], "b_ends": []}
        valid = np.zeros(count, bool)
        base = 0
        for run, ends, found in self._tokens_of(units, self._joins(units)):
            if found is None:
                continue
            valid[run] = True
            order.extend(run)
            a, a_ends, b, b_ends = found
            for name, some in zip(parts, (ends + base, a, a_ends + base, b, b_ends + base), strict=True):
                parts[name].append(some)
            base += int(ends[-1])
        ends, a, a_ends, b, b_ends = (np.concatenate([np.empty(0, np.int64), *x]) for x in parts.values())
        number = np.array(order, np.int64)
        unit_of = lambda places: number[np.searchsorted(ends, places)]
        common = np.intersect1d(a_ends, b_ends, assume_unique=True)
        cuts = np.union1d(a_ends, b_ends)
        pairs = a[np.searchsorted(a_ends, cuts)] << 32 | b[np.searchsorted(b_ends, cuts)]
        by_unit = np.argsort(unit_of(cuts), kind="stable")
        return Aligned(
            np.bincount(unit_of(a_ends), minlength=count),
            np.bincount(unit_of(b_ends), minlength=count),
            np.bincount(unit_of(common), minlength=count),
            self._written(number, ends, a, a_ends, b, b_ends, common, count),
            valid,
            pairs[by_unit],
            np.cumsum(np.bincount(unit_of(cuts), minlength=count)),
        )

    def look_up(self, units: list[str]) -> Aligned:
        """As align, but units that earlier chunks of the task had are remembered."""
        places = self.places
        new = [u for u in units if u not in places]
        self.remembered = self.remembered.and_more(self.align(new))
        places.update(zip(new, range(len(places), len(places) + len(new)), strict=True))
        found = self.remembered.some(np.fromiter(map(places.__getitem__, units), np.int64, len(units)))
        if len(places) > REMEMBERED:
            self.places, self.remembered = dict(zip(units, range(len(units)), strict=True)), found
        return found

    def _written(self, number, ends, a, a_ends, b, b_ends, common, count) -> list[str]:
        """The groups of each unit: ids of A, a bar, ids of B; groups are parted by semicolons."""
        group = np.concatenate([np.searchsorted(common, a_ends), np.searchsorted(common, b_ends)])
        of_b = np.repeat([0, 1], [len(a), len(b)])
        order = np.argsort(2 * group + of_b, kind="stable")
        group, of_b, ids = group[order], of_b[order], np.concatenate([a, b])[order]
        opens = np.append(True, (group[1:] != group[:-1]) | (of_b[1:] != of_b[:-1]))[: len(ids)]
        unit = np.searchsorted(ends, common)[group]
        first = np.append(True, unit[1:] != unit[:-1])[: len(ids)]
        sign = np.where(first, 0, np.where(~opens, 1, np.where(of_b == 1, 3, 2)))
        signs = self.signs
        shown = [signs[s][i] for s, i in zip(sign.tolist(), ids.tolist(), strict=True)]
        edges = np.append(np.flatnonzero(first), len(ids)).tolist()
        written = [""] * count
        for k, start, end in zip(number.tolist(), edges[:-1], edges[1:], strict=True):
            written[k] = "".join(shown[start:end])
        return written


def align(documents: DataFrame, files: Files, keep: Callable[[Column], Column] = lambda groups: groups) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of every row.

    groups writes the groups as `a1,a2|b1;a3|b2,b3`; `keep` makes of it what is stored and returned, a digest, say.
    A pair's count is the number of links of all documents that hold it; count_sum adds it up over the row's links, and n_best is the number of
    those whose count is the highest of their id in B."""
    rows = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    results = f"chunk long, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups string, {_UNITS}"
    names = [field.split()[0] for field in results.split(", ")]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(files)
        gc.disable()  # nothing here is cyclic, and each collection would walk through all that is remembered
        for chunk, part in chunk_ids(batches, 1, CHUNK_BYTES):
            yield pa.RecordBatch.from_arrays(_encoded(aligner, chunk, part), names=names)

    encoded = rows.mapInArrow(encode, results).withColumn("groups", keep(F.col("groups")))
    held = bucketed(encoded, "chunk", bucket_number(rows.sparkSession, size), "alignment_chunks")

    link = F.posexplode(F.arrays_zip("pairs", "counts")).alias("k", "pair")
    counted = held.where("pairs IS NOT NULL").select(F.col("chunk").alias("chunk"), link).select("chunk", "k", F.col("pair.pairs").alias("pair"), F.col("pair.counts").alias("n"))
    b = F.col("pair").bitwiseAND(0xFFFFFFFF).alias("b")
    totals = counted.groupBy("pair").agg(F.sum("n").alias("total"))
    best = totals.groupBy(b).agg(F.max("total").alias("best"))  # a row for each id of B at most
    summed = counted.select("chunk", "k", b, F.sum("n").over(Window.partitionBy("pair")).alias("total"))
    answers = summed.join(F.broadcast(best), "b").select("chunk", "k", "total", (F.col("total") == F.col("best")).alias("is_best"))

    returned = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    schema = f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups {dict(held.dtypes)['groups']}"

    def total(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        units = chunk.filter(chunk.column("pairs").is_valid())
        documents = chunk.filter(chunk.column("units").is_valid())
        return _totalled(units, documents, answers).select(returned)

    return held.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(total, schema)


def _encoded(aligner: Aligner, chunk: int, part: pa.RecordBatch) -> list[pa.Array]:
    """A row for each document, and one more with what the chunk's units link."""
    known, flat, sizes = aligner.distinct_units(part.column(1))
    found = aligner.look_up(known)
    row = np.repeat(np.arange(len(sizes)), sizes)
    bad = np.bincount(row, ~found.valid[flat], minlength=len(sizes)) > 0
    flat, row = flat[~bad[row]], row[~bad[row]]
    per_unit = np.diff(found.ends, prepend=0)
    added = lambda values: np.bincount(row, values[flat], minlength=len(sizes)).astype(np.int64)
    pairs, links = np.unique(found.links, return_inverse=True)
    counts = np.bincount(links, np.repeat(np.bincount(flat, minlength=len(known)), per_unit), minlength=len(pairs)).astype(np.int64)
    offsets = pa.array(np.append(0, np.cumsum(np.bincount(row, minlength=len(sizes)))).astype(np.int32))
    written = pa.array(found.written, pa.large_string()).take(pa.array(flat))
    groups = pc.binary_join(pa.ListArray.from_arrays(offsets, written), pa.scalar(";", written.type)).cast(pa.string())
    more = lambda values, kind: pa.array([*values, None], kind)
    only = lambda values, kind: pa.ListArray.from_arrays(pa.array([*[None] * len(sizes), 0, len(values)], pa.int32()), pa.array(values, kind))
    return [
        pa.array(np.full(len(sizes) + 1, chunk, np.int64)),
        pa.concat_arrays([part.column(0), pa.nulls(1, part.column(0).type)]),
        *(more(added(x).tolist(), pa.int64()) for x in (found.n_a, found.n_b, found.n_groups, per_unit)),
        pa.concat_arrays([groups, pa.nulls(1, pa.string())]),
        pa.concat_arrays([pa.ListArray.from_arrays(offsets, pa.array(flat, pa.int32())), pa.nulls(1, pa.list_(pa.int32()))]),
        only(links, pa.int32()),
        only(found.ends, pa.int32()),
        only(pairs, pa.int64()),
        only(counts, pa.int64()),
    ]


def _totalled(units: pa.Table, documents: pa.Table, answers: pa.Table) -> pa.Table:
    """The documents of a chunk with the sums over their units' links of what came back for the pairs."""
    listed = lambda table, column: table.column(column).combine_chunks().flatten().to_numpy()
    links, ends, flat = listed(units, "unit_links"), listed(units, "unit_ends"), listed(documents, "units")
    edges = np.append(0, np.cumsum(documents.column("units").combine_chunks().value_lengths().to_numpy()))
    at = answers.column("k").to_numpy()
    for name, column in (("count_sum", "total"), ("n_best", "is_best")):
        value = np.zeros(len(listed(units, "pairs")), np.int64)
        value[at] = answers.column(column).to_numpy()
        before = np.append(0, np.cumsum(value[links]))[np.append(0, ends)]
        by_unit = np.append(0, np.cumsum(np.diff(before)[flat]))
        documents = documents.append_column(name, pa.array(by_unit[edges[1:]] - by_unit[edges[:-1]], pa.int64()))
    return documents
