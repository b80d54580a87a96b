"""SentencePiece segmentations sampled by forward filtering and backward sampling, and their decoding.

All ways to cut a text into pieces form a lattice. The forward pass sums, for every position, the
probabilities of the ways to reach it; the backward pass draws a piece that ends at the last
position, in proportion to its probability times the sum at its start, then goes on from there. So a segmentation
is drawn with its exact probability. The random numbers come from a hash of the row's key and
the position in the text: the same row gets the same pieces in every run, wherever it is computed.

No piece runs from other characters into a space, so the lattice falls into units that start at
spaces: a unit that occurs often is filtered once in a batch, and all its occurrences are
sampled side by side. Pieces of a vocabulary that would join units stay unused.

The vocabulary is read from a file of a public tokenizer, on the driver. A BPE vocabulary has merge ranks instead of
probabilities; a piece of rank r then counts 1 / (r + 1) ("ranked"). Characters without a
piece are cut into byte pieces; so is the mark that stands for a space. Decoding joins the bytes of the pieces, so
every text comes back as it was.

Defined cases: a null text has no segmentation (null) and decodes to null; an empty text has no
pieces; texts may be of any length; a null key counts as the empty text."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asset_catalog.llm.common import slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"

#: Stands for a space in pieces.
MARK = "▁"

#: Stands for that mark where a text holds it itself; no valid text holds half a surrogate pair.
_OWN_MARK = "\ud800"

#: Bytes of text that are segmented at once: a task's memory is some 200 times as much.
AT_ONCE = 3 << 19

#: Units of at most so many characters are filtered side by side; longer ones are rare, and one by one.
_SHORT = 40

#: Below this a forward sum of a long unit is scaled up, with those that it is compared to.
_SMALL = 1e-150

_BASE = np.uint64(0x9E3779B97F4A7C15)
_SLOTS = 1 << 20


def _code_hash(codes: np.ndarray) -> np.ndarray:
    x = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def uniform(keys: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Numbers in [0, 1) from 64-bit keys and places, by the finalizer of splitmix64."""
    x = keys + (places.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(float) * 2.0**-53


class Vocabulary:
    """The usable pieces with their weights, ids and bytes, and a table to find pieces by hash.

    A character without a piece is spelled in bytes, with one weight for all of them."""

    def __init__(self, weights: dict[str, float], ids: dict[str, int], raw: list[bytes], bytes_at: list[int], spelled_weight: float, units: str) -> None:
        self.raw, self.bytes_at, self.units = raw, bytes_at, units
        self.pieces = sorted(weights)
        self.index = {piece: k for k, piece in enumerate(self.pieces)}
        self.weights = np.array([weights[p] for p in self.pieces] + [spelled_weight])
        self.ids = np.array([ids[p] for p in self.pieces], np.int32)
        self.lengths = np.array([len(p) for p in self.pieces], np.int64)
        self.longest = int(self.lengths.max(initial=1))
        self.codes = np.zeros((len(self.pieces), self.longest), np.uint32)
        for k, piece in enumerate(self.pieces):
            self.codes[k, : len(piece)] = _codes(piece)
        self.powers = np.array([pow(int(_BASE), k, 1 << 64) for k in range(self.longest + 1)], np.uint64)
        self.hashes = np.zeros(len(self.pieces), np.uint64)
        for k in range(self.longest):
            longer = self.lengths > k
            self.hashes[longer] = self.hashes[longer] * _BASE + _code_hash(self.codes[longer, k])
        self.slots = np.full(_SLOTS, -1, np.int32)
        for k, slot in enumerate((self.hashes >> np.uint64(44)).tolist()):
            while self.slots[slot] >= 0:
                slot = (slot + 1) % _SLOTS
            self.slots[slot] = k

    def find(self, hashes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes are those of pieces of the length, and of which pieces."""
        slot = (hashes >> np.uint64(44)).astype(np.int64)
        rows = np.arange(len(hashes))
        found_rows, found = [], []
        while len(rows):
            piece = self.slots[slot]
            some = np.flatnonzero(piece >= 0)
            rows, slot, piece = rows[some], slot[some], piece[some]
            same = (self.hashes[piece] == hashes[rows]) & (self.lengths[piece] == length)
            found_rows.append(rows[same])
            found.append(piece[same])
            rows, slot = rows[~same], (slot[~same] + 1) % _SLOTS
        rows = np.concatenate([*found_rows, np.empty(0, np.int64)])
        order = np.argsort(rows)
        return rows[order], np.concatenate([*found, np.empty(0, np.int32)])[order]

    def spelling(self, character: str) -> list[int]:
        """The byte pieces of a character; the unit's stand-in for the mark is spelled as the mark."""
        return [self.bytes_at[b] for b in (MARK if character == _OWN_MARK else character).encode("utf-8", "surrogatepass")]


@dataclass
class Lattice:
    """Positions of all units in one row, from base[unit]; position p has the arcs first[p] to
    first[p + 1]. An arc has its cumulated share of what reaches its end, its start, and a piece: its number, or -1 less
    the code point that is spelled."""

    base: np.ndarray
    lengths: np.ndarray
    first: np.ndarray
    shares: np.ndarray
    starts: np.ndarray
    pieces: np.ndarray


def _filter_short(units: list[str], vocabulary: Vocabulary) -> list[np.ndarray]:
    """Arcs of short units, all units side by side: unit, end, start, piece, share. Many arcs: numbers have 32 bits."""
    codes = _codes("".join(units))
    sizes = np.fromiter(map(len, units), np.int64, len(units))
    offsets = np.cumsum(sizes) - sizes
    order = np.argsort(-sizes, kind="stable")
    sizes, offsets = sizes[order], offsets[order]
    spelled = len(vocabulary.pieces)
    hashes, forward = [np.zeros(len(units), np.uint64)], [np.ones(len(units))]
    out: list[list[np.ndarray]] = [[], [], [], [], []]
    for end in range(1, int(sizes.max(initial=0)) + 1):
        alive = len(sizes) - int(np.searchsorted(sizes[::-1], end, side="left"))
        code = codes[offsets[:alive] + end - 1]
        hashes.append(hashes[-1][:alive] * _BASE + _code_hash(code))
        total = np.zeros(alive)
        arcs = []
        without = np.ones(alive, bool)
        for length in range(min(end, vocabulary.longest), 0, -1):
            start = end - length
            rows, piece = vocabulary.find(hashes[end] - hashes[start][:alive] * vocabulary.powers[length], length)
            exact = (codes[(offsets[rows] + start)[:, None] + np.arange(length)] == vocabulary.codes[piece, :length]).all(axis=1)
            rows, piece = rows[exact], piece[exact]
            total[rows] += vocabulary.weights[piece] * forward[start][rows]
            arcs.append((rows, start, piece.astype(np.int64), total[rows]))
            if length == 1:
                without[rows] = False
        rows = np.flatnonzero(without)
        total[rows] += vocabulary.weights[spelled] * forward[end - 1][rows]
        arcs.append((rows, end - 1, -1 - code[rows].astype(np.int64), total[rows]))
        for rows, start, piece, reached in arcs:
            out[0].append(order[rows].astype(np.int32))
            out[1].append(np.full(len(rows), end, np.int32))
            out[2].append(np.full(len(rows), start, np.int32))
            out[3].append(piece.astype(np.int32))
            out[4].append(reached / total[rows])
        forward.append(total)
    del hashes, forward
    kinds = [np.int32] * 4 + [np.float64]
    return [np.concatenate([*out.pop(0), np.empty(0, kind)]) for kind in kinds]


def _filter_long(unit: str, number: int, vocabulary: Vocabulary) -> list[np.ndarray]:
    """Arcs of one unit, in the same form and order."""
    index, weights, longest = vocabulary.index, vocabulary.weights.tolist(), vocabulary.longest
    forward = [1.0]
    rows = []
    for end in range(1, len(unit) + 1):
        arcs, total = [], 0.0
        for start in range(max(0, end - longest), end):
            piece = index.get(unit[start:end])
            if piece is not None:
                total += forward[start] * weights[piece]
                arcs.append((end, start, piece, total))
        if unit[end - 1] not in index:
            total += forward[end - 1] * weights[-1]
            arcs.append((end, end - 1, -1 - ord(unit[end - 1]), total))
        forward.append(total)
        if total < _SMALL:
            forward[-longest:] = [f / _SMALL for f in forward[-longest:]]
        rows += [(e, s, p, reached / total) for e, s, p, reached in arcs]
    ends, starts, pieces, shares = zip(*rows, strict=True)
    return [np.full(len(rows), number), np.array(ends), np.array(starts), np.array(pieces), np.array(shares)]


def lattice(units: list[str], vocabulary: Vocabulary) -> Lattice:
    """The forward pass over different units."""
    lengths = np.fromiter(map(len, units), np.int64, len(units))
    base = np.cumsum(lengths + 1) - (lengths + 1)
    short = np.flatnonzero(lengths <= _SHORT)
    made = _filter_short([units[k] for k in short], vocabulary)
    made[0] = short[made[0]].astype(np.int32)
    parts = [made, *[_filter_long(units[k], k, vocabulary) for k in np.flatnonzero(lengths > _SHORT)]]
    columns = [np.concatenate([p.pop(0) for p in parts]) for _ in range(5)]
    share, piece, start, end, unit = (columns.pop() for _ in range(5))
    place = base[unit]
    del unit
    order = np.argsort((place + end) * 64 + (start - end), kind="stable")
    first = np.zeros(int((lengths + 1).sum()) + 1, np.int64)
    np.cumsum(np.bincount(place + end, minlength=len(first) - 1), out=first[1:])
    del end
    return Lattice(base, lengths, first, share[order], (place + start)[order], piece.astype(np.int32, copy=False)[order])


def load(path: str = MODEL, ranked: bool = True, sharpness: float = 1.0) -> Vocabulary:
    """The vocabulary of a SentencePiece model with byte pieces. `ranked`: its scores are merge ranks, not
    logarithms; `sharpness`: the power that weights are raised to."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    raw, ids, logs, bytes_at = [], {}, {}, [-1] * 256
    for i in range(size):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            bytes_at[int(piece[1:-1], 16)] = i
            raw.append(bytes([int(piece[1:-1], 16)]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            raw.append(b"")
        else:
            raw.append(piece.replace(MARK, " ").encode())
            if MARK not in piece.lstrip(MARK):
                ids[piece] = i
                logs[piece] = -np.log(1.0 - model.get_score(i)) if ranked else model.get_score(i)
    if min(bytes_at) < 0:
        raise ValueError(f"{path} has no pieces for bytes, so texts could not be decoded")
    lowest = min(logs.values(), default=0.0) - 1.0  # a character spelled in bytes is less likely than any piece
    weights = {piece: float(np.exp(sharpness * log)) for piece, log in logs.items()}
    alone = [c for c in "\n\t\r" if not any(c in piece for piece in ids if len(piece) > 1)]
    cut = "".join(map(re.escape, alone))
    units = f"{MARK}+[^{MARK}{cut}]*|[^{MARK}{cut}]+" + (f"|[{cut}]" if cut else "")
    return Vocabulary(weights, ids, raw, bytes_at, float(np.exp(sharpness * lowest)), units)


def _marked(text: str) -> str:
    return MARK + text.replace(MARK, _OWN_MARK).replace(" ", MARK)


class Sampler:
    """Samples and decodes batches of texts."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.units = re.compile(vocabulary.units)

    def encode(self, texts: list[str | None], keys: np.ndarray) -> list[np.ndarray | None]:
        """The ids of each text. Texts longer than AT_ONCE are cut between units, which changes nothing."""
        out: list[np.ndarray | None] = [None if t is None else np.empty(0, np.int32) for t in texts]
        short = [k for k, t in enumerate(texts) if t and len(t) <= AT_ONCE]
        found = [self.units.findall(_marked(texts[k])) for k in short]
        for k, ids in zip(short, self._sample(found, keys[short], np.zeros(len(short), np.int64)), strict=True):
            out[k] = ids
        for k, text in enumerate(texts):
            if text and len(text) > AT_ONCE:
                out[k] = np.concatenate(list(self._in_parts(text, keys[k : k + 1])))
        return out

    def _in_parts(self, text: str, key: np.ndarray) -> Iterator[np.ndarray]:
        part, start, size = [], 0, 0
        for unit in self.units.finditer(_marked(text)):
            part.append(unit[0])
            size += len(unit[0])
            if size >= AT_ONCE // 4:
                yield self._sample([part], key, np.array([start]))[0]
                part, start, size = [], start + size, 0
        yield self._sample([part], key, np.array([start]))[0]

    def _sample(self, found: list[list[str]], keys: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
        """The ids of each list of units; starts: where in its text the first one stands."""
        per_text = np.fromiter(map(len, found), np.int64, len(found))
        if not per_text.sum():
            return [np.empty(0, np.int32) for _ in found]
        index: dict[str, int] = {}
        unit = np.array([index.setdefault(u, len(index)) for f in found for u in f], np.int64)
        net = lattice(list(index), self.vocabulary)

        text = np.repeat(np.arange(len(found)), per_text)
        size = net.lengths[unit]
        first_unit = np.repeat(np.cumsum(per_text) - per_text, per_text)
        before = np.cumsum(size) - size
        shift = starts[text] + before - before[first_unit] - net.base[unit]  # from a position here to one in the text
        bottom = net.base[unit]
        at = bottom + size
        drawn = keys[text]
        alive = np.arange(len(unit))
        steps, order = np.zeros(len(unit), np.int64), []
        while len(alive):
            here = at[alive]
            chance = uniform(drawn[alive], here + shift[alive])
            arc = net.first[here]
            beyond = np.flatnonzero(net.shares[arc] <= chance)
            while len(beyond):
                arc[beyond] += 1
                beyond = beyond[net.shares[arc[beyond]] <= chance[beyond]]
            order.append((alive, arc))
            steps[alive] += 1
            here = net.starts[arc]
            at[alive] = here
            alive = alive[here > bottom[alive]]
        path = np.empty(steps.sum(), np.int64)
        last = np.cumsum(steps) - 1
        for back, (who, arc) in enumerate(order):
            path[last[who] - back] = arc
        piece = net.pieces[path]
        spelled = piece < 0
        characters = np.unique(-1 - piece[spelled])
        spellings = [self.vocabulary.spelling(chr(c)) for c in characters.tolist()]
        width = np.ones(len(path), np.int64)
        which = np.searchsorted(characters, -1 - piece[spelled])
        width[spelled] = np.array([len(x) for x in spellings], np.int64)[which] if len(which) else 0
        place = np.cumsum(width) - width
        ids = np.empty(width.sum(), np.int32)
        ids[place[~spelled]] = self.vocabulary.ids[piece[~spelled]]
        for k, spelling in enumerate(spellings):
            start = place[spelled][which == k] if len(spellings) > 1 else place[spelled]
            for byte, i in enumerate(spelling):
                ids[start + byte] = i
        per_unit = np.bincount(np.repeat(np.arange(len(unit)), steps), width, len(unit))
        bounds = np.cumsum(np.bincount(text, per_unit, len(found)).astype(np.int64))[:-1]
        return np.split(ids, bounds)

    def decode(self, ids: np.ndarray) -> bytes:
        """The UTF-8 text of the ids, without the space that encoding puts before it."""
        return b"".join(map(self.vocabulary.raw.__getitem__, ids.tolist()))[1:]


def row_keys(keys: list, seed: int) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.array([digest("" if k is None else str(k), seed) for k in keys], np.uint64)


def encode(documents: DataFrame, vocabulary: Vocabulary, seed: int = 0) -> DataFrame:
    """(doc_id, ids): a sampled segmentation of every text."""

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(vocabulary)
        for batch in batches:
            for part in slices(batch, 1, AT_ONCE):
                ids = sampler.encode(part.column(1).to_pylist(), row_keys(part.column(0).to_pylist(), seed))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    rows = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(sample, f"doc_id {dict(rows.dtypes)['doc_id']}, ids array<int>")


def decode(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(doc_id, ids, text): the text that the ids spell."""

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(vocabulary)
        for batch in batches:
            lists = batch.column(1)
            texts = [sampler.decode(v.values.to_numpy()).decode() if v.is_valid else None for v in lists]
            yield pa.RecordBatch.from_arrays([batch.column(0), lists, pa.array(texts, pa.string())], names=["doc_id", "ids", "text"])

    rows = encoded.select("doc_id", "ids")
    return rows.mapInArrow(spell, f"doc_id {dict(rows.dtypes)['doc_id']}, ids array<int>, text string")


def round_trip(documents: DataFrame, vocabulary: Vocabulary, seed: int = 0) -> DataFrame:
    """(doc_id, n_pieces, ids_md5, text_md5, lossless) of every row: its sampled segmentation and what
    it decodes to, as digests. ids_md5 is over the ids as little-endian 32-bit numbers; digests and
    `lossless` are null for null texts."""
    import hashlib

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(vocabulary)
        for batch in batches:
            for part in slices(batch, 1, AT_ONCE):
                texts = part.column(1).to_pylist()
                rows = []
                for text, ids in zip(texts, sampler.encode(texts, row_keys(part.column(0).to_pylist(), seed)), strict=True):
                    if ids is None:
                        rows.append((0, None, None, None))
                        continue
                    spelled = sampler.decode(ids)
                    rows.append((len(ids), hashlib.md5(ids.tobytes()).hexdigest(), hashlib.md5(spelled).hexdigest(), spelled == text.encode()))
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names=names)

    kinds = [pa.int64(), pa.string(), pa.string(), pa.bool_()]
    names = ["doc_id", "n_pieces", "ids_md5", "text_md5", "lossless"]
    rows = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(digest, f"doc_id {dict(rows.dtypes)['doc_id']}, n_pieces long, ids_md5 string, text_md5 string, lossless boolean")
