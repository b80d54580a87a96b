"""Quality by attention-based multiple-instance learning.

A document is a bag of passages of equal length. Each passage is encoded by the pairs of neighbouring
character kinds in it (letters, capitals, digits, marks, line ends and so on), as square roots of
shares, by how little it repeats itself, and by one learned layer. Gated attention, a product of a tanh and a sigmoid layer, gives every
passage a weight, learned from the labels of whole documents alone; the weighted mean of the encodings
is scored by a logistic unit. So a few bad passages of a long text can count, and the weights tell which.

Fitting takes a bounded sample of the labelled documents (`sample_rows`, by hash). Scoring reads every
text whole, passage by passage; memory is bounded by a slice of texts, or by the longest text.

Defined cases: null and empty texts are one empty passage; without labels of both kinds every score is
the share of good labels, 0.5 without any."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asset_catalog.llm.common import fold, keep_texts, labelled, score_texts, slices
from asset_catalog.llm.toxicity import sigmoid

PASSAGE_BYTES = 512

_GROUPS = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ", "\n", "\t\r", ".", ",", "!", "?", "|", "#", "$&%*", "@", "'\"`", "()[]{}<>", "-_", ":;", "/\\~^+="]
_KINDS = len(_GROUPS) + 2
#: The kind of each byte; bytes of longer characters are the last kind, other control characters the one before.
_KIND = np.array([next((k for k, g in enumerate(_GROUPS) if c < 128 and chr(c) in g), _KINDS - 1 - (c < 128)) for c in range(256)], np.int32)
PAIRS = _KINDS * _KINDS
#: Windows of so many bytes are told apart in so many slots to see how often a passage repeats itself.
WINDOW, SLOTS = 6, 2048
#: What a passage is encoded by: its pairs, its different windows, and twice more how far these are few.
INPUTS = PAIRS + 2


#: Bytes of a text that are encoded at once; a multiple of a passage.
PART = PASSAGE_BYTES << 12


def encode(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Counts of pairs and of different windows for each passage, and the number of passages of each text."""
    raw = [t or b"" for t in texts.cast(pa.binary()).to_pylist()]
    encoded, some = [], []
    for text in raw:
        if len(text) <= PART:
            some.append(text)
            continue
        encoded += [_encode(some)] if some else []
        encoded += [np.concatenate([_encode([text[at : at + PART]]) for at in range(0, len(text), PART)])]
        some = []
    encoded += [_encode(some)] if some else []
    passages = np.array([max(1, -(-len(t) // PASSAGE_BYTES)) for t in raw], np.int64)
    return np.concatenate([np.empty((0, PAIRS + 1), np.uint16), *encoded]), passages


def _encode(raw: list[bytes]) -> np.ndarray:
    """Counts of pairs and of different windows for each passage."""
    sizes = np.array([len(t) for t in raw], np.int64)
    passages = np.maximum(1, -(-sizes // PASSAGE_BYTES))
    codes = np.frombuffer(b"".join(raw), np.uint8)
    kinds = _KIND[codes]
    starts = np.cumsum(sizes) - sizes
    within = np.arange(len(kinds)) - np.repeat(starts, sizes)
    passage = np.repeat(np.cumsum(passages) - passages, sizes) + within // PASSAGE_BYTES
    inside = np.flatnonzero(within % PASSAGE_BYTES)  # a pair belongs to the passage that holds both
    pairs = kinds[inside - 1] * _KINDS + kinds[inside]
    total = int(passages.sum())
    counts = np.bincount(passage[inside] * PAIRS + pairs, minlength=total * PAIRS).reshape(-1, PAIRS)
    full = np.flatnonzero(within % PASSAGE_BYTES >= WINDOW - 1)
    window = np.zeros(len(full), np.uint32)
    for back in range(WINDOW):
        window = window * np.uint32(0x01000193) + codes[full - back]
    seen = np.zeros((total, SLOTS), bool)
    seen.reshape(-1)[passage[full] * SLOTS + (window * np.uint32(2654435769) >> np.uint32(21))] = True
    return np.column_stack((counts, seen.sum(axis=1))).astype(np.uint16)


def inputs(encoded: np.ndarray) -> np.ndarray:
    counts, different = encoded[:, :PAIRS], encoded[:, PAIRS]
    pairs = np.maximum(1, counts.sum(axis=1))
    fresh = np.minimum(1, different / np.maximum(1, pairs - (WINDOW - 2)))
    return np.column_stack((np.sqrt(counts / pairs[:, None]), fresh, 4 * np.maximum(0, 0.5 - fresh))).astype(np.float32)


@dataclass
class Attention:
    """layer, offset: encoder; content, gate, pull: attention; head, bias: the unit for documents."""

    layer: np.ndarray
    offset: np.ndarray
    content: np.ndarray
    gate: np.ndarray
    pull: np.ndarray
    head: np.ndarray
    bias: np.ndarray

    def forward(self, x: np.ndarray, passages: np.ndarray) -> dict[str, np.ndarray]:
        bag = np.repeat(np.arange(len(passages)), passages)
        first = np.cumsum(passages) - passages
        hidden = np.tanh(x @ self.layer + self.offset)
        content, gate = np.tanh(hidden @ self.content), sigmoid(hidden @ self.gate).astype(np.float32)
        energy = (content * gate) @ self.pull
        power = np.exp(energy - np.maximum.reduceat(energy, first)[bag])
        weight = power / np.add.reduceat(power, first)[bag]
        mean = np.add.reduceat(weight[:, None] * hidden, first)
        score = sigmoid(mean @ self.head + self.bias[0])
        return {"bag": bag, "first": first, "hidden": hidden, "content": content, "gate": gate, "weight": weight, "mean": mean, "score": score}

    def slopes(self, x: np.ndarray, passages: np.ndarray, good: np.ndarray) -> list[np.ndarray]:
        """Of the mean log loss, by each of the fields."""
        at = self.forward(x, passages)
        bag, first, hidden, content, gate, weight = (at[k] for k in ("bag", "first", "hidden", "content", "gate", "weight"))
        error = ((at["score"] - good) / len(good)).astype(np.float32)
        to_mean = error[:, None] * self.head
        by_weight = (hidden * to_mean[bag]).sum(axis=1)
        by_energy = weight * (by_weight - np.add.reduceat(weight * by_weight, first)[bag])
        by_product = by_energy[:, None] * self.pull
        by_content = by_product * gate * (1 - content**2)
        by_gate = by_product * content * gate * (1 - gate)
        by_hidden = weight[:, None] * to_mean[bag] + by_content @ self.content.T + by_gate @ self.gate.T
        by_layer = by_hidden * (1 - hidden**2)
        return [
            x.T @ by_layer,
            by_layer.sum(axis=0),
            hidden.T @ by_content,
            hidden.T @ by_gate,
            (content * gate).T @ by_energy,
            at["mean"].T @ error,
            np.array([error.sum()], np.float32),
        ]

    def __call__(self, texts: pa.Array) -> np.ndarray:
        if not len(texts):
            return np.empty(0)
        counts, passages = encode(texts)
        return self.forward(inputs(counts), passages)["score"].astype(float)

    def passage_weights(self, text: str) -> np.ndarray:
        """The attention that each passage of a text gets."""
        counts, passages = encode(pa.array([text]))
        return self.forward(inputs(counts), passages)["weight"]


def fit(
    counts: list[np.ndarray], good: np.ndarray, hidden: int = 32, inner: int = 16, epochs: int = 40, batch: int = 256, rate: float = 0.01, seed: int = 5
) -> Attention:
    """Fits by Adam on batches of documents, in an order drawn from the seed."""
    draw = np.random.default_rng(seed)
    make = lambda *shape: (draw.normal(0, 1, shape) / np.sqrt(shape[0])).astype(np.float32)
    share = good.mean() if len(good) else 0.5
    bias = np.log(max(share, 1e-9) / max(1 - share, 1e-9))
    model = Attention(make(INPUTS, hidden), np.zeros(hidden, np.float32), make(hidden, inner), make(hidden, inner), make(inner), make(hidden), np.array([bias], np.float32))
    if not 0 < share < 1 or not len(good):
        model.head[:] = 0
        return model
    names = [f.name for f in fields(Attention)]
    first = [np.zeros_like(getattr(model, n)) for n in names]
    second = [np.zeros_like(getattr(model, n)) for n in names]
    step = 0
    for _ in range(epochs):
        order = draw.permutation(len(good))
        for at in range(0, len(order), batch):
            step += 1
            chosen = order[at : at + batch]
            x = inputs(np.concatenate([counts[i] for i in chosen]))
            passages = np.array([len(counts[i]) for i in chosen])
            for k, slope in enumerate(model.slopes(x, passages, good[chosen])):
                first[k] += 0.1 * (slope - first[k])
                second[k] += 0.01 * (slope * slope - second[k])
                value = getattr(model, names[k])
                value -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return model


def learn(documents: DataFrame, labels: DataFrame, modulus: int = 3, held_out: int = 1, sample_rows: int = 6_000) -> Attention:
    """The model fitted on at most about sample_rows labelled documents outside the held-out fold."""
    known = labelled(labels, "quality", sample_rows, 2, lambda key: fold(key, modulus) != held_out)
    rows = documents.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(known), "doc_id")

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 0):
                counts, passages = encode(part.column(0))
                bags = [c.tobytes() for c in np.split(counts, np.cumsum(passages)[:-1])]
                yield pa.RecordBatch.from_arrays([pa.array(bags, pa.binary()), part.column(1), part.column(2)], names=names)

    names = ["bag", "label", "doc_id"]
    drawn = rows.select("text", "label", "doc_id").mapInArrow(gather, f"bag binary, label int, doc_id {dict(rows.dtypes)['doc_id']}")
    got = drawn.toArrow().sort_by("doc_id")
    bags = [np.frombuffer(b, np.uint16).reshape(-1, PAIRS + 1) for b in got.column("bag").to_pylist()]
    return fit(bags, got.column("label").to_numpy().astype(np.float32))


def score_quality(documents: DataFrame, model: Attention) -> DataFrame:
    """(doc_id, score) of every row."""
    return score_texts(documents, lambda texts: [model(texts)], "score double")


def drop_poor(documents: DataFrame, model: Attention, threshold: float = 0.5) -> DataFrame:
    """The rows that score the threshold or more."""
    return keep_texts(documents, lambda texts: model(texts) >= threshold)
