"""Toxicity by a factorization machine over hashed terms.

A text is the set of its terms, hashed into a fixed number of buckets. Beside a weight for each term
the machine learns a short vector for each, whose products score every pair of terms that occur
together: what is harmless alone, such as naming a group, can count beside an insult. Half the squared
sum of the vectors, less the squares, adds up all pairs in one pass over the terms.

Fitting takes a bounded sample of the labelled documents (`sample_rows`, by hash). Only buckets whose
presence goes with the label beyond chance enter the machine, or that do so together with another one: pairs
are tried among the commonest buckets of the sample. So a long text does not add up the noise of thousands
of rare words, and a term that tells nothing alone takes part. Scoring reads every text whole.

Defined cases: null and empty texts have no terms and get the machine's bias; without labels of both
kinds every score is the share of toxic labels, 0 without any; a term counts once per text."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asset_catalog.llm.common import fold, keep_texts, labelled, score_texts, slices

BUCKETS = 1 << 18

#: Everything in ASCII but letters separates terms.
_SEPARATED = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def text_terms(texts: pa.Array) -> Iterator[np.ndarray]:
    """The hashed terms of each text, each once."""
    for text in pc.utf8_lower(texts).cast(pa.binary()).to_pylist():
        words = set((text or b"").translate(_SEPARATED).split())
        yield np.unique(np.fromiter(map(zlib.crc32, words), np.int64, len(words)) & (BUCKETS - 1))


@dataclass
class Machine:
    """place: the row of a bucket in weights and vectors, -1 for buckets left out."""

    place: np.ndarray
    bias: float
    weights: np.ndarray
    vectors: np.ndarray

    def logits(self, rows: np.ndarray, places: np.ndarray, count: int) -> np.ndarray:
        """Scores of `count` texts from pairs of text and place."""
        total = np.zeros(count) + np.bincount(rows, self.weights[places], count)
        for column in self.vectors.T:
            seen = column[places]
            total += 0.5 * (np.bincount(rows, seen, count).astype(float) ** 2 - np.bincount(rows, seen * seen, count))
        return self.bias + total

    def __call__(self, texts: pa.Array) -> np.ndarray:
        found = [self.place[t] for t in text_terms(texts)]
        rows = np.repeat(np.arange(len(found)), [len(f) for f in found])
        places = np.concatenate([*found, np.empty(0, np.int32)]).astype(np.int64)
        known = places >= 0
        return sigmoid(self.logits(rows[known], places[known], len(found)))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * np.asarray(x, float)))


def likelihood_gain(seen: np.ndarray, with_label: np.ndarray, count: int, positive: float) -> np.ndarray:
    """Likelihood ratio of presence against the label, from how many texts have it and how many of these the label."""

    def part(observed: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return observed * np.log(np.maximum(observed, 1e-12) / np.maximum(expected, 1e-12))

    share = positive / count
    return 2 * (
        part(with_label, seen * share)
        + part(seen - with_label, seen * (1 - share))
        + part(positive - with_label, (count - seen) * share)
        + part(count - seen - positive + with_label, (count - seen) * (1 - share))
    )


def telling_pairs(rows: np.ndarray, flat: np.ndarray, toxic: np.ndarray, common: np.ndarray, gain: np.ndarray, least: float) -> np.ndarray:
    """Those of the `common` buckets that together with another one gain `least` more than either does alone.

    rows and flat: pairs of text and bucket, in order of texts; gain: of every bucket alone."""
    column = np.full(BUCKETS, -1)
    column[common] = np.arange(len(common))
    both, toxic_both = np.zeros((2, len(common), len(common)))
    for at in range(0, len(toxic), 4096):
        start, end = np.searchsorted(rows, (at, at + 4096))
        held = column[flat[start:end]]
        has = np.zeros((min(4096, len(toxic) - at), len(common)), np.float32)
        has[rows[start:end][held >= 0] - at, held[held >= 0]] = 1
        both += has.T @ has
        toxic_both += (has * toxic[at : at + 4096, None].astype(np.float32)).T @ has
    more = likelihood_gain(both, toxic_both, len(toxic), toxic.sum()) - np.maximum(gain[common][:, None], gain[common])
    np.fill_diagonal(more, 0)
    return common[(more >= least).any(axis=1)]


def fit(
    terms: list[np.ndarray],
    labels: np.ndarray,
    factors: int = 8,
    least_texts: int = 4,
    least_gain: float = 15.0,
    paired: int = 1024,
    least_pair_gain: float = 30.0,
    steps: int = 250,
    rate: float = 0.05,
    decay: float = 1e-4,
    seed: int = 3,
) -> Machine:
    """Fits by Adam on the log loss. A bucket takes part if it occurs in least_texts texts and its
    likelihood ratio against the label is at least least_gain, or if it is one of the `paired` commonest and
    the ratio of a pair with another of these is higher by least_pair_gain than that of either alone."""
    toxic = labels.astype(float)
    count, positive = len(toxic), toxic.sum()
    place = np.full(BUCKETS, -1, np.int32)
    if not 0 < positive < count:
        share = positive / count if count else 0.0
        bias = np.log(max(share, 1e-9) / max(1 - share, 1e-9))
        return Machine(place, float(bias), np.zeros(1), np.zeros((1, factors)))
    rows = np.repeat(np.arange(count), [len(t) for t in terms])
    flat = np.concatenate(terms)
    seen = np.bincount(flat, minlength=BUCKETS).astype(float)
    with_label = np.bincount(flat, toxic[rows], BUCKETS)

    share = positive / count
    gain = likelihood_gain(seen, with_label, count, positive)
    often = np.argsort(-seen, kind="stable")[:paired]
    pairs = telling_pairs(rows, flat, toxic, often[seen[often] >= least_texts], gain, least_pair_gain)
    chosen = np.union1d(np.flatnonzero((seen >= least_texts) & (gain >= least_gain)), pairs)
    place[chosen] = np.arange(len(chosen))
    places = place[flat]
    rows, places = rows[places >= 0], places[places >= 0].astype(np.int64)

    size = max(1, len(chosen))
    draw = np.random.default_rng(seed)
    machine = Machine(place, float(np.log(share / (1 - share))), np.zeros(size), draw.normal(0, 0.01, (size, factors)))
    flatten = lambda m: np.concatenate(([m.bias], m.weights, m.vectors.ravel()))
    values = flatten(machine)
    first, second = np.zeros_like(values), np.zeros_like(values)
    for step in range(1, steps + 1):
        slope = (sigmoid(machine.logits(rows, places, count)) - toxic) / count
        own = slope[rows]
        moves = np.empty_like(machine.vectors)
        for f, column in enumerate(machine.vectors.T):
            seen_there = column[places]
            sums = np.bincount(rows, seen_there, count)
            moves[:, f] = np.bincount(places, own * (sums[rows] - seen_there), size)
        slopes = np.concatenate(([slope.sum()], np.bincount(places, own, size), moves.ravel()))
        slopes[1:] += decay / size * values[1:]
        first += 0.1 * (slopes - first)
        second += 0.01 * (slopes * slopes - second)
        values -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
        machine.bias, machine.weights = float(values[0]), values[1 : 1 + size]
        machine.vectors = values[1 + size :].reshape(size, factors)
    return machine


def learn(
    documents: DataFrame, labels: DataFrame, modulus: int = 5, held_out: int = 0, sample_rows: int = 15_000
) -> Machine:
    """The machine fitted on at most about sample_rows labelled documents outside the held-out fold."""
    known = labelled(labels, "toxic", sample_rows, 1, lambda key: fold(key, modulus) != held_out)
    rows = documents.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(known), "doc_id")

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 0):
                terms = [t.astype(np.int32).tobytes() for t in text_terms(part.column(0))]
                yield pa.RecordBatch.from_arrays([pa.array(terms, pa.binary()), part.column(1), part.column(2)], names=names)

    names = ["terms", "label", "doc_id"]
    drawn = rows.select("text", "label", "doc_id").mapInArrow(gather, f"terms binary, label int, doc_id {dict(rows.dtypes)['doc_id']}")
    got = drawn.toArrow().sort_by("doc_id")
    terms = [np.frombuffer(t, np.int32).astype(np.int64) for t in got.column("terms").to_pylist()]
    return fit(terms, got.column("label").to_numpy())


def score_toxicity(documents: DataFrame, machine: Callable[[pa.Array], np.ndarray]) -> DataFrame:
    """(doc_id, score) of every row."""
    return score_texts(documents, lambda texts: [machine(texts)], "score double")


def drop_toxic(documents: DataFrame, machine: Callable[[pa.Array], np.ndarray], threshold: float = 0.5) -> DataFrame:
    """The rows that score below the threshold."""
    return keep_texts(documents, lambda texts: machine(texts) < threshold)
