"""Language identification by cross-parsing entropy.

For each language a suffix automaton is built of a sample of its labelled text; it knows every
substring of the sample. A text is cut into the longest phrases that occur in a language's sample,
one after the other; the fewer it takes, the better the language explains it. The number of phrases
times the bits to point at a place in the sample, for each character, is the cross-parsing
entropy, and the language where it is lowest wins; equal ones go to the first by code point.

Letters are lower-cased and everything between them is one space. All texts of a batch are parsed side
by side: a step of the automata is a table look-up for many texts at once. Texts are cut into blocks of
`BLOCK` symbols for that, so a phrase ends at the end of a block at the latest; every block is read.

The sample is bounded: about `windows` windows of `window` characters for each language, from documents
chosen by hash. So the tables grow with the number of languages only.

Defined cases: null texts and texts without a letter are `und` with score 0; rows whose lang is null teach
nothing, nor do texts without letters; where nothing was learned everything is `und`; letters that no
sample holds are phrases of their own in every language."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asset_catalog.llm.common import fold, score_texts, slices

UNKNOWN = "und"
BLOCK = 1024

#: Characters of a text that are read at once; a longer text is parsed in parts.
PART = 1 << 20

#: Symbols: 0 is what stands between letters, 1 a letter that no sample holds, then the letters.
_GAP, _OTHER = 0, 1


def suffix_automaton(symbols: list[int], alphabet: int) -> np.ndarray:
    """Transitions [state, symbol] of the smallest automaton of all substrings; -1 where there is none."""
    follow: list[dict[int, int]] = [{}]
    length, link = [0], [-1]
    last = 0
    for symbol in symbols:
        state = len(follow)
        follow.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and symbol not in follow[at]:
            follow[at][symbol] = state
            at = link[at]
        if at >= 0:
            target = follow[at][symbol]
            if length[target] == length[at] + 1:
                link[state] = target
            else:
                clone = len(follow)
                follow.append(dict(follow[target]))
                length.append(length[at] + 1)
                link.append(link[target])
                while at >= 0 and follow[at].get(symbol) == target:
                    follow[at][symbol] = clone
                    at = link[at]
                link[target] = link[state] = clone
        last = state
    table = np.full((len(follow), alphabet), -1, np.int32)
    for state, out in enumerate(follow):
        for symbol, target in out.items():
            table[state, symbol] = target
    return table


def steps(table: np.ndarray) -> np.ndarray:
    """The transitions for parsing, flat: a state is its row's start. Where a phrase ends and the symbol
    starts the next, the bits of the state that it leads to from the root are inverted. In the last row every
    symbol starts a phrase: there parsing begins, and goes on after a symbol that the sample does not hold."""
    states, alphabet = table.shape
    restart = np.where(table[0] >= 0, table[0], states)
    rows = np.vstack((table, np.full(alphabet, -1)))
    return np.where(rows >= 0, rows * alphabet, ~(restart * alphabet)).astype(np.int32).reshape(-1)


def _letters() -> np.ndarray:
    """For every code point the lower-case letter that it is, or 0."""
    codes = np.zeros(sys.maxunicode + 1, np.uint32)
    for code in range(sys.maxunicode + 1):
        letter = chr(code)
        if letter.isalpha():
            codes[code] = ord(letter.lower()[0])
    return codes


def _parts(texts: list[str | None]) -> Iterator[tuple[list[int], list[str]]]:
    """Texts in parts, some at a time, with the numbers of the texts that they belong to."""
    owners, parts, size = [], [], 0
    for owner, text in enumerate(texts):
        for at in range(0, len(text or ""), PART):
            owners.append(owner)
            parts.append(text[at : at + PART])
            size += len(parts[-1])
            if size >= 4 * PART:
                yield owners, parts
                owners, parts, size = [], [], 0
    yield owners, parts


@dataclass
class Automata:
    """symbols: for each code point; tables: the steps of each language; bits: of a phrase in each."""

    languages: list[str]
    symbols: np.ndarray
    alphabet: int
    tables: list[np.ndarray]
    bits: np.ndarray

    def read(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of all texts in one array, and how many each has; gaps are one symbol."""
        raw = [(t or "").encode("utf-32-le", "surrogatepass") for t in texts.to_pylist()]
        if not raw:
            return np.empty(0, self.symbols.dtype), np.empty(0, np.int64)
        sizes = np.array([len(r) // 4 for r in raw], np.int64)
        found = self.symbols[np.frombuffer(b"".join(raw), np.uint32)]
        text = np.repeat(np.arange(len(raw)), sizes)
        first = np.ones(len(found), bool)
        first[1:] = text[1:] != text[:-1]
        before = np.concatenate((found[:1], found[:-1]))
        kept = (found != _GAP) | (~first & (before != _GAP))
        return found[kept], np.bincount(text[kept], minlength=len(raw))

    def phrases(self, found: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Phrases of each text [text, language]."""
        blocks = -(-sizes // BLOCK)
        owner = np.repeat(np.arange(len(sizes)), blocks)
        part = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        start = (np.cumsum(sizes) - sizes)[owner] + part * BLOCK
        length = np.minimum(BLOCK, sizes[owner] - part * BLOCK)
        order = np.argsort(-length, kind="stable")
        owner, start, length = owner[order], start[order], length[order]
        counts = np.zeros((len(sizes), len(self.tables)))
        if not len(owner):
            return counts
        alive = len(length) - np.searchsorted(length[::-1], np.arange(length[0]), side="right")
        begun = np.zeros((len(self.tables), len(owner)), np.int32)
        states = np.repeat(np.array([[len(t) - self.alphabet] for t in self.tables], np.int32), len(owner), axis=1)
        for step in range(length[0]):
            live = alive[step]
            symbol = found[start[:live] + step].astype(np.int32)
            for k, table in enumerate(self.tables):
                to = table[states[k, :live] + symbol]
                starts = to >> 31
                begun[k, :live] -= starts
                states[k, :live] = to ^ starts
        for k in range(len(self.tables)):
            counts[:, k] = np.bincount(owner, begun[k], len(sizes))
        return counts

    def __call__(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        """Language and score of each text. The score is how far the runner-up's entropy lies above the
        best, as a share of their sum: 0 if both explain the text alike; 1 for the only language."""
        count = len(texts)
        if not self.languages:
            return [UNKNOWN] * count, np.zeros(count)
        sizes, letters, phrases = np.zeros(count), np.zeros(count), np.zeros((count, len(self.tables)))
        for owners, parts in _parts(texts.to_pylist()):
            found, read = self.read(pa.array(parts, pa.string()))
            np.add.at(sizes, owners, read)
            np.add.at(letters, owners, np.bincount(np.repeat(np.arange(len(read)), read), found != _GAP, len(read)))
            np.add.at(phrases, owners, self.phrases(found, read))
        letters = letters > 0
        entropy = phrases * self.bits / np.maximum(1, sizes)[:, None]
        best = entropy.argmin(axis=1)
        if len(self.languages) > 1:
            two = np.partition(entropy, 1, axis=1)[:, :2]
            score = (two[:, 1] - two[:, 0]) / np.maximum(two.sum(axis=1), 1e-12)
        else:
            score = np.ones(count)
        names = [self.languages[b] if known else UNKNOWN for b, known in zip(best, letters, strict=True)]
        return names, np.where(letters, score, 0.0)


def build(samples: dict[str, list[str]]) -> Automata:
    """Automata of the languages' sampled windows."""
    letters = _letters()
    plain = lambda text: letters[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    used = np.unique(np.concatenate([np.empty(0, np.uint32), *[plain(t) for ts in samples.values() for t in ts]]))
    used = used[used > 0]
    of_letter = np.full(sys.maxunicode + 1, _OTHER, np.uint16)
    of_letter[0] = _GAP
    of_letter[used] = np.arange(len(used)) + 2
    reader = Automata([], of_letter[letters], len(used) + 2, [], np.empty(0))
    tables, bits = [], []
    for language in sorted(samples):
        found, sizes = reader.read(pa.array(sorted(samples[language]), pa.string()))
        pieces = np.split(found, np.cumsum(sizes)[:-1])
        symbols = [s for piece in pieces if (piece != _GAP).any() for s in [*piece.tolist(), _GAP]]
        if symbols:
            reader.languages.append(language)
            tables.append(steps(suffix_automaton(symbols, reader.alphabet)))
            bits.append(np.log2(len(symbols) + 1))
    reader.tables, reader.bits = tables, np.array(bits)
    return reader


def learn(documents: DataFrame, modulus: int = 5, held_out: int = 0, windows: int = 64, window: int = 250) -> Automata:
    """Automata from about `windows` windows of each language, outside the held-out fold.

    Documents are drawn by hash, as many of each language whatever its share; the window of a document is drawn
    by hash as well. Where a language has fewer documents than windows, their windows are longer."""
    known = documents.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & (fold(F.col("doc_id"), modulus) != held_out))
    known = known.where(F.col("text").rlike(r"\p{L}"))
    known = known.withColumn("language", F.col("lang").cast("string"))
    counts = {r.language: r.n for r in known.groupBy("language").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return build({})
    # One row for each language, as the automata are: so texts are drawn where they are, without a join.
    shares = F.create_map(*[F.lit(x) for language, n in sorted(counts.items()) for x in (language, min(1.0, windows / n))])
    drawn = F.pmod(F.xxhash64("doc_id", F.lit(4)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    place = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.greatest(F.lit(1), F.length("text") - F.col("width"))).cast("int") + 1
    widths = F.create_map(*[F.lit(x) for language, n in sorted(counts.items()) for x in (language, -(-window * windows // min(n, windows)))])
    rows = known.where(drawn < shares[F.col("language")]).withColumn("width", widths[F.col("language")])
    got = rows.select("language", F.substring("text", place, F.col("width")).alias("text")).collect()
    samples: dict[str, list[str]] = {}
    for row in got:
        samples.setdefault(row.language, []).append(row.text)
    return build(samples)


def identify(documents: DataFrame, automata: Automata) -> DataFrame:
    """(doc_id, lang_pred, score) of every row."""

    def name(texts: pa.Array) -> list:
        languages, scores = automata(texts)
        return [pa.array(languages, pa.string()), scores]

    return score_texts(documents, name, "lang_pred string, score double")


def drop_unexplained(documents: DataFrame, automata: Automata, contradicted: float = 0.2) -> DataFrame:
    """The rows whose text has a letter and does not contradict its given language, in all their columns.

    Rejected are texts without a letter, and texts whose given language is a learned one but not the
    predicted, if the prediction scores `contradicted` or more. The given language decides
    only here; the prediction does not see it. A text in a language that was not learned is kept if its
    given language is null or not a learned one. Nothing is shuffled."""
    text, given = documents.columns.index("text"), documents.columns.index("lang")
    known = set(automata.languages)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                names, scores = automata(part.column(text))
                claims = part.column(given).to_pylist()
                kept = [
                    name != UNKNOWN and not (claim in known and claim != name and score >= contradicted)
                    for name, claim, score in zip(names, claims, scores, strict=True)
                ]
                yield part.filter(pa.array(kept, pa.bool_()))

    return documents.mapInArrow(keep, documents.schema)
