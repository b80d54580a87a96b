"""Language-model scores by logistic mixing of hashed-context bit predictors, and a word-count baseline.

A text is its bytes and one end. Each of these symbols is coded in bits along a Huffman tree of the training symbols.
For every bit four predictors look up what followed the last one to four symbols: counts of zeros and
ones under a hash of the context and of the place in the tree. Their log odds are mixed by weights; gates
choose the weights, one set by how often the longest contexts were seen, the other by the kind of the last
symbol and the depth in the tree. The weights are learned online, a few symbols at a time whose own counts are taken off,
first on a bounded sample, then from there on the windows of all training texts in groups, whose weights are averaged; an adaptive map
from the mixed odds to observed shares refines the result. So there are three predictions of every symbol; within a text they are weighed by how well each did on
the blocks before, with older blocks fading, so the mix goes on adapting to the text. Weights depend on
the past only, so the scores are log probabilities of whole texts.

What follows a window of four symbols depends on the window alone. So texts are scored by distinct windows, and
each symbol only looks up its window. Counts come from all training texts: windows are summed
in Spark, then hashed into tables of fixed size; only these tables, the tree and a bounded sample reach the driver.

The baseline counts words. Words above a fixed share of all training words, therefore bounded in number,
are counted where the text is; all others meet their counts in a join by word.

Defined cases: null and empty texts are an end alone; without training texts every bit has even odds and the
baseline's N and V are 0; rows that share an id are scored each for itself; a null id is in the fold of the empty text."""

from __future__ import annotations

import heapq
import itertools
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asset_catalog.llm.common import checkpointed, sampled, slices, stored

END = 256
ORDERS = 4
_BITS = 9
_MASK = np.uint64((1 << _BITS) - 1)
#: Slots of each predictor's table, as a power of two.
TABLE_BITS = 20
#: Symbols that are scored before the weights of the three predictions move.
BLOCK = 32
FADING = 0.95
#: Predicted windows that a task remembers, and the slots to find them in, as a power of two.
REMEMBERED = 1 << 20
_SLOT_BITS = 21
#: Bytes of text that are scored at once, a multiple of a block; a longer text is scored in parts.
AT_ONCE = 2 << 20
#: Words of at least this share of all training words are counted without a shuffle; so there are at most 250,000.
COMMON = 4e-6
LONGEST_COMMON = 64
#: Windows, about, that one group of them learns from one after the other.
TOGETHER = 1 << 17
_RATE = 0.02
_PRIOR = 0.4


def windows(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """The window of every symbol of all texts, the symbol lowest, and how many symbols each text has."""
    flat = np.frombuffer(b"\0".join([*(t or b"" for t in texts), b""]), np.uint8).astype(np.uint64)
    sizes = np.array([len(t or b"") + 1 for t in texts], np.int64)
    lasts = np.cumsum(sizes) - 1
    flat[lasts] = END
    keys = flat.copy()
    starts = lasts - sizes + 1
    for back in range(1, ORDERS + 1):
        shifted = np.full_like(flat, END)
        shifted[back:] = flat[: max(0, len(flat) - back)]
        for ahead in range(back):  # before its start a text has ends
            shifted[(starts + ahead)[ahead < sizes]] = END
        keys |= shifted << np.uint64(_BITS * back)
    return keys, sizes


def huffman(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The tree of all symbols, each counted once more than given: for every symbol where its path
    starts in the flat arrays, the nodes on the path, and the bits."""
    heap = [(int(c) + 1, s, s) for s, c in enumerate(counts)]
    heapq.heapify(heap)
    parent: dict[int, tuple[int, int]] = {}
    node = len(counts)
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        parent[a[2]], parent[b[2]] = (node, 0), (node, 1)
        heapq.heappush(heap, (a[0] + b[0], node, node))
        node += 1
    first, nodes, bits = [0], [], []
    for symbol in range(len(counts)):
        path, at = [], symbol
        while at in parent:
            path.append(parent[at])
            at = parent[at][0]
        nodes += [n - len(counts) for n, _ in reversed(path)]
        bits += [b for _, b in reversed(path)]
        first.append(len(nodes))
    return np.array(first), np.array(nodes, np.uint64), np.array(bits, bool)


@dataclass
class Tree:
    first: np.ndarray
    nodes: np.ndarray
    bits: np.ndarray

    def expand(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All bits of the windows: the window's number, the depth, the bit, and its slots [order, bit]."""
        symbol = (keys & _MASK).astype(np.int64)
        length = self.first[symbol + 1] - self.first[symbol]
        owner = np.repeat(np.arange(len(keys)), length)
        depth = np.arange(len(owner)) - np.repeat(np.cumsum(length) - length, length)
        at = self.first[symbol][owner] + depth
        place = self.nodes[at] * np.uint64(0xD6E8FEB86659FD93)
        slots = np.empty((ORDERS, len(owner)), np.int32)
        for order in range(1, ORDERS + 1):
            context = (keys >> np.uint64(_BITS)) & np.uint64((1 << _BITS * order) - 1)
            mixed = (context + np.uint64(order)) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(31)
            mixed = (mixed[owner] + place) * np.uint64(0xBF58476D1CE4E5B9)
            slots[order - 1] = mixed >> np.uint64(64 - TABLE_BITS)
        return owner, depth, self.bits[at], slots


#: The kind of each symbol for the gates: small and capital letters, digits, spaces, line ends, marks, longer characters, ends.
_KIND = np.array([0 if chr(c).islower() and c < 128 else 1 if chr(c).isupper() and c < 128 else 2 if chr(c).isdigit() and c < 128 else 3 if c == 32 else 4 if c < 32 else 5 if c < 128 else 6 for c in range(256)] + [7])
_DEPTHS = 8
_LEVELS = np.array([1, 2, 4, 16])
_STEPS = 33


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _odds(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return np.log((ones + _PRIOR) / (zeros + _PRIOR)).astype(np.float32)


@dataclass
class Mixer:
    """odds and levels: of each slot [order, slot]; weights: of each gate's sets; refined: observed odds
    of each depth and step of mixed odds."""

    tree: Tree
    odds: np.ndarray
    levels: np.ndarray
    weights: list[np.ndarray]
    refined: np.ndarray

    def gates(self, keys: np.ndarray, owner: np.ndarray, depth: np.ndarray, levels: np.ndarray) -> list[np.ndarray]:
        """`levels`: of the two longest contexts, [2, bit]."""
        kind = _KIND[((keys >> np.uint64(_BITS)) & _MASK).astype(np.int64)]
        wide = len(_LEVELS) + 1
        return [levels[1].astype(np.int64) * wide + levels[0], kind[owner] * _DEPTHS + np.minimum(depth, _DEPTHS - 1)]

    def mixed(self, inputs: np.ndarray, gates: list[np.ndarray]) -> list[np.ndarray]:
        return [np.einsum("ob,bo->b", inputs, w[g][:, :ORDERS]) + w[g][:, ORDERS] for w, g in zip(self.weights, gates, strict=True)]

    def refine(self, odds: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Between the two nearest steps of the map of the depth; half of it, half the mixed odds."""
        at = np.clip((odds + 8) * 2, 0, _STEPS - 1.001)
        low = at.astype(np.int64)
        row = np.minimum(depth, _DEPTHS - 1) * _STEPS + low
        flat = self.refined.reshape(-1)
        return 0.5 * odds + 0.5 * (flat[row] * (low + 1 - at) + flat[row + 1] * (at - low))

    def predict(self, keys: np.ndarray) -> np.ndarray:
        """log2 probabilities [prediction, window] of the last symbols of the windows."""
        owner, depth, bits, slots = self.tree.expand(keys)
        inputs = np.stack([self.odds[k][slots[k]] for k in range(ORDERS)])
        levels = np.stack([self.levels[k][slots[k]] for k in (ORDERS - 2, ORDERS - 1)])
        both = self.mixed(inputs, self.gates(keys, owner, depth, levels))
        sign = np.where(bits, 1.0, -1.0)
        out = []
        for odds in [*both, self.refine(0.5 * (both[0] + both[1]), depth)]:
            out.append(np.bincount(owner, -np.logaddexp(0, -sign * np.clip(odds, -16, 16)), len(keys)) / np.log(2))
        return np.stack(out)


def _slot(keys: np.ndarray) -> np.ndarray:
    return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)


def _block_sums(logs: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums [prediction, block] of the symbols of each block; a block belongs to one text."""
    blocks = -(-sizes // BLOCK)
    text = np.repeat(np.arange(len(sizes)), blocks)
    part = np.arange(len(text)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    return np.add.reduceat(logs, (np.cumsum(sizes) - sizes)[text] + part * BLOCK, axis=0, dtype=float).T


class Scorer:
    """Scores texts with a mixer, and remembers the windows that it has predicted, up to a fixed number."""

    def __init__(self, mixer: Mixer) -> None:
        self.mixer = mixer
        self.places = np.zeros(1 << _SLOT_BITS, np.int32)
        self.keys = np.full(REMEMBERED, ~np.uint64(0))
        self.logs = np.zeros((REMEMBERED, 3), np.float32)
        self.count = 0

    def log_probabilities(self, keys: np.ndarray) -> np.ndarray:
        """log2 [window, prediction]. What a task has met before is looked up, the rest is predicted once."""
        which = self.places[_slot(keys)]
        missed = np.flatnonzero(self.keys[which] != keys)
        if not len(missed):
            return self.logs[which]
        new = np.unique(keys[missed])
        made = np.ascontiguousarray(self.mixer.predict(new).T, np.float32)
        if self.count + len(new) > REMEMBERED:
            logs = self.logs[which]
            logs[missed] = made[np.searchsorted(new, keys[missed])]
            self.keys[:], self.count = ~np.uint64(0), 0
            new, made = new[:REMEMBERED], made[:REMEMBERED]
        else:
            logs = None
        end = self.count + len(new)
        self.keys[self.count : end], self.logs[self.count : end] = new, made
        self.places[_slot(new)] = np.arange(self.count, end, dtype=np.int32)
        if logs is None:
            which[missed] = self.count + np.searchsorted(new, keys[missed])
            logs = self.logs[which]
        self.count = end
        return logs

    def _gains(self, texts: list[bytes | None]) -> Iterator[np.ndarray]:
        """Sums [prediction, block] over the blocks of the texts, in their order; of a long text part by part."""
        for long, group in itertools.groupby(texts, key=lambda t: len(t or b"") > AT_ONCE):
            if not long:
                keys, sizes = windows(list(group))
                yield _block_sums(self.log_probabilities(keys), sizes)
                continue
            for text in group:
                for at in range(0, len(text) + 1, AT_ONCE):
                    before = min(ORDERS, at)
                    keys = windows([text[at - before : at + AT_ONCE]])[0][before:]
                    keys = keys if at + AT_ONCE > len(text) else keys[:-1]  # only the last part has the end
                    yield _block_sums(self.log_probabilities(keys), np.array([len(keys)]))

    def bits(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """Bits of each text under the model, its end included, and its bytes."""
        sizes = np.array([len(t or b"") + 1 for t in texts], np.int64)
        blocks = -(-sizes // BLOCK)
        gains = np.concatenate(list(self._gains(texts)), axis=1)
        firsts = np.cumsum(blocks) - blocks
        order = np.argsort(-blocks, kind="stable")
        firsts, counts = firsts[order], blocks[order]
        alive = len(counts) - np.searchsorted(counts[::-1], np.arange(counts[0]), side="right")
        trust, total = np.zeros((len(gains), len(sizes))), np.zeros(len(sizes))
        for step in range(int(counts[0])):
            live = alive[step]
            gain = gains[:, firsts[:live] + step]
            past = trust[:, :live]
            whole = lambda x: x.max(axis=0) + np.log2(np.exp2(x - x.max(axis=0)).sum(axis=0))
            total[:live] += whole(past + gain) - whole(past)
            trust[:, :live] = FADING * past + gain - gain.max(axis=0)
        out = np.empty(len(sizes))
        out[order] = -total
        return out, sizes - 1


def count_windows(texts: DataFrame) -> DataFrame:
    """(window, n) over all texts. `texts`: one binary column."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 0):
                keys, n = np.unique(windows(part.column(0).to_pylist())[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], names=["window", "n"])

    return texts.mapInArrow(count, "window long, n long").groupBy("window").agg(F.sum("n").alias("n"))


def count_slots(counted: DataFrame, tree: Tree) -> np.ndarray:
    """Zeros and ones of every slot [order, slot, bit], summed over all windows. At most 2**TABLE_BITS rows
    of each order reach the driver."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, _, bits, slots = tree.expand(batch.column(0).to_numpy().view(np.uint64))
            n = batch.column(1).to_numpy()[owner]
            places = (slots.astype(np.int64) + (np.arange(ORDERS) << TABLE_BITS)[:, None]).reshape(-1)
            places, which = np.unique(places, return_inverse=True)
            sums = [np.bincount(which, np.tile(np.where(bits == b, n, 0), ORDERS), len(places)) for b in (False, True)]
            yield pa.RecordBatch.from_arrays([pa.array(places.astype(np.int32)), *[pa.array(s.astype(np.int64)) for s in sums]], names=["slot", "zeros", "ones"])

    rows = counted.mapInArrow(spread, "slot int, zeros long, ones long").groupBy("slot")
    got = rows.agg(F.sum("zeros").cast("float").alias("zeros"), F.sum("ones").cast("float").alias("ones")).toArrow()
    counts = np.zeros((ORDERS << TABLE_BITS, 2), np.float32)
    at = got.column("slot").to_numpy()
    counts[at, 0], counts[at, 1] = got.column("zeros").to_numpy(), got.column("ones").to_numpy()
    return counts.reshape(ORDERS, 1 << TABLE_BITS, 2)


@dataclass
class Learner:
    """A mixer whose weights move: `steady`, what has moved each weight so far; `seen`, zeros and ones at each
    depth and step of mixed odds, from which the map is made."""

    mixer: Mixer
    steady: list[np.ndarray]
    seen: np.ndarray

    def go_over(self, counts: np.ndarray, keys: np.ndarray, times: np.ndarray, batch: int) -> None:
        """A few windows at a time: predicts their bits without their own counts, then moves the weights of the gates
        that were open, then the map. `times`: how often each window counts."""
        mixer = self.mixer
        for at in range(0, len(keys), batch):
            part = keys[at : at + batch]
            owner, depth, bits, slots = mixer.tree.expand(part)
            often = times[at : at + batch][owner]
            others = np.stack([counts[k][slots[k]] for k in range(ORDERS)])  # [order, bit, zero or one]
            others[:, np.arange(len(bits)), bits.astype(np.int64)] -= 1
            others = np.maximum(others, 0)
            inputs = _odds(others[..., 0], others[..., 1])
            seen_levels = np.searchsorted(_LEVELS, others[ORDERS - 2 :].sum(axis=2), side="right")
            gates = mixer.gates(part, owner, depth, seen_levels)
            both = mixer.mixed(inputs, gates)
            full = np.vstack((inputs, np.ones(len(bits))))
            for weight, steadied, gate, odds in zip(mixer.weights, self.steady, gates, both, strict=True):
                error = often * (bits - _sigmoid(odds))
                slopes = np.stack([np.bincount(gate, error * x, len(weight)) for x in full], axis=1)
                steadied += slopes**2
                weight += _RATE * 4 * slopes / np.sqrt(steadied)
            step = np.clip(np.rint((0.5 * (both[0] + both[1]) + 8) * 2), 0, _STEPS - 1).astype(np.int64)
            cells = np.minimum(depth, _DEPTHS - 1) * _STEPS + step
            for bit in (0, 1):
                self.seen[bit] += np.bincount(cells, often * (bits == bit), _DEPTHS * _STEPS).reshape(_DEPTHS, _STEPS)

    def settled(self) -> Mixer:
        self.mixer.refined = np.log(self.seen[1] / self.seen[0])
        return self.mixer


def start_learning(tree: Tree, counts: np.ndarray, texts: list[bytes], batch: int = 2048) -> Learner:
    """Goes over the texts once in their order."""
    wide = len(_LEVELS) + 1
    start = np.array([0.2, 0.2, 0.3, 0.4, 0.0])
    weights = [np.tile(start, (wide * wide, 1)), np.tile(start, (8 * _DEPTHS, 1))]
    grid = np.tile(np.arange(_STEPS) / 2 - 8.0, (_DEPTHS, 1))
    levels = np.searchsorted(_LEVELS, counts.sum(axis=2), side="right").astype(np.uint8)
    mixer = Mixer(tree, _odds(counts[..., 0], counts[..., 1]), levels, weights, grid)
    learner = Learner(mixer, [np.full_like(w, 0.1) for w in weights], np.stack([1 - _sigmoid(grid), _sigmoid(grid)]) * 8)
    keys = windows(texts)[0] if texts else np.empty(0, np.uint64)
    learner.go_over(counts, keys, np.ones(len(keys)), batch)
    return learner


def learn_weights(tree: Tree, counts: np.ndarray, texts: list[bytes], batch: int = 2048) -> Mixer:
    """The mixer with what these texts teach."""
    return start_learning(tree, counts, texts, batch).settled()


def learn_from_all(counted: DataFrame, kinds: int, counts: np.ndarray, learner: Learner) -> Mixer:
    """Goes over all windows, each as often as it occurs: groups of them go on from what the learner knows, each for itself;
    their weights are averaged by their symbols, and what they see is added up. Groups hold the same windows in the same
    order however rows are dealt. Only the sums, of fixed number, reach the driver."""
    groups = max(1, -(-kinds // TOGETHER))
    travels = replace(learner, mixer=replace(learner.mixer, odds=None, levels=None))

    def go_on(group: pa.Table) -> pa.Table:
        keys, times = group.column("window").to_numpy().view(np.uint64), group.column("n").to_numpy().astype(float)
        order = np.argsort(keys * np.uint64(0x9E3779B97F4A7C15))
        own = Learner(replace(travels.mixer, weights=[w.copy() for w in travels.mixer.weights]), [s.copy() for s in travels.steady], np.zeros_like(travels.seen))
        own.go_over(counts, keys[order], times[order], 4096)
        total = times.sum()
        sums = np.concatenate([*(total * w.reshape(-1) for w in own.mixer.weights), own.seen.reshape(-1), [total]])
        return pa.table({"place": np.arange(len(sums), dtype=np.int32), "value": sums})

    placed = counted.withColumn("part", F.pmod(F.xxhash64("window"), F.lit(groups)))
    moved = placed.groupBy("part").applyInArrow(go_on, "place int, value double")
    rows = sorted(moved.groupBy("place").agg(F.sum("value")).collect())
    if rows:
        sums = np.array([value for _, value in rows])
        at = 0
        for weight in learner.mixer.weights:
            weight[:] = (sums[at : at + weight.size] / sums[-1]).reshape(weight.shape)
            at += weight.size
        learner.seen += sums[at:-1].reshape(learner.seen.shape)
    return learner.settled()


def learn(documents: DataFrame, learns: Column, sample_rows: int = 400) -> Mixer:
    """The model of all rows where `learns` holds. Its weights come from all of their windows, and only start from what about
    sample_rows of the texts teach."""
    training = documents.where(learns & F.col("text").isNotNull())
    counted = checkpointed(count_windows(training.select(F.col("text").cast("binary").alias("text"))))
    symbols, kinds = np.zeros(END + 1, np.int64), 0
    by_symbol = counted.groupBy(F.col("window").bitwiseAND(int(_MASK)).alias("symbol"))
    for row in by_symbol.agg(F.sum("n").alias("n"), F.count("*").alias("kinds")).collect():
        symbols[row.symbol] = row.n
        kinds += row.kinds
    tree = Tree(*huffman(symbols))
    drawn = sampled(training.select("doc_id", F.col("text").cast("binary").alias("text")), F.col("doc_id"), sample_rows, 9)
    texts = sorted(((str(r.doc_id), bytes(r.text)) for r in drawn.collect()))
    counts = count_slots(counted, tree)
    return learn_from_all(counted, kinds, counts, start_learning(tree, counts, [t for _, t in texts]))


def score_texts(documents: DataFrame, mixer: Mixer) -> DataFrame:
    """(doc_id, n_bytes, bits) of every row."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(mixer)
        for batch in batches:
            for part in slices(batch, 1, AT_ONCE):
                bits, sizes = scorer.bits(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes), pa.array(bits)], names=["doc_id", "n_bytes", "bits"])

    rows = documents.select("doc_id", F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(score, f"doc_id {dict(rows.dtypes)['doc_id']}, n_bytes long, bits double")


def count_words(texts: DataFrame) -> DataFrame:
    """(word, c): the lower-cased words of all texts. bytes.split() cuts at space and tab to carriage return."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.binary()), pa.array(seen.values(), pa.int64())], names=["word", "c"])

        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen.update((text or b"").lower().split())
                if len(seen) > 300_000:
                    yield out()
                    seen.clear()
        yield out()

    return texts.mapInArrow(count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def score_all(documents: DataFrame, learns: Column, sample_rows: int = 400) -> DataFrame:
    """Model and baseline of every row: (doc_id, n_bytes, bits, n_tokens, n_known, train_tokens, base_score).

    The baseline is the sum over words and one end of log10((c + 1) / (N + V + 1))."""
    spark = documents.sparkSession
    training = documents.where(learns)
    counts = stored(count_words(training.select(F.col("text").cast("binary").alias("text"))), "lm-words")
    ends = training.count()
    words, kinds = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    total, distinct = words + ends, kinds + (ends > 0)
    least = max(1, int(np.ceil(COMMON * max(1, total))))
    frequent = (F.col("c") >= least) & (F.length("word") <= LONGEST_COMMON)
    common = spark.sparkContext.broadcast({bytes(r.word): float(np.log10(r.c + 1)) for r in counts.where(frequent).collect()})
    mixer = learn(documents, learns, sample_rows)
    unit = np.log10(total + distinct + 1)
    end_score = float(np.log10(ends + 1) - unit)
    key_type = documents.schema["doc_id"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs = common.value
        scorer = Scorer(mixer)
        for batch in batches:
            for part in slices(batch, 2, AT_ONCE):
                texts = part.column(2).to_pylist()
                bits, sizes = scorer.bits(texts)
                tokens, found, base = [], [], []
                for text in texts:
                    split = (text or b"").lower().split()
                    own = [log for log in map(logs.get, split) if log is not None]
                    tokens.append(len(split) + 1)
                    found.append(len(own) + (ends > 0))
                    base.append(sum(own) - unit * len(own) + end_score)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(sizes), pa.array(bits), pa.array(tokens, pa.int64()), pa.array(found, pa.int64()), pa.array(base, pa.float64())], names=names)

    names = ["doc_id", "mark", "n_bytes", "bits", "n_tokens", "found", "base"]

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = common.value
        for batch in batches:
            for part in slices(batch, 2):
                rows, seen, times = [], [], []
                for row, text in enumerate(part.column(2).to_pylist()):
                    rare = Counter([w for w in (text or b"").lower().split() if w not in known])
                    rows += [row] * len(rare)
                    seen += rare.keys()
                    times += rare.values()
                at = pa.array(rows, pa.int32())
                heads = np.concatenate(([1], np.diff(rows))) != 0 if rows else np.empty(0, bool)
                yield pa.RecordBatch.from_arrays([part.column(0).take(at), part.column(1).take(at), pa.array(seen, pa.binary()), pa.array(times, pa.int32()), pa.array(heads)], names=["doc_id", "mark", "word", "n", "head"])

    texts = documents.select("doc_id", (F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")) - (1 << 31)).cast("int").alias("mark"), F.col("text").cast("binary").alias("text"))
    scored = texts.mapInArrow(score, f"doc_id {key_type}, mark int, n_bytes long, bits double, n_tokens long, found long, base double")
    pairs = texts.mapInArrow(others, f"doc_id {key_type}, mark int, word binary, n int, head boolean")
    rare = (
        pairs.join(counts.where(~frequent), "word", "left")
        .groupBy("doc_id", "mark")
        .agg(
            F.sum(F.col("n") * (F.log10(F.coalesce("c", F.lit(0)) + F.lit(1.0)) - F.lit(float(unit)))).alias("rare_base"),
            F.sum(F.when(F.col("c") > 0, F.col("n"))).alias("rare_found"),
            F.sum(F.col("head").cast("int")).alias("rows"),
        )
        .withColumnsRenamed({"doc_id": "rare_id", "mark": "rare_mark"})
    )
    same = F.col("doc_id").eqNullSafe(F.col("rare_id")) & (F.col("mark") == F.col("rare_mark"))
    return scored.join(rare, same, "left").select(
        "doc_id",
        "n_bytes",
        "bits",
        "n_tokens",
        (F.col("found") + F.coalesce(F.floor(F.col("rare_found") / F.col("rows")), F.lit(0))).cast("long").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce(F.col("rare_base") / F.col("rows"), F.lit(0.0))).alias("base_score"),
    )
