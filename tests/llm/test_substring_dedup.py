from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest

from asset_catalog.llm import substring_dedup
from asset_catalog.llm.substring_dedup import COVERS, Words, period_for, ranked, remove_repeats

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window):
    """(doc_id, n_words, n_removed, kept, ranges) of each row by counting every window as a tuple of words."""
    texts = [WORDS.findall(t or "") for _, t in rows]
    seen = Counter(tuple(t[k : k + window]) for t in texts for k in range(len(t) - window + 1))
    out = []
    for (doc, _), words in zip(rows, texts, strict=True):
        gone = set()
        for k in range(len(words) - window + 1):
            if seen[tuple(words[k : k + window])] > 1:
                gone.update(range(k, k + window))
        edges = sorted(k for k in gone if k - 1 not in gone), sorted(k + 1 for k in gone if k + 1 not in gone)
        out.append((doc, len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone), list(zip(*edges, strict=True))))
    return sorted(out, key=str)


def result(documents, window):
    rows = remove_repeats(documents, window).collect()
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept, [tuple(x) for x in r.removed]) for r in rows), key=str)


@pytest.mark.parametrize("period", sorted(COVERS))
def test_every_shift_brings_two_places_into_the_cover(period):
    assert {(a - b) % period for a in COVERS[period] for b in COVERS[period]} == set(range(period))


def test_anchors_of_the_window_of_35_words():
    assert period_for(35) == 21 and period_for(3) == 1


@pytest.mark.parametrize("window", [1, 3, 8, 35])
def test_same_as_counting_all_windows(documents, window, monkeypatch):
    """Few different words, planted passages at any offset, texts that repeat themselves, over many chunks."""
    monkeypatch.setattr(substring_dedup, "CHUNK_BYTES", 600)
    draw = np.random.default_rng(window)
    vocabulary = [f"w{k}" for k in range(3 if window < 8 else 400)] + ["ünïcode inside", "日本"]
    passages = [draw.choice(vocabulary, n).tolist() for n in (window, window + 1, 2 * window, 3 * window + 7)]
    rows = []
    for k in range(60):
        words = draw.choice(vocabulary, int(draw.integers(0, 90))).tolist()
        for p in draw.integers(0, len(passages), k % 3):
            at = int(draw.integers(0, len(words) + 1))
            words[at:at] = passages[p][: int(draw.integers(window - 1, len(passages[p]) + 1))]
        rows.append((k, str(draw.choice([" ", "\n", "\t \x0b"])).join(words), "en", "a"))
    rows += [(100, " ".join(["same"] * (window + 1)), "en", "a"), (101, " ".join(["once"] * window), "en", "a")]
    assert result(documents(rows), window) == brute([r[:2] for r in rows], window)


def test_messy_rows(messy):
    held = [(r.doc_id, r.text) for r in messy.collect()]
    assert result(messy, 35) == brute(held, 35)
    assert result(messy, 5) == brute(held, 5)


def test_copies_of_a_text_go_and_short_ones_stay(documents):
    text = " ".join(f"w{k}" for k in range(35))
    got = result(documents([(k, text, "en", "a") for k in range(50)] + [(None, text[:-4], "en", "a"), (None, text[:-4], "en", "a")]), 35)
    assert [r[2] for r in got] == [35] * 50 + [0, 0]


def test_no_rows(nothing):
    assert remove_repeats(nothing).count() == 0


def test_ranks_of_hashes_that_agree_in_one_half():
    first, second = np.array([5, 5, 5, 1], np.uint64), np.array([1, 2, 1, 1], np.uint64)
    sample, ranks, counts = ranked(first, second)
    assert ranks.tolist() == [1, 2, 1, 0] and counts.tolist() == [1, 2, 1] and first[sample].tolist() == [1, 5, 5]


def test_rolled_hashes_are_those_of_the_words():
    words = Words.of([b"a b c a b", None, b"", b"x a b c"])
    one = words.rolled(3, 0x9E3779B97F4A7C15)
    assert words.sizes.tolist() == [5, 0, 0, 4]
    assert one[0] == one[6] and len({int(one[k]) for k in (0, 1, 2, 5)}) == 4


def test_texts_are_not_shuffled(messy, capsys):
    remove_repeats(messy).explain()
    plan = capsys.readouterr().out
    assert plan.count("Bucketed: true") == 3
    assert not [line for line in plan.splitlines() if "Exchange" in line and "text" in line]
    assert plan.count("Exchange") == 4
