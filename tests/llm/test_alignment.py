from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from asset_catalog.llm import alignment, registered
from asset_catalog.llm.alignment import Aligner, align, byte_letters, refined


@pytest.fixture(scope="module")
def files():
    return alignment.load()


@pytest.fixture(scope="module")
def aligner(files):
    return Aligner(files)


def whole(aligner, text):
    """Ids and byte ranges of all tokens, the text encoded whole and each token's bytes put one after the other."""
    if not text:
        return None
    out = []
    for ids, raw in (
        (aligner.a.encode(" " + text, add_special_tokens=False).ids, aligner.a_bytes),
        (aligner.b.encode(text), aligner.b_bytes),
    ):
        if b"".join(raw[i] for i in ids) != (" " + text).encode():
            return None
        ends = np.cumsum([len(raw[i]) for i in ids]).tolist()
        out.append(list(zip(ids, [0, *ends[:-1]], ends, strict=True)))
    return out


def brute(aligner, rows):
    """Rows by comparing every token's range with every other's."""
    tokens = [whole(aligner, text) for _, text in rows]
    links, groups = [], []
    for found in tokens:
        a, b = found or ([], [])
        links.append([(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]])
        shared = sorted({x[2] for x in a} & {y[2] for y in b})
        inside = lambda side, start, end: ",".join(str(t[0]) for t in side if start < t[2] <= end)
        groups.append([f"{inside(a, s, e)}|{inside(b, s, e)}" for s, e in zip([0, *shared], shared, strict=False)])
    count = Counter(pair for some in links for pair in some)
    most = defaultdict(int)
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    out = []
    for (doc, _), found, some, cut in zip(rows, tokens, links, groups, strict=True):
        a, b = found or ([], [])
        out.append((doc, len(a), len(b), len(cut), len(some), sum(count[p] == most[p[1]] for p in some), sum(count[p] for p in some), ";".join(cut)))
    return sorted(out, key=str)


def result(documents, files):
    return sorted(map(tuple, align(documents, files).collect()), key=str)


TEXTS = [
    "The quick brown fox, jumping over the lazy dog's 12345 bones!",
    "  leading, double  inside and trailing  ",
    " ",
    "\n\t\r\n",
    "line\nline \n next hard wide　ideographic \x1c odd \x85 end",
    "日本語のテキスト without spaces混ざった ☃ 😀😀 👩‍👩‍👧 ﷽ ᚠᚢᚦ \U0001f9ff é ﬁ",
    "mark ▁ inside",
    "▁",
    "<|endoftext|> <s> </s> <unk> <0x41>",
    "nul \0 and \x01 \x7f ﻿ ￿ \U0010ffff",
    "don't can't 'sx 's we'll",
    "x" * 3000,
    "ᚠ" * 500,
    "a" + " " * 300 + "b",
    "".join(chr(c) for c in range(1, 0x250)),
    "Straße ÅNGSTRÖM naïve Œuvre — “quoted” … §4 ½ кириллица עברית العربية हिन्दी 한국어",
]


def test_same_as_comparing_all_ranges(documents, files, aligner, monkeypatch):
    monkeypatch.setattr(alignment, "CHUNK_BYTES", 900)
    rows = [(k, t, "en", "a") for k, t in enumerate(TEXTS)] + [(50, TEXTS[0], "en", "a"), (None, TEXTS[5], None, None), (51, None, "en", "a"), (52, "", "en", "a")]
    assert result(documents(rows), files) == brute(aligner, [r[:2] for r in rows])


def test_units_give_the_tokens_of_whole_texts(aligner):
    """Random texts of letters, digits, signs and all kinds of white space, joined and alone."""
    draw = np.random.default_rng(3)
    signs = ["a", "B", "the", "ing", "1", "23", "'", "'s", ".", "é", "日", "😀", " ", " ", " ", "  ", "\n", "\t", " ", " ", "\x1d", "-", "́", "​"]
    for _ in range(400):
        text = "".join(draw.choice(signs, int(draw.integers(1, 40))).tolist())
        units = aligner.units(text)
        assert " ".join(units) == text
        alone = aligner.align(list(dict.fromkeys(units)))
        place = {u: k for k, u in enumerate(dict.fromkeys(units))}
        a, b = whole(aligner, text)
        assert sum(alone.n_a[place[u]] for u in units) == len(a) and sum(alone.n_b[place[u]] for u in units) == len(b)
        expected = brute(aligner, [(0, text)])[0]
        assert ";".join(alone.written[place[u]] for u in units) == expected[-1]


def test_spans_are_coarse_cuts_and_bytes_refine_them(aligner):
    """The spans alone misplace ends inside characters; refined ends are those of the decoded bytes."""
    text = "ᚠ 😀日 naïve \U0001f9ff x"
    raw = (" " + text).encode()
    a, a_ends, b, b_ends = aligner._tokens(text, raw)
    assert a_ends.tolist() == np.cumsum(aligner.a_lengths[a]).tolist() and b_ends.tolist() == np.cumsum(aligner.b_lengths[b]).tolist()
    spans = [(p.begin, p.end) for p in aligner.b.encode(text, return_type="proto").pieces]
    assert [e + 1 for _, e in spans] != b_ends.tolist() and spans[-1][1] == len(raw) - 1
    assert refined(np.array([9, 4, 9, 12]), np.array([False, True, False, True]), np.array([1, 3, 2, 6])).tolist() == [1, 4, 6, 12]


def test_messy_rows(messy, files, aligner):
    held = [(r.doc_id, r.text) for r in messy.collect() if len(r.text or "") < 9000]
    got = align(messy, files).collect()
    assert len(got) == messy.count()
    long = next(r for r in got if r.n_a > 10_000)
    assert long.n_links == long.n_a + long.n_b - long.n_groups and long.doc_id == 6
    short = {r[0]: (r[1], r[2], r[3], r[4], r[7]) for r in brute(aligner, held)}
    assert all((r.n_a, r.n_b, r.n_groups, r.n_links, r.groups) == short[r.doc_id] for r in got if r.doc_id in short)


def test_no_rows(nothing, files):
    assert align(nothing, files).count() == 0


def test_without_safe_cuts_a_text_is_one_unit(files):
    spaced = alignment.Files(files.byte_level.replace('"use_regex": true', '"use_regex": false').replace('"use_regex":true', '"use_regex":false'), files.pieces)
    assert Aligner(spaced).units("one two") == ["one two"] and Aligner(files).units("one two") == ["one", "two"]


def test_every_byte_has_a_letter():
    assert sorted(byte_letters().values()) == list(range(256)) and byte_letters()["Ġ"] == 32


def test_query_digests_the_groups(spark, sf_dir, aligner):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").limit(4).collect()
    got = {r.doc_id: r for r in registered.QUERIES["op11_alignment"](spark, sf_dir).collect()}
    for doc, n_a, n_b, n_groups, n_links, _, _, groups in brute(aligner, [(r.doc_id, r.text[:2000]) for r in rows if len(r.text) < 2000]):
        r = got[doc]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.groups_sha256) == (n_a, n_b, n_groups, n_links, hashlib.sha256(groups.encode()).hexdigest())
