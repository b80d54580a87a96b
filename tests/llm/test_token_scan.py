from __future__ import annotations

import numpy as np
import pytest

from asset_catalog.llm import token_scan
from asset_catalog.llm.token_scan import Tokens


@pytest.fixture(scope="module")
def tokens():
    return token_scan.load()


def brute(files, separator):
    """Start and tokens of each document, one id after the other."""
    out = {}
    for name, ids in files.items():
        start = number = 0
        for place, i in enumerate(ids):
            if i == separator:
                out[name, number] = (start, place - start, True)
                start, number = place + 1, number + 1
        if start < len(ids):
            out[name, number] = (start, len(ids) - start, False)
    return out


@pytest.mark.parametrize(("block_bytes", "separator"), [(4, 9), (14, 9), (1 << 20, 9), (24, 70_000), (1 << 20, 70_000)])
def test_documents_are_stitched_across_blocks(spark, tmp_path, block_bytes, separator):
    draw = np.random.default_rng(separator)
    files = {f"f{k}.bin": draw.integers(0, 9, size).tolist() for k, size in enumerate((0, 1, 37, 60, 33, 16))}
    for k, ids in enumerate(files.values()):
        for place in draw.integers(0, max(1, len(ids)), k * 3).tolist():
            ids[place : place + 1] = [separator]
    files["f6.bin"] = [separator] * 5
    files["f7.bin"] = [1] * 40
    vocabulary = Tokens({}, "", separator)
    width = vocabulary.dtype.itemsize
    for name, ids in files.items():
        (tmp_path / name).write_bytes(np.array(ids, vocabulary.dtype).tobytes())
    scanned = token_scan.find_separators(spark, str(tmp_path), vocabulary, max(width, block_bytes // width * width))
    rows = token_scan.documents_of(scanned).collect()
    found = {(r.file, r.number): (r.start, r.n_tokens, r.ended) for r in rows}
    assert len(rows) == len(found) and found == brute(files, separator)


def test_counts_are_those_of_the_tokenizer(real, tokens):
    encoder = tokens.encoder()
    expected = {r.doc_id: len(encoder.encode_ordinary(r.text)) for r in real.collect()}
    for block_bytes in (20_000, token_scan.BLOCK_BYTES):
        rows = token_scan.count_tokens(real, tokens, block_bytes).collect()
        assert len(rows) == len(expected) and {r.doc_id: r.n_tokens for r in rows} == expected


def test_messy_rows(messy, nothing, tokens):
    encoder = tokens.encoder()
    texts = {r.doc_id: r.text for r in messy.collect()}
    rows = token_scan.count_tokens(messy, tokens).collect()
    assert len(rows) == 10 and [r.doc_id for r in rows].count(1) == 2
    assert all(r.n_tokens == len(encoder.encode_ordinary(texts[r.doc_id] or "")) for r in rows)
    assert token_scan.count_tokens(nothing, tokens).collect() == []


def test_separator_in_a_text_is_plain_text(documents, tokens):
    rows = token_scan.count_tokens(documents([(1, "a <|endoftext|> b", "en", "s"), (2, "c", "en", "s")]), tokens).collect()
    assert {r.doc_id: r.n_tokens for r in rows} == {1: len(tokens.encoder().encode_ordinary("a <|endoftext|> b")), 2: 1}
