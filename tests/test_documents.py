"""Export documents read in pieces, against the reader that takes each as one cell."""

from __future__ import annotations

import json
import random
from pathlib import Path

import pytest

from asset_catalog.sources import documents
from asset_catalog.sources.documents import document_entries, read_pieces
from asset_catalog.sources.landed import keyed_rows, read_documents, read_keyed_json

TEXTS = ["plain", "}{][", '"quoted" \\ {', "ünï ☃ 😀", "line\nbreak", "", "\\", '\\"}', "a" * 700, "}" * 40]


def asset(draw, depth=0):
    if depth > 2 or draw.random() < 0.3:
        return draw.choice([*TEXTS, 1, -2.5, True, None, [], {}])
    if draw.random() < 0.4:
        return [asset(draw, depth + 1) for _ in range(draw.randint(0, 4))]
    return {draw.choice(TEXTS) + str(k): asset(draw, depth + 1) for k in range(draw.randint(0, 4))}


def document(draw, entries):
    held = {f"{draw.choice(TEXTS)}{k}": asset(draw) for k in range(entries)}
    return json.dumps(held, ensure_ascii=draw.random() < 0.5, indent=draw.choice([None, 2]))


@pytest.fixture
def small_blocks(spark, monkeypatch):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    monkeypatch.setattr(documents, "BLOCK_ROWS_LOG2", 3)
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def write(folder: Path, texts):
    folder.mkdir()
    for name, text in texts.items():
        (folder / f"{name}.json").write_bytes(text if isinstance(text, bytes) else text.encode())
    return str(folder)


def read(spark, path):
    entries, broken = document_entries(read_pieces(spark, path, larger_than=0))
    rows = entries.orderBy("source_file", "part", "pos").collect()
    found = [(Path(r.source_file).stem, r.object_key, r.raw) for r in rows]
    return found, sorted(Path(r.source_file).stem for r in broken.collect())


def test_same_entries_as_of_whole_documents(spark, tmp_path, small_blocks):
    draw = random.Random(5)
    held = {f"d{k}": document(draw, n) for k, n in enumerate((0, 1, 2, 30, 90))}
    held["twice"] = '{"a": {"n": 1}, "b": 5, "a": {"n": 2}}\n \n'
    held["marked"] = b"\xef\xbb\xbf" + b'{"a": {"n": [1, {"x": "}"}]}, "z": "}"}'
    held["flat"] = ' {"a": "1", "b": [{"x": {}}, 2], "c": null} '
    path = write(tmp_path / "in", held)
    found, broken = read(spark, path)
    assert broken == []
    for name, text in held.items():
        expected = spark.createDataFrame([(text.decode("utf-8-sig") if isinstance(text, bytes) else text,)], "value string")
        rows = expected.selectExpr("posexplode(map_entries(from_json(value, 'map<string,string>'))) AS (pos, e)").orderBy("pos").collect()
        assert [(k, v) for n, k, v in found if n == name] == [(r.e.key, r.e.value) for r in rows], name
    assert read_pieces(spark, path, 0).select("block").distinct().count() > 5


def test_last_entry_of_a_key_counts_whatever_the_size(spark, tmp_path, small_blocks):
    draw = random.Random(6)
    path = write(tmp_path / "in", {f"d{k}": document(draw, 20 * k) for k in range(4)})
    expected = sorted(map(tuple, keyed_rows(read_documents(spark, path)).collect()), key=str)
    for larger_than in (0, 4000, 1 << 40):
        assert sorted(map(tuple, read_keyed_json(spark, path, larger_than).collect()), key=str) == expected


BROKEN = {
    "cut_inside": '{"a": {"b": 1}, "c": {"d": 2',
    "cut_behind": '{"a": {"b": 1}',
    "cut_text": '{"a": {"b": 1}, "c": "x',
    "no_comma": '{"a": {"b": 1} "c": {"d": 2}}',
    "last_comma": '{"a": {"b": 1}, }',
    "too_many": '{"a": {"b": 1}}}',
    "behind": '{"a": {"b": 1}} {"c": {}}',
    "words": '{"a": {"b": 1}} more',
    "list": '[{"a": 1}]',
    "bad_entry": '{"a": {"b": 1}, "c": {d: }, "e": {}}',
    "bracket": '{"a": [{"b": 1}, "c": {"d": 1}}',
    "text": "words only",
    "blank": " \n",
}


def test_broken_documents_give_no_entries_and_are_named(spark, tmp_path):
    path = write(tmp_path / "in", {**BROKEN, "good": '{"a": {"b": 1}, "c": "d"}', "empty": "{}"})
    found, broken = read(spark, path)
    assert broken == sorted(BROKEN)
    assert found == [("good", "a", '{"b":1}'), ("good", "c", "d")]


def test_no_task_holds_a_document(spark, tmp_path, small_blocks):
    """The pieces of one line are dealt over many tasks, and no cell is longer than an entry."""
    text = json.dumps({f"key{k}": {"text": "x" * 300, "n": [{"k": k}]} for k in range(400)})
    path = write(tmp_path / "in", {"one": text})
    pieces = read_pieces(spark, path, larger_than=0)
    assert pieces.rdd.getNumPartitions() > 20
    entries, broken = document_entries(pieces)
    assert entries.count() == 400 and broken.count() == 0
    assert pieces.selectExpr("max(length(value))").first()[0] < 500


def test_entries_of_one_document_stay_in_many_tasks(spark, tmp_path):
    """Entries meet the list of whole documents where they are, not in one task for each document."""
    (tmp_path / "a.json").write_text(json.dumps({f"k{n}": {"n": n} for n in range(50)}))
    entries, _ = document_entries(read_pieces(spark, str(tmp_path), 0))
    assert entries.count() == 50
    plan = entries._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
