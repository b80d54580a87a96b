from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from asset_catalog.operators.assets import read_assets
from asset_catalog.operators.relate import endpoint_ids, enrich_with_detail
from asset_catalog.schemas import ConfigError
from asset_catalog.sources import landed
from asset_catalog.sources.exports import (
    asset_file_key,
    keyed_documents,
    write_asset_files,
    write_entry_lines,
    write_keyed_json,
)
from tests.conftest import dumps, query


def put(path, value):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(value if isinstance(value, str) else json.dumps(value, indent=1))


def test_listing(spark, tmp_path):
    put(tmp_path / "p1.json", {"count": 3, "results": [{"id": 1, "name": "a"}, {"id": 2, "name": "b"}]})
    put(tmp_path / "p2.json", {"count": 3, "results": [{"id": 3, "name": "c", "x": [1, {"y": None}]}]})
    put(tmp_path / "p3.json", "{broken")
    rows = landed.read_listing(spark, str(tmp_path), "query")
    assert sorted(r["object_key"] for r in rows.collect()) == ["1", "2", "3"]
    detail = spark.createDataFrame([("1", '{"full":1}'), ("9", "{}")], "object_key string, raw string")
    full = {r["object_key"]: (r["raw"][:8], r["has_detail"]) for r in enrich_with_detail(rows, detail, "object_key").collect()}
    assert full["1"] == ('{"full":', True) and full["2"][1] is False and len(full) == 3
    twice = enrich_with_detail(rows.union(rows), detail.union(detail), "object_key")
    assert {r["object_key"]: (r["raw"][:8], r["has_detail"]) for r in twice.collect()} == full and twice.count() == 3
    broken = landed.unreadable(landed.read_documents(spark, str(tmp_path)))
    assert [r["value"] for r in broken.collect()] == ["{broken"]


def test_keyed_json(spark, tmp_path):
    put(tmp_path / "a.json", '{"1": {"name": "old", "n": 1.50}, "é\\"": {"name": "x"},\n "1": {"name": "new"}}')
    got = {r["object_key"]: json.loads(r["raw"]) for r in landed.read_keyed_json(spark, str(tmp_path / "a.json")).collect()}
    assert got == {"1": {"name": "new"}, 'é"': {"name": "x"}}
    with pytest.raises(ConfigError):
        landed.read_keyed_json(spark, str(tmp_path / "none.json"))


def test_lines(spark, tmp_path):
    put(tmp_path / "q" / "h_a.json", dumps(query()) + "\n\n" + dumps(query(name="b")) + "\n")
    put(tmp_path / "q" / "h_b.json", dumps(query(name="c")))
    rows = landed.read_json_lines(spark, str(tmp_path / "q"))
    assert rows.count() == 3
    assert {r["source_file"][-8:] for r in rows.collect()} == {"h_a.json", "h_b.json"}
    assert sorted(r["name"] for r in read_assets(rows, "query").collect()) == ["SampleQuery", "b", "c"]


def test_mapping(spark, tmp_path):
    put(tmp_path / "t.json", {"OrdersV1": "new", "": "x", "a.b": ""})
    pairs = landed.read_mapping(spark, str(tmp_path / "t.json"))
    assert landed.load_mapping(pairs) == {"ordersv1": "new", "a.b": ""}
    with pytest.raises(ConfigError):
        landed.load_mapping(pairs, max_bytes=10)
    assert landed.read_mapping(spark, str(tmp_path / "none.json")) is None
    assert landed.load_mapping(None) is None
    put(tmp_path / "twice.json", '{"a": "x", "a": "y"}')
    assert landed.load_mapping(landed.read_mapping(spark, str(tmp_path / "twice.json"))) == {"a": "y"}
    put(tmp_path / "u.json", {"A": "x", "a": "y"})
    with pytest.raises(ConfigError):
        landed.load_mapping(landed.read_mapping(spark, str(tmp_path / "u.json")))


def test_endpoints(spark, tmp_path):
    put(tmp_path / "e.json", [{"id": "2", "endpoint_id": "e2", "name": "n"}, {"id": "1", "endpoint_id": "e1", "name": "n"}])
    rows = landed.read_endpoints(spark, str(tmp_path / "e.json"))
    assert endpoint_ids(rows, "n") == ("e2", "2")
    for name in ("m", ""):
        with pytest.raises(ConfigError):
            endpoint_ids(rows, name)


def test_inventory(spark, tmp_path):
    results = [{"id": n, "name": f"q{n}", "tags": ["t"] if n % 2 else None} for n in range(600)]
    put(tmp_path / "i.json", {"count": 600, "results": results})
    rows = landed.read_target_inventory(spark, str(tmp_path), "dashboard")
    assert rows.count() == 600
    assert tuple(rows.where("id = '3'").first()) == ("dashboard", "3", "q3", ["t"])


@pytest.mark.parametrize("documents", [1, 7])
def test_export_documents_hold_every_entry(spark, tmp_path, documents):
    assets = {f'k"\\{n}é:': {"name": f"a{n}", "tags": [], "x": None, "n": 1.5} for n in range(50)}
    rows = [(k, json.dumps(v)) for k, v in assets.items()]
    entries = spark.createDataFrame(rows, "object_key string, raw string")
    write_keyed_json(entries, str(tmp_path / "out"), documents)
    assert spark.read.text(str(tmp_path / "out")).count() == documents
    held = {}
    for line in spark.read.text(str(tmp_path / "out")).collect():
        held.update(json.loads(line[0]))
    assert held == assets
    back = landed.read_keyed_json(spark, str(tmp_path / "out"))
    assert {r["object_key"]: json.loads(r["raw"]) for r in back.collect()} == assets
    assert keyed_documents(entries.limit(0), 1).count() == 0
    write_entry_lines(entries, str(tmp_path / "lines"))
    assert spark.read.text(str(tmp_path / "lines")).count() == len(assets)
    back = landed.read_entry_lines(spark, str(tmp_path / "lines"))
    assert {r["object_key"]: json.loads(r["raw"]) for r in back.collect()} == assets


def test_broken_documents_are_not_passed_over(spark, tmp_path):
    put(tmp_path / "m.json", '{"a": "x"')
    put(tmp_path / "i" / "1.json", {"results": [{"id": 1, "name": "q"}]})
    put(tmp_path / "i" / "2.json", '{"results": [{"id": 2')
    put(tmp_path / "e.json", '[{"id": 1}')
    for read in (
        lambda: landed.read_mapping(spark, str(tmp_path / "m.json")),
        lambda: landed.read_target_inventory(spark, str(tmp_path / "i"), "query"),
        lambda: landed.read_endpoints(spark, str(tmp_path / "e.json")),
    ):
        with pytest.raises(ConfigError):
            read()
    rejected = landed.rejected_listing(landed.read_documents(spark, str(tmp_path / "i")), "dashboard")
    assert sorted(r["reason"] for r in rejected.collect()) == ["no key", "not a page"]


def test_asset_files(spark, tmp_path, texts):
    pretty = json.dumps(query(name="a/b c"), indent=1)
    values = [pretty, dumps(query(name="x", updated_at="2021-01-01")), dumps(query(name="x", updated_at="2022-01-01"))]
    assets = read_assets(texts(values), "query")
    assert sorted(r[0] for r in assets.select(asset_file_key(F.col("asset_key"), F.col("name"))).distinct().collect()) == [
        f"{query()['query_hash']}_a%2Fb+c.json", f"{query()['query_hash']}_x.json"]
    path = str(tmp_path / "landed")
    write_asset_files(assets, path, buckets=3)
    back = read_assets(landed.read_json_lines(spark, path), "query")
    assert sorted((r["name"], r["updated_at"]) for r in back.collect()) == [
        ("a/b c", query()["updated_at"]), ("x", "2022-01-01")]
    write_asset_files(read_assets(texts([dumps(query(name="x", updated_at="2023-01-01"))]), "query"), path, 3)
    assert landed.read_json_lines(spark, path).count() == 3


def test_an_export_document_is_never_one_cell(spark, tmp_path):
    """Entries are sorted and written one by one; a document may be larger than a cell or a task's memory."""
    entries = spark.range(2000).select(F.concat(F.lit('k}"'), "id").alias("object_key"), F.concat(F.lit('{"n": '), "id", F.lit("}")).alias("raw"))
    parts = keyed_documents(entries, 3)
    assert parts.agg(F.max(F.length("value"))).first()[0] < 40
    assert "collect_list" not in parts._jdf.queryExecution().toString()
    write_keyed_json(entries, str(tmp_path / "out"), 3)
    files = [json.loads(f.read_text()) for f in (tmp_path / "out").glob("part-*")]
    assert len(files) == 3 and sum(map(len, files)) == 2000
    for larger_than in (0, 1 << 20):
        back = landed.read_keyed_json(spark, str(tmp_path / "out"), larger_than=larger_than)
        assert sorted(json.loads(r["raw"])["n"] for r in back.collect()) == list(range(2000))
