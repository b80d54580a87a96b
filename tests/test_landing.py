"""Landed assets: one read alone, and all replaced by their last states."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from asset_catalog.config import Config
from asset_catalog.operators.assets import read_assets
from asset_catalog.plans.lifecycles import import_assets
from asset_catalog.sources.exports import compact_landing, read_asset, write_asset_files
from asset_catalog.sources.tables import ensure_catalog, read_catalog
from tests.conftest import dumps, query

ROWS = [query(name=f"n{k}", query=f"select {k}") for k in range(40)]


def landed(spark, path, *assets):
    rows = spark.createDataFrame([(dumps(a),) for a in assets], "raw string")
    write_asset_files(read_assets(rows, "query"), str(path), 8)


def lines(path):
    return sorted(line for f in path.rglob("part-*") for line in f.read_text().splitlines())


@pytest.fixture
def path(spark, tmp_path):
    path = tmp_path / "landed" / "queries"
    landed(spark, path, *ROWS)
    landed(spark, path, query(name="n3", query="later", updated_at="2030-01-01T00:00:00+02:00"), query(name="new"))
    landed(spark, path, query(name="n3", query="earlier", updated_at="2029-12-31T21:59:59Z"), query(name="n4", query="landed last"))
    (path / "bucket=0" / "part-broken.txt").write_text('{"cut\n{"cut\n' + dumps({"name": "no key"}) + "\n")
    return path


def catalog(spark, tmp_path, name):
    config = Config(landing=str(tmp_path / "landed"), catalog_root=str(tmp_path / name), database=f"{name}_{abs(hash(str(tmp_path)))}")
    ensure_catalog(spark, config)
    _, rejected = import_assets(spark, config, "query", as_of=None)
    rows = read_catalog(spark, config, "query").drop("update_date_time")
    return sorted(map(tuple, rows.collect())), sorted(r["raw"] for r in spark.read.parquet(rejected).distinct().collect())


def test_import_after_compaction_gives_the_same(spark, path, tmp_path):
    before = catalog(spark, tmp_path, "before")
    assert len(lines(path)) == 47
    compact_landing(spark, str(path), "query")
    assert len(lines(path)) == 41 + 2  # one for each asset, and what cannot be read
    assert catalog(spark, tmp_path, "after") == before
    kept = lines(path)
    compact_landing(spark, str(path), "query")
    assert lines(path) == kept
    landed(spark, path, query(name="n5", query="after", updated_at="2031-01-01T00:00:00Z"))
    found = read_asset(spark, str(path), "query", query()["query_hash"], "n5", 8)
    assert [r["updated_at"][:4] for r in found.collect()] == ["2031"]


def test_one_asset_reads_one_directory(spark, path):
    found = read_asset(spark, str(path), "query", query()["query_hash"], "n3", 8)
    assert [(r["name"], r["updated_at"]) for r in found.collect()] == [("n3", "2030-01-01T00:00:00+02:00")]
    assert "later" in found.first()["raw"]
    scanned = found.select(F.input_file_name().alias("f")).inputFiles()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan and scanned
    assert read_asset(spark, str(path), "query", "none", "n3", 8).count() == 0
