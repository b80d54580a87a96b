from __future__ import annotations

import dataclasses

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from asset_catalog.config import Config
from asset_catalog.operators import catalog as catalog_operators
from asset_catalog.operators.assets import read_assets
from asset_catalog.operators.catalog import merge_into, project_catalog, upsert
from asset_catalog.schemas import DASHBOARD, QUERY, ConfigError, kind_of
from asset_catalog.sources import tables
from asset_catalog.sources.tables import (
    commit_version,
    ensure_catalog,
    read_catalog,
    table_name,
    upsert_catalog,
    upserted_parts,
)
from tests.conftest import dashboard, dumps, query


@pytest.fixture
def config(tmp_path):
    return Config(landing=str(tmp_path / "landed"), catalog_root=str(tmp_path / "catalog"),
                  database=f"cat_{abs(hash(str(tmp_path)))}")


def pull(texts, *assets, at="2024-01-01 00:00:00"):
    rows = texts([dumps(a) for a in assets])
    return project_catalog(read_assets(rows, "query"), "query", F.lit(at))


def test_projection(texts):
    asset = query(tags=["a b", "v2"], name="N")
    row = pull(texts, asset).first().asDict()
    assert "REDACTED" not in row.pop("query_object")
    assert row == {"query_name": "N", "query_hash": asset["query_hash"], "tags": ["ab", "v"],
                   "update_date_time": "2024-01-01 00:00:00", "is_migrated": False}
    rows = read_assets(texts([dumps(dashboard())]), "dashboard")
    assert project_catalog(rows, "dashboard", typed_tags=True).select("tags", "dashboard_slug").first() == (
        [], "sampledash")
    assert project_catalog(rows, DASHBOARD).schema["update_date_time"].dataType.simpleString() == "string"


def held(rows, message):
    return rows.withColumn("is_migrated", F.lit(True)).withColumn("upload_message", F.lit(message))


def rows_of(frame):
    return sorted((r["query_name"], r["query_hash"], r["update_date_time"], r["is_migrated"], r["upload_message"])
                  for r in frame.collect())


def test_upsert(texts):
    target = held(pull(texts, query(name="a"), query(name="b"), at="2023"), "sent")
    source = pull(texts, query(name="b"), query(name="c"), at="2024")
    once = upsert(target, source, QUERY.merge_keys)
    h = query()["query_hash"]
    assert rows_of(once) == [("a", h, "2023", True, "sent"), ("b", h, "2024", False, "sent"),
                             ("c", h, "2024", False, None)]
    assert rows_of(upsert(once, source, QUERY.merge_keys)) == rows_of(once)
    assert rows_of(upsert(target, source.limit(0), QUERY.merge_keys)) == rows_of(target)
    assert rows_of(upsert(target.limit(0), source, QUERY.merge_keys)) == [
        ("b", h, "2024", False, None), ("c", h, "2024", False, None)]


def test_null_keys_match_nothing(texts):
    rows = pull(texts, query(name="a"), at="2023").withColumn("query_hash", F.lit(None).cast("string"))
    assert upsert(held(rows, "m"), rows, QUERY.merge_keys).count() == 2


def test_tables(spark, texts, config):
    ensure_catalog(spark, config)
    ensure_catalog(spark, config)
    assert read_catalog(spark, config, "dashboard").schema == DASHBOARD.catalog_schema
    first = upsert_catalog(pull(texts, query(name="a"), query(name="b"), at="1"), config, "query")
    second = upsert_catalog(pull(texts, query(name="b"), query(name="c"), at="2"), config, "query")
    assert first != second
    got = {(r["query_name"], r["update_date_time"]) for r in read_catalog(spark, config, "query").collect()}
    assert got == {("a", "1"), ("b", "2"), ("c", "2")}
    # The version before is still whole.
    assert spark.read.parquet(first).count() == 2
    commit_version(held(pull(texts, query(name="z")), "m"), config, "query")
    assert [r["upload_message"] for r in read_catalog(spark, config, "query").collect()] == ["m"]


def test_merge_needs_a_table_that_can(spark, texts, config):
    ensure_catalog(spark, config)
    with pytest.raises(PySparkException, match="does not support MERGE"):
        merge_into(pull(texts, query()), table_name(config, "query"), QUERY.merge_keys)


def test_settings():
    good = '{"landing": " /a ", "catalog_root": "/b"}'
    assert Config.from_json(good).landing == "/a"
    for bad in ("{", '{"landing": "/a"}', '{"landing": "", "catalog_root": "/b"}',
                '{"landing": "/a", "catalog_root": "/b", "token": "x"}'):
        with pytest.raises(ConfigError):
            Config.from_json(bad)
    with pytest.raises(ConfigError):
        kind_of("alert")


@pytest.fixture
def in_parts(config):
    return dataclasses.replace(config, catalog_parts=16, catalog_buckets=2)


def files_of(path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in path.rglob("*.parquet")}


def many(texts, numbers, at):
    return pull(texts, *[query(name=f"n{k}") for k in numbers], at=at)


def test_parts_hold_the_same_as_versions(spark, texts, config, in_parts, tmp_path):
    pulls = [many(texts, range(40), "1"), many(texts, [3, 50, 51], "2"), many(texts, [], "3"), many(texts, range(30, 60), "4")]
    expected = held(many(texts, range(0, 90, 9), "0"), "sent")
    ensure_catalog(spark, in_parts)
    ensure_catalog(spark, in_parts)
    commit_version(expected, in_parts, "query")
    for source in pulls:
        expected = upsert(expected, source, QUERY.merge_keys)
        upsert_catalog(source, in_parts, "query")
        now = read_catalog(spark, in_parts, "query")
        assert rows_of(now) == rows_of(expected) and now.schema == QUERY.catalog_schema
    commit_version(held(many(texts, [1], "9"), "m"), in_parts, "query")
    assert rows_of(read_catalog(spark, in_parts, "query")) == [("n1", query()["query_hash"], "9", True, "m")]


def test_an_upsert_writes_only_the_parts_it_touches(spark, texts, in_parts, tmp_path):
    ensure_catalog(spark, in_parts)
    upsert_catalog(many(texts, range(200), "1"), in_parts, "query")
    folder = tmp_path / "catalog"
    before = files_of(folder)
    assert len({f.split("/")[2] for f in before}) == 16
    upsert_catalog(many(texts, [7, 8, 500], "2"), in_parts, "query")
    after = files_of(folder)
    touched = {f.split("/")[2] for f in before.items() ^ after.items() for f in f[:1]}
    assert 1 <= len(touched) <= 3
    assert read_catalog(spark, in_parts, "query").count() == 201


@pytest.mark.parametrize("limit", ["-1", "10MB"])
def test_the_table_is_not_moved(spark, texts, in_parts, limit):
    """Neither a pull too large to broadcast nor a small one shuffles the target."""
    ensure_catalog(spark, in_parts)
    upsert_catalog(many(texts, range(50), "1"), in_parts, "query")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        merged = upserted_parts(many(texts, range(40, 60), "2"), in_parts, "query")
        plan = merged._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    depth = lambda line: len(line) - len(line.lstrip(" :+-*()0123456789"))
    scans = [k for k, line in enumerate(plan) if "FileScan parquet" in line]
    assert len(scans) >= 2
    for k in scans:
        above, level = [], depth(plan[k])
        for line in reversed(plan[:k]):
            if depth(line) < level:
                above.append(line)
                level = depth(line)
        moved = [line for line in above if "Exchange hashpartitioning(query_hash" in line or ("Exchange" in line and "ENSURE" in line)]
        assert not moved, "\n".join(plan)


@pytest.mark.parametrize("limit", [1, 1000])
def test_many_rows_are_not_broadcast(spark, texts, config, monkeypatch, tmp_path, limit):
    """Spark guesses too little for keys taken out of JSON; known counts keep them off the driver."""
    monkeypatch.setattr(catalog_operators, "BROADCAST_ROWS", limit)
    for name, rows in (("target", held(many(texts, range(40), "0"), "sent")), ("source", many(texts, range(20, 60), "1"))):
        rows.write.parquet(str(tmp_path / name))
    target, source = (spark.read.parquet(str(tmp_path / name)) for name in ("target", "source"))
    merged = upsert(target, source, QUERY.merge_keys, counts=(40, 40))
    assert ("BroadcastHashJoin" in merged._jdf.queryExecution().executedPlan().toString()) == (limit > 40)
    assert rows_of(merged) == rows_of(upsert(target, source, QUERY.merge_keys))
    ensure_catalog(spark, config)
    upsert_catalog(source, config, "query")
    assert read_catalog(spark, config, "query").count() == 40


def test_parts_of_many_rows_are_joined_in_groups(spark, texts, in_parts, monkeypatch):
    """Each group of parts has a task for each bucket, so that tasks do not grow with the table."""
    ensure_catalog(spark, in_parts)
    upsert_catalog(many(texts, range(120), "1"), in_parts, "query")
    source = many(texts, range(60, 160), "2")
    expected = upsert(read_catalog(spark, in_parts, "query"), source, QUERY.merge_keys)
    monkeypatch.setattr(tables, "BUCKET_ROWS", 10)
    merged = upserted_parts(source, in_parts, "query")
    assert rows_of(merged.drop("part")) == rows_of(expected)
    assert merged.rdd.getNumPartitions() > 16
    before = rows_of(expected)
    upsert_catalog(source, in_parts, "query")
    assert rows_of(read_catalog(spark, in_parts, "query")) == before
    assert tables._part_groups({3: 4, 1: 9, 2: 1, 7: 30}, 10) == [[1, 2], [3], [7]]
