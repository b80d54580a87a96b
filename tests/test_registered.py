"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import datetime
import math
import os

import duckdb
import pytest

from asset_catalog.plans.registered import all_oracles, all_queries
from asset_catalog.sources import scratch

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    held = duckdb.connect()
    for file in sorted(os.listdir(SF_DIR)):
        held.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{SF_DIR}/{file}'")
    return held


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def canonical(rows):
    return sorted(repr(tuple(plain(v) for v in row)) for row in rows)


def test_every_query_has_sql():
    assert set(all_queries()) == set(all_oracles())


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_same_as_sql(spark, duck, name):
    got = all_queries()[name](spark, SF_DIR)
    columns = sorted(got.columns)
    expected = duck.sql(all_oracles()[name])
    assert sorted(expected.columns) == columns
    rows = expected.select(*columns).fetchall()
    assert canonical(map(tuple, got.select(columns).collect())) == canonical(rows)
    assert rows


@pytest.mark.parametrize(
    "name",
    ["scan_json_lines", "export_asset_files", "upsert_queries", "upsert_dashboards", "outbox_create", "status_messages"],
)
def test_same_without_a_shared_folder(spark, duck, monkeypatch, name):
    monkeypatch.setattr(scratch, "scratch_folder", lambda spark: None)
    test_same_as_sql(spark, duck, name)


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_no_python_in_the_plan(spark, name):
    plan = all_queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for slow in ("EvalPython", "MapInPandas", "CartesianProduct", "NestedLoopJoin", "LocalLimit"):
        assert slow not in plan or (slow == "LocalLimit" and name == "page_listing")
