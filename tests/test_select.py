from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from asset_catalog.operators import assets as ops
from asset_catalog.operators import select
from asset_catalog.operators.assets import quarantine, read_assets
from asset_catalog.schemas import ConfigError
from tests.conftest import dumps, query


@pytest.fixture
def some(spark):
    rows = [
        ("1", "a", ["x", "y"], "2021-11-01T00:00:00.000Z"),
        ("2", "a", ["y"], "2021-10-31T23:59:59.999Z"),
        ("3", "b", [], "2021-11-02T00:00:00Z"),
        ("4", "c", None, None),
        ("5", None, ["x", None], "2021-11-01 00:00:00.000Z"),
        ("6", "A", [None], "2021-13-01T00:00:00.000Z"),
    ]
    return spark.createDataFrame(rows, "id string, name string, tags array<string>, updated_at string")


def ids(frame):
    return "".join(sorted(row["id"] for row in frame.collect()))


def test_tags(some):
    assert ids(select.filter_tags(some, ["x", "z"])) == "15"
    assert ids(select.filter_tags(some, [])) == "123456"


def test_dates(some):
    assert ids(select.filter_modified_since(some, "2021-11-01")) == "13"
    assert ids(select.filter_modified_since(some, None)) == "123456"
    assert ids(select.undated(some)) == "456"
    with pytest.raises(ConfigError):
        select.filter_modified_since(some, "01.11.2021")


def test_names(some, spark):
    assert ids(select.filter_names(some, "all", ["a"])) == "123456"
    assert ids(select.filter_names(some, "subset", ["a", "b"])) == "123"
    assert ids(select.filter_names(some, "subset", [])) == ""
    names = spark.createDataFrame([("a",), ("a",), (None,), ("z",)], "name string")
    assert ids(select.filter_names(some, "subset", names)) == "12"


def test_upload_modes(some):
    chosen = lambda mode: ids(select.select_for_upload(some, mode, ["x"], ["a", "b"]))
    assert [chosen(m) for m in select.INSERT_MODES] == ["15", "123", "1", "1235", "123456"]
    with pytest.raises(ConfigError):
        chosen("Some")


def test_deletion_goes_by_name(some):
    assert ids(select.select_for_delete(some, ["x"], ["c"])) == "145"
    closure = select.expand_by_name(some, select.chosen_for_delete(["x"], ["c"]))
    assert {(r["id"], r["collateral"]) for r in closure.collect()} == {("1", False), ("2", True), ("4", False)}
    assert ids(select.select_all(some, confirm=True)) == "123456"
    with pytest.raises(ConfigError):
        select.select_all(some)


def test_counts_pages_and_previews(some):
    assert tuple(ops.run_counts(some, select.has_tag(["x"])).first()) == (6, 2)
    assert ids(ops.page(some, ["id"], 2, 4)) == "56"
    assert ids(ops.preview(some, ["id"])) == "1"
    assert ops.preview(some.where("false"), ["id"]).count() == 0
    assert sorted(r[0] or "" for r in ops.distinct_names(some).collect()) == ["", "A", "a", "b", "c"]


def test_unreadable_rows_are_set_aside(texts):
    good = dumps(query())
    values = [good, good[:-5], good + good, dumps(query(name=None)), dumps(query(query_hash=None)), "[]", "x"]
    rows = texts(values)
    assert read_assets(rows, "query").count() == 1
    reasons = [r["reason"] for r in quarantine(rows, "query").collect()]
    assert reasons == ["not one JSON object"] * 2 + ["no name", "no query_hash"] + ["not one JSON object"] * 2


def test_very_long_texts_are_read(spark):
    rows = spark.range(1).selectExpr(
        "concat('{\"query_hash\":\"h\",\"name\":\"', repeat('x', 20000001), '\"}') AS raw")
    assert read_assets(rows, "query").select(F.length("name")).collect() == [(20000001,)]
    assert quarantine(rows, "query").select("reason").collect() == []


def test_last_state_wins(spark):
    rows = spark.createDataFrame(
        [("k", 1, "a"), ("k", 2, "b"), ("k", None, "c"), ("l", None, "d"), (None, 1, "e")],
        "key string, n int, v string",
    )
    last = ops.latest_per_key(rows, ["key"], ["n"])
    assert sorted(r["v"] for r in last.collect()) == ["b", "d", "e"]
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan  # cut before the shuffle
    assert last.columns == rows.columns
