"""What the plans of the hot operators must look like."""

from __future__ import annotations

from pyspark.sql import functions as F

from asset_catalog.functions.json_fields import or_default
from asset_catalog.functions.text import multi_replace
from asset_catalog.operators import outbox, relate
from asset_catalog.operators.assets import read_assets
from asset_catalog.operators.catalog import upsert
from asset_catalog.operators.relate import enrich_with_detail
from asset_catalog.operators.select import filter_tags
from asset_catalog.plans.lifecycles import Mappings, catalog_rows
from tests.conftest import dumps, query


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_json_is_parsed_once_under_a_filter(texts):
    rows = filter_tags(read_assets(texts([dumps(query())]), "query"), ["x"])
    assert plan_of(rows.select("name", "updated_at")).count("parseJson") == 1


def test_tables_are_read_by_column(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).select("id", F.lit("x").alias("text"), F.lit("y").alias("other")).write.parquet(path)
    rows = spark.read.parquet(path).where("id > 3")
    plan = plan_of(rows.select(multi_replace(F.col("text"), {"x": "z"})))
    assert "ReadSchema: struct<id:bigint,text:string>" in plan and "GreaterThan(id,3)" in plan


def exchanges(spark, frame):
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return plan_of(frame.select("*")).count("Exchange hashpartitioning")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)


def test_an_import_is_shuffled_once(spark, texts):
    rows = catalog_rows(texts([dumps(query())]), "query", mappings=Mappings({"a": "b"}, {"c": "d"}))
    assert exchanges(spark, rows) == 1
    assert plan_of(rows).count("parseJson(concat([, raw") == 1


def test_detail_is_joined_without_a_further_shuffle(spark):
    rows = spark.createDataFrame([("1", "{}")], "object_key string, raw string")
    assert exchanges(spark, enrich_with_detail(rows, rows, "object_key")) == 2


def test_mapping_is_one_constant(texts):
    plan = plan_of(texts(["a"]).select(multi_replace(F.col("raw"), {"a": "b"})))
    assert plan.count('{"a": "b"}') == 1


def test_small_pulls_do_not_move_the_catalog(spark, tmp_path):
    schema = "query_hash string, query_name string, query_object string, upload_message string"
    target, source = str(tmp_path / "t"), str(tmp_path / "s")
    spark.createDataFrame([("h", "n", "{}", "m")], schema).write.parquet(target)
    spark.createDataFrame([("h", "n", "{}", "m")], schema).drop("upload_message").write.parquet(source)
    merged = upsert(spark.read.parquet(target), spark.read.parquet(source), ["query_hash", "query_name"])
    plan = plan_of(merged)
    assert plan.count("BroadcastHashJoin") == 2 and "Exchange hashpartitioning" not in plan


def test_each_step_reads_a_text_once(spark, texts):
    """Finding F6: key fields were read by the filter and again after it, and each text was trimmed from its start."""
    rows = read_assets(texts([dumps(query()), dumps(query()) + " \n", dumps(query(name=None)), dumps(query()) + "}"]), "query")
    assert plan_of(rows.select("asset_key")).count("$.query_hash") == 1
    assert plan_of(rows.select("name")).count("$.name") == 1
    assert [r["name"] for r in rows.collect()] == ["SampleQuery", "SampleQuery"]


def test_matches_are_looked_for_where_one_can_begin(spark, texts):
    """Finding F6: every way of the pattern was tried at every character."""
    mapping = {"k-9": "K", "^x": "caret", "]y": "bracket", "ss": "S", "é": "e"}
    rows = texts(["a ^x ]y k-9 K-9 ſs É \x01 -", "nothing", None])
    folded = rows.select(multi_replace(F.col("raw"), mapping, preserve_case=True).alias("new"))
    assert "(?=[" in plan_of(folded)
    assert [r["new"] for r in folded.collect()][1:] == ["nothing", None]
    assert folded.first()["new"].startswith("a caret bracket K ")


def test_requests_and_children_come_of_one_reading(spark, texts):
    """Finding F5: assets were parsed for their charts and once more for their requests."""
    given = [query(), query(name="none", visualizations=None), query(name="empty", visualizations=[])]
    given.append(query(name="secret", options={"api_key": [1, {"api_key": "x"}], "a": '"api_key":1'}))
    queries = read_assets(texts([dumps(asset) for asset in given]), "query")
    apart = outbox.query_requests(queries, F.lit("ds"), "marker")
    kept = outbox.query_requests(queries, F.lit("ds"), "marker", keep=["parsed"])
    requests, charts = outbox.requests_and_children(kept, relate.explode_visualizations, "charts")
    assert "parseJson" in plan_of(apart) and "parseJson" not in plan_of(requests)
    assert requests.columns == apart.columns
    assert sorted(requests.collect()) == sorted(apart.collect())
    fields = ["parent_key", "pos", "old_viz_id", F.to_json("visualization").alias("chart")]
    expected = relate.explode_visualizations(queries).select(fields)
    assert sorted(map(str, charts.select(fields).collect())) == sorted(map(str, expected.collect()))
    assert '{"a":"\\"api_key\\":1","api_key":null}' in requests.where("source_key LIKE '%secret'").first()["body"]


def test_default_reads_its_value_once(texts):
    """Finding F5: the value was made anew for each test of it."""
    made = texts(["", "a", None]).select(or_default(F.upper("raw"), F.lit("none"), kind="string").alias("given"))
    assert plan_of(made).count("upper(") == 1
    assert [row["given"] for row in made.collect()] == ["none", "A", "none"]
