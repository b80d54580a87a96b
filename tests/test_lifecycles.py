from __future__ import annotations

import dataclasses
import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from asset_catalog.config import Config
from asset_catalog.operators.outbox import (
    build_delete_outbox,
    build_outbox,
    collect_status,
    delete_messages,
    read_responses,
    rejected_responses,
    write_outbox,
)
from asset_catalog.operators.relate import endpoint_ids, new_ids
from asset_catalog.operators.select import chosen_for_delete, expand_by_name, filter_names
from asset_catalog.plans import derived
from asset_catalog.plans.lifecycles import (
    Choice,
    Mappings,
    Upload,
    catalog_with_messages,
    clean_export,
    export_assets,
    import_assets,
    land,
    remove_requests,
    run_report,
)
from asset_catalog.schemas import RESPONSES, ConfigError
from asset_catalog.sources.landed import read_endpoints, read_json_lines, read_keyed_json
from asset_catalog.sources.tables import commit_version, current_version, ensure_catalog, read_catalog
from asset_catalog.streaming.landing import import_new
from tests.conftest import dashboard, dumps, query, widget
from tests.test_sources import put

MAPPINGS = Mappings({"raw_zone": "lake.sales", "OrdersV1": "orders_v2"}, {"strpos": "instr"})


@pytest.fixture
def config(spark, tmp_path):
    config = Config(landing=str(tmp_path / "landed"), catalog_root=str(tmp_path / "catalog"),
                    database=f"run_{abs(hash(str(tmp_path)))}", marker_tag="moved")
    ensure_catalog(spark, config)
    return config


def lines(*assets):
    return "\n".join(a if isinstance(a, str) else dumps(a) for a in assets) + "\n"


def test_import(spark, config, tmp_path):
    put(tmp_path / "landed" / "queries" / "1.json", lines(
        query(tags=["t"]), query(tags=["t"], query="select 2", updated_at="2022-01-01T00:00:00.000Z"),
        query(name="other", tags=["u"]), query(name="early", tags=["t"], updated_at="2020-01-01T00:00:00Z"),
        query(name="undated", tags=["t"], updated_at=None), '{"cut'))
    version, rejected = import_assets(spark, config, "query", Choice(["t"], "2021-01-01"), MAPPINGS)
    rows = read_catalog(spark, config, "query").collect()
    assert [(r["query_name"], json.loads(r["query_object"])["query"]) for r in rows] == [("SampleQuery", "select 2")]
    assert {r["reason"] for r in spark.read.parquet(rejected).collect()} == {
        "not one JSON object", "no readable updated_at"}
    assert spark.read.parquet(version).count() == 1


def test_what_landed_last_counts(spark, config, tmp_path):
    for number, text in enumerate(["b", "a", "c"]):
        put(tmp_path / "landed" / "queries" / f"{text}.json", lines(query(query=text)))
        os.utime(tmp_path / "landed" / "queries" / f"{text}.json", (10**9 + number, 10**9 + number))
    os.utime(tmp_path / "landed" / "queries" / "a.json", (2 * 10**9, 2 * 10**9))
    import_assets(spark, config, "query")
    rows = read_catalog(spark, config, "query").collect()
    assert [json.loads(r["query_object"])["query"] for r in rows] == ["a"]


def test_rewritten_object(spark, config, tmp_path):
    put(tmp_path / "landed" / "queries" / "1.json", lines(query()))
    import_assets(spark, config, "query", mappings=MAPPINGS)
    got = json.loads(read_catalog(spark, config, "query").first()["query_object"])
    expected = query(query="select \n1 as a,\n instr('x','y') as b from lake.sales.orders_v2")
    del expected["api_key"]
    assert got == expected


def test_land_from_listing(spark, config, texts):
    rows = texts([dumps(query(name="a", tags=["t"])), dumps(query(name="b"))])
    listing = rows.select(F.lit("1").alias("object_key"), "raw")
    land(listing, f"{config.landing}/queries", "query", Choice(["t"]))
    kept = read_json_lines(spark, f"{config.landing}/queries").collect()
    assert [json.loads(r["raw"])["name"] for r in kept] == ["a"]


def test_clean_export(spark, tmp_path):
    document = {"1": query(), "2": query(query=None, name=None), "3": "no object"}
    put(tmp_path / "raw" / "all.json", document)
    rejected = clean_export(spark, str(tmp_path / "raw"), str(tmp_path / "clean"), MAPPINGS, secrets=())
    assert [r["object_key"] for r in rejected.collect()] == ["3"]
    got = {r["object_key"]: json.loads(r["raw"]) for r in read_keyed_json(spark, str(tmp_path / "clean")).collect()}
    new = "select \n1 as a,\n instr('x','y') as b from lake.sales.orders_v2"
    assert got == {"1": query(query=new), "2": query(query=None, name=None)}


def answer(frame, spark, fails=()):
    """What a sender would land: an id for each request but the failing ones."""
    rows = []
    for r in frame.collect():
        ok = r["source_key"] not in fails
        rows.append((r["step"], r["source_key"], 200 if ok else 400, f"new-{r['source_key']}" if ok else None,
                     None if ok else "refused"))
    return spark.createDataFrame(rows, RESPONSES)


def bodies(frame):
    return {r["source_key"]: json.loads(r["body"]) for r in frame.collect()}


def test_upload_and_remove(spark, config, tmp_path):
    put(tmp_path / "landed" / "queries" / "1.json", lines(
        query(tags=["x"]), query(name="bare", query_hash="h2", visualizations=None),
        query(name="bad"), query(name="same", visualizations=None)))  # of equal text, so of equal hash
    put(tmp_path / "landed" / "dashboards" / "1.json", lines(
        dashboard(), dashboard(slug="empty", name="Empty", widgets=None), dashboard(slug="no", name="No")))
    for kind in ("query", "dashboard"):
        import_assets(spark, config, kind)
    put(tmp_path / "e.json", [{"id": "ds", "endpoint_id": "ep", "name": "main"}])
    _, source = endpoint_ids(read_endpoints(spark, str(tmp_path / "e.json")), "main")
    upload, h = Upload.from_catalog(spark, config, source), query()["query_hash"] + "/SampleQuery"
    bad, bare, same = (f"{k}/{n}" for k, n in ((query()["query_hash"], "bad"), ("h2", "bare"), (query()["query_hash"], "same")))

    first = upload.query_requests()
    body = bodies(first)[h]
    assert body == {
        "data_source_id": "ds", "query": query()["query"], "name": "SampleQuery", "description": "",
        "schedule": None, "options": {"parameters": []}, "visualizations": query()["visualizations"],
        "tags": ["moved", "x"]}
    made = answer(first, spark, fails=[bad])
    second = upload.chart_requests(made)
    assert bodies(second)[f"{h}#2"] == {
        "name": "chart 2", "type": "COUNTER", "description": "", "query_id": f"new-{h}",
        "options": {"counterColName": "A", "rowNumber": 1, "stringDecimal": 0, "formatTargetValue": False}}
    assert len(bodies(second)) == 5  # none of the query that failed
    drawn = answer(second, spark, fails=[f"{h}#3"])
    assert {(r[0], r[1]) for r in upload.id_map(drawn).collect()} == {
        ("1", f"new-{h}#0"), ("4", f"new-{h}#1"), ("2", f"new-{h}#2"), ("5", f"new-{h}#4")}

    third = upload.dashboard_requests()
    assert bodies(third)["empty/Empty"] == {
        "name": "Empty", "layout": [], "dashboard_filters_enabled": False, "widgets": [], "is_trashed": None,
        "is_draft": True, "tags": ["moved"]}
    shown = answer(third, spark, fails=["no/No"])
    fourth = upload.widget_requests(drawn.union(shown))
    position = widget(1, 2)["options"]
    assert bodies(fourth) == {
        "sampledash/SampleDash#0": {"dashboard_id": "new-sampledash/SampleDash", "visualization_id": f"new-{h}#2", "text": "",
                         "options": position, "width": 1},
        "sampledash/SampleDash#1": {"dashboard_id": "new-sampledash/SampleDash", "visualization_id": None, "text": "",
                         "options": position, "width": 1},
        "sampledash/SampleDash#2": {"dashboard_id": "new-sampledash/SampleDash", "visualization_id": f"new-{h}#4", "text": "",
                         "options": "", "width": 1},
        "sampledash/SampleDash#3": {"dashboard_id": "new-sampledash/SampleDash", "visualization_id": None, "text": "only text",
                         "options": position, "width": 2}}
    placed = answer(fourth, spark)

    write_outbox(build_outbox(first, second, third, fourth), str(tmp_path / "outbox"))
    assert spark.read.parquet(str(tmp_path / "outbox")).groupBy("step").count().count() == 4
    everything = made.union(drawn).union(shown).union(placed)
    everything.write.json(str(tmp_path / "responses"))
    responses = read_responses(spark, str(tmp_path / "responses"))
    said = {}
    for r in sorted(upload.status(responses).collect(), key=lambda r: (r["step"], r["pos"], r["message"])):
        said.setdefault(r["source_key"], []).append(r["message"])
    counts = {r["step"]: (r["succeeded"], r["failed"]) for r in upload.counts(responses).collect()}
    assert counts == {1: (3, 1), 2: (4, 1), 3: (2, 1), 4: (4, 0)}
    assert said[bare] == [f"created query bare as new-{bare}", "no chart in query bare"]
    assert said[bad] == ["failed query bad: refused"]
    assert said[h][0] == f"created query SampleQuery as new-{h}"
    assert said[h][4] == "failed chart of SampleQuery: refused" and len(said[h]) == 6
    assert said["empty/Empty"] == ["created dashboard Empty as new-empty/Empty"]
    assert len(said["sampledash/SampleDash"]) == 5
    assert said[same] == [f"created query same as new-{same}", "no chart in query same"]
    noted = catalog_with_messages(spark, config, "query", upload.status(responses))
    commit_version(noted, config, "query")
    messages = {r["query_name"]: r["upload_message"] for r in read_catalog(spark, config, "query").collect()}
    assert messages["bad"] == "failed query bad: refused" and messages["SampleQuery"].count("\n") == 5



def test_only_objects_of_the_kind_are_removed(spark, config):
    inventory = spark.createDataFrame(
        [("query", "1", "a", ["moved"]), ("query", "2", "a", []), ("query", "3", "b", ["other"]),
         ("dashboard", "1", "a", []), ("dashboard", "9", "b", ["moved"]), ("folder", "7", "a", ["moved"])],
        "kind string, id string, name string, tags array<string>")
    gone = remove_requests(inventory, "query", config)
    assert sorted((r["step"], r["path"]) for r in gone.collect()) == [(5, "queries/1"), (5, "queries/2")]
    gone = remove_requests(inventory, "dashboard", config, names=["b"])
    assert [(r["step"], r["method"], r["path"], r["body"]) for r in gone.collect()] == [(6, "DELETE", "dashboards/9", None)]
    both = build_delete_outbox(expand_by_name(inventory, chosen_for_delete(["moved"])))
    assert sorted(r["path"] for r in both.collect()) == ["dashboards/9", "queries/1", "queries/2"]


def test_messages_of_deletions(spark, config):
    selected = spark.createDataFrame(
        [("query", "1", "a"), ("query", "2", None), ("dashboard", "1", "d"), ("query", "5", "unanswered")],
        "kind string, id string, name string")
    responses = spark.createDataFrame(
        [(5, "1", 200, None, None), (5, "2", 404, None, "gone"), (6, "1", 500, None, None), (6, "1", 200, None, None),
         (1, "5", 200, "n", None)], RESPONSES)
    said = {(r["step"], r["source_key"]): r["message"] for r in delete_messages(selected, responses).collect()}
    assert said == {(5, "1"): "deleted query a (1)", (5, "2"): "failed to delete query  (2): gone", (6, "1"): "deleted dashboard d (1)"}


def test_upload_of_an_export(spark, tmp_path):
    put(tmp_path / "q.json", {"1": query(), "2": query(name="other", query_hash="h2")})
    put(tmp_path / "d.json", {"sampledash": dashboard()})
    queries = filter_names(export_assets(spark, str(tmp_path / "q.json"), "query"), "subset", ["other"])
    dashboards = export_assets(spark, str(tmp_path / "d.json"), "dashboard")
    upload = Upload(queries, dashboards, "ds", "moved")
    assert [r["source_key"] for r in upload.query_requests().collect()] == ["h2/other"]
    made = answer(upload.query_requests(), spark)
    assert upload.chart_requests(made).count() == 5
    assert [r["source_key"] for r in upload.dashboard_requests().collect()] == ["sampledash/SampleDash"]


def test_messages_stay_rows(spark):
    rows = spark.range(2500).select(
        F.lit("k").alias("parent_key"), F.lit(2).alias("step"), F.col("id").cast("int").alias("pos"),
        F.concat(F.lit("m"), F.col("id")).alias("message"))
    got = collect_status(rows.union(rows))
    assert got.count() == 2500 and got.columns == ["source_key", "step", "pos", "message"]


def test_what_is_rejected_is_written(spark, config, texts, tmp_path):
    rows = texts([dumps(query(name="a")), '{"cut', dumps(query(query_hash=None))])
    rejected = land(rows, f"{config.landing}/queries", "query")
    assert {r["reason"] for r in spark.read.parquet(rejected).collect()} == {"not one JSON object", "no query_hash"}
    assert read_json_lines(spark, f"{config.landing}/queries").count() == 1
    put(tmp_path / "raw" / "a.json", {"1": query()})
    put(tmp_path / "raw" / "b.json", '{"2": {"name"')
    left = clean_export(spark, str(tmp_path / "raw"), str(tmp_path / "clean"), MAPPINGS)
    assert [tuple(r) for r in left.collect()] == [(None, '{"2": {"name"')]


def test_cut_responses_are_rejected(spark, tmp_path):
    put(tmp_path / "r" / "1.json", '{"step": 1, "source_key": "a", "status": 200, "new_id": "9"}\n{"step": 1, "sour\n{"status": 200}\n')
    lines = read_json_lines(spark, str(tmp_path / "r"))
    assert [r["source_key"] for r in read_responses(spark, str(tmp_path / "r")).collect()] == ["a"]
    assert {r["reason"] for r in rejected_responses(lines).collect()} == {"not one JSON object", "no step or source key"}


def test_the_later_answer_counts(spark):
    schema = "step int, source_key string, status int, new_id string, message string, landed_at timestamp"
    rows = [(1, "a", 200, "9", None, datetime(2024, 1, 1)), (1, "a", 200, "10", None, datetime(2024, 1, 2)),
            (1, "b", 200, "9", None, None), (1, "b", 200, "10", None, None), (1, "a", 400, "99", None, datetime(2024, 1, 3))]
    assert {tuple(r) for r in new_ids(spark.createDataFrame(rows, schema)).collect()} == {("a", "10"), ("b", "10")}


def test_the_latest_state_is_that_of_the_latest_time(spark, config, tmp_path):
    times = {"late": "2021-01-01T12:00:05.900Z", "early": "2021-01-01T12:00:05Z", "offset": "2021-01-01T15:00:00+05:00"}
    put(tmp_path / "landed" / "queries" / "1.json", lines(*[query(query=q, updated_at=t) for q, t in times.items()]))
    import_assets(spark, config, "query")
    assert json.loads(read_catalog(spark, config, "query").first()["query_object"])["query"] == "late"


def test_a_key_given_twice_keeps_its_last_value(spark, config, tmp_path):
    twice = dumps(query(query="x"))[:-1] + ', "query": "y"}'
    put(tmp_path / "landed" / "queries" / "1.json", lines(twice))
    import_assets(spark, config, "query")
    assert json.loads(read_catalog(spark, config, "query").first()["query_object"])["query"] == "y"


def test_a_concurrent_import_is_not_dropped(spark, config, tmp_path):
    built_on = current_version(spark, config, "query")
    put(tmp_path / "landed" / "queries" / "1.json", lines(query()))
    import_assets(spark, config, "query")
    with pytest.raises(ConfigError):
        commit_version(read_catalog(spark, config, "query").where("false"), config, "query", built_on)
    assert read_catalog(spark, config, "query").count() == 1


def test_names_are_chosen_by_kind(spark, config, tmp_path):
    put(tmp_path / "landed" / "queries" / "1.json", lines(query(name="a"), query(name="b")))
    put(tmp_path / "landed" / "dashboards" / "1.json", lines(dashboard(slug="a", name="a"), dashboard(slug="d", name="d")))
    for kind in ("query", "dashboard"):
        import_assets(spark, config, kind)
    upload = Upload.from_catalog(spark, config, "ds", "Query Name", query_names=["a"], dashboard_names=["d"])
    assert [r["name"] for r in upload.queries.collect()] == ["a"]
    assert [r["name"] for r in upload.dashboards.collect()] == ["d"]


def test_run_report(spark, texts):
    rows = texts([dumps(query(tags=["t"])), dumps(query(tags=["t"], updated_at=None)), dumps(query(tags=["u"], updated_at=None)), "[]"])
    got = {r["outcome"]: r["n"] for r in run_report(rows, "query", Choice(["t"], "2021-01-01")).collect()}
    assert got == {"imported": 1, "no readable updated_at": 1, "not chosen": 1, "not one JSON object": 1}


def test_stream_takes_in_what_is_new(spark, config, tmp_path):
    put(tmp_path / "landed" / "queries" / "1.json", lines(query(name="a"), query(name="b")))
    for _ in range(2):
        run = import_new(spark, config, "query", str(tmp_path / "progress"), mappings=MAPPINGS)
        run.awaitTermination()
    assert read_catalog(spark, config, "query").count() == 2
    put(tmp_path / "landed" / "queries" / "2.json", lines(query(name="b", query="strpos"), query(name="c")))
    import_new(spark, config, "query", str(tmp_path / "progress"), mappings=MAPPINGS).awaitTermination()
    rows = {r["query_name"]: json.loads(r["query_object"])["query"] for r in read_catalog(spark, config, "query").collect()}
    assert sorted(rows) == ["a", "b", "c"] and rows["b"] == "instr"


def test_stream_of_a_fresh_session_takes_keys_given_twice(spark, config, tmp_path):
    """The batches of a stream run in a session of their own, whose settings are those the readers give it."""
    fresh = spark.newSession()
    assert fresh.conf.get("spark.sql.variant.allowDuplicateKeys") == "false"
    twice = dumps(query(name="b", query="x"))[:-1] + ', "query": "y", "options": {"a": 1, "a": 2}}'
    put(tmp_path / "landed" / "queries" / "1.json", lines(query(name="a"), twice))
    import_new(fresh, config, "query", str(tmp_path / "progress")).awaitTermination()
    rows = {r["query_name"]: json.loads(r["query_object"]) for r in read_catalog(spark, config, "query").collect()}
    assert sorted(rows) == ["a", "b"] and rows["b"]["query"] == "y" and rows["b"]["options"] == {"a": 2}


def test_import_into_a_table_in_parts(spark, config, tmp_path):
    parts = dataclasses.replace(config, database=config.database + "_p", catalog_root=config.catalog_root + "_p", catalog_parts=4, catalog_buckets=2)
    ensure_catalog(spark, parts)
    put(tmp_path / "landed" / "queries" / "1.json", lines(query(name="a"), query(name="b"), '{"cut'))
    _, rejected = import_assets(spark, parts, "query", mappings=MAPPINGS)
    put(tmp_path / "landed" / "queries" / "2.json", lines(query(name="b", query="strpos", updated_at="2030-01-01T00:00:00Z"), query(name="c")))
    import_assets(spark, parts, "query", mappings=MAPPINGS)
    rows = {r["query_name"]: json.loads(r["query_object"])["query"] for r in read_catalog(spark, parts, "query").collect()}
    assert sorted(rows) == ["a", "b", "c"] and rows["b"] == "instr"
    assert spark.read.parquet(rejected).count() == 1


def test_costly_rows_are_dealt_over_all_cores(spark, tmp_path):
    """Adaptive execution joins small parts again unless their number is given."""
    derived.spread_table(spark, "/root/testdata/sf0.001", "orders", "o_orderkey").write.parquet(str(tmp_path / "out"))
    assert len(list((tmp_path / "out").glob("*.parquet"))) == 4
