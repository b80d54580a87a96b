"""Request bodies, the outbox and the messages drawn from responses."""

from __future__ import annotations

from pyspark.sql import functions as F

from asset_catalog.config import Config
from asset_catalog.functions.json_fields import text_fields
from asset_catalog.operators import outbox, payloads, relate
from asset_catalog.operators.assets import read_assets
from asset_catalog.operators.catalog import project_catalog
from asset_catalog.operators.select import chosen_for_delete, expand_by_name
from asset_catalog.plans import derived
from asset_catalog.plans.lifecycles import Upload, removed_objects
from asset_catalog.plans.registered.rewriting import OLD_QUERY
from asset_catalog.plans.registered.scans import AS_OF, own_catalog
from asset_catalog.schemas import KINDS
from asset_catalog.sources.scratch import written_once
from asset_catalog.sources.tables import upsert_catalog

MARKER = "migrated"


def _queries(spark, sf_dir):
    return read_assets(derived.queries(spark, sf_dir), "query")


def _dashboards(spark, sf_dir):
    return read_assets(derived.dashboards(spark, sf_dir), "dashboard")


def _body_fields(rows, *names: str):
    """The other columns of rows and some fields of their ``body`` as texts."""
    others = [c for c in rows.columns if c != "body"]
    return rows.select(*others, text_fields(F.col("body"), *names).alias("f")).select(*others, "f.*")


def payload_query(spark, sf_dir):
    body = payloads.query_payload(F.col("parsed"), F.lit("ds1"), MARKER)
    rows = _body_fields(
        _queries(spark, sf_dir).select("asset_key", body.alias("body")),
        *["data_source_id", "query", "name", "description", "schedule", "options", "tags"],
        "visualizations",
    )
    first = F.get_json_object("visualizations", "$[0].id")
    return rows.withColumn("first_chart", first).drop("visualizations")


def payload_visualization(spark, sf_dir):
    charts = relate.explode_visualizations(_queries(spark, sf_dir)).where("visualization IS NOT NULL")
    body = payloads.visualization_payload(
        F.col("visualization"), F.concat(F.lit("n"), F.col("asset_key"))
    )
    rows = charts.select("old_viz_id", body.alias("body"))
    return _body_fields(rows, "name", "type", "description", "options", "query_id")


def payload_dashboard(spark, sf_dir):
    body = payloads.dashboard_payload(F.col("parsed"), MARKER)
    rows = _body_fields(
        _dashboards(spark, sf_dir).select("asset_key", body.alias("body")),
        *["name", "layout", "dashboard_filters_enabled", "is_trashed", "is_draft", "tags", "widgets"],
    )
    return rows.withColumn("widgets", F.size(F.from_json("widgets", "array<string>")))


def payload_widget(spark, sf_dir):
    widgets = relate.explode_widgets(_dashboards(spark, sf_dir)).where("widget IS NOT NULL")
    body = payloads.widget_payload(F.col("widget"), F.col("asset_key"), F.col("old_viz_id"))
    rows = widgets.select(F.col("pos").cast("int").alias("pos"), body.alias("body"))
    return _body_fields(rows, "dashboard_id", "visualization_id", "text", "options", "width")


def outbox_create(spark, sf_dir):
    """All four steps, each with the answers to the step before."""
    queries, charts = outbox.requests_and_children(
        outbox.query_requests(_queries(spark, sf_dir), F.lit("ds1"), MARKER, keep=["parsed"]),
        relate.explode_visualizations,
        "charts",
    )
    dashboards, widgets = outbox.requests_and_children(
        outbox.dashboard_requests(_dashboards(spark, sf_dir), MARKER, keep=["parsed"]), relate.explode_widgets, "widgets"
    )
    sent = charts.where("visualization IS NOT NULL").withColumn("source_key", outbox.child_key())
    id_map = relate.build_id_map(
        sent.select("source_key", "old_viz_id", "parent_key", "pos"),
        derived.chart_responses(spark, sf_dir),
    )
    requests = outbox.build_outbox(
        queries,
        outbox.visualization_requests(charts, derived.query_responses(spark, sf_dir)),
        dashboards,
        outbox.widget_requests(widgets, derived.dashboard_responses(spark, sf_dir), id_map),
    )
    return _body_fields(requests, "name", "query_id", "dashboard_id", "visualization_id")


def outbox_delete(spark, sf_dir):
    """From an inventory of both kinds, which share ids and names."""
    chosen = chosen_for_delete(["1-URGENT", "BUILDING"], ["q_7"])
    selected = expand_by_name(derived.whole_inventory(spark, sf_dir), chosen)
    return outbox.build_delete_outbox(selected).select("step", "method", "path", "source_key")


def delete_messages(spark, sf_dir):
    inventory = derived.whole_inventory(spark, sf_dir)
    config = Config(landing="-", catalog_root="-")
    gone = [removed_objects(inventory, kind, config, tags=["1-URGENT", "BUILDING"]) for kind in KINDS]
    return outbox.delete_messages(gone[0].unionByName(gone[1]), derived.delete_responses(spark, sf_dir))


def rejected_responses(spark, sf_dir):
    """Lines cut short, and lines that do not say what they answer."""
    answers = derived.query_responses(spark, sf_dir).withColumn("raw", F.to_json(F.struct("step", "source_key", "status", "message")))
    failed = F.col("status") == 400
    spoilt = F.when(failed, F.to_json(F.struct("step", "status", "message"))).otherwise(F.substring("raw", 1, 30))
    return outbox.rejected_responses(answers.select(spoilt.alias("raw")))


def upload_by_names(spark, sf_dir):
    """Queries and dashboards from the catalog, each by names of their own."""
    config = own_catalog(spark)
    for kind, rows in (("query", _queries(spark, sf_dir)), ("dashboard", _dashboards(spark, sf_dir))):
        found = project_catalog(rows, kind, F.lit(AS_OF)).dropDuplicates(KINDS[kind].merge_keys)
        upsert_catalog(written_once(found, "pulled"), config, kind)
    names = {"query_names": ["q_7", "q_70"], "dashboard_names": ["Customer#000000005", "Customer#000000011"]}
    upload = Upload.from_catalog(spark, config, "ds1", "Query Name", **names)
    return upload.query_requests().unionByName(upload.dashboard_requests()).select("step", "path", "source_key")


def status_messages(spark, sf_dir):
    """Charts name their queries, and a query without charts has a row as well."""
    charts = relate.explode_visualizations(_queries(spark, sf_dir)).select("parent_key", "name", "pos")
    charts = written_once(charts, "chart-places")
    created, drawn = derived.query_responses(spark, sf_dir), derived.chart_responses(spark, sf_dir)
    said = outbox.push_messages(charts, created, 1).unionByName(
        outbox.child_messages(charts.where("pos IS NOT NULL"), drawn, 2)
    )
    said = said.unionByName(outbox.no_chart_messages(charts))
    return outbox.collect_status(said)


QUERIES = {
    "payload_query": payload_query,
    "payload_visualization": payload_visualization,
    "payload_dashboard": payload_dashboard,
    "payload_widget": payload_widget,
    "outbox_create": outbox_create,
    "outbox_delete": outbox_delete,
    "status_messages": status_messages,
    "delete_messages": delete_messages,
    "rejected_responses": rejected_responses,
    "upload_by_names": upload_by_names,
}

_CHART = "FROM orders, range(1, 5) r(i) WHERE o_orderpriority <> '5-LOW' AND i <= left(o_orderpriority, 1)::INTEGER"
_WIDGET = "FROM customer, range(1, 5) r(j) WHERE c_nationkey <> 24 AND j <= c_nationkey % 5"

ORACLES = {
    "payload_query": f"""
        SELECT md5(o_orderkey::VARCHAR) AS asset_key, 'ds1' AS data_source_id, {OLD_QUERY} AS query,
               'q_' || o_custkey AS name,
               CASE WHEN o_orderstatus = 'P' THEN 'note ' || o_orderpriority ELSE '' END AS description,
               CASE o_orderstatus WHEN 'F' THEN '{{"interval":3600}}' END AS schedule,
               '{{"parameters":[]}}' AS options,
               '["{MARKER}"' || CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN ''
                   ELSE ',"' || o_orderpriority || '","s_' || o_orderstatus || '"' END || ']' AS tags,
               CASE WHEN o_orderpriority <> '5-LOW' THEN (o_orderkey * 10 + 1)::VARCHAR END
                   AS first_chart
        FROM orders""",
    "payload_visualization": f"""
        SELECT (o_orderkey * 10 + i)::VARCHAR AS old_viz_id, 'v' || i AS name,
               CASE WHEN i = 1 THEN 'TABLE' ELSE 'COUNTER' END AS type, '' AS description,
               '{{"counterColName":"total","rowNumber":' || i || '}}' AS options,
               'n' || md5(o_orderkey::VARCHAR) AS query_id
        {_CHART}""",
    "payload_dashboard": f"""
        SELECT 'c_' || c_custkey AS asset_key, c_name AS name, '[]' AS layout,
               'true' AS dashboard_filters_enabled, NULL::VARCHAR AS is_trashed, 'false' AS is_draft,
               '["{MARKER}","' || c_mktsegment || '"]' AS tags,
               CASE WHEN c_nationkey = 24 THEN 0 ELSE c_nationkey % 5 END::INTEGER AS widgets
        FROM customer""",
    "payload_widget": f"""
        SELECT (j - 1)::INTEGER AS pos, 'c_' || c_custkey AS dashboard_id,
               CASE WHEN j <> 3 THEN (c_custkey * 10 + j)::VARCHAR END AS visualization_id,
               CASE j WHEN 3 THEN 'note' ELSE '' END AS text,
               CASE j WHEN 4 THEN ''
                      ELSE '{{"isHidden":false,"position":{{"col":' || j || '}}}}' END AS options,
               CASE WHEN j <= 2 THEN 1 ELSE j END::VARCHAR AS width
        {_WIDGET}""",
    # The chart of widget j of a customer has the id of chart j of the order of that number.
    "outbox_create": f"""
        SELECT 1::INTEGER AS step, 'POST' AS method, 'queries' AS path,
               md5(o_orderkey::VARCHAR) || '/q_' || o_custkey AS source_key, 'q_' || o_custkey AS name,
               NULL::VARCHAR AS query_id, NULL::VARCHAR AS dashboard_id,
               NULL::VARCHAR AS visualization_id
        FROM orders
        UNION ALL
        SELECT 2, 'POST', 'visualizations',
               md5(o_orderkey::VARCHAR) || '/q_' || o_custkey || '#' || (i - 1), 'v' || i,
               'n' || o_orderkey, NULL, NULL
        {_CHART} AND o_orderstatus <> 'P'
        UNION ALL
        SELECT 3, 'POST', 'dashboards', 'c_' || c_custkey || '/' || c_name, c_name, NULL, NULL, NULL
        FROM customer
        UNION ALL
        SELECT 4, 'POST', 'widgets', 'c_' || c_custkey || '/' || c_name || '#' || (j - 1), NULL, NULL,
               'd' || c_custkey,
               CASE WHEN j <> 3 THEN
                   (SELECT max('c-' || o_orderkey || '-' || j) FROM orders
                    WHERE o_orderkey = c_custkey AND o_orderpriority <> '5-LOW'
                      AND j <= left(o_orderpriority, 1)::INTEGER AND o_orderstatus <> 'P'
                      AND NOT (o_orderstatus = 'O' AND j = 2)) END
        {_WIDGET} AND c_mktsegment <> 'MACHINERY'""",
    "outbox_delete": """
        SELECT 5::INTEGER AS step, 'DELETE' AS method, 'queries/' || o_orderkey AS path,
               o_orderkey::VARCHAR AS source_key
        FROM orders
        WHERE o_custkey IN (SELECT o_custkey FROM orders
                            WHERE o_orderpriority = '1-URGENT' OR o_custkey = 7)
        UNION ALL
        SELECT 6, 'DELETE', 'dashboards/' || c_custkey, c_custkey::VARCHAR
        FROM customer
        WHERE c_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING' OR c_custkey = 7)""",
    "delete_messages": """
        SELECT DISTINCT o_orderkey::VARCHAR AS source_key, 5::INTEGER AS step, 0::INTEGER AS pos,
               CASE WHEN o_orderstatus = 'P' THEN 'failed to delete query q_' || o_custkey || ' (' || o_orderkey || '): in use'
                    ELSE 'deleted query q_' || o_custkey || ' (' || o_orderkey || ')' END AS message
        FROM orders WHERE o_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
        UNION ALL
        SELECT DISTINCT c_custkey::VARCHAR, 6, 0, 'deleted dashboard q_' || c_custkey || ' (' || c_custkey || ')'
        FROM customer WHERE c_mktsegment = 'BUILDING'""",
    "rejected_responses": """
        SELECT CASE WHEN o_orderstatus = 'P' THEN '{"step":1,"status":400,"message":"quota"}'
                    ELSE left('{"step":1,"source_key":"' || md5(o_orderkey::VARCHAR), 30) END AS raw,
               CASE WHEN o_orderstatus = 'P' THEN 'no step or source key' ELSE 'not one JSON object' END AS reason
        FROM orders""",
    "upload_by_names": """
        SELECT DISTINCT 1::INTEGER AS step, 'queries' AS path, md5(o_orderkey::VARCHAR) || '/q_' || o_custkey AS source_key
        FROM orders WHERE o_custkey IN (7, 70)
        UNION ALL
        SELECT DISTINCT 3, 'dashboards', 'c_' || c_custkey || '/' || c_name
        FROM customer WHERE c_name IN ('Customer#000000005', 'Customer#000000011')""",
    "status_messages": """
        WITH said AS (
            SELECT o_orderkey, o_custkey, 1 AS step, 0 AS pos,
                   CASE WHEN o_orderstatus = 'P' THEN 'failed query q_' || o_custkey || ': quota'
                        ELSE 'created query q_' || o_custkey || ' as n' || o_orderkey END AS message
            FROM orders
            UNION ALL
            SELECT o_orderkey, o_custkey, 2, i - 1,
                   CASE WHEN o_orderstatus = 'O' AND i = 2
                        THEN 'failed chart of q_' || o_custkey || ': busy'
                        ELSE 'created chart of q_' || o_custkey || ' as c-' || o_orderkey || '-' || i END
            FROM orders, range(1, 5) r(i)
            WHERE o_orderpriority <> '5-LOW' AND i <= left(o_orderpriority, 1)::INTEGER
              AND o_orderstatus <> 'P'
            UNION ALL
            SELECT o_orderkey, o_custkey, 2, 0, 'no chart in query q_' || o_custkey
            FROM orders WHERE o_orderpriority = '5-LOW')
        SELECT DISTINCT md5(o_orderkey::VARCHAR) || '/q_' || o_custkey AS source_key,
               step::INTEGER AS step, pos::INTEGER AS pos, message
        FROM said""",
}
