"""Charts and widgets, and the ids that tie them to created parents and charts."""

from __future__ import annotations

from pyspark.sql import functions as F

from asset_catalog.operators import relate
from asset_catalog.operators.assets import read_assets
from asset_catalog.plans import derived
from asset_catalog.plans.derived import text
from asset_catalog.plans.registered.scans import _endpoint_documents
from asset_catalog.sources.landed import endpoint_rows


def explode_visualizations(spark, sf_dir):
    charts = relate.explode_visualizations(read_assets(derived.queries(spark, sf_dir), "query"))
    return charts.select(
        "asset_key",
        text("pos").alias("pos"),
        "old_viz_id",
        F.try_variant_get("visualization", "$.type", "string").alias("type"),
        F.to_json(F.try_variant_get("visualization", "$.options", "variant")).alias("options"),
    )


def explode_widgets(spark, sf_dir):
    widgets = relate.explode_widgets(read_assets(derived.dashboards(spark, sf_dir), "dashboard"))
    return widgets.select(
        "asset_key",
        text("pos").alias("pos"),
        F.try_variant_get("widget", "$.id", "string").alias("widget_id"),
        "old_viz_id",
    )


def _line_key():
    day = F.date_format("l_shipdate", "yyyy-MM-dd")
    return F.md5(F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", day))


def remap_ids(spark, sf_dir):
    """A widget per line item that shows the chart of its part; returned ones show none."""
    chart = F.concat(F.lit("p"), text("l_partkey"))
    widgets = derived.spread_table(spark, sf_dir, "lineitem", "l_orderkey").select(
        _line_key().alias("widget"),
        F.when(F.col("l_returnflag") != "R", chart).alias("old_viz_id"),
    )
    id_map = derived.table(spark, sf_dir, "part").where("p_size > 10").select(
        F.concat(F.lit("p"), text("p_partkey")).alias("old_viz_id"),
        F.concat(F.lit("new-"), text("p_partkey")).alias("new_viz_id"),
    )
    return relate.remap_visualization_ids(widgets, id_map)


def attach_parent_id(spark, sf_dir):
    """A chart per line item; its query is the one of the order, known by its hash only."""
    charts = derived.spread_table(spark, sf_dir, "lineitem", "l_orderkey").select(
        F.md5(text("l_orderkey")).alias("parent_key"), _line_key().alias("chart")
    )
    responses = derived.query_responses(spark, sf_dir)
    by_hash = responses.withColumn("source_key", F.substring_index("source_key", "/", 1))
    return relate.attach_parent_id(charts, by_hash)


def build_id_map(spark, sf_dir):
    """Charts named by part, so an old id is sent many times and the last answer counts. All
    requests were sent twice; the ids given out first are greater as texts."""
    lines = derived.spread_table(spark, sf_dir, "lineitem", "l_orderkey")
    charts = lines.select(
        _line_key().alias("source_key"),
        F.concat(F.lit("p"), text("l_partkey")).alias("old_viz_id"),
        F.lpad(text("l_orderkey"), 12, "0").alias("parent_key"),
        F.col("l_linenumber").alias("pos"),
    )
    responses = lines.select(
        _line_key().alias("source_key"),
        F.when(F.col("l_returnflag") == "R", 400).otherwise(200).alias("status"),
        F.concat(F.lit("c"), _line_key()).alias("new_id"),
        F.lit("2024-01-02 00:00:00").cast("timestamp").alias("landed_at"),
    )
    first = responses.withColumn("new_id", F.concat(F.lit("z"), "new_id")).withColumn(
        "landed_at", F.lit("2024-01-01 00:00:00").cast("timestamp")
    )
    responses = responses.unionByName(first)
    return relate.build_id_map(charts, responses)


def resolve_endpoint(spark, sf_dir):
    return relate.resolve_endpoint(endpoint_rows(_endpoint_documents(spark, sf_dir)), "NATION_15")


def response_status(spark, sf_dir):
    rows = relate.split_by_status(derived.query_responses(spark, sf_dir))
    return rows.select("source_key", "status", "outcome")


QUERIES = {
    "explode_visualizations": explode_visualizations,
    "explode_widgets": explode_widgets,
    "remap_ids": remap_ids,
    "attach_parent_id": attach_parent_id,
    "build_id_map": build_id_map,
    "resolve_endpoint": resolve_endpoint,
    "response_status": response_status,
}

_LINE = """md5(l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-'
               || strftime(l_shipdate, '%Y-%m-%d'))"""

ORACLES = {
    "explode_visualizations": """
        SELECT md5(o_orderkey::VARCHAR) AS asset_key, (i - 1)::VARCHAR AS pos,
               (o_orderkey * 10 + i)::VARCHAR AS old_viz_id,
               CASE WHEN i = 1 THEN 'TABLE' ELSE 'COUNTER' END AS type,
               '{"counterColName":"total","rowNumber":' || i || '}' AS options
        FROM orders, range(1, 5) r(i)
        WHERE o_orderpriority <> '5-LOW' AND i <= left(o_orderpriority, 1)::INTEGER
        UNION ALL
        SELECT md5(o_orderkey::VARCHAR), NULL, NULL, NULL, NULL
        FROM orders WHERE o_orderpriority = '5-LOW'""",
    "explode_widgets": """
        SELECT 'c_' || c_custkey AS asset_key, (j - 1)::VARCHAR AS pos,
               (c_custkey * 100 + j)::VARCHAR AS widget_id,
               CASE WHEN j <> 3 THEN (c_custkey * 10 + j)::VARCHAR END AS old_viz_id
        FROM customer, range(1, 5) r(j)
        WHERE c_nationkey <> 24 AND j <= c_nationkey % 5
        UNION ALL
        SELECT 'c_' || c_custkey, NULL, NULL, NULL
        FROM customer WHERE c_nationkey = 24 OR c_nationkey % 5 = 0""",
    "remap_ids": f"""
        SELECT {_LINE} AS widget, CASE WHEN l_returnflag <> 'R' THEN 'p' || l_partkey END AS old_viz_id,
               CASE WHEN l_returnflag <> 'R' AND p_size > 10 THEN 'new-' || p_partkey END AS new_viz_id
        FROM lineitem LEFT JOIN (SELECT DISTINCT p_partkey, 11 AS p_size FROM part WHERE p_size > 10)
             ON p_partkey = l_partkey""",
    "attach_parent_id": f"""
        SELECT md5(l_orderkey::VARCHAR) AS parent_key, {_LINE} AS chart, 'n' || l_orderkey AS parent_id
        FROM lineitem SEMI JOIN orders ON o_orderkey = l_orderkey AND o_orderstatus <> 'P'""",
    "build_id_map": f"""
        SELECT 'p' || l_partkey AS old_viz_id, 'c' || {_LINE} AS new_viz_id
        FROM lineitem WHERE l_returnflag <> 'R'
        QUALIFY row_number() OVER (PARTITION BY l_partkey
            ORDER BY l_orderkey DESC, l_linenumber DESC, {_LINE} DESC) = 1""",
    "resolve_endpoint": """
        SELECT 'ep' || s_suppkey AS endpoint_id, 'ds' || s_suppkey AS data_source_id
        FROM supplier WHERE s_nationkey = 15 ORDER BY 'ds' || s_suppkey LIMIT 1""",
    "response_status": """
        SELECT md5(o_orderkey::VARCHAR) || '/q_' || o_custkey AS source_key,
               CASE WHEN o_orderstatus = 'P' THEN 400 ELSE 200 END::INTEGER AS status,
               CASE WHEN o_orderstatus = 'P' THEN 'fail' ELSE 'ok' END AS outcome
        FROM orders""",
}
