"""Readers and export writers. The texts that files would hold are derived from tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from asset_catalog.config import Config
from asset_catalog.operators.assets import latest_per_key, quarantine, read_assets
from asset_catalog.operators.catalog import project_catalog, stage
from asset_catalog.operators.relate import enrich_with_detail
from asset_catalog.plans import derived
from asset_catalog.plans.derived import text
from asset_catalog.plans.lifecycles import Choice, land, run_report
from asset_catalog.schemas import DASHBOARD
from asset_catalog.sources.exports import (
    asset_file_key,
    compact_landing,
    read_asset,
    write_asset_files,
    write_entry_lines,
    write_keyed_json,
)
from asset_catalog.sources.landed import (
    endpoint_rows,
    inventory_rows,
    keyed_rows,
    listing_rows,
    mapping_rows,
    read_entry_lines,
    read_json_lines,
    read_keyed_json,
    rejected_listing,
)
from asset_catalog.sources.scratch import scratch_path, written_once
from asset_catalog.sources.tables import ensure_catalog, read_catalog, upsert_catalog

AS_OF = "2024-01-01 00:00:00"


def _pages(spark, sf_dir, *more):
    """Listing pages of two queries each, one page per order; ``more`` fields end each object."""

    def item(n):
        return F.struct(
            (F.col("o_orderkey") * 2 + n).alias("id"),
            F.concat(F.lit("q_"), text("o_custkey")).alias("name"),
            F.array("o_orderpriority").alias("tags"),
            *more,
        )

    page = F.struct(F.lit(2).alias("count"), F.array(item(0), item(1)).alias("results"))
    return derived.spread_table(spark, sf_dir, "orders", "o_orderkey").select(F.to_json(page).alias("value"))


def scan_listing(spark, sf_dir):
    rows = listing_rows(_pages(spark, sf_dir), "query")
    return rows.select("object_key", F.get_json_object("raw", "$.name").alias("name"))


def enrich_detail(spark, sf_dir):
    orders = derived.table(spark, sf_dir, "orders")
    listing = orders.select(
        text("o_orderkey").alias("object_key"), F.to_json(F.struct("o_custkey")).alias("raw")
    )
    time = F.when(F.col("o_orderstatus") == "F", "2020-01-01T23:00:01Z").otherwise(F.lit("2020-01-02T05:00:01+05:00"))
    full = F.to_json(F.struct("o_custkey", "o_orderpriority", time.alias("updated_at")))
    detail = orders.where("o_orderstatus != 'P'")
    stale = detail.select(
        text("o_orderkey").alias("object_key"),
        F.to_json(F.struct(F.lit("2020-01-01T23:00:00.5Z").alias("updated_at"), F.lit("z").alias("o_orderpriority"))).alias("raw"),
    )
    detail = detail.select(text("o_orderkey").alias("object_key"), full.alias("raw")).unionByName(stale)
    return enrich_with_detail(listing, detail, "object_key").select(
        "object_key",
        "has_detail",
        F.get_json_object("raw", "$.o_custkey").alias("custkey"),
        F.get_json_object("raw", "$.o_orderpriority").alias("priority"),
    )


def scan_keyed_json(spark, sf_dir):
    """Documents with a key given twice; customers come back in many documents."""

    def entry(n):
        order = F.concat(F.lit('": {"order": '), text("o_orderkey"), F.lit(f', "n": {n}}}'))
        return F.concat(F.lit('"'), text("o_custkey"), order)

    documents = derived.spread_table(spark, sf_dir, "orders", "o_orderkey").select(
        F.lpad(text("o_orderkey"), 12, "0").alias("source_file"),
        F.concat(F.lit("{"), entry(1), F.lit(", "), entry(2), F.lit("}")).alias("value"),
    )
    return keyed_rows(documents).select(
        "object_key",
        F.get_json_object("raw", "$.order").alias("last_order"),
        F.get_json_object("raw", "$.n").alias("n"),
    )


def scan_json_lines(spark, sf_dir):
    """Lines written to text files and read back."""
    path = scratch_path(spark, "landed-queries")
    derived.landed_queries(spark, sf_dir).select(F.col("raw").alias("value")).write.text(path)
    return read_assets(read_json_lines(spark, path), "query").select(
        "asset_key", "name", F.array_join("tags", "|").alias("tags"), "updated_at"
    )


def scan_quarantine(spark, sf_dir):
    rows = quarantine(derived.landed_queries(spark, sf_dir), "query")
    return rows.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def scan_mapping(spark, sf_dir):
    """One mapping document per customer."""
    pair = F.create_map("c_name", F.concat(F.lit("lake."), "c_mktsegment"))
    documents = derived.table(spark, sf_dir, "customer").select(
        F.lpad(text("c_custkey"), 12, "0").alias("source_file"), F.to_json(pair).alias("value")
    )
    return mapping_rows(documents)


def own_catalog(spark, **settings):
    """An empty catalog of its own for a query."""
    root = scratch_path(spark, "catalog")
    config = Config(landing=f"{root}/landed", catalog_root=root, database=f"own_{uuid.uuid4().hex}", **settings)
    ensure_catalog(spark, config)
    return config


def scan_rejected_documents(spark, sf_dir):
    """Pages cut short, and pages whose objects have no id."""
    value, status = F.col("value"), F.get_json_object("value", "$.results[0].status")
    pages = _pages(spark, sf_dir, F.col("o_orderstatus").alias("status"))
    spoilt = F.when(status == "F", F.substring(value, 1, 40)).when(status == "P", F.regexp_replace(value, '"id":[0-9]+,', ""))
    return rejected_listing(pages.select(F.coalesce(spoilt, value).alias("value")), "query")


def land_rejected(spark, sf_dir):
    """A listing is landed; what it could not read is beside the landed files."""
    path = f"{scratch_path(spark, 'listed')}/queries"
    rejected = land(derived.landed_queries(spark, sf_dir), path, "query")
    landed = read_json_lines(spark, path).select(F.lit("landed").alias("outcome"))
    rows = spark.read.parquet(rejected).select(F.col("reason").alias("outcome")).unionByName(landed)
    return rows.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


def report_of_run(spark, sf_dir):
    lines = derived.landed_queries(spark, sf_dir)
    return run_report(lines, "query", Choice(["1-URGENT", "s_P"], "1996-01-01"))


def scan_catalog(spark, sf_dir):
    """A catalog table is made, filled and read."""
    rows = project_catalog(read_assets(derived.dashboards(spark, sf_dir), "dashboard"), "dashboard", F.lit(AS_OF))
    config = own_catalog(spark)
    pulled = written_once(rows.dropDuplicates(DASHBOARD.merge_keys), "pulled-dashboards")
    upsert_catalog(stage(pulled, "staged_dashboards"), config, "dashboard")
    return read_catalog(spark, config, "dashboard").select(
        "dashboard_name",
        "dashboard_slug",
        F.array_join("tags", "|").alias("tags"),
        F.get_json_object("dashboard_object", "$.id").alias("object_id"),
        "update_date_time",
        "is_migrated",
    )


def _endpoint_documents(spark, sf_dir):
    item = F.struct(
        F.concat(F.lit("ds"), text("s_suppkey")).alias("id"),
        F.concat(F.lit("ep"), text("s_suppkey")).alias("endpoint_id"),
        F.concat(F.lit("NATION_"), text("s_nationkey")).alias("name"),
    )
    other = F.struct(F.lit("").alias("id"), F.lit("").alias("endpoint_id"), F.col("s_name").alias("name"))
    return derived.table(spark, sf_dir, "supplier").select(
        F.to_json(F.array(item, other)).alias("value")
    )


def scan_endpoints(spark, sf_dir):
    return endpoint_rows(_endpoint_documents(spark, sf_dir)).select("pos", "id", "endpoint_id", "name")


def scan_inventory(spark, sf_dir):
    rows = inventory_rows(_pages(spark, sf_dir), "query")
    return rows.select("kind", "id", "name", F.array_join("tags", "|").alias("tags"))


def export_keyed_json(spark, sf_dir):
    """Written as sixteen documents and read back."""
    path = scratch_path(spark, "documents")
    write_keyed_json(_export_entries(spark, sf_dir), path, 16)
    return _entry_fields(read_keyed_json(spark, path))


def compacted_landing(spark, sf_dir):
    """Three landings of states of customers' assets, compacted to the last of each."""
    path = scratch_path(spark, "landing")
    assets = read_assets(derived.dashboards(spark, sf_dir), "dashboard")
    for year in (2021, 2023, 2022):
        raw = F.regexp_replace("raw", r"\}\s*$", f', "updated_at": "{year}-01-01T00:00:00Z"}}')
        write_asset_files(assets.withColumns({"raw": raw, "updated_at": F.lit(f"{year}-01-01T00:00:00Z")}), path, 8)
    compact_landing(spark, path, "dashboard")
    return read_assets(read_json_lines(spark, path), "dashboard").select("asset_key", "name", "updated_at")


def one_asset(spark, sf_dir):
    """One landed asset, whose directory alone is read."""
    path = scratch_path(spark, "landing")
    write_asset_files(read_assets(derived.dashboards(spark, sf_dir), "dashboard"), path, 8)
    return read_asset(spark, path, "dashboard", "c_7", "Customer#000000007", 8).select("asset_key", "name")


def scan_large_document(spark, sf_dir):
    """One document with an entry for each order, read in pieces; notes hold what looks like JSON."""
    note = F.concat(F.lit('}{ "'), "o_orderpriority", F.lit('\\" ]['), text("o_custkey"))
    parts = F.array(F.struct("o_orderstatus"), F.struct(F.lit("x").alias("o_orderstatus")))
    entries = derived.spread_table(spark, sf_dir, "orders", "o_orderkey").select(
        text("o_orderkey").alias("object_key"), F.to_json(F.struct(note.alias("note"), parts.alias("parts"))).alias("raw")
    )
    path = scratch_path(spark, "document")
    write_keyed_json(entries, path, 1)
    return read_keyed_json(spark, path, larger_than=0).select(
        "object_key",
        F.get_json_object("raw", "$.note").alias("note"),
        F.get_json_object("raw", "$.parts[0].o_orderstatus").alias("status"),
    )


def export_entry_lines(spark, sf_dir):
    """Written as lines of one entry and read back."""
    path = scratch_path(spark, "entries")
    write_entry_lines(_export_entries(spark, sf_dir), path)
    return _entry_fields(read_entry_lines(spark, path))


def _export_entries(spark, sf_dir):
    assets = read_assets(derived.dashboards(spark, sf_dir), "dashboard")
    last = latest_per_key(assets.select("asset_key", "updated_at", "raw"), ["asset_key"], ["updated_at"])
    return last.select(F.col("asset_key").alias("object_key"), "raw")


def _entry_fields(back):
    return back.select(
        "object_key",
        F.get_json_object("raw", "$.name").alias("name"),
        F.get_json_object("raw", "$.widgets[0].id").alias("first_widget"),
    )


def export_asset_files(spark, sf_dir):
    """Many orders share a file key here; the latest state of each file is written and read back."""
    assets = read_assets(derived.queries(spark, sf_dir, hash_of="o_custkey"), "query")
    path = scratch_path(spark, "asset-files")
    write_asset_files(assets, path, 64)
    held = read_assets(read_json_lines(spark, path).select("raw"), "query")
    key = asset_file_key(F.col("asset_key"), F.col("name"))
    return held.select(key.alias("file_key"), "updated_at")


def file_key(spark, sf_dir):
    assets = read_assets(derived.dashboards(spark, sf_dir), "dashboard")
    return assets.select("asset_key", asset_file_key(F.col("asset_key"), F.col("name")).alias("file_key"))


QUERIES = {
    "scan_listing": scan_listing,
    "enrich_detail": enrich_detail,
    "scan_keyed_json": scan_keyed_json,
    "scan_json_lines": scan_json_lines,
    "scan_quarantine": scan_quarantine,
    "scan_mapping": scan_mapping,
    "scan_catalog": scan_catalog,
    "scan_endpoints": scan_endpoints,
    "scan_inventory": scan_inventory,
    "export_keyed_json": export_keyed_json,
    "compact_landing": compacted_landing,
    "read_asset": one_asset,
    "scan_large_document": scan_large_document,
    "export_entry_lines": export_entry_lines,
    "export_asset_files": export_asset_files,
    "scan_rejected_documents": scan_rejected_documents,
    "land_rejected": land_rejected,
    "run_report": report_of_run,
    "asset_file_key": file_key,
}

# A time as ISO text with milliseconds.
ISO = """(strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.')
    || lpad((date_part('millisecond', o_orderdate)::BIGINT % 1000)::VARCHAR, 3, '0') || 'Z')"""

ORACLES = {
    "scan_listing": """
        SELECT (o_orderkey * 2 + n)::VARCHAR AS object_key, 'q_' || o_custkey AS name
        FROM orders, (VALUES (0), (1)) v(n)""",
    "enrich_detail": """
        SELECT DISTINCT o_orderkey::VARCHAR AS object_key, o_orderstatus <> 'P' AS has_detail,
               o_custkey::VARCHAR AS custkey,
               CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS priority
        FROM orders""",
    "scan_keyed_json": """
        SELECT o_custkey::VARCHAR AS object_key, max(o_orderkey)::VARCHAR AS last_order, '2' AS n
        FROM orders GROUP BY o_custkey""",
    "scan_json_lines": f"""
        SELECT md5(o_orderkey::VARCHAR) AS asset_key, 'q_' || o_custkey AS name,
               CASE WHEN NOT (o_orderpriority = '5-LOW' AND o_orderstatus = 'P')
                    THEN o_orderpriority || '|s_' || o_orderstatus END AS tags,
               {ISO} AS updated_at
        FROM orders
        WHERE NOT (o_orderstatus = 'F' AND o_orderpriority IN ('5-LOW', '3-MEDIUM', '2-HIGH', '1-URGENT'))""",
    "scan_quarantine": """
        SELECT CASE o_orderpriority WHEN '3-MEDIUM' THEN 'no name' WHEN '2-HIGH' THEN 'no query_hash'
                                    ELSE 'not one JSON object' END AS reason,
               count(*)::BIGINT AS n
        FROM orders
        WHERE o_orderstatus = 'F' AND o_orderpriority IN ('5-LOW', '3-MEDIUM', '2-HIGH', '1-URGENT')
        GROUP BY 1""",
    "scan_mapping": """
        SELECT DISTINCT lower(c_name) AS old, 'lake.' || c_mktsegment AS new FROM customer""",
    "scan_catalog": f"""
        SELECT c_name AS dashboard_name, 'c_' || c_custkey AS dashboard_slug, c_mktsegment AS tags,
               c_custkey::VARCHAR AS object_id, '{AS_OF}' AS update_date_time, false AS is_migrated
        FROM customer""",
    "scan_endpoints": """
        SELECT 0 AS pos, 'ds' || s_suppkey AS id, 'ep' || s_suppkey AS endpoint_id,
               'NATION_' || s_nationkey AS name FROM supplier
        UNION ALL SELECT 1, '', '', s_name FROM supplier""",
    "scan_inventory": """
        SELECT 'query' AS kind, (o_orderkey * 2 + n)::VARCHAR AS id, 'q_' || o_custkey AS name,
               o_orderpriority AS tags
        FROM orders, (VALUES (0), (1)) v(n)""",
    "export_keyed_json": """
        SELECT DISTINCT 'c_' || c_custkey AS object_key, c_name AS name,
               CASE WHEN c_nationkey <> 24 AND c_nationkey % 5 > 0
                    THEN (c_custkey * 100 + 1)::VARCHAR END AS first_widget
        FROM customer""",
    "compact_landing": """
        SELECT DISTINCT 'c_' || c_custkey AS asset_key, c_name AS name, '2023-01-01T00:00:00Z' AS updated_at FROM customer""",
    "read_asset": """
        SELECT DISTINCT 'c_' || c_custkey AS asset_key, c_name AS name FROM customer WHERE c_custkey = 7""",
    "scan_large_document": r"""
        SELECT o_orderkey::VARCHAR AS object_key, '}{ "' || o_orderpriority || '\" ][' || o_custkey AS note, o_orderstatus AS status
        FROM orders""",
    "export_entry_lines": """
        SELECT DISTINCT 'c_' || c_custkey AS object_key, c_name AS name,
               CASE WHEN c_nationkey <> 24 AND c_nationkey % 5 > 0
                    THEN (c_custkey * 100 + 1)::VARCHAR END AS first_widget
        FROM customer""",
    "export_asset_files": f"""
        SELECT md5(o_custkey::VARCHAR) || '_q_' || o_custkey || '.json' AS file_key,
               max({ISO}) AS updated_at
        FROM orders GROUP BY o_custkey""",
    "scan_rejected_documents": """
        SELECT left('{"count":2,"results":[{"id":' || o_orderkey * 2 || ',"name":"q_' || o_custkey || '","tags":["', 40)
                   AS raw, 'not a page' AS reason
        FROM orders WHERE o_orderstatus = 'F'
        UNION ALL
        SELECT '{"name":"q_' || o_custkey || '","tags":["' || o_orderpriority || '"],"status":"P"}', 'no key'
        FROM orders, (VALUES (0), (1)) v(n) WHERE o_orderstatus = 'P'""",
    "land_rejected": """
        SELECT CASE WHEN o_orderstatus <> 'F' OR o_orderpriority = '4-NOT SPECIFIED' THEN 'landed'
                    WHEN o_orderpriority = '3-MEDIUM' THEN 'no name'
                    WHEN o_orderpriority = '2-HIGH' THEN 'no query_hash'
                    ELSE 'not one JSON object' END AS outcome,
               count(*)::BIGINT AS n
        FROM orders GROUP BY 1""",
    "run_report": """
        SELECT CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '3-MEDIUM' THEN 'no name'
                    WHEN o_orderstatus = 'F' AND o_orderpriority = '2-HIGH' THEN 'no query_hash'
                    WHEN o_orderstatus = 'F' AND o_orderpriority IN ('5-LOW', '1-URGENT') THEN 'not one JSON object'
                    WHEN (o_orderpriority = '1-URGENT' OR o_orderstatus = 'P' AND o_orderpriority <> '5-LOW')
                         AND o_orderdate >= TIMESTAMP '1996-01-01' THEN 'imported'
                    ELSE 'not chosen' END AS outcome,
               count(*)::BIGINT AS n
        FROM orders GROUP BY 1""",
    "asset_file_key": """
        SELECT 'c_' || c_custkey AS asset_key,
               'c_' || c_custkey || '_' || replace(c_name, '#', '%23') || '.json' AS file_key
        FROM customer""",
}
