"""The catalog: projection, last state per key, upsert."""

from __future__ import annotations

from pyspark.sql import functions as F

from asset_catalog.functions.json_fields import text_fields
from asset_catalog.functions.mappings import FUNCTIONS
from asset_catalog.operators.assets import latest_per_key as keep_latest
from asset_catalog.operators.assets import changed_at, read_assets
from asset_catalog.operators.catalog import project_catalog
from asset_catalog.plans import derived
from asset_catalog.plans.derived import text
from asset_catalog.plans.lifecycles import Mappings, catalog_rows
from asset_catalog.plans.registered.rewriting import NEW_QUERY, OLD_QUERY, nation_mapping
from asset_catalog.plans.registered.scans import AS_OF, ISO, own_catalog
from asset_catalog.schemas import DASHBOARD, QUERY
from asset_catalog.sources.scratch import written_once
from asset_catalog.sources.tables import commit_version, read_catalog, upsert_catalog

BEFORE = "2023-01-01 00:00:00"


def import_queries(spark, sf_dir):
    """Landed lines to catalog rows: read, keep the last state, rewrite, project."""
    mappings = Mappings(nation_mapping(spark, sf_dir), FUNCTIONS)
    return catalog_rows(derived.landed_queries(spark, sf_dir), "query", mappings=mappings, as_of=F.lit(AS_OF))


def import_lifecycle(spark, sf_dir):
    rows = import_queries(spark, sf_dir)
    return rows.select(
        "query_name",
        "query_hash",
        F.array_join("tags", "|").alias("tags"),
        F.get_json_object("query_object", "$.query").alias("query"),
        "update_date_time",
        "is_migrated",
    )


def catalog_projection(spark, sf_dir):
    assets = read_assets(derived.queries(spark, sf_dir), "query")
    rows = project_catalog(assets, "query", F.lit(AS_OF))
    rows = rows.withColumn("object", text_fields(F.col("query_object"), "id", "query"))
    return rows.select(
        "query_name",
        "query_hash",
        F.array_join("tags", "|").alias("tags"),
        F.col("object.id").alias("object_id"),
        "object.query",
        "update_date_time",
        "is_migrated",
    )


def latest_per_key(spark, sf_dir):
    """Here a customer is the key, so that keys come back many times, and times are written in
    several precisions and offsets."""
    lines = derived.queries(spark, sf_dir, hash_of="o_custkey", written=derived.mixed_iso)
    assets = read_assets(lines, "query")
    numbered = assets.select(
        "asset_key",
        "updated_at",
        F.try_variant_get("parsed", "$.id", "bigint").alias("id"),
        changed_at(F.col("updated_at")).alias("changed"),
    )
    return keep_latest(numbered, ["asset_key"], ["changed", "id"]).drop("changed")


def _held_queries(spark, sf_dir):
    """Catalog rows of an earlier pull: orders that are not finished, already migrated."""
    orders = derived.table(spark, sf_dir, "orders").where("o_orderstatus != 'F'")
    return orders.select(
        F.concat(F.lit("q_"), text("o_custkey")).alias("query_name"),
        F.md5(text("o_orderkey")).alias("query_hash"),
        F.array(F.lit("old")).alias("tags"),
        F.to_json(F.struct(F.col("o_orderkey").alias("id"))).alias("query_object"),
        F.lit(BEFORE).alias("update_date_time"),
        F.lit(True).alias("is_migrated"),
        F.concat(F.lit("sent "), text("o_orderkey")).alias("upload_message"),
    ).dropDuplicates(QUERY.merge_keys)


def _upserted(spark, held, source, kind, **settings):
    """A catalog table that holds rows of an earlier pull, after the upsert of another."""
    config = own_catalog(spark, **settings)
    commit_version(held, config, kind)
    upsert_catalog(source, config, kind)
    return read_catalog(spark, config, kind)


def upsert_queries(spark, sf_dir, **settings):
    pulled = read_assets(derived.queries(spark, sf_dir), "query").drop("raw")
    pulled = pulled.where("NOT array_contains(tags, 's_O')")
    last = keep_latest(pulled, ["asset_key", "name"], ["updated_at"])
    source = written_once(project_catalog(last, "query", F.lit(AS_OF)), "pulled-queries")
    return _upserted(spark, _held_queries(spark, sf_dir), source, "query", **settings).select(
        "query_name",
        "query_hash",
        F.array_join("tags", "|").alias("tags"),
        F.get_json_object("query_object", "$.id").alias("object_id"),
        "update_date_time",
        "is_migrated",
        "upload_message",
    )


def upsert_parts(spark, sf_dir):
    """The same in a table cut into parts and buckets by its keys."""
    return upsert_queries(spark, sf_dir, catalog_parts=16, catalog_buckets=4)


def upsert_dashboards(spark, sf_dir):
    customer = derived.table(spark, sf_dir, "customer")
    target = customer.where("c_nationkey < 15").select(
        F.col("c_name").alias("dashboard_name"),
        F.concat(F.lit("c_"), text("c_custkey")).alias("dashboard_slug"),
        F.array(F.lit("old")).alias("tags"),
        F.lit("{}").alias("dashboard_object"),
        F.lit(BEFORE).alias("update_date_time"),
        F.lit(True).alias("is_migrated"),
        F.concat(F.lit("sent "), "c_mktsegment").alias("upload_message"),
    ).dropDuplicates(DASHBOARD.merge_keys)
    pulled = read_assets(derived.dashboards(spark, sf_dir), "dashboard").drop("raw")
    pulled = pulled.where("updated_at >= '2024-01-10'")
    last = keep_latest(pulled, ["asset_key", "name"], ["updated_at"])
    source = written_once(project_catalog(last, "dashboard", F.lit(AS_OF)), "pulled-dashboards")
    return _upserted(spark, target, source, "dashboard").select(
        "dashboard_name",
        "dashboard_slug",
        F.array_join("tags", "|").alias("tags"),
        F.get_json_object("dashboard_object", "$.id").alias("object_id"),
        "update_date_time",
        "is_migrated",
        "upload_message",
    )


QUERIES = {
    "import_lifecycle": import_lifecycle,
    "catalog_projection": catalog_projection,
    "latest_per_key": latest_per_key,
    "upsert_queries": upsert_queries,
    "upsert_parts": upsert_parts,
    "upsert_dashboards": upsert_dashboards,
}

_TAGS = """CASE WHEN NOT (o_orderpriority = '5-LOW' AND o_orderstatus = 'P') THEN
    regexp_replace(o_orderpriority, '[^A-Za-z]', '', 'g') || '|s_' || o_orderstatus END"""

ORACLES = {
    "import_lifecycle": f"""
        SELECT DISTINCT 'q_' || o_custkey AS query_name, md5(o_orderkey::VARCHAR) AS query_hash,
               {_TAGS} AS tags, {NEW_QUERY} AS query, '{AS_OF}' AS update_date_time,
               false AS is_migrated
        FROM orders
        WHERE NOT (o_orderstatus = 'F' AND o_orderpriority IN ('5-LOW', '3-MEDIUM', '2-HIGH', '1-URGENT'))""",
    "catalog_projection": f"""
        SELECT 'q_' || o_custkey AS query_name, md5(o_orderkey::VARCHAR) AS query_hash,
               {_TAGS} AS tags, o_orderkey::VARCHAR AS object_id, {OLD_QUERY} AS query,
               '{AS_OF}' AS update_date_time, false AS is_migrated
        FROM orders""",
    "latest_per_key": f"""
        SELECT md5(o_custkey::VARCHAR) AS asset_key, o_orderkey AS id,
               CASE o_orderstatus
                   WHEN 'O' THEN replace({ISO.replace("o_orderdate", "(o_orderdate + INTERVAL 5 HOURS)")}, 'Z', '+05:00')
                   WHEN 'F' THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') ELSE {ISO} END AS updated_at
        FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY
            date_trunc(CASE o_orderstatus WHEN 'F' THEN 'second' ELSE 'millisecond' END, o_orderdate) DESC,
            o_orderkey DESC) = 1""",
    # Untagged assets drop out of the pull: their tags are null, which is not "without s_O".
    "upsert_queries": f"""
        SELECT DISTINCT 'q_' || o_custkey AS query_name, md5(o_orderkey::VARCHAR) AS query_hash,
               CASE WHEN pulled THEN {_TAGS} ELSE 'old' END AS tags,
               o_orderkey::VARCHAR AS object_id,
               CASE WHEN pulled THEN '{AS_OF}' ELSE '{BEFORE}' END AS update_date_time,
               NOT pulled AS is_migrated,
               CASE WHEN o_orderstatus <> 'F' THEN 'sent ' || o_orderkey END AS upload_message
        FROM (SELECT *, o_orderstatus <> 'O'
                        AND NOT (o_orderpriority = '5-LOW' AND o_orderstatus = 'P') AS pulled
              FROM orders)""",
    "upsert_dashboards": f"""
        SELECT DISTINCT c_name AS dashboard_name, 'c_' || c_custkey AS dashboard_slug,
               CASE WHEN c_nationkey >= 9 THEN c_mktsegment ELSE 'old' END AS tags,
               CASE WHEN c_nationkey >= 9 THEN c_custkey::VARCHAR END AS object_id,
               CASE WHEN c_nationkey >= 9 THEN '{AS_OF}' ELSE '{BEFORE}' END AS update_date_time,
               c_nationkey < 9 AS is_migrated,
               CASE WHEN c_nationkey < 15 THEN 'sent ' || c_mktsegment END AS upload_message
        FROM customer""",
}

ORACLES["upsert_parts"] = ORACLES["upsert_queries"]
