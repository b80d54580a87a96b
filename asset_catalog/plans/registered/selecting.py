"""Selection of assets for import, upload and deletion."""

from __future__ import annotations

from pyspark.sql import functions as F

from asset_catalog.functions.tags import parse_list
from asset_catalog.operators import assets as ops
from asset_catalog.operators import select
from asset_catalog.operators.assets import read_assets
from asset_catalog.operators.pages import Pages
from asset_catalog.plans import derived
from asset_catalog.plans.registered.scans import ISO

TAGS = ["1-URGENT", "s_P"]
NAMES = ["q_7", "q_70", "q_Q"]


def _assets(spark, sf_dir):
    return read_assets(derived.queries(spark, sf_dir), "query")


def _keys(rows):
    return rows.select("asset_key", "name")


def filter_tags(spark, sf_dir):
    return _keys(select.filter_tags(_assets(spark, sf_dir), TAGS))


def filter_modified_since(spark, sf_dir):
    rows = select.filter_modified_since(_assets(spark, sf_dir), "1998-01-01")
    return rows.select("asset_key", "updated_at")


def filter_names(spark, sf_dir):
    return _keys(select.filter_names(_assets(spark, sf_dir), "subset", NAMES))


def typed_names(spark, sf_dir):
    """Names as a user types them into a setting."""
    names = parse_list(" q_7 , q_70,, q_Q ", names=True)
    return _keys(select.filter_names(_assets(spark, sf_dir), "subset", names))


def filter_names_table(spark, sf_dir):
    """Names from a table of any size."""
    names = derived.table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'")
    names = names.select(F.concat(F.lit("q_"), derived.text("c_custkey")).alias("name"))
    return select.filter_names(derived.inventory(spark, sf_dir), "subset", names).select("id", "name")


def _upload(mode):
    return lambda spark, sf_dir: _keys(
        select.select_for_upload(_assets(spark, sf_dir), mode, TAGS, NAMES)
    )


def select_delete_seed(spark, sf_dir):
    return select.select_for_delete(derived.inventory(spark, sf_dir), TAGS, NAMES).select("id", "name")


def select_delete_all(spark, sf_dir):
    return select.select_all(derived.inventory(spark, sf_dir), confirm=True).select("id", "name")


def delete_name_closure(spark, sf_dir):
    chosen = select.chosen_for_delete(["1-URGENT"], NAMES)
    rows = select.expand_by_name(derived.inventory(spark, sf_dir), chosen)
    return rows.select("id", "name", "collateral")


def distinct_names(spark, sf_dir):
    return ops.distinct_names(
        select.select_for_delete(derived.inventory(spark, sf_dir), TAGS, NAMES)
    )


def run_counts(spark, sf_dir):
    return ops.run_counts(_assets(spark, sf_dir), select.chosen_for_delete(TAGS, NAMES))


def page_listing(spark, sf_dir):
    rows = derived.inventory(spark, sf_dir).withColumn("n", F.col("id").cast("bigint"))
    return ops.page(rows, ["n"], 3, 250).select("id", "name")


def page_by_number(spark, sf_dir):
    """A page by its number, which reads none of the rows before it."""
    rows = derived.inventory(spark, sf_dir).withColumn("n", F.col("id").cast("bigint"))
    return Pages(rows, ["n"]).page(5, 250).select("id", "name")


def page_deep(spark, sf_dir):
    """The page after a given row, which passes by all rows before it."""
    rows = derived.inventory(spark, sf_dir).withColumn("n", F.col("id").cast("bigint"))
    return ops.page_after(rows, ["n"], [900], 250).select("id", "name")


def preview_first(spark, sf_dir):
    return ops.preview(_assets(spark, sf_dir), ["updated_at", "asset_key"]).select(
        "asset_key", "name", "updated_at"
    )


QUERIES = {
    "filter_tags": filter_tags,
    "filter_modified_since": filter_modified_since,
    "filter_names": filter_names,
    "parse_list": typed_names,
    "filter_names_table": filter_names_table,
    "select_upload_tags": _upload("Tags"),
    "select_upload_name": _upload("Query Name"),
    "select_upload_and": _upload("Both (and)"),
    "select_upload_or": _upload("Both (or)"),
    "select_upload_all": _upload("ALL"),
    "select_delete_seed": select_delete_seed,
    "select_delete_all": select_delete_all,
    "delete_name_closure": delete_name_closure,
    "distinct_names": distinct_names,
    "run_counts": run_counts,
    "page_listing": page_listing,
    "page_by_number": page_by_number,
    "page_deep": page_deep,
    "preview_first": preview_first,
}

_KEYS = "SELECT md5(o_orderkey::VARCHAR) AS asset_key, 'q_' || o_custkey AS name FROM orders"
_IDS = "SELECT o_orderkey::VARCHAR AS id, 'q_' || o_custkey AS name FROM orders"
# Assets without tags (a low priority that is pending) match no tag.
_TAG = "(o_orderpriority = '1-URGENT' OR o_orderstatus = 'P' AND o_orderpriority <> '5-LOW')"
_SEED_TAG = "(o_orderpriority = '1-URGENT' OR o_orderstatus = 'P')"
_NAME = "o_custkey IN (7, 70)"

ORACLES = {
    "filter_tags": f"{_KEYS} WHERE {_TAG}",
    "filter_modified_since": f"""
        SELECT md5(o_orderkey::VARCHAR) AS asset_key, {ISO} AS updated_at
        FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'""",
    "filter_names": f"{_KEYS} WHERE {_NAME}",
    "parse_list": f"{_KEYS} WHERE {_NAME}",
    "filter_names_table": f"""{_IDS}
        WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
    "select_upload_tags": f"{_KEYS} WHERE {_TAG}",
    "select_upload_name": f"{_KEYS} WHERE {_NAME}",
    "select_upload_and": f"{_KEYS} WHERE {_TAG} AND {_NAME}",
    "select_upload_or": f"{_KEYS} WHERE {_TAG} OR {_NAME}",
    "select_upload_all": _KEYS,
    "select_delete_seed": f"{_IDS} WHERE {_SEED_TAG} OR {_NAME}",
    "select_delete_all": _IDS,
    "delete_name_closure": f"""
        SELECT o_orderkey::VARCHAR AS id, 'q_' || o_custkey AS name,
               NOT (o_orderpriority = '1-URGENT' OR {_NAME}) AS collateral
        FROM orders
        WHERE o_custkey IN (SELECT o_custkey FROM orders
                            WHERE o_orderpriority = '1-URGENT' OR {_NAME})""",
    "distinct_names": f"SELECT DISTINCT name FROM ({_IDS} WHERE {_SEED_TAG} OR {_NAME})",
    "run_counts": f"""
        SELECT count(*)::BIGINT AS total, count(*) FILTER (WHERE {_TAG} OR {_NAME})::BIGINT AS selected
        FROM orders""",
    "page_listing": f"{_IDS} ORDER BY o_orderkey LIMIT 250 OFFSET 500",
    "page_by_number": f"{_IDS} ORDER BY o_orderkey LIMIT 250 OFFSET 1000",
    "page_deep": f"{_IDS} WHERE o_orderkey > 900 ORDER BY o_orderkey LIMIT 250",
    "preview_first": f"""
        SELECT md5(o_orderkey::VARCHAR) AS asset_key, 'q_' || o_custkey AS name, {ISO} AS updated_at
        FROM orders ORDER BY updated_at, asset_key LIMIT 1""",
}
