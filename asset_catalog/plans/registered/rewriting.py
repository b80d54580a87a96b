"""Rewriting of names in texts, and functions of single columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from asset_catalog.functions.json_fields import (
    member,
    or_default,
    parse_rows,
    redact,
    set_and_drop,
    text_field,
    text_fields,
)
from asset_catalog.functions.mappings import FUNCTIONS
from asset_catalog.functions.tags import normalise_tags, parse_tag_list
from asset_catalog.functions.text import multi_replace
from asset_catalog.operators.assets import read_assets
from asset_catalog.operators.relate import explode_widgets
from asset_catalog.operators.rewrite import (
    annotate_query,
    rewrite_object,
    rewrite_query,
    rewrite_status,
)
from asset_catalog.operators.tokens import replace_tokens as replace_tokens_by
from asset_catalog.plans import derived
from asset_catalog.plans.derived import text
from asset_catalog.plans.registered.scans import ISO
from asset_catalog.sources.landed import load_mapping

# Keys that start alike, hold a sign with a meaning in patterns, or stand in another's value.
WORDS = {
    "th": "TH",
    "the": "<the>",
    "ther": "$1",
    "thereb": "\\",
    "ou": "",
    "oun": "the",
    "e.": "e!",
    "é": "e",
    "ERE": "ere there",
    "ieren": "i{eren}",
    "zu": "zu|zu",
}


def replace_words(spark, sf_dir):
    documents = derived.spread_table(spark, sf_dir, "documents", "doc_id")
    return documents.select("doc_id", multi_replace(F.col("text"), WORDS).alias("rewritten"))


def replace_tokens(spark, sf_dir):
    """Whole words only, case kept."""
    documents = derived.spread_table(spark, sf_dir, "documents", "doc_id")
    words = {"the": "<the>", "und": "&", "des": "$2"}
    rewritten = multi_replace(F.col("text"), words, match="token", preserve_case=True)
    return documents.select("doc_id", rewritten.alias("rewritten"))


def nation_mapping(spark, sf_dir):
    """NATION_1 begins NATION_10 and so on: the longer name must win."""
    nation = derived.table(spark, sf_dir, "nation")
    new = F.concat(F.lit("lake.n_"), derived.text("n_nationkey"))
    tables = load_mapping(nation.select(F.col("n_name").alias("old"), new.alias("new")))
    return {**tables, "raw_zone": "lake.sales", "ordersv1": "orders_v2"}


def _rewritten(spark, sf_dir):
    assets = read_assets(derived.queries(spark, sf_dir), "query")
    return rewrite_query(assets, nation_mapping(spark, sf_dir), FUNCTIONS)


def rewrite_queries(spark, sf_dir):
    return _rewritten(spark, sf_dir).select("asset_key", "new_query")


def rewrite_objects(spark, sf_dir):
    """Fields of the JSON after the text was put back: values and types are kept."""
    names = ["query", "id", "tags", "schedule", "description", "runtime", "api_key"]
    schema = ", ".join(f"`{name}` string" for name in names) + ", visualizations array<struct<id string>>"
    rows = rewrite_object(_rewritten(spark, sf_dir))
    fields = rows.select("asset_key", F.from_json("object", schema).alias("f")).select("asset_key", "f.*")
    first = F.get("visualizations", F.lit(0))["id"].alias("first_chart")
    return fields.select("*", first).withColumn("runtime", F.col("runtime").cast("double")).drop("visualizations")


def rewrite_statuses(spark, sf_dir):
    """Finished orders have a text in lower case and without any key, which does not change."""
    orders = derived.spread_table(spark, sf_dir, "orders", "o_orderkey")
    textless = (F.col("o_orderpriority") == "4-NOT SPECIFIED") & (F.col("o_orderstatus") == "P")
    plain = F.when(F.col("o_orderstatus") == "F", "select 1 from plain").otherwise(derived.query_text())
    fields = F.struct(
        F.lit("q").alias("name"),
        F.md5(derived.text("o_orderkey")).alias("query_hash"),
        F.when(~textless, plain).alias("query"),
    )
    tables = nation_mapping(spark, sf_dir)
    assets = read_assets(orders.select(F.to_json(fields).alias("raw")), "query")
    rows = rewrite_status(rewrite_query(assets, tables, FUNCTIONS), tables, FUNCTIONS)
    return rows.select("asset_key", "tables_status", "functions_status", "changed")


def normalised_tags(spark, sf_dir):
    assets = read_assets(derived.queries(spark, sf_dir), "query")
    tags = text_field(F.col("parsed"), "tags")
    return assets.select(
        "asset_key",
        F.array_join(normalise_tags(tags), "|").alias("tags"),
        F.array_join(normalise_tags(tags, typed=True), "|").alias("typed_tags"),
    )


def parsed_tag_list(spark, sf_dir):
    part = derived.table(spark, sf_dir, "part")
    typed = F.concat(
        F.lit(" "), "p_brand", F.lit(" ,"), "p_type", F.lit(",,  "), "p_name", F.lit(",")
    )
    return part.select(
        "p_partkey",
        F.array_join(parse_tag_list(typed), "|").alias("tags"),
        F.array_join(parse_tag_list(typed, separators=","), "|").alias("names"),
    )


def replace_by_table(spark, sf_dir):
    """A mapping with a key for each customer, of three pieces each, which stays a table."""
    customer = derived.table(spark, sf_dir, "customer")
    pairs = customer.select(F.col("c_name").alias("old"), F.concat(F.lit("lake."), "c_mktsegment").alias("new"))
    name = F.concat(F.lit("Customer#"), F.lpad(text("o_custkey"), 9, "0"))
    noted = F.concat(F.lit("SELECT * FROM "), name, F.lit(" JOIN "), name, F.lit("x WHERE y."), name, F.lit(" = "), "o_orderpriority")
    orders = derived.spread_table(spark, sf_dir, "orders", "o_orderkey").select("o_orderkey", noted.alias("note"))
    return replace_tokens_by(orders, "note", pairs, "rewritten").select("o_orderkey", "rewritten")


def json_roundtrip(spark, sf_dir):
    """Every document through JSON and back."""
    documents = derived.spread_table(spark, sf_dir, "documents", "doc_id")
    raw = F.to_json(F.struct("doc_id", "text", F.struct("lang", "n_chars").alias("about")))
    texts = documents.select(raw.alias("raw"))
    again = texts.select(parse_rows(texts).alias("parsed")).select(
        set_and_drop(F.col("parsed"), {}).alias("json")
    )
    fields = F.from_json("json", "doc_id bigint, text string, about struct<lang:string,n_chars:bigint>")
    return again.select(fields.alias("j")).select("j.doc_id", "j.text", "j.about.lang", "j.about.n_chars")


def defaults(spark, sf_dir):
    dashboards = read_assets(derived.dashboards(spark, sf_dir), "dashboard")
    widgets = explode_widgets(dashboards).where("widget IS NOT NULL")
    widget = F.col("widget")
    return widgets.select(
        "asset_key",
        "pos",
        or_default(member(widget, "width"), F.lit(1)).cast("int").alias("width"),
        or_default(text_field(widget, "text"), F.lit("no text"), kind="string").alias("text"),
        F.to_json(or_default(member(widget, "options"), F.lit(""))).alias("options"),
    )


def redact_object(spark, sf_dir):
    assets = read_assets(derived.queries(spark, sf_dir), "query")
    clean = assets.select("asset_key", redact(F.col("parsed")).alias("json"))
    fields = F.from_json("json", "user struct<name:string>, version string").alias("f")
    clean = clean.select("asset_key", F.col("json").contains("secret-").alias("leaks"), fields)
    return clean.select("asset_key", "leaks", F.col("f.user.name").alias("user"), "f.version")


def redact_embedded(spark, sf_dir):
    """Dashboards embed queries with secrets; a text that looks like one is left alone."""
    assets = read_assets(derived.dashboards(spark, sf_dir), "dashboard")
    clean = assets.select("asset_key", redact(F.col("parsed")).alias("json"))
    return clean.select(
        "asset_key",
        F.col("json").contains("secret-").alias("leaks"),
        F.get_json_object("json", "$.widgets[0].visualization.query.query").alias("query"),
        F.get_json_object("json", "$.widgets[0].visualization.id").alias("chart"),
    )


def annotated_query(spark, sf_dir):
    assets = read_assets(derived.queries(spark, sf_dir), "query")
    parsed = F.col("parsed")
    text = annotate_query(
        F.col("name"),
        text_field(parsed, "data_source_id"),
        F.try_variant_get(parsed, "$.user.name", "string"),
        F.col("updated_at"),
        text_field(parsed, "query"),
    )
    return assets.select("asset_key", text.alias("annotated"))


QUERIES = {
    "multi_replace": replace_words,
    "multi_replace_token": replace_tokens,
    "replace_by_table": replace_by_table,
    "rewrite_queries": rewrite_queries,
    "rewrite_object": rewrite_objects,
    "rewrite_status": rewrite_statuses,
    "normalise_tags": normalised_tags,
    "parse_tag_list": parsed_tag_list,
    "json_roundtrip": json_roundtrip,
    "or_default": defaults,
    "redact_object": redact_object,
    "redact_embedded": redact_embedded,
    "annotate_query": annotated_query,
}


def _sql(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _replace_sql(mapping: dict[str, str], text: str) -> str:
    """DuckDB's way to the same: split at the keys, look every key up, put together."""
    keys = sorted((k.lower() for k in mapping), key=len, reverse=True)
    pattern = _sql("|".join(k.replace(".", "\\.") for k in keys))
    values = ", ".join(f"{_sql(k.lower())}: {_sql(v)}" for k, v in mapping.items())
    return f"""
        WITH low AS (SELECT doc_id, lower({text}) AS t FROM documents),
        cut AS (SELECT doc_id, string_split_regex(t, {pattern}) AS gaps,
                       regexp_extract_all(t, {pattern}) AS hits FROM low)
        SELECT doc_id, array_to_string(list_transform(range(1, len(gaps) + 1), lambda i:
                   gaps[i] || CASE WHEN i <= len(hits)
                                   THEN (MAP {{{values}}})[hits[i]] ELSE '' END), '') AS rewritten
        FROM cut"""


_TEXTLESS = "o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P'"
_UNTAGGED = "o_orderpriority = '5-LOW' AND o_orderstatus = 'P'"

# The text of a derived query after the rewrite. NATION_25 to NATION_29 have no entry of
# their own, so NATION_2 matches in them.
NEW_QUERY = f"""CASE WHEN NOT ({_TEXTLESS}) THEN
    'select sum(total) as "größe", instr(note, ''x'')' || chr(10) || 'from lake.sales.orders_v2 t, '
    || CASE WHEN o_custkey % 30 < 25 THEN 'lake.n_' || (o_custkey % 30)
            ELSE 'lake.n_2' || (o_custkey % 10) END
    || ' where key = ' || o_custkey END"""

OLD_QUERY = f"""CASE WHEN NOT ({_TEXTLESS}) THEN
    'SELECT Sum(Total) AS "Größe", strpos(Note, ''X'')' || chr(10) || 'FROM Raw_Zone.OrdersV1 t, NATION_'
    || (o_custkey % 30) || ' WHERE Key = ' || o_custkey END"""

ORACLES = {
    "multi_replace": _replace_sql(WORDS, "text"),
    # Every character of a word is a letter, digit or underscore, so words never share a
    # boundary and each is replaced apart from the others.
    "multi_replace_token": """
        WITH cut AS (SELECT doc_id, string_split_regex(text, '[\\pL\\pN_]+') AS gaps,
                            regexp_extract_all(text, '[\\pL\\pN_]+') AS hits FROM documents)
        SELECT doc_id, array_to_string(list_transform(range(1, len(gaps) + 1), lambda i:
                   gaps[i] || CASE WHEN i > len(hits) THEN ''
                                   WHEN lower(hits[i]) = 'the' THEN '<the>'
                                   WHEN lower(hits[i]) = 'und' THEN '&'
                                   WHEN lower(hits[i]) = 'des' THEN '$2'
                                   ELSE hits[i] END), '') AS rewritten
        FROM cut""",
    "replace_by_table": """
        SELECT o_orderkey, 'select * from ' || coalesce('lake.' || c_mktsegment, name) || ' join ' || name || 'x where y.'
               || coalesce('lake.' || c_mktsegment, name) || ' = ' || lower(o_orderpriority) AS rewritten
        FROM (SELECT *, 'customer#' || lpad(o_custkey::VARCHAR, 9, '0') AS name FROM orders)
        LEFT JOIN customer ON lower(c_name) = name""",
    "rewrite_queries": f"""
        SELECT md5(o_orderkey::VARCHAR) AS asset_key, {NEW_QUERY} AS new_query FROM orders""",
    "rewrite_object": f"""
        SELECT md5(o_orderkey::VARCHAR) AS asset_key, {NEW_QUERY} AS query,
               o_orderkey::VARCHAR AS id,
               CASE WHEN NOT ({_UNTAGGED})
                    THEN '["' || o_orderpriority || '","s_' || o_orderstatus || '"]' END AS tags,
               CASE o_orderstatus WHEN 'F' THEN '{{"interval":3600}}' END AS schedule,
               CASE o_orderstatus WHEN 'O' THEN '' WHEN 'P' THEN 'note ' || o_orderpriority END
                   AS description,
               o_totalprice AS runtime,
               CASE WHEN o_orderpriority <> '5-LOW' THEN (o_orderkey * 10 + 1)::VARCHAR END
                   AS first_chart,
               NULL::VARCHAR AS api_key
        FROM orders""",
    "rewrite_status": f"""
        SELECT md5(o_orderkey::VARCHAR) AS asset_key,
               CASE WHEN {_TEXTLESS} THEN 'failed' ELSE 'completed' END AS tables_status,
               CASE WHEN {_TEXTLESS} THEN 'failed' ELSE 'completed' END AS functions_status,
               NOT ({_TEXTLESS}) AND o_orderstatus <> 'F' AS changed
        FROM orders""",
    "normalise_tags": f"""
        SELECT md5(o_orderkey::VARCHAR) AS asset_key,
               CASE WHEN NOT ({_UNTAGGED})
                    THEN regexp_replace(o_orderpriority, '[^A-Za-z]', '', 'g') || '|s_'
                         || o_orderstatus END AS tags,
               CASE WHEN NOT ({_UNTAGGED}) THEN o_orderpriority || '|s_' || o_orderstatus END
                   AS typed_tags
        FROM orders""",
    "parse_tag_list": """
        SELECT p_partkey, p_brand || '|' || p_type || '|' || replace(p_name, ' ', '|') AS tags,
               p_brand || '|' || p_type || '|' || p_name AS names
        FROM part""",
    "json_roundtrip": "SELECT doc_id, text, lang, n_chars FROM documents",
    "or_default": """
        SELECT 'c_' || c_custkey AS asset_key, (j - 1)::INTEGER AS pos,
               CASE WHEN j <= 2 THEN 1 ELSE j END::INTEGER AS width,
               CASE j WHEN 3 THEN 'note' ELSE 'no text' END AS text,
               CASE j WHEN 4 THEN '""'
                      ELSE '{"isHidden":false,"position":{"col":' || j || '}}' END AS options
        FROM customer, range(1, 5) r(j)
        WHERE c_nationkey <> 24 AND j <= c_nationkey % 5""",
    "redact_object": """
        SELECT md5(o_orderkey::VARCHAR) AS asset_key, false AS leaks, 'u_' || o_custkey AS user,
               '1' AS version
        FROM orders""",
    "redact_embedded": """
        SELECT 'c_' || c_custkey AS asset_key, false AS leaks,
               CASE WHEN shown THEN '{"api_key":"in a text"}' END AS query,
               CASE WHEN shown THEN (c_custkey * 10 + 1)::VARCHAR END AS chart
        FROM (SELECT *, c_nationkey <> 24 AND c_nationkey % 5 > 0 AS shown FROM customer)""",
    "annotate_query": f"""
        SELECT md5(o_orderkey::VARCHAR) AS asset_key,
               '/*' || chr(10) || 'Name: q_' || o_custkey || chr(10) || 'Data source: 1' || chr(10)
               || 'Created By: u_' || o_custkey || chr(10) || 'Last Updated At: ' || {ISO} || chr(10)
               || '*/' || chr(10) || coalesce({OLD_QUERY}, '') AS annotated
        FROM orders""",
}
