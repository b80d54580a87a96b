"""Query text moved to new table and function names, inside its JSON object."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asset_catalog.functions.json_fields import SECRET_FIELDS, set_and_drop, text_field
from asset_catalog.functions.text import clean_mapping, multi_replace, rewrite_text
from asset_catalog.operators.tokens import replace_tokens
from asset_catalog.schemas import ConfigError


def rewrite_query(
    rows: DataFrame,
    tables: Mapping[str, str] | DataFrame | None,
    functions: Mapping[str, str] | DataFrame | None,
    **options,
) -> DataFrame:
    """Add ``query`` and ``new_query``: the text of ``parsed`` before and after the rewrite.

    Without any mapping the two are equal, and not lower-cased. A mapping of functions works
    without one of tables. A mapping that is a table (old, new) may have any size; its keys are
    whole identifiers.
    """
    query = text_field(F.col("parsed"), "query")
    rows = rows.withColumn("query", query)
    if not isinstance(tables, DataFrame) and not isinstance(functions, DataFrame):
        return rows.withColumn("new_query", rewrite_text(F.col("query"), tables, functions, **options))
    rows = rows.withColumn("new_query", F.col("query"))
    for mapping in (tables, functions):
        if isinstance(mapping, DataFrame):
            rest = dict(options)
            if rest.pop("match", "token") != "token":
                raise ConfigError("a mapping that is a table replaces whole identifiers only")
            rows = replace_tokens(rows.withColumnRenamed("new_query", "_moved"), "_moved", mapping, "new_query", **rest).drop("_moved")
        else:
            rows = rows.withColumn("new_query", multi_replace(F.col("new_query"), mapping, **options))
    return rows


def rewrite_object(
    rows: DataFrame, drop: Iterable[str] = SECRET_FIELDS, field: str = "query"
) -> DataFrame:
    """Add ``object``: the JSON of the asset with the rewritten text put back, secrets dropped.

    Other fields keep values and types. A query without text keeps its null.
    """
    text = F.col(f"new_{field}")
    return rows.withColumn(
        "object",
        set_and_drop(F.col("parsed"), {field: F.coalesce(text.cast("variant"), _null())}, drop),
    )


def _null() -> Column:
    return F.parse_json(F.lit("null"))


def rewrite_status(
    rows: DataFrame, tables: Mapping[str, str] | None, functions: Mapping[str, str] | None
) -> DataFrame:
    """Add per query what each pass did and whether the text changed.

    'completed', 'failed' for a query without text (it is left as it is), 'skipped' without a
    mapping.
    """

    def outcome(mapping: Mapping[str, str] | None) -> Column:
        if not clean_mapping(mapping):
            return F.lit("skipped")
        return F.when(F.col("query").isNull(), "failed").otherwise("completed")

    return rows.select(
        "*",
        outcome(tables).alias("tables_status"),
        outcome(functions).alias("functions_status"),
        F.coalesce(F.col("query") != F.col("new_query"), F.lit(False)).alias("changed"),
    )


# Fixed value: the header put ahead of a query.
HEADER = "/*\nName: %s\nData source: %s\nCreated By: %s\nLast Updated At: %s\n*/\n%s"


def annotate_query(
    name: Column, data_source: Column, created_by: Column, updated_at: Column, query: Column
) -> Column:
    """The query text with a comment that says what it is; missing parts stay empty."""
    parts = [name, data_source, created_by, updated_at, query]
    return F.format_string(HEADER, *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
