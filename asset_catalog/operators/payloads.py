"""Request bodies that create assets in the target service, as JSON text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from asset_catalog.functions.json_fields import (
    SECRET_FIELDS,
    blank,
    member,
    or_default,
    text_field,
)

# Nulls are part of the bodies.
_WITH_NULLS = {"ignoreNullFields": "false"}


def body_text(fields: Column) -> Column:
    """The body of these fields, with the secrets that an export's options and embedded objects may hold."""
    return F.to_json(fields, _WITH_NULLS)


def _body(fields: Column) -> Column:
    """The body without secrets."""
    return blank(body_text(fields), SECRET_FIELDS)


def _marked_tags(tags: Column, marker: str) -> Column:
    none = F.array().cast("array<string>")
    return F.concat(F.array(F.lit(marker)), F.coalesce(tags, none))


def query_fields(parsed: Column, data_source_id: Column, marker: str) -> Column:
    return F.struct(
        data_source_id.cast("string").alias("data_source_id"),
        text_field(parsed, "query").alias("query"),
        text_field(parsed, "name").alias("name"),
        or_default(text_field(parsed, "description"), F.lit(""), kind="string").alias("description"),
        member(parsed, "schedule").alias("schedule"),
        member(parsed, "options").alias("options"),
        member(parsed, "visualizations").alias("visualizations"),
        _marked_tags(F.try_variant_get(parsed, "$.tags", "array<string>"), marker).alias("tags"),
    )


def query_payload(parsed: Column, data_source_id: Column, marker: str) -> Column:
    """Body that creates a query on the target data source, with the marker among its tags."""
    return _body(query_fields(parsed, data_source_id, marker))


def visualization_fields(chart: Column, query_id: Column) -> Column:
    return F.struct(
        text_field(chart, "name").alias("name"),
        text_field(chart, "type").alias("type"),
        text_field(chart, "description").alias("description"),
        member(chart, "options").alias("options"),
        query_id.alias("query_id"),
    )


def visualization_payload(chart: Column, query_id: Column) -> Column:
    """Body that creates a chart of an already created query."""
    return _body(visualization_fields(chart, query_id))


def dashboard_fields(parsed: Column, marker: str) -> Column:
    no_widgets = F.parse_json(F.lit("[]"))
    return F.struct(
        text_field(parsed, "name").alias("name"),
        member(parsed, "layout").alias("layout"),
        member(parsed, "dashboard_filters_enabled").alias("dashboard_filters_enabled"),
        or_default(member(parsed, "widgets"), no_widgets).alias("widgets"),
        member(parsed, "is_trashed").alias("is_trashed"),
        member(parsed, "is_draft").alias("is_draft"),
        _marked_tags(F.try_variant_get(parsed, "$.tags", "array<string>"), marker).alias("tags"),
    )


def dashboard_payload(parsed: Column, marker: str) -> Column:
    """Body that creates a dashboard."""
    return _body(dashboard_fields(parsed, marker))


def widget_fields(widget: Column, dashboard_id: Column, visualization_id: Column) -> Column:
    return F.struct(
        dashboard_id.alias("dashboard_id"),
        visualization_id.alias("visualization_id"),
        text_field(widget, "text").alias("text"),
        or_default(member(widget, "options"), F.lit("")).alias("options"),
        or_default(member(widget, "width"), F.lit(1)).alias("width"),
    )


def widget_payload(widget: Column, dashboard_id: Column, visualization_id: Column) -> Column:
    """Body that puts a widget on an already created dashboard.

    Text and width are the widget's own; a widget without chart has a null chart id.
    """
    return _body(widget_fields(widget, dashboard_id, visualization_id))
