"""Children of assets (charts, widgets) and the ids that tie them to the target service."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asset_catalog.functions.json_fields import elements, text_field
from asset_catalog.operators.assets import changed_at, latest_per_key
from asset_catalog.operators.joins import join_each
from asset_catalog.schemas import ConfigError


def _children(assets: DataFrame, field: str, child: str) -> DataFrame:
    return assets.select(
        *[c for c in assets.columns if c not in ("parsed", "raw", "source_key")],
        F.col("source_key").alias("parent_key"),
        F.posexplode_outer(elements(F.col("parsed"), field)).alias("pos", child),
    )


def explode_visualizations(queries: DataFrame) -> DataFrame:
    """One row per chart of a query, in order; a query without charts gives one row of nulls.

    ``parent_key`` is the source key of the query.
    """
    charts = _children(queries, "visualizations", "visualization")
    return charts.withColumn("old_viz_id", text_field(F.col("visualization"), "id"))


def explode_widgets(dashboards: DataFrame) -> DataFrame:
    """One row per widget of a dashboard, in order; none gives one row of nulls.

    ``old_viz_id`` is null for a widget that holds text only.
    """
    widgets = _children(dashboards, "widgets", "widget")
    return widgets.withColumn(
        "old_viz_id", F.try_variant_get("widget", "$.visualization.id", "string")
    )


def enrich_with_detail(listing: DataFrame, detail: DataFrame, key: str) -> DataFrame:
    """The full object for each listed one; ``has_detail`` is false where none was landed.

    A key listed more than once, as when pages shift while they are read, is kept once; of
    several details of a key the latest is taken: by time of change, then by landing where
    ``landed_at`` says when, then by text, so that it is always the same. Both rankings leave
    their rows where the join needs them.
    """
    listed = _latest_object(listing, key)
    one = _latest_object(detail, key).select(key, F.col("raw").alias("_detail"))
    joined = listed.join(one, key, "left")
    return joined.withColumn("has_detail", F.col("_detail").isNotNull()).withColumn(
        "raw", F.coalesce("_detail", "raw")
    ).drop("_detail")


def _latest_object(rows: DataFrame, key: str) -> DataFrame:
    changed = changed_at(F.get_json_object("raw", "$.updated_at"))
    order = ["_changed", *[c for c in ["landed_at"] if c in rows.columns], "raw"]
    return latest_per_key(rows.withColumn("_changed", changed), [key], order).drop("_changed")


def succeeded(status: Column) -> Column:
    """Whether a response says success; a missing status does not."""
    return F.coalesce(status == 200, F.lit(False))


def new_ids(responses: DataFrame) -> DataFrame:
    """One new id for each source key that was answered with success, also when it was sent
    again and so answered more than once: then the answer that landed last counts, and of
    several of the same time the largest number."""
    good = responses.where(succeeded(F.col("status")))
    return good.groupBy("source_key").agg(_last_id(good, "new_id").alias("new_id"))


def _last_id(rows: DataFrame, name: str) -> Column:
    """The id that landed last; a longer text is a larger number."""
    landed = [F.col(c) for c in ["landed_at"] if c in rows.columns]
    return F.max_by(name, F.when(F.col(name).isNotNull(), F.struct(*landed, F.length(name), F.col(name))))


def split_by_status(responses: DataFrame) -> DataFrame:
    return responses.withColumn(
        "outcome", F.when(succeeded(F.col("status")), "ok").otherwise("fail")
    )


def build_id_map(charts: DataFrame, responses: DataFrame) -> DataFrame:
    """New chart id per old one, from the answers to the charts' requests.

    ``charts`` has ``source_key``, ``old_viz_id`` and the order columns ``parent_key``, ``pos``;
    an old id that was sent twice maps to the answer that landed last, and without landing times
    to the last in that order.
    """
    sent = charts.select("source_key", "old_viz_id", "parent_key", "pos")
    landed = ["landed_at"] if "landed_at" in responses.columns else []
    good = responses.where(succeeded(F.col("status")))
    answered = good.groupBy("source_key").agg(
        _last_id(good, "new_id").alias("new_id"), *[F.max(c).alias(c) for c in landed]
    )
    sent = sent.join(answered, "source_key")
    last = latest_per_key(sent, ["old_viz_id"], [*landed, "parent_key", "pos", "source_key"])
    return last.select("old_viz_id", F.col("new_id").alias("new_viz_id"))


def remap_visualization_ids(widgets: DataFrame, id_map: DataFrame) -> DataFrame:
    """Add the new chart id of each widget; null when its chart has none."""
    one = id_map.groupBy("old_viz_id").agg(_last_id(id_map, "new_viz_id").alias("new_viz_id"))
    return join_each(widgets, one, "old_viz_id", "left")


def attach_parent_id(children: DataFrame, responses: DataFrame) -> DataFrame:
    """Add the new id of the parent; children of a parent that failed are left out."""
    answers = new_ids(responses).select(
        F.col("source_key").alias("parent_key"), F.col("new_id").alias("parent_id")
    )
    return join_each(children, answers, "parent_key", "inner")


def resolve_endpoint(endpoints: DataFrame, name: str) -> DataFrame:
    """The first endpoint of that name in the order of the list, as one row or none."""
    return (
        endpoints.where(F.col("name") == name)
        .orderBy("pos", "id")
        .limit(1)
        .select("endpoint_id", F.col("id").alias("data_source_id"))
    )


def endpoint_ids(endpoints: DataFrame, name: str) -> tuple[str, str]:
    """Endpoint id and data source id of the named endpoint, which must exist."""
    if not name:
        raise ConfigError("an endpoint name is needed")
    found = resolve_endpoint(endpoints, name).head(1)
    if not found:
        raise ConfigError(f"no endpoint is named {name!r}")
    return found[0]["endpoint_id"], found[0]["data_source_id"]
