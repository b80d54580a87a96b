"""Whole runs: land, import into the catalog, clean an export, upload, remove.

Each builds one lazy plan per table written. Where a result is used more than once it is
written to the catalog's shared folder first and read back, which also ends its lineage.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from asset_catalog.config import Config
from asset_catalog.functions.json_fields import SECRET_FIELDS, parse_rows
from asset_catalog.operators import outbox
from asset_catalog.operators.assets import (
    changed_at,
    classify_assets,
    latest_per_key,
    quarantine,
    read_assets,
    source_key,
)
from asset_catalog.operators.catalog import project_catalog, stage
from asset_catalog.operators.relate import (
    build_id_map,
    enrich_with_detail,
    explode_visualizations,
    explode_widgets,
)
from asset_catalog.operators.rewrite import rewrite_object, rewrite_query
from asset_catalog.operators.select import (
    chosen_for_delete,
    UNDATED,
    expand_by_name,
    filter_modified_since,
    filter_tags,
    has_tag,
    modified_since,
    select_for_upload,
    undated,
    updated,
)
from asset_catalog.schemas import (
    STEP_DASHBOARD,
    STEP_QUERY,
    STEP_VISUALIZATION,
    STEP_WIDGET,
    Kind,
    kind_of,
)
from asset_catalog.sources.exports import write_asset_files, write_keyed_json
from asset_catalog.sources.landed import (
    read_export_entries,
    read_json_lines,
    read_keyed_json,
)
from asset_catalog.sources.scratch import written_once
from asset_catalog.sources.tables import read_catalog, upsert_catalog


@dataclass(frozen=True)
class Choice:
    """Which assets take part: by tags and by date of the last change; all when empty."""

    tags: Sequence[str] = ()
    since: str | None = None

    def of(self, assets: DataFrame) -> DataFrame:
        return filter_modified_since(filter_tags(assets, self.tags), self.since)


@dataclass(frozen=True)
class Mappings:
    """Old to new names of tables and functions; None where there is no such mapping.

    A mapping too large for the driver is a table (old, new), as ``read_mapping`` returns it, and then
    replaces whole identifiers only."""

    tables: Mapping[str, str] | DataFrame | None = None
    functions: Mapping[str, str] | DataFrame | None = None


def land(
    listing: DataFrame,
    path: str,
    kind: str | Kind,
    choice: Choice = Choice(),
    detail: DataFrame | None = None,
) -> str:
    """Chosen assets of a listing, with their full objects where given, as landed lines.

    Returns the path of what could not be read, (raw, reason), which is beside the landed ones."""
    if detail is not None:
        listing = enrich_with_detail(listing, detail, "object_key")
    found = written_once(classify_assets(listing.select("raw"), kind), "listed")
    rejected = f"{path.rstrip('/')}-rejected/{uuid.uuid4().hex}"
    found.where("reason IS NOT NULL").select("raw", "reason").write.parquet(rejected)
    write_asset_files(choice.of(found.where("reason IS NULL")), path)
    return rejected


def catalog_rows(
    lines: DataFrame,
    kind: str | Kind,
    choice: Choice = Choice(),
    mappings: Mappings = Mappings(),
    as_of: datetime | Column | None = None,
) -> DataFrame:
    """Landed lines as catalog rows: the last state of each chosen asset, queries rewritten.

    The last is that of the latest ``updated_at`` as a time; of states changed at the same time
    the one that landed last counts.
    """
    assets = choice.of(read_assets(lines, kind)).withColumn("tie", F.xxhash64("raw"))
    return _catalog_rows(assets, kind_of(kind), mappings, as_of)


def _catalog_rows(
    assets: DataFrame, kind: Kind, mappings: Mappings, as_of: datetime | Column | None
) -> DataFrame:
    order = ["changed", *[c for c in ["landed_at"] if c in assets.columns], "tie"]
    assets = assets.withColumn("changed", changed_at(F.col("updated_at")))
    columns = ["asset_key", "name", "parsed", *order]
    last = latest_per_key(assets.select(columns), ["asset_key", "name"], order)
    if kind.name == "query":
        last = rewrite_object(rewrite_query(last, mappings.tables, mappings.functions))
    return project_catalog(last, kind, as_of)


def rejected_rows(lines: DataFrame, kind: str | Kind, choice: Choice = Choice()) -> DataFrame:
    """Landed lines that the import leaves out although they may have been wanted."""
    rejected = quarantine(lines, kind).select("raw", "reason")
    if choice.since:
        unclear = undated(filter_tags(read_assets(lines, kind), choice.tags))
        rejected = rejected.unionByName(unclear.select("raw", "reason"))
    return rejected


def import_assets(
    spark: SparkSession,
    config: Config,
    kind: str | Kind,
    choice: Choice = Choice(),
    mappings: Mappings = Mappings(),
    as_of: datetime | None = None,
) -> tuple[str, str]:
    """Put the landed assets into the catalog; returns the paths of the new version of the
    table and of the lines that were rejected."""
    kind = kind_of(kind)
    lines = read_json_lines(spark, f"{config.landing}/{kind.collection}")
    return import_lines(lines, config, kind, choice, mappings, as_of)


def import_lines(
    lines: DataFrame,
    config: Config,
    kind: str | Kind,
    choice: Choice = Choice(),
    mappings: Mappings = Mappings(),
    as_of: datetime | None = None,
) -> tuple[str, str]:
    """The same of lines. They are read and parsed once: what is found is written with the
    reason against it, and good and rejected ones are then taken from there."""
    kind, run = kind_of(kind), uuid.uuid4().hex
    scratch = f"{config.catalog_root}/staged"
    found = classify_assets(lines, kind).withColumn("tie", F.xxhash64("raw"))
    wanted = has_tag(choice.tags) if choice.tags else F.lit(True)
    undatable = F.when(F.lit(bool(choice.since)) & wanted & updated().isNull(), UNDATED)
    found = found.withColumn("reason", F.coalesce("reason", undatable))
    kept_raw = F.when(F.col("reason").isNotNull(), F.col("raw"))
    found = written_once(found.withColumn("raw", kept_raw), f"landed-{kind.collection}", scratch)

    rejected = f"{config.catalog_root}/rejected/{kind.collection}/{run}"
    found.where("reason IS NOT NULL").select("raw", "reason").write.parquet(rejected)
    rows = _catalog_rows(choice.of(found.where("reason IS NULL")), kind, mappings, as_of)
    staged = written_once(rows, f"staged-{kind.collection}", scratch)
    return upsert_catalog(stage(staged, f"staged_{kind.table}"), config, kind), rejected


def run_report(lines: DataFrame, kind: str | Kind, choice: Choice = Choice()) -> DataFrame:
    """What a run over landed lines does, as (outcome, n): 'imported' for chosen assets, 'not
    chosen' for the other readable ones, else the reason of the rejection. One pass."""
    kind = kind_of(kind)
    found = classify_assets(lines, kind)
    wanted = has_tag(choice.tags) if choice.tags else F.lit(True)
    undatable = F.when(F.lit(bool(choice.since)) & wanted & updated().isNull(), UNDATED)
    since = modified_since(choice.since) if choice.since else F.lit(True)
    chosen = F.when(wanted & F.coalesce(since, F.lit(False)), "imported").otherwise("not chosen")
    outcome = F.coalesce("reason", undatable, chosen)
    return found.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


def clean_export(
    spark: SparkSession,
    source: str,
    path: str,
    mappings: Mappings,
    secrets: Iterable[str] = SECRET_FIELDS,
    documents_out: int = 1,
) -> DataFrame:
    """Rewrite the queries of an export and write it to another path; returns what was left out,
    (object_key, raw): entries that are no JSON objects, and documents that are none, without key.
    Documents too large for a cell are named by their path instead."""
    entries, unread = read_export_entries(spark, source)
    entries = entries.withColumn("parsed", F.explode(F.array(parse_rows(entries))))
    broken = unread.select(
        F.lit(None).cast("string").alias("object_key"),
        F.coalesce("value", "source_file").alias("raw"),
        F.lit(None).cast("variant").alias("parsed"),
    )
    found = written_once(entries.select("object_key", "raw", "parsed").unionByName(broken), "export")
    rows = found.where("parsed IS NOT NULL").drop("raw")
    moved = rewrite_object(rewrite_query(rows, mappings.tables, mappings.functions), drop=secrets)
    write_keyed_json(moved.select("object_key", F.col("object").alias("raw")), path, documents_out)
    return found.where("parsed IS NULL").drop("parsed")


def catalog_assets(spark: SparkSession, config: Config, kind: str | Kind) -> DataFrame:
    """The catalog's objects as assets."""
    kind = kind_of(kind)
    rows = read_catalog(spark, config, kind)
    return read_assets(rows.select(F.col(kind.object_column).alias("raw")), kind).drop("raw")


def export_assets(spark: SparkSession, path: str, kind: str | Kind) -> DataFrame:
    """The objects of an export, raw or cleaned, as assets."""
    return read_assets(read_keyed_json(spark, path).select("raw"), kind).drop("raw")


class Upload:
    """Requests of an upload, step by step, each from the answers to the steps before.

    ``queries`` and ``dashboards`` are the assets to upload, from the catalog or an export and
    chosen as wanted; queries go to the target data source ``data_source_id``. Charts and
    widgets are written to the shared folder once, as every step needs them and joins count
    their keys: to the one the cluster names, else to ``scratch`` if given.
    """

    def __init__(
        self,
        queries: DataFrame,
        dashboards: DataFrame,
        data_source_id: str,
        marker_tag: str,
        scratch: str | None = None,
    ) -> None:
        self.queries, self.dashboards = queries, dashboards
        self.data_source_id, self.marker_tag = data_source_id, marker_tag
        self.charts = written_once(explode_visualizations(queries), "charts", scratch)
        self.widgets = written_once(explode_widgets(dashboards), "widgets", scratch)

    @classmethod
    def from_catalog(
        cls,
        spark: SparkSession,
        config: Config,
        data_source_id: str,
        mode: str = "ALL",
        tags: Sequence[str] = (),
        query_names: Sequence[str] = (),
        dashboard_names: Sequence[str] = (),
    ) -> Upload:
        """Upload what is chosen from the catalog; queries and dashboards have names of their own."""
        chosen = [
            select_for_upload(catalog_assets(spark, config, kind), mode, tags, names)
            for kind, names in (("query", query_names), ("dashboard", dashboard_names))
        ]
        return cls(*chosen, data_source_id, config.marker_tag, f"{config.catalog_root}/staged")

    def query_requests(self) -> DataFrame:
        return outbox.query_requests(self.queries, F.lit(self.data_source_id), self.marker_tag)

    def chart_requests(self, responses: DataFrame) -> DataFrame:
        return outbox.visualization_requests(self.charts, _step(responses, STEP_QUERY))

    def dashboard_requests(self) -> DataFrame:
        return outbox.dashboard_requests(self.dashboards, self.marker_tag)

    def id_map(self, responses: DataFrame) -> DataFrame:
        sent = self.charts.where("visualization IS NOT NULL")
        sent = sent.withColumn("source_key", outbox.child_key())
        return build_id_map(sent, _step(responses, STEP_VISUALIZATION))

    def widget_requests(self, responses: DataFrame) -> DataFrame:
        created = _step(responses, STEP_DASHBOARD)
        return outbox.widget_requests(self.widgets, created, self.id_map(responses))

    def status(self, responses: DataFrame) -> DataFrame:
        """Messages per asset in the order of steps.

        Charts and widgets name their parents, and a parent without any has a row as well.
        """
        said = [
            outbox.push_messages(self.charts, responses, STEP_QUERY),
            outbox.child_messages(self.charts, responses, STEP_VISUALIZATION),
            outbox.no_chart_messages(self.charts),
            outbox.push_messages(self.widgets, responses, STEP_DASHBOARD),
            outbox.child_messages(self.widgets, responses, STEP_WIDGET),
        ]
        return outbox.collect_status(outbox.build_outbox(*said))

    def counts(self, responses: DataFrame) -> DataFrame:
        """Requests of each step answered with success or failure: (step, succeeded, failed)."""
        return outbox.answer_counts(responses)


def catalog_with_messages(
    spark: SparkSession, config: Config, kind: str | Kind, status: DataFrame
) -> DataFrame:
    """Catalog rows with what became of them as ``upload_message``.

    An asset has about as many messages as children in its own JSON text.
    """
    kind = kind_of(kind)
    ordered = F.array_sort(F.collect_list(F.struct("step", "pos", "message")))
    texts = F.transform(ordered, lambda said: said["message"])
    said = status.groupBy("source_key").agg(F.array_join(texts, "\n").alias("said"))
    rows = read_catalog(spark, config, kind)
    joined = rows.withColumn(
        "source_key", source_key(F.col(kind.key_column), F.col(kind.name_column))
    ).join(said, "source_key", "left")
    message = F.coalesce("said", "upload_message")
    return joined.withColumn("upload_message", message).select(rows.columns)


def _step(responses: DataFrame, step: int) -> DataFrame:
    return responses.where(F.col("step") == step)


def removed_objects(
    inventory: DataFrame,
    kind: str | Kind,
    config: Config,
    tags: Sequence[str] | None = None,
    names: Sequence[str] = (),
) -> DataFrame:
    """The target's objects of one kind by tag or name, and all of the kind that share their names.

    Without tags or names it is what earlier uploads created, by their marker tag.
    """
    if tags is None:
        tags = () if names else (config.marker_tag,)
    of_kind = inventory.where(F.col("kind") == kind_of(kind).name)
    return expand_by_name(of_kind, chosen_for_delete(tags, names))


def remove_requests(
    inventory: DataFrame,
    kind: str | Kind,
    config: Config,
    tags: Sequence[str] | None = None,
    names: Sequence[str] = (),
) -> DataFrame:
    """Requests that delete the removed objects; what became of them: ``outbox.delete_messages``."""
    return outbox.build_delete_outbox(removed_objects(inventory, kind, config, tags, names))
