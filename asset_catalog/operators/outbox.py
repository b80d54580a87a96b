"""Requests to the target service as rows, and what their answers mean.

A sender outside of this library delivers the requests of one step and lands the responses;
the requests of the next step are then built by joining to those. Nothing here opens a
connection, so a task that runs twice cannot create anything twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from asset_catalog.functions.json_fields import SECRET_FIELDS, blank_column
from asset_catalog.operators.payloads import (
    body_text,
    dashboard_fields,
    query_fields,
    visualization_fields,
    widget_fields,
)
from asset_catalog.operators.relate import attach_parent_id, remap_visualization_ids, succeeded
from asset_catalog.schemas import (
    OUTBOX,
    KINDS,
    RESPONSES,
    STEP_DASHBOARD,
    STEP_DELETE,
    STEP_QUERY,
    STEP_VISUALIZATION,
    STEP_WIDGET,
)
from asset_catalog.sources.landed import read_json_lines
from asset_catalog.sources.scratch import written_once


def _requests(
    rows: DataFrame, step: int, path: str, fields: Column, source_key: Column, keep: Sequence[str] = ()
) -> DataFrame:
    requests = rows.select(
        F.lit(step).alias("step"),
        F.lit("POST").alias("method"),
        F.lit(path).alias("path"),
        body_text(fields).alias("body"),
        source_key.alias("source_key"),
        *keep,
    )
    return blank_column(requests, "body", SECRET_FIELDS)


def child_key() -> Column:
    """Source key of a chart or widget: its parent's and its place in it."""
    return F.concat_ws("#", F.col("parent_key"), F.col("pos").cast("string"))


def query_requests(
    queries: DataFrame, data_source_id: Column, marker: str, keep: Sequence[str] = ()
) -> DataFrame:
    """Requests for queries, with the columns of the queries to keep beside them."""
    fields = query_fields(F.col("parsed"), data_source_id, marker)
    return _requests(queries, STEP_QUERY, "queries", fields, F.col("source_key"), keep)


def visualization_requests(charts: DataFrame, query_responses: DataFrame) -> DataFrame:
    """Requests for the charts of queries that were created."""
    ready = attach_parent_id(charts.where("visualization IS NOT NULL"), query_responses)
    fields = visualization_fields(F.col("visualization"), F.col("parent_id"))
    return _requests(ready, STEP_VISUALIZATION, "visualizations", fields, child_key())


def dashboard_requests(dashboards: DataFrame, marker: str, keep: Sequence[str] = ()) -> DataFrame:
    """Requests for dashboards, with the columns of the dashboards to keep beside them."""
    fields = dashboard_fields(F.col("parsed"), marker)
    return _requests(dashboards, STEP_DASHBOARD, "dashboards", fields, F.col("source_key"), keep)


def widget_requests(
    widgets: DataFrame, dashboard_responses: DataFrame, id_map: DataFrame
) -> DataFrame:
    """Requests for the widgets of dashboards that were created, with the new chart ids."""
    present = widgets.where("widget IS NOT NULL")
    ready = remap_visualization_ids(present, id_map)
    ready = attach_parent_id(ready, dashboard_responses)
    fields = widget_fields(F.col("widget"), F.col("parent_id"), F.col("new_viz_id"))
    return _requests(ready, STEP_WIDGET, "widgets", fields, child_key())


def requests_and_children(
    requests: DataFrame, children: Callable[[DataFrame], DataFrame], name: str
) -> tuple[DataFrame, DataFrame]:
    """The requests for assets and the rows of ``children`` of these assets, which are read, parsed
    and written to the shared folder once.

    ``requests`` keep ``parsed``, and ``children`` gives each asset a row at least, as
    :func:`explode_visualizations` and :func:`explode_widgets` do. The body goes with the first of them.
    """
    own = F.coalesce(F.col("pos"), F.lit(0)) == 0
    rows = written_once(children(requests).withColumn("body", F.when(own, F.col("body"))), name)
    sent = rows.where(own).withColumnRenamed("parent_key", "source_key")
    return sent.select(OUTBOX.names), rows.drop("step", "method", "path", "body")


def build_outbox(*requests: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, requests)


def _by_kind(values: dict[str, object]) -> Column:
    """The value for the row's kind; null for any other kind."""
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])[F.col("kind")]


def build_delete_outbox(selected: DataFrame) -> DataFrame:
    """One DELETE per selected object of the target service, where its own ``kind`` says.

    Rows of a kind that the service does not know are left out."""
    known = selected.where(F.col("kind").isin(*KINDS))
    path = F.concat_ws("/", _by_kind({name: kind.collection for name, kind in KINDS.items()}), "id")
    return known.select(
        _by_kind(STEP_DELETE).alias("step"),
        F.lit("DELETE").alias("method"),
        path.alias("path"),
        F.lit(None).cast("string").alias("body"),
        F.col("id").alias("source_key"),
    )


_BAD = "_bad"


def _response(lines: DataFrame) -> DataFrame:
    schema = T.StructType([*RESPONSES.fields, T.StructField(_BAD, T.StringType())])
    parsed = F.from_json("raw", schema, {"columnNameOfCorruptRecord": _BAD})
    return lines.withColumn("response", parsed)


def _whole() -> Column:
    found = F.col("response")
    return F.coalesce(found[_BAD].isNull() & found["step"].isNotNull() & found["source_key"].isNotNull(), F.lit(False))


def response_rows(lines: DataFrame) -> DataFrame:
    """Responses of landed lines, with the time of their landing where lines tell it."""
    landed = [c for c in ["landed_at"] if c in lines.columns]
    good = _response(lines).where(_whole())
    return good.select(*[F.col(f"response.{name}").alias(name) for name in RESPONSES.names], *landed)


def rejected_responses(lines: DataFrame) -> DataFrame:
    """Lines that are no response: cut ones, and those that do not say what they answer."""
    bad = _response(lines).where(~_whole())
    cut = F.col("response").isNull() | F.col(f"response.{_BAD}").isNotNull()
    return bad.select("raw", F.when(cut, "not one JSON object").otherwise("no step or source key").alias("reason"))


def read_responses(spark, path: str) -> DataFrame:
    """Responses landed by the sender, one JSON object per line; what is none of them is in
    ``rejected_responses`` of the same lines."""
    return response_rows(read_json_lines(spark, path))


def write_outbox(outbox: DataFrame, path: str) -> None:
    """Requests for a sender, one directory per step."""
    outbox.select(OUTBOX.names).write.mode("overwrite").partitionBy("step").parquet(path)


def _answers(responses: DataFrame, step: int) -> DataFrame:
    """One answer per source key of a step: a success if there was any, the last to land."""
    landed = [c for c in ["landed_at"] if c in responses.columns]
    good = succeeded(F.col("status")).alias("good")
    best = F.max(F.struct(good, *landed, F.length("new_id").alias("digits"), "new_id", "message"))
    found = responses.where(F.col("step") == step).groupBy("source_key").agg(best.alias("best"))
    return found.select("source_key", "best.good", "best.new_id", F.col("best.message").alias("why"))


def push_messages(children: DataFrame, responses: DataFrame, step: int) -> DataFrame:
    """What became of each asset that was sent: (parent_key, step, pos, message).

    ``children`` are its charts or widgets; an asset without any has a row there as well.
    """
    answers = _answers(responses, step).withColumnRenamed("source_key", "parent_key")
    said = children.select("parent_key", "name").distinct().join(answers, "parent_key")
    return _messages(said, step, F.lit(0))


def child_messages(children: DataFrame, responses: DataFrame, step: int) -> DataFrame:
    """The same for the charts and widgets themselves, which have a place in their parent."""
    sent = children.select("parent_key", "name", "pos", child_key().alias("source_key"))
    said = sent.distinct().join(_answers(responses, step), "source_key")
    return _messages(said, step, F.col("pos"))


# What a step creates, for messages.
_NOUN = {
    STEP_QUERY: "query",
    STEP_VISUALIZATION: "chart of",
    STEP_DASHBOARD: "dashboard",
    STEP_WIDGET: "widget of",
}


def _messages(said: DataFrame, step: int, pos: Column) -> DataFrame:
    what = F.concat(F.lit(_NOUN[step] + " "), F.coalesce("name", F.lit("")))
    good = F.concat(F.lit("created "), what, F.lit(" as "), F.coalesce("new_id", F.lit("?")))
    bad = F.concat(F.lit("failed "), what, F.lit(": "), F.coalesce("why", F.lit("no reason given")))
    return said.select(
        "parent_key",
        F.lit(step).alias("step"),
        pos.cast("int").alias("pos"),
        F.when(F.col("good"), good).otherwise(bad).alias("message"),
    )


def delete_messages(selected: DataFrame, responses: DataFrame) -> DataFrame:
    """What became of each object that was to be deleted: (source_key, step, pos, message)."""
    known = selected.where(F.col("kind").isin(*KINDS))
    asked = known.select(F.col("id").alias("source_key"), "kind", "name", _by_kind(STEP_DELETE).alias("step"))
    good = F.bool_or(succeeded(F.col("status"))).alias("good")
    answers = responses.groupBy("step", "source_key").agg(good, F.max("message").alias("why"))
    what = F.concat_ws(" ", F.col("kind"), F.coalesce("name", F.lit("")), F.concat(F.lit("("), "source_key", F.lit(")")))
    bad = F.concat(F.lit("failed to delete "), what, F.lit(": "), F.coalesce("why", F.lit("no reason given")))
    return asked.distinct().join(answers, ["step", "source_key"]).select(
        "source_key",
        "step",
        F.lit(0).alias("pos"),
        F.when(F.col("good"), F.concat(F.lit("deleted "), what)).otherwise(bad).alias("message"),
    )


def answer_counts(responses: DataFrame) -> DataFrame:
    """How many requests of each step were answered with success, and how many were not at all:
    (step, succeeded, failed). A request that was sent again counts once."""
    one = responses.groupBy("step", "source_key").agg(F.bool_or(succeeded(F.col("status"))).alias("good"))
    return one.groupBy("step").agg(F.count_if("good").alias("succeeded"), F.count_if(~F.col("good")).alias("failed"))


def no_chart_messages(charts: DataFrame) -> DataFrame:
    """A message for each query that has no charts; such queries are created all the same."""
    return charts.where("pos IS NULL").select(
        "parent_key",
        F.lit(STEP_VISUALIZATION).alias("step"),
        F.lit(0).alias("pos"),
        F.concat(F.lit("no chart in query "), F.col("name")).alias("message"),
    )


def collect_status(messages: DataFrame) -> DataFrame:
    """The messages of all assets, one row each: (source_key, step, pos, message).

    A message that comes more than once, because an asset did, is kept once. Rows stay rows, so
    no asset's messages meet in one cell; ``step`` and ``pos`` give their order.
    """
    return messages.select(F.col("parent_key").alias("source_key"), "step", "pos", "message").distinct()
