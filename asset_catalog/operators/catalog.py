"""Catalog rows: their projection from assets and the upsert of a new pull."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asset_catalog.functions.json_fields import redact, text_field
from asset_catalog.functions.tags import normalise_tags
from asset_catalog.schemas import Kind, kind_of


def project_catalog(
    assets: DataFrame,
    kind: str | Kind,
    as_of: datetime | Column | None = None,
    *,
    typed_tags: bool = False,
) -> DataFrame:
    """Catalog rows of assets: key fields, normalised tags, the object as JSON text.

    The object is the column ``object`` where a rewrite made one, else the redacted asset.
    ``as_of`` is the load time, now unless given.
    """
    kind = kind_of(kind)
    parsed = F.col("parsed")
    time = F.current_timestamp() if as_of is None else as_of
    time = time if isinstance(time, Column) else F.lit(time)
    return assets.select(
        F.col("name").alias(kind.name_column),
        F.col("asset_key").alias(kind.key_column),
        normalise_tags(text_field(parsed, "tags"), typed=typed_tags).alias("tags"),
        (F.col("object") if "object" in assets.columns else redact(parsed)).alias(
            kind.object_column
        ),
        time.cast("string").alias("update_date_time"),
        F.lit(False).alias("is_migrated"),
    )


def stage(rows: DataFrame, name: str) -> DataFrame:
    """Register rows as a view."""
    rows.createOrReplaceTempView(name)
    return rows


# Rows of a side of a join that Spark may still send to every executor by way of the driver.
BROADCAST_ROWS = 50_000


def _side(rows: DataFrame, count: int | None) -> DataFrame:
    """A side of a join, which is not broadcast if it is known to have many rows: Spark guesses the bytes of
    rows from the files that they come from, where they may be a tenth."""
    return rows if count is None or count <= BROADCAST_ROWS else rows.hint("merge")


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    keep: Sequence[str] = ("upload_message",),
    come_by: tuple[int, Sequence[Column]] | None = None,
    counts: tuple[int | None, int | None] = (None, None),
) -> DataFrame:
    """The target with every source row put in: replacing the row with equal keys, or added.

    ``source`` holds each key once and lacks the columns ``keep``: a replaced row keeps the
    target's values there, a new row gets null. A null in a key equals nothing.

    Two joins instead of a full outer one: neither moves the target when the source is small
    enough for Spark to broadcast, and the second reads only keys and kept columns of it.
    ``come_by`` deals the source's rows into so many tasks by some columns, so that they write few files.
    ``counts`` are the rows of target and source, where known; many are never broadcast.
    """
    keys = list(keys)
    stay = target.join(_side(source.select(keys), counts[1]), keys, "left_anti")
    come = source.join(_side(target.select(*keys, *keep), counts[0]), keys, "left").select(target.columns)
    if come_by:
        come = come.repartition(come_by[0], *come_by[1])
    return stay.unionByName(come)


def merge_into(source: DataFrame, table: str, keys: Sequence[str]) -> None:
    """The same by MERGE, for table formats that can change rows in place. Untried: no such format
    is at hand, and parquet refuses it."""
    target = table.rsplit(".", 1)[-1]
    match = [F.col(f"source.{k}") == F.col(f"{target}.{k}") for k in keys]
    condition = match[0]
    for part in match[1:]:
        condition = condition & part
    values = {c: F.col(f"source.{c}") for c in source.columns}
    message = {"upload_message": F.lit(None).cast("string")}
    (
        source.alias("source")
        .mergeInto(table, condition)
        .whenMatched()
        .update(values)
        .whenNotMatched()
        .insert({**values, **message})
        .merge()
    )
