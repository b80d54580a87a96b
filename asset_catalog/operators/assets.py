"""Landed JSON rows as assets with key columns, and the rows that cannot be read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from asset_catalog.functions.json_fields import LONGEST_TEXT, parse_rows, text_field
from asset_catalog.schemas import Kind, kind_of


def source_key(key: Column, name: Column) -> Column:
    """What tells an asset from all others: its key is not enough, since queries of equal text
    have equal hashes. A key holds no slash, so the first one ends it."""
    return F.concat_ws("/", key, name)


def changed_at(updated_at: Column) -> Column:
    """The time in a text of any precision and offset; null when it is none. Texts cannot be
    compared: a whole second sorts after its fractions, and offsets do not sort at all."""
    return F.try_to_timestamp(updated_at)


def read_assets(rows: DataFrame, kind: str | Kind, raw: str = "raw") -> DataFrame:
    """Rows with a readable object, its key fields as columns and the VARIANT ``parsed``.

    ``source_key`` tells the asset from all others in requests and responses.

    Unreadable rows are left to :func:`quarantine`. Keeping the good ones is done by the
    generator, so each text is parsed once and its key fields are read once; a filter would be
    pushed below and parse again.
    """
    kind = kind_of(kind)
    found = rows.withColumn("_found", parse_rows(rows, raw))
    fields = F.struct(
        F.col("_found").alias("parsed"),
        text_field(F.col("_found"), kind.key_field).alias("asset_key"),
        text_field(F.col("_found"), "name").alias("name"),
    )
    usable = F.filter(
        F.array(fields),
        lambda asset: asset["parsed"].isNotNull() & asset["asset_key"].isNotNull() & asset["name"].isNotNull(),
    )
    return found.select(*rows.columns, F.inline(usable)).select("*", *_other_fields(F.col("asset_key"), F.col("name")))


def _fields(kind: Kind) -> list[Column]:
    key, name = text_field(F.col("parsed"), kind.key_field), text_field(F.col("parsed"), "name")
    return [key.alias("asset_key"), name.alias("name"), *_other_fields(key, name)]


def _other_fields(key: Column, name: Column) -> list[Column]:
    parsed = F.col("parsed")
    return [
        source_key(key, name).alias("source_key"),
        F.try_variant_get(parsed, "$.tags", "array<string>").alias("tags"),
        text_field(parsed, "updated_at").alias("updated_at"),
    ]


def classify_assets(rows: DataFrame, kind: str | Kind, raw: str = "raw") -> DataFrame:
    """All rows, parsed once: the columns of :func:`read_assets`, and ``reason``, which is null for
    readable ones and else what :func:`quarantine` says. To be written before it is filtered."""
    kind = kind_of(kind)
    parsed = rows.withColumn("parsed", F.explode(F.array(parse_rows(rows, raw))))
    return parsed.select("*", *_fields(kind), _reason(F.col("parsed"), raw, kind).alias("reason"))


def _reason(parsed: Column, raw: str, kind: Kind) -> Column:
    long = F.length(raw) > LONGEST_TEXT
    return (
        F.when(parsed.isNull() & long, "not one JSON object or too long for one")
        .when(parsed.isNull(), "not one JSON object")
        .when(text_field(parsed, "name").isNull(), "no name")
        .when(text_field(parsed, kind.key_field).isNull(), f"no {kind.key_field}")
    )


def quarantine(rows: DataFrame, kind: str | Kind, raw: str = "raw") -> DataFrame:
    """Rows that :func:`read_assets` leaves out, with the reason."""
    kind = kind_of(kind)
    found = F.transform(F.array(parse_rows(rows, raw)), lambda parsed: _reason(parsed, raw, kind))
    return rows.withColumn("reason", F.explode(F.filter(found, lambda why: why.isNotNull())))


def latest_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row per key in the given order, which should leave no ties.

    Ranking is cut to one row per key before the shuffle, so a key that holds most of the rows
    reaches its task with one row per input partition.
    """
    last_first = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return rows.withColumn("_rank", F.row_number().over(last_first)).where("_rank = 1").drop("_rank")


def distinct_names(rows: DataFrame) -> DataFrame:
    return rows.select("name").distinct()


def run_counts(rows: DataFrame, selected: Column) -> DataFrame:
    """How many assets there are and how many are selected, in one pass."""
    return rows.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.coalesce(selected, F.lit(False))).alias("selected"),
    )


def page_after(rows: DataFrame, order: Sequence[str], last: Sequence | None, size: int) -> DataFrame:
    """The page that follows the row whose ``order`` columns are ``last``, the first one for None.

    The rows before it are passed by in the scan, so a deep page costs no more than the first:
    each task hands on ``size`` rows at most. ``order`` must tell rows apart and hold no nulls.
    """
    if last is not None:
        beyond = F.lit(False)
        for column, value in reversed(list(zip(order, last, strict=True))):
            beyond = (F.col(column) > F.lit(value)) | ((F.col(column) == F.lit(value)) & beyond)
        rows = rows.where(beyond)
    return rows.orderBy(*order).limit(size)


def page(rows: DataFrame, order: Sequence[str], number: int, size: int) -> DataFrame:
    """Page ``number`` (from 1) of the rows in the given order, for the first few pages: all rows
    before it meet in one task. ``page_after`` goes on from any row, ``Pages`` finds pages of any number."""
    return rows.orderBy(*order).offset((number - 1) * size).limit(size)


def preview(rows: DataFrame, order: Sequence[str], count: int = 1) -> DataFrame:
    return rows.orderBy(*order).limit(count)
