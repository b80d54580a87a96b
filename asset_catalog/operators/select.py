"""Which assets take part: by tag, date and name."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asset_catalog.operators.joins import join_each
from asset_catalog.schemas import ConfigError

# The choices for what to insert.
INSERT_MODES = ("Tags", "Query Name", "Both (and)", "Both (or)", "ALL")

_DATE_TIME = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}$"


def has_tag(tags: Sequence[str]) -> Column:
    """Shares at least one tag; never null."""
    if not tags:
        return F.lit(False)
    wanted = F.array(*[F.lit(tag) for tag in tags])
    return F.coalesce(F.arrays_overlap(F.col("tags"), wanted), F.lit(False))


def has_name(names: Sequence[str]) -> Column:
    """Named exactly like one of the names; never null."""
    if not names:
        return F.lit(False)
    return F.coalesce(F.col("name").isin(list(names)), F.lit(False))


def filter_tags(rows: DataFrame, tags: Sequence[str]) -> DataFrame:
    """Assets that share a tag with the list; all assets when the list is empty."""
    return rows.where(has_tag(tags)) if tags else rows


def updated(column: str = "updated_at") -> Column:
    """The first 19 characters as a time without zone; null when they are none."""
    text = F.substring(column, 1, 19)
    return F.when(text.rlike(_DATE_TIME), text.try_cast("timestamp_ntz"))


def modified_since(date: str) -> Column:
    """Updated on or after midnight of the date; null where that cannot be told."""
    try:
        since = datetime.strptime(date, "%Y-%m-%d")
    except ValueError:
        raise ConfigError(f"date must look like 2021-11-01, not {date!r}") from None
    return updated() >= F.lit(since.isoformat()).cast("timestamp_ntz")


def filter_modified_since(rows: DataFrame, date: str | None) -> DataFrame:
    """Assets updated on or after midnight of the date; all assets when none is given."""
    return rows.where(modified_since(date)) if date else rows


UNDATED = "no readable updated_at"


def undated(rows: DataFrame) -> DataFrame:
    """Assets that a date filter cannot judge, with the reason."""
    return rows.where(updated().isNull()).withColumn("reason", F.lit(UNDATED))


def filter_names(rows: DataFrame, mode: str, names: Sequence[str] | DataFrame = ()) -> DataFrame:
    """All assets in mode 'all'; otherwise those named in the list or in a table of names."""
    if mode == "all":
        return rows
    if isinstance(names, DataFrame):
        return join_each(rows, names.select("name").distinct(), "name", "left_semi")
    return rows.where(has_name(names))


def select_for_upload(
    rows: DataFrame, mode: str, tags: Sequence[str] = (), names: Sequence[str] = ()
) -> DataFrame:
    """Assets chosen by tag, by name, by both, by either, or all of them."""
    if mode not in INSERT_MODES:
        raise ConfigError(f"insert mode must be one of {', '.join(INSERT_MODES)}, not {mode!r}")
    chosen = {
        "Tags": has_tag(tags),
        "Query Name": has_name(names),
        "Both (and)": has_tag(tags) & has_name(names),
        "Both (or)": has_tag(tags) | has_name(names),
    }
    return rows if mode == "ALL" else rows.where(chosen[mode])


def chosen_for_delete(tags: Sequence[str] = (), names: Sequence[str] = ()) -> Column:
    return has_tag(tags) | has_name(names)


def select_for_delete(
    rows: DataFrame, tags: Sequence[str] = (), names: Sequence[str] = ()
) -> DataFrame:
    """Target objects that carry one of the tags or one of the names."""
    return rows.where(chosen_for_delete(tags, names))


def select_all(rows: DataFrame, *, confirm: bool = False) -> DataFrame:
    """Everything, for deletion; must be asked for explicitly."""
    if not confirm:
        raise ConfigError("deleting everything needs confirm=True")
    return rows


def expand_by_name(rows: DataFrame, chosen: Column) -> DataFrame:
    """Every object that shares its name, and its kind where rows tell it, with a chosen one.

    Deletion goes by name, so objects that were not chosen themselves are included; they are
    marked ``collateral``.
    """
    keys = [c for c in ["kind", "name"] if c in rows.columns]
    marked = rows.withColumn("collateral", ~F.coalesce(chosen, F.lit(False)))
    names = marked.where(~F.col("collateral")).select(*keys).distinct()
    return marked.join(names, keys, "left_semi")
