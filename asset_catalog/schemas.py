"""Column layouts shared by readers, operators and writers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


class ConfigError(ValueError):
    """A run was asked for with settings that cannot work."""


@dataclass(frozen=True)
class Kind:
    """How one kind of asset names its key and its catalog columns."""

    name: str
    key_field: str  # JSON field that identifies the asset
    listing_field: str  # JSON field that joins a listing to its detail
    collection: str  # path of the asset in the target service
    table: str
    prefix: str  # prefix of the catalog's name and object columns

    @property
    def name_column(self) -> str:
        return f"{self.prefix}_name"

    @property
    def key_column(self) -> str:
        return f"{self.prefix}_{self.key_field.removeprefix(self.prefix + '_')}"

    @property
    def object_column(self) -> str:
        return f"{self.prefix}_object"

    @property
    def merge_keys(self) -> list[str]:
        return [self.key_column, self.name_column]

    @property
    def catalog_schema(self) -> T.StructType:
        return T.StructType([
            T.StructField(self.name_column, T.StringType()),
            T.StructField(self.key_column, T.StringType()),
            T.StructField("tags", T.ArrayType(T.StringType())),
            T.StructField(self.object_column, T.StringType()),
            T.StructField("update_date_time", T.StringType()),
            T.StructField("is_migrated", T.BooleanType()),
            T.StructField("upload_message", T.StringType()),
        ])


# Field, path and table names of the exported objects and of the catalog.
QUERY = Kind("query", "query_hash", "id", "queries", "cleaned_queries", "query")
DASHBOARD = Kind("dashboard", "slug", "slug", "dashboards", "cleaned_dashboards", "dashboard")
KINDS = {"query": QUERY, "dashboard": DASHBOARD}

# Order in which requests must be answered: each step needs ids given out by an earlier one.
STEP_QUERY, STEP_VISUALIZATION, STEP_DASHBOARD, STEP_WIDGET = 1, 2, 3, 4
# Deletions have steps of their own, so that no answer to one is taken for a creation's.
STEP_DELETE = {"query": 5, "dashboard": 6}

OUTBOX = T.StructType([
    T.StructField("step", T.IntegerType()),
    T.StructField("method", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("body", T.StringType()),
    T.StructField("source_key", T.StringType()),
])

RESPONSES = T.StructType([
    T.StructField("step", T.IntegerType()),
    T.StructField("source_key", T.StringType()),
    T.StructField("status", T.IntegerType()),
    T.StructField("new_id", T.StringType()),
    T.StructField("message", T.StringType()),
])


def kind_of(kind: str | Kind) -> Kind:
    if isinstance(kind, Kind):
        return kind
    try:
        return KINDS[kind]
    except KeyError:
        raise ConfigError(f"unknown kind of asset: {kind!r}") from None
