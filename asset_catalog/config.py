"""Settings of a run. Secrets are not among them: nothing here talks to a service."""

from __future__ import annotations

import json
from dataclasses import dataclass, fields

from asset_catalog.schemas import ConfigError


@dataclass(frozen=True)
class Config:
    """Where assets land, where the catalog lives, and what is put on migrated objects."""

    landing: str
    catalog_root: str
    database: str = "asset_catalog"
    endpoint_name: str = ""
    # Tag put on every created object and selected by default on removal. Set it to the tag
    # that earlier runs used when their objects must still be found.
    marker_tag: str = "migrated"
    # Where positive, the catalog tables are cut into so many parts by their keys, each in so many
    # buckets: an upsert then moves and writes only what the pull touches.
    catalog_parts: int = 0
    catalog_buckets: int = 32

    def __post_init__(self) -> None:
        for name in ("landing", "catalog_root", "database", "marker_tag"):
            value = getattr(self, name)
            if not isinstance(value, str) or not value.strip():
                raise ConfigError(f"{name} must be a non-empty text")
        for name, least in (("catalog_parts", 0), ("catalog_buckets", 1)):
            value = getattr(self, name)
            if not isinstance(value, int) or value < least:
                raise ConfigError(f"{name} must be a number of {least} or more")
        for f in fields(self):
            value = getattr(self, f.name)
            if isinstance(value, str):
                object.__setattr__(self, f.name, value.strip().rstrip("/"))

    @classmethod
    def from_json(cls, text: str) -> Config:
        try:
            values = json.loads(text)
        except ValueError as error:
            raise ConfigError(f"settings are not JSON: {error}") from error
        known = {f.name for f in fields(cls)}
        unknown = sorted(set(values) - known)
        if unknown:
            raise ConfigError(f"unknown settings: {', '.join(unknown)}")
        try:
            return cls(**values)
        except TypeError as error:
            raise ConfigError(str(error)) from error
