"""Tag lists: as stored in assets and as typed by a user."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


# Fixed value: what is removed from stored tags.
_NOT_KEPT = "[^A-Za-z,_]"


def normalise_tags(tags_json: Column, *, typed: bool = False) -> Column:
    """Tags of a JSON array text.

    By default everything but letters, commas and underscores is removed before splitting at
    commas, so digits, blanks and hyphens vanish and ``[]`` gives one empty tag. ``typed``
    reads the array as it is instead.
    """
    if typed:
        return F.from_json(tags_json, "array<string>")
    return F.split(F.regexp_replace(tags_json, _NOT_KEPT, ""), ",")


def parse_tag_list(text: Column, *, separators: str = r"[,\s]+") -> Column:
    """Entries of a list typed as text, trimmed, empty ones dropped."""
    parts = F.transform(F.split(text, separators), lambda part: F.trim(part))
    return F.filter(parts, lambda part: part != "")


def parse_list(text: str | None, *, names: bool = False) -> list[str]:
    """The same for a setting: tags end at commas or blanks, names at commas only."""
    parts = re.split(r"," if names else r"[,\s]+", text or "")
    return [part.strip() for part in parts if part.strip()]
