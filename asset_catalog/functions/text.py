"""Rewriting names inside text: every key of a mapping is replaced in one left-to-right pass."""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from asset_catalog.schemas import ConfigError

# Characters tried as the mark between pieces of a text; one that no key contains is used.
_MARKS = [chr(code) for code in range(1, 9)]


def clean_mapping(pairs: Mapping[str, str] | Iterable[tuple[str, str]] | None) -> dict[str, str]:
    """Lower-case the keys and drop empty ones; two keys that become equal must agree."""
    items = pairs.items() if isinstance(pairs, Mapping) else (pairs or [])
    cleaned: dict[str, str] = {}
    for old, new in items:
        key = (old or "").lower()
        if not key:
            continue
        value = new or ""
        if cleaned.setdefault(key, value) != value:
            raise ConfigError(f"mapping gives two values for {key!r}")
    return cleaned


def longest_first_pattern(keys: Iterable[str]) -> str:
    """A regular expression that matches the longest key at a position.

    The keys are laid out as a tree of shared beginnings, so the work per character of text
    does not grow with the number of keys.
    """
    root: dict = {}
    for key in keys:
        node = root
        for char in key:
            node = node.setdefault(char, {})
        node[""] = {}
    return _branch(root)


def _branch(node: dict) -> str:
    lead = []
    while len(node) == 1:
        (char, node), = node.items()
        if not char:
            return "".join(lead)
        lead.append(_quoted(char))
    ways = [_quoted(char) + _branch(child) for char, child in node.items() if char]
    return f"{''.join(lead)}(?:{'|'.join(ways)}){'?' if '' in node else ''}"


def _quoted(char: str) -> str:
    return "\\" + char if char.isascii() and not char.isalnum() else char


def _lookup(part: Column, mapping: dict[str, str]) -> Column:
    """Value of ``part`` in the mapping. Map literals are searched linearly, so the mapping
    is cut into many short maps and the one to search is chosen by checksum."""
    count = 2 * len(mapping)
    buckets: list[dict[str, str]] = [{} for _ in range(count)]
    for key, value in mapping.items():
        buckets[zlib.crc32(key.encode()) % count][key] = value
    table = F.from_json(F.lit(json.dumps(buckets)), "array<map<string,string>>")
    bucket = F.get(table, (F.crc32(F.encode(part, "UTF-8")) % count).cast("int"))
    return F.element_at(bucket, part)


def multi_replace(
    text: Column,
    mapping: Mapping[str, str] | None,
    *,
    match: str = "substring",
    preserve_case: bool = False,
) -> Column:
    """Replace every occurrence of a mapping key by its value, longest key first.

    A replaced piece is never looked at again. The text is lower-cased unless
    ``preserve_case``; ``match='token'`` replaces whole identifiers only. Without any key the
    text comes back as it is.

    One regular-expression pass puts a mark on both sides of each match; splitting at the mark
    then gives gap, match, gap, match, ..., gap. A mark that is part of the text itself is
    matched too and shows up as an empty piece, so no text can be misread.
    """
    if match not in ("substring", "token"):
        raise ConfigError(f"match must be 'substring' or 'token', not {match!r}")
    mapping = clean_mapping(mapping)
    if not mapping:
        return text
    taken = set("".join(mapping))
    mark = next((m for m in _MARKS if m not in taken), None)
    if mark is None:
        raise ConfigError("mapping keys use every control character kept for marking")
    keys = longest_first_pattern(mapping)
    # Where no match can begin, one look at the character says so.
    first = "".join(_quoted(char) for char in sorted({key[0] for key in mapping}))
    if match == "token":
        keys = rf"(?<![\p{{L}}\p{{N}}_])(?:{keys})(?![\p{{L}}\p{{N}}_])"
    flags = "(?iu)" if preserve_case else ""
    source = text if preserve_case else F.lower(text)
    marked = F.regexp_replace(source, F.lit(f"{flags}(?=[{first}{mark}])(?:({keys})|{mark})"), F.lit(f"{mark}$1{mark}"))

    def piece(part: Column, position: Column) -> Column:
        key = F.lower(part) if preserve_case else part
        kept = F.when(part == "", F.lit(mark)).otherwise(part)
        return F.when(position % 2 == 0, part).otherwise(F.coalesce(_lookup(key, mapping), kept))

    return F.array_join(F.transform(F.split(marked, mark, -1), piece), "")


def rewrite_text(
    text: Column,
    tables: Mapping[str, str] | None,
    functions: Mapping[str, str] | None,
    **options,
) -> Column:
    """Apply the table mapping, then the function mapping to what the first pass produced."""
    return multi_replace(multi_replace(text, tables, **options), functions, **options)
