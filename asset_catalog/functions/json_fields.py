"""Fields of asset JSON. A text is parsed once to a VARIANT and all fields are read from that."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The JSON texts of values that count as "nothing given".
_EMPTY = ["null", '""', "{}", "[]", "0", "0.0", "-0.0", "false"]

# Characters of one text that Spark's JSON parser takes unless told otherwise.
LONGEST_TEXT = 20_000_000

# Fields that hold secrets. Dashboards embed queries, so they occur inside too.
SECRET_FIELDS = ("api_key",)


def parse_object(raw: Column) -> Column:
    """The parsed text, or null when the text is not exactly one JSON object.

    Spark's parser stops after the first value. Wrapping the text in brackets makes anything
    that follows an error or a second element. Of a key given twice the last value counts, for
    which the active session's setting is changed; where the rows are known, :func:`parse_rows`
    changes that of their own session instead.
    """
    _take_equal_keys(SparkSession.active())
    return _parsed(raw)


def _take_equal_keys(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


def _parsed(raw: Column) -> Column:
    text = F.concat(F.lit("["), raw, F.lit("]"))
    long = F.from_json(text, "variant", {"maxStringLen": str(2**31 - 1)})  # up to a VARIANT's 128 MiB
    wrapped = F.coalesce(F.try_parse_json(text), F.when(F.length(raw) > LONGEST_TEXT, long))
    values = F.array(F.try_variant_get(wrapped, "$", "array<variant>"))
    single = F.transform(values, lambda found: F.when(F.size(found) == 1, F.get(found, F.lit(0))))
    # Trimming walks through the whole text, so it is left to those that end otherwise.
    closed = raw.endswith("}") | F.rtrim(raw, F.lit(" \t\r\n")).endswith("}")
    return F.when(closed, F.get(single, F.lit(0)))


def parse_rows(rows: DataFrame, raw: str = "raw") -> Column:
    """:func:`parse_object` of a column of these rows, with keys that are given twice.

    Whether Spark takes such keys is a setting of the session that runs the rows. It is set there: a
    stream hands its batches over in a session of its own, which is not the active one."""
    _take_equal_keys(rows.sparkSession)
    return _parsed(F.col(raw))


def text_field(parsed: Column, name: str) -> Column:
    """A field as text; arrays and objects as JSON text; null when absent or JSON null."""
    return F.try_variant_get(parsed, f"$.{name}", "string")


def text_fields(raw: Column, *names: str) -> Column:
    """Some top-level fields of a JSON text as a struct of texts, read in one pass."""
    return F.from_json(raw, ", ".join(f"`{name}` string" for name in names))


def member(parsed: Column, name: str) -> Column:
    """A field with its type kept; null when absent."""
    return F.try_variant_get(parsed, f"$.{name}", "variant")


def elements(parsed: Column, name: str) -> Column:
    """An array field as an array of VARIANT; null when absent or no array."""
    return F.try_variant_get(parsed, f"$.{name}", "array<variant>")


def set_and_drop(parsed: Column, new: Mapping[str, Column], drop: Iterable[str] = ()) -> Column:
    """JSON text of the object with some fields replaced and some left out, types kept.

    Fields to leave out are blanked in embedded objects.
    """
    entries = parsed.try_cast("map<string,variant>")
    drop = list(drop)
    if drop:
        entries = F.map_filter(entries, lambda key, value: ~key.isin(drop))

    def replaced(key: Column, value: Column) -> Column:
        for name, column in new.items():
            value = F.when(key == name, column.cast("variant")).otherwise(value)
        return value

    if new:
        entries = F.transform_values(entries, replaced)
    return blank(F.to_json(entries), drop)


def blank(json: Column, fields: Iterable[str]) -> Column:
    """JSON text as Spark writes it, with null in place of the fields' values at any depth.

    A quotation mark inside a text is written with a backslash, so only real fields match. Texts
    that do not hold a field's name are not searched.
    """
    def without(field: str) -> Callable[[Column], Column]:
        return lambda text: _blank(text, field)

    for field in fields:
        json = _once(json, without(field))
    return json


def blank_column(rows: DataFrame, name: str, fields: Iterable[str]) -> DataFrame:
    """:func:`blank` of a column. Making the text is a step of its own here, which Spark compiles."""
    for field in fields:
        rows = rows.withColumn(name, _blank(F.col(name), field))
    return rows


def _once(value: Column, function: Callable[[Column], Column]) -> Column:
    """The function of a value that it uses several times and that is computed once."""
    return F.get(F.transform(F.array(value), function), F.lit(0))


def _blank(json: Column, field: str) -> Column:
    value = r'(?:"(?:[^"\\]++|\\.)*+"|[-+0-9.eE]++|true|false)'
    plain = F.regexp_replace(json, rf'(?<!\\)"{re.escape(field)}":{value}', f'"{field}":null')
    held = F.contains(json, F.lit(f'"{field}":'))
    return F.when(held, _once(plain, lambda text: _blank_nested(text, field))).otherwise(json)


def _blank_nested(json: Column, field: str) -> Column:
    """The same for values that are arrays or objects, which may hold the field again.

    The text is cut behind each such field and put together from its end: what stands behind a
    cut is then free of the field, and starts with the value. Parsing takes one value and
    leaves what follows, so the length of the parsed value's text tells where the rest starts.
    """
    nested = rf'(?<!\\)"{re.escape(field)}":(?=[\[{{])'

    def without_value(rest: Column, part: Column) -> Column:
        def after(text: Column) -> Column:
            value = F.to_json(F.try_parse_json(text))
            return F.concat(F.lit(f'"{field}":null'), F.substring(text, F.length(value) + 1, F.length(text)))

        return _once(F.concat(part, rest), after)

    def joined(parts: Column) -> Column:
        tail = F.aggregate(F.reverse(F.slice(parts, F.lit(2), F.size(parts))), F.lit(""), without_value)
        return F.concat(F.get(parts, F.lit(0)), tail)

    return F.when(json.rlike(nested), _once(F.split(json, nested), joined)).otherwise(json)


def redact(parsed: Column, secrets: Iterable[str] = SECRET_FIELDS) -> Column:
    """JSON text of the object without its secret fields, which embedded objects keep as null."""
    return set_and_drop(parsed, {}, secrets)


def or_default(value: Column, default: Column, *, kind: str = "variant") -> Column:
    """``value``, or ``default`` where it is missing or empty ('', 0, false, [] or {})."""
    if kind == "variant":
        default = default.cast("variant")

    def empty(value: Column) -> Column:
        if kind == "variant":
            return F.to_json(value).isin(_EMPTY)
        if kind == "string":
            return value == ""
        if kind == "array":
            return F.size(value) == 0
        if kind == "number":
            return value == 0
        raise ValueError(f"unknown kind of value: {kind!r}")

    return _once(value, lambda given: F.when(given.isNull() | empty(given), default).otherwise(given))
