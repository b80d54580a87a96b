"""Readers of landed JSON.

Each ``read_*`` reads files and hands their texts to the function of the same rows, which also
works on texts that come from a table.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from asset_catalog.functions.json_fields import parse_rows
from asset_catalog.functions.text import clean_mapping
from asset_catalog.operators.assets import latest_per_key
from asset_catalog.schemas import ConfigError, Kind, kind_of
from asset_catalog.sources.documents import LARGE_DOCUMENT, document_entries, has_large, read_pieces

# Bytes of a mapping that the driver takes in unless told otherwise: it builds a pattern of them.
MAX_MAPPING_BYTES = 64 << 20

_SOURCE = "_metadata.file_path AS source_file"


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: ``value`` is its whole text. Work is spread over files."""
    return spark.read.text(path, wholetext=True).selectExpr("value", _SOURCE)


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line of the landed asset files, which hold one JSON object per line, with
    the file and the time it landed."""
    return line_rows(spark.read.format("text").load(path))


def line_rows(files: DataFrame, *columns: str) -> DataFrame:
    """The same of a read text source, which may be a stream, with some of its own columns."""
    landed = "_metadata.file_modification_time AS landed_at"
    return files.selectExpr(*columns, "value AS raw", _SOURCE, landed).where(F.trim("raw") != "")


def _array(value: Column, field: str | None) -> Column:
    """Elements of a JSON array, or of the array in a field, as raw JSON texts."""
    if field is None:
        return F.from_json(value, "array<string>")
    return F.from_json(value, f"{field} array<string>")[field]


def unreadable(documents: DataFrame, field: str | None = "results") -> DataFrame:
    """Documents whose array cannot be read, so that none is lost unseen."""
    return documents.where(_array(F.col("value"), field).isNull())


def unreadable_objects(documents: DataFrame) -> DataFrame:
    """Documents that are not one JSON object: cut ones, for instance."""
    return documents.where(parse_rows(documents, "value").isNull())


def rejected_listing(pages: DataFrame, kind: str | Kind) -> DataFrame:
    """What :func:`listing_rows` cannot use: whole pages and objects without a key, as
    (raw, reason)."""
    broken = unreadable(pages).select(F.col("value").alias("raw"), F.lit("not a page").alias("reason"))
    listed = listing_rows(pages, kind).where("object_key IS NULL")
    return broken.unionByName(listed.select("raw", F.lit("no key").alias("reason")))


def _all_read(documents: DataFrame, broken: DataFrame, what: str) -> DataFrame:
    """The documents, if none is broken: what builds on them must not work on a part."""
    first = broken.select("source_file").head(1)
    if first:
        raise ConfigError(f"{what} cannot be read: {first[0]['source_file']}")
    return documents


def listing_rows(pages: DataFrame, kind: str | Kind) -> DataFrame:
    """One row per object listed on landed pages: ``object_key`` (id or slug) and ``raw``."""
    field = kind_of(kind).listing_field
    listed = pages.select(F.explode(_array(F.col("value"), "results")).alias("raw"))
    return listed.select(F.get_json_object("raw", f"$.{field}").alias("object_key"), "raw")


def read_listing(spark: SparkSession, path: str, kind: str | Kind) -> DataFrame:
    return listing_rows(read_documents(spark, path), kind)


def _placed_entries(documents: DataFrame) -> DataFrame:
    """Entries of JSON objects with their place: (source_file, pos, object_key, raw)."""
    entries = F.map_entries(F.from_json("value", "map<string,string>"))
    rows = documents.select("source_file", F.posexplode(entries).alias("pos", "entry"))
    return rows.select(
        "source_file", "pos", F.col("entry.key").alias("object_key"), F.col("entry.value").alias("raw")
    )


def _entries(documents: DataFrame) -> DataFrame:
    """Entries of JSON objects, the last one of each key: (object_key, raw).

    ``documents`` has ``value`` and ``source_file``; of two documents the later name counts.
    """
    rows = _placed_entries(documents)
    return latest_per_key(rows, ["object_key"], ["source_file", "pos"]).select("object_key", "raw")


def line_entries(lines: DataFrame) -> DataFrame:
    """Entries of export lines, the last one of each key: (object_key, raw).

    ``lines`` has ``raw``, a JSON object with any number of entries, and ``source_file``; of two
    files the later name counts. Files are read by many tasks.
    """
    return _entries(lines.withColumnRenamed("raw", "value"))


def read_entry_lines(spark: SparkSession, path: str) -> DataFrame:
    """Entries of an export written line by line."""
    return line_entries(read_json_lines(spark, path))


def keyed_rows(documents: DataFrame) -> DataFrame:
    """One row per entry of export documents (key -> asset): ``object_key``, ``raw``.

    A key given twice keeps its last entry of the last document.
    """
    return _entries(documents)


def read_export(spark: SparkSession, path: str) -> DataFrame:
    """The export documents under a path, a file or a directory of documents, with their size in bytes."""
    try:
        documents = spark.read.text(path, wholetext=True)
        return documents.selectExpr("value", _SOURCE, "_metadata.file_size AS file_size")
    except AnalysisException as error:
        raise ConfigError(f"no export to read at {path}") from error


def read_export_entries(
    spark: SparkSession, path: str, larger_than: int = LARGE_DOCUMENT
) -> tuple[DataFrame, DataFrame]:
    """Entries (object_key, raw) of the export documents under a path, the last one of each key, and
    the documents that are no JSON object, (source_file, value). Of documents of more than
    ``larger_than`` bytes, which are read in pieces, ``value`` is null."""
    documents = read_export(spark, path).where(F.col("file_size") <= larger_than)
    rows = _placed_entries(documents).select("*", F.lit(0).cast("long").alias("part"))
    unread = unreadable_objects(documents).select("source_file", "value")
    if has_large(spark, path, larger_than):
        large, broken = document_entries(read_pieces(spark, path, larger_than))
        rows, unread = rows.unionByName(large), unread.unionByName(broken, allowMissingColumns=True)
    entries = latest_per_key(rows, ["object_key"], ["source_file", "part", "pos"])
    return entries.select("object_key", "raw"), unread


def read_keyed_json(
    spark: SparkSession, path: str, larger_than: int = LARGE_DOCUMENT
) -> DataFrame:
    """Entries of the export documents under a path. Documents that are no JSON object give none;
    :func:`read_export_entries` finds them as well. A document of any size is read by many tasks."""
    return read_export_entries(spark, path, larger_than)[0]


def mapping_rows(documents: DataFrame) -> DataFrame:
    """Pairs (old, new) of mapping documents, keys lower-cased, empty keys dropped."""
    pairs = _entries(documents)
    pairs = pairs.select(F.lower("object_key").alias("old"), F.col("raw").alias("new"))
    return pairs.where("old != ''").distinct()


def read_mapping(spark: SparkSession, path: str) -> DataFrame | None:
    """Pairs (old, new) of a mapping file, or None when there is no file. A file that is no
    JSON object is refused; taken for an empty mapping it would leave every text as it is."""
    try:
        documents = read_documents(spark, path)
        return mapping_rows(_all_read(documents, unreadable_objects(documents), "the mapping"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def load_mapping(
    pairs: DataFrame | None, max_bytes: int = MAX_MAPPING_BYTES
) -> dict[str, str] | None:
    """The mapping on the driver, where its pattern is built: every key is part of one regular
    expression, which is the limit of this form. Its size is checked before; a
    larger one is refused, never cut, and ``max_bytes`` can be raised to fit it."""
    if pairs is None:
        return None
    size = pairs.agg(F.sum(F.octet_length("old") + F.coalesce(F.octet_length("new"), F.lit(0)))).first()[0]
    if (size or 0) > max_bytes:
        raise ConfigError(f"mapping has {size} bytes, more than {max_bytes}")
    rows = pairs.select("old", "new").collect()
    return clean_mapping((row["old"], row["new"]) for row in rows)


def endpoint_rows(documents: DataFrame) -> DataFrame:
    """Endpoints of landed lists, with their place in the list."""
    listed = documents.select(F.posexplode(_array(F.col("value"), None)).alias("pos", "item"))
    fields = ["id", "endpoint_id", "name"]
    return listed.select("pos", *[F.get_json_object("item", f"$.{f}").alias(f) for f in fields])


def read_endpoints(spark: SparkSession, path: str) -> DataFrame:
    documents = read_documents(spark, path)
    return endpoint_rows(_all_read(documents, unreadable(documents, None), "the list of endpoints"))


def inventory_rows(pages: DataFrame, kind: str | Kind) -> DataFrame:
    """Objects of the target service on landed pages, however many: (kind, id, name, tags)."""
    item = F.from_json("item", "id string, name string, tags array<string>")
    listed = pages.select(F.explode(_array(F.col("value"), "results")).alias("item"))
    return listed.select(item.alias("item")).select(
        F.lit(kind_of(kind).name).alias("kind"), "item.id", "item.name", "item.tags"
    )


def read_target_inventory(spark: SparkSession, path: str, kind: str | Kind) -> DataFrame:
    """All landed pages; one that cannot be read is refused, since deletion builds on them."""
    pages = read_documents(spark, path)
    return inventory_rows(_all_read(pages, unreadable(pages), "a page of the inventory"), kind)
