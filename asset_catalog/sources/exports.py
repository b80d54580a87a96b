"""Writers of asset files and of export documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from asset_catalog.operators.assets import changed_at, classify_assets, latest_per_key, read_assets
from asset_catalog.schemas import Kind
from asset_catalog.sources.landed import line_rows

def _entry() -> Column:
    """An entry of a JSON object, key and raw value."""
    entry = F.concat(F.to_json(F.array("object_key")), F.lit(":"), F.col("raw"))
    # ["key"] becomes "key" for use as the name of the entry.
    return F.regexp_replace(entry, r'^\["((?:[^"\\]|\\.)*)"\]:', '"$1":')


def keyed_documents(entries: DataFrame, documents: int) -> DataFrame:
    """Export documents, JSON objects key -> asset, cut by the hash of the key: (document, value).

    ``entries`` holds each ``object_key`` once, so hashing spreads them evenly and no document
    grows beyond its share. Together the documents hold every entry exactly once. A document is a
    partition of its own, whose rows in their order, sorted by Spark, are its text; it is never one cell.
    """
    document = F.pmod(F.xxhash64("object_key"), F.lit(documents)).cast("int").alias("document")
    body = entries.select(document, F.lit(False).alias("ends"), _entry().alias("entry"))
    ends = entries.select(document).distinct().select("document", F.lit(True).alias("ends"), F.lit("}").alias("entry"))
    rows = body.unionByName(ends).repartitionById(documents, F.col("document")).sortWithinPartitions("ends", "entry")
    # Below its upper bits, which number the partitions, the id counts a partition's rows.
    first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
    opening = F.when(F.col("ends"), "").when(first, "{").otherwise(",")
    return rows.select("document", F.concat(opening, "entry").alias("value"))


def write_keyed_json(entries: DataFrame, path: str, documents: int = 1) -> None:
    """Write the catalog as so many export documents, one per file and line, of any size. A document is
    written by one task, entry by entry; ``write_entry_lines`` writes with many."""
    rows = keyed_documents(entries, documents).select("value")
    rows.write.mode("overwrite").option("lineSep", " ").text(path)


def entry_lines(entries: DataFrame) -> DataFrame:
    """Export lines, each a JSON object of one entry: (value). Raw values come onto one line;
    line breaks can stand between the parts of a JSON text only."""
    entry = F.regexp_replace(_entry(), r"[\r\n]+", " ")
    return entries.select(F.concat(F.lit("{"), entry, F.lit("}")).alias("value"))


def write_entry_lines(entries: DataFrame, path: str) -> None:
    """Write an export that many tasks write and read: files are cut between lines anywhere."""
    entry_lines(entries).write.mode("overwrite").text(path)


def asset_file_key(key: Column, name: Column) -> Column:
    """File name of an asset: key, underscore, name. The name is made safe for a path."""
    return F.concat(key, F.lit("_"), F.url_encode(name), F.lit(".json"))


def asset_files(assets: DataFrame, buckets: int) -> DataFrame:
    """One row per asset file, the last state of each: (bucket, file_key, raw).

    ``raw`` is put on one line; line breaks can stand between the parts of a JSON text only.
    """
    line = F.regexp_replace("raw", r"[\r\n]+", " ")
    last = latest_per_key(
        assets.select(
            asset_file_key(F.col("asset_key"), F.col("name")).alias("file_key"),
            changed_at(F.col("updated_at")).alias("changed"),
            F.xxhash64("raw").alias("tie"),
            line.alias("raw"),
        ),
        ["file_key"],
        ["changed", "tie"],
    )
    return last.select(_bucket(F.col("file_key"), buckets).alias("bucket"), "file_key", "raw")


def _bucket(file_key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(file_key), F.lit(buckets)).cast("int")


#: Directories that assets land in.
BUCKETS = 64


def write_asset_files(assets: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Land assets, one JSON line each, in directories by the hash of their file key.

    A file per asset would be millions of tiny files. A later landing is put beside an earlier
    one, and whoever reads keeps the last state of each key, so nothing is read while it is
    being replaced. Rebalancing cuts a bucket that is large into several files.
    """
    (
        asset_files(assets, buckets)
        .select("bucket", F.col("raw").alias("value"))
        .hint("rebalance", F.col("bucket"))
        .write.mode("append")
        .partitionBy("bucket")
        .text(path)
    )


def _landed(spark: SparkSession, path: str) -> DataFrame:
    """Landed lines with their bucket."""
    return line_rows(spark.read.text(path), "bucket")


def read_asset(
    spark: SparkSession, path: str, kind: str | Kind, key: str, name: str, buckets: int = BUCKETS
) -> DataFrame:
    """The last state of one landed asset, as of :func:`read_assets`; no row if it has not landed. Only the
    directory that the asset lands in is listed and read; ``buckets`` must be that of the landing."""
    file_key = asset_file_key(F.lit(key), F.lit(name))
    bucket = spark.range(1).select(_bucket(file_key, buckets)).first()[0]
    assets = read_assets(_landed(spark, path).where(F.col("bucket") == bucket).drop("bucket"), kind)
    found = assets.where((F.col("asset_key") == key) & (F.col("name") == name))
    found = found.withColumns({"changed": changed_at(F.col("updated_at")), "tie": F.xxhash64("raw")})
    return latest_per_key(found, ["asset_key", "name"], ["changed", "landed_at", "tie"]).drop("changed", "tie")


def last_states(lines: DataFrame, kind: str | Kind) -> DataFrame:
    """What of landed lines an import would use: (bucket, raw), the last state of each asset. Lines that
    cannot be read stay, once each, so that an import still reports them."""
    found = classify_assets(lines, kind)
    good = F.col("reason").isNull()
    unread = F.sha2("raw", 256)
    rows = found.select(
        "bucket",
        good.alias("good"),
        F.when(good, F.col("asset_key")).otherwise(unread).alias("key"),
        F.when(good, F.col("name")).otherwise("").alias("name"),
        changed_at(F.col("updated_at")).alias("changed"),
        "landed_at",
        F.xxhash64("raw").alias("tie"),
        "raw",
    )
    last = latest_per_key(rows, ["bucket", "good", "key", "name"], ["changed", "landed_at", "tie"])
    return last.select("bucket", "raw")


def compact_landing(spark: SparkSession, path: str, kind: str | Kind) -> None:
    """Replace what landed by the last state of each asset, bucket by bucket.

    An import then reads these only, and gives the same catalog. Spark writes the new files beside the
    directories and moves them in when all are written, so a failed run changes nothing. Nothing may land
    meanwhile: a file that lands between reading and moving would go. To a stream the new files are
    new, so it takes the last states in once more.
    """
    (
        last_states(_landed(spark, path), kind)
        .select("bucket", F.col("raw").alias("value"))
        .hint("rebalance", F.col("bucket"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("bucket")
        .text(path)
    )
