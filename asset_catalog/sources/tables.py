"""The two catalog tables, in one of two layouts.

By versions: a table points at a directory that holds one complete version of it. An upsert writes the
next version beside it and then moves the table over, so readers never see half a version and
the version being read is never overwritten. The check that no other run has moved the table and the move
are two steps, so runs must not overlap.

By parts (``Config.catalog_parts``): a table is partitioned by a hash of its keys and bucketed by the
keys. An upsert reads and writes the parts that the pull touches, and joins them where they
lie, whatever the size of the pull. Spark writes them beside the table and moves them in when all are
written: a failed run changes nothing, a run that is repeated puts the same rows in again, but a reader may meet
some parts from before an upsert and some from after it. Runs must not overlap.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from asset_catalog.config import Config
from asset_catalog.operators.catalog import upsert
from asset_catalog.schemas import KINDS, ConfigError, Kind, kind_of
from asset_catalog.sources.scratch import scratch_path


def table_name(config: Config, kind: str | Kind) -> str:
    return f"`{config.database.replace('`', '``')}`.{kind_of(kind).table}"


def _version_path(config: Config, kind: Kind) -> str:
    return f"{config.catalog_root}/{kind.table}/version={uuid.uuid4().hex}"


def ensure_catalog(spark: SparkSession, config: Config) -> None:
    """Create the database and the two tables unless they are there."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{config.database.replace('`', '``')}`")
    for kind in KINDS.values():
        name = table_name(config, kind)
        if config.catalog_parts:
            _create_in_parts(spark, config, kind)
        elif not spark.catalog.tableExists(name):
            spark.catalog.createTable(
                name, path=_version_path(config, kind), source="parquet", schema=kind.catalog_schema
            )


def _create_in_parts(spark: SparkSession, config: Config, kind: Kind) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kind.catalog_schema)
    keys = ", ".join(f"`{key}`" for key in kind.merge_keys)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table_name(config, kind)} ({columns}, part INT) USING parquet"
        f" OPTIONS (partitionOverwriteMode 'dynamic') PARTITIONED BY (part)"
        f" CLUSTERED BY ({keys}) INTO {config.catalog_buckets} BUCKETS"
        f" LOCATION {_quoted(f'{config.catalog_root}/{kind.table}/parts={config.catalog_parts}')}"
    )


def _with_part(rows: DataFrame, config: Config, kind: Kind) -> DataFrame:
    return rows.withColumn("part", F.pmod(F.xxhash64(*kind.merge_keys), F.lit(config.catalog_parts)).cast("int"))


# Rows of a bucket that one task joins and sorts.
BUCKET_ROWS = 250_000


def _part_counts(rows: DataFrame) -> dict[int, int]:
    return {row["part"]: row["count"] for row in rows.groupBy("part").count().collect()}


def _part_groups(counts: dict[int, int], most: int) -> list[list[int]]:
    """Parts in groups of at most so many rows; a larger part is a group of its own."""
    groups, held = [], 0
    for part, count in sorted(counts.items()):
        if not groups or held + count > most:
            groups.append([])
            held = 0
        groups[-1].append(part)
        held += count
    return groups


def upserted_parts(source: DataFrame, config: Config, kind: str | Kind) -> DataFrame:
    """All rows of the parts that the source touches, after the upsert. The table's buckets are those
    of the joins, so only the source is moved; two lists of at most ``catalog_parts`` numbers come to the driver.

    A join has a task for each bucket, whatever the size of the table. So parts of many rows are joined
    group by group, each with tasks of its own; the source is then written by part first."""
    kind, spark = kind_of(kind), source.sparkSession
    name = table_name(config, kind)
    spark.catalog.refreshTable(name)
    placed = _with_part(source, config, kind)
    come_counts = _part_counts(placed)
    if not come_counts:
        return spark.table(name).limit(0)
    held_counts = _part_counts(spark.table(name).where(F.col("part").isin(list(come_counts))))
    both = {part: count + held_counts.get(part, 0) for part, count in come_counts.items()}
    groups = _part_groups(both, BUCKET_ROWS * config.catalog_buckets)
    if len(groups) > 1:
        path = scratch_path(spark, "placed", f"{config.catalog_root}/staged")
        placed.hint("rebalance", F.col("part")).write.partitionBy("part").parquet(path)
        placed = spark.read.schema(placed.schema).parquet(path)
    return reduce(DataFrame.unionByName, [
        _upserted_group(placed, name, group, config, kind, [sum(n.get(p, 0) for p in group) for n in (held_counts, come_counts)])
        for group in groups
    ])


def _upserted_group(placed: DataFrame, name: str, group: list[int], config: Config, kind: Kind, counts: list[int]) -> DataFrame:
    """The same of some parts. Rows that come are dealt by part and bucket, so that a file has one writer."""
    chosen = F.col("part").isin(group)
    target = placed.sparkSession.table(name).where(chosen)
    come_by = _dealt_by(placed.sparkSession, config, kind, len(group))
    return upsert(target, placed.where(chosen), kind.merge_keys, come_by=come_by, counts=tuple(counts)).select(target.columns)


def _dealt_by(spark: SparkSession, config: Config, kind: Kind, parts: int) -> tuple[int, list[Column]]:
    """How rows of so many parts are dealt, each file's to one task."""
    usual = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    bucket = F.pmod(F.hash(*kind.merge_keys), F.lit(config.catalog_buckets))
    return max(1, min(parts * config.catalog_buckets, usual)), [F.col("part"), bucket]


def _commit_parts(rows: DataFrame, config: Config, kind: Kind) -> str:
    """Make the rows the whole table: parts without rows are dropped."""
    spark, name = rows.sparkSession, table_name(config, kind)
    placed = _with_part(rows.select(kind.catalog_schema.names), config, kind)
    tasks, columns = _dealt_by(spark, config, kind, config.catalog_parts)
    placed.repartition(tasks, *columns).select(spark.table(name).columns).write.mode("overwrite").insertInto(name)
    spark.catalog.refreshTable(name)
    held = {row["part"] for row in spark.table(name).select("part").distinct().collect()}
    filled = {row["part"] for row in placed.select("part").distinct().collect()}
    for part in sorted(held - filled):
        spark.sql(f"ALTER TABLE {name} DROP PARTITION (part = {part})")
    return current_version(spark, config, kind)


def read_catalog(spark: SparkSession, config: Config, kind: str | Kind) -> DataFrame:
    """The current version, also when another session has moved the table to it."""
    name = table_name(config, kind)
    spark.catalog.refreshTable(name)
    return spark.table(name).select(kind_of(kind).catalog_schema.names)


def current_version(spark: SparkSession, config: Config, kind: str | Kind) -> str:
    """The directory that the table points at now."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table_name(config, kind)}").where("col_name = 'Location'")
    return rows.first()["data_type"]


def commit_version(
    rows: DataFrame, config: Config, kind: str | Kind, built_on: str | None = None
) -> str:
    """Write rows as the next version of a table and move the table to it.

    ``built_on`` is the version that the rows were made from. If the table has moved on since,
    it stays where it is and the run is refused, as it would drop what the other one put in.
    """
    kind, spark = kind_of(kind), rows.sparkSession
    if config.catalog_parts:
        return _commit_parts(rows, config, kind)
    path = _version_path(config, kind)
    rows.select(kind.catalog_schema.names).write.parquet(path)
    name = table_name(config, kind)
    spark.catalog.refreshTable(name)
    now = current_version(spark, config, kind)
    if built_on is not None and now != built_on:
        raise ConfigError(f"{name} was changed by another run, from {built_on} to {now}; run again")
    spark.sql(f"ALTER TABLE {name} SET LOCATION {_quoted(path)}")
    spark.catalog.refreshTable(name)
    return path


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def upsert_catalog(source: DataFrame, config: Config, kind: str | Kind) -> str:
    """Put catalog rows into their table; returns the path of the new version, or of the table's parts.

    ``source`` is used more than once, and its rows are counted; it should be a written table."""
    kind = kind_of(kind)
    if config.catalog_parts:
        upserted_parts(source, config, kind).write.mode("overwrite").insertInto(table_name(config, kind))
        source.sparkSession.catalog.refreshTable(table_name(config, kind))
        return current_version(source.sparkSession, config, kind)
    version = current_version(source.sparkSession, config, kind)
    target = read_catalog(source.sparkSession, config, kind)
    merged = upsert(target, source, kind.merge_keys, counts=(target.count(), source.count()))
    return commit_version(merged, config, kind, version)
