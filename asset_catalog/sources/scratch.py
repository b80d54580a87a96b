"""Intermediate results that are used more than once, written to a folder all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from asset_catalog.schemas import ConfigError


def scratch_folder(spark: SparkSession) -> str | None:
    """The shared folder that the cluster names for checkpoints, if it names one."""
    return spark.conf.get("spark.checkpoint.dir", None)


def scratch_path(spark: SparkSession, name: str, folder: str | None = None) -> str:
    """A path of its own in the shared folder: the one for checkpoints, else the given one. Without
    either a local session takes its warehouse; a cluster is refused, as the warehouse may be a folder of the
    driver's alone. What is written there goes when the application ends."""
    folder = scratch_folder(spark) or folder
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ConfigError("set spark.checkpoint.dir to a folder that all executors share")
        folder = f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
    path = f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    held = jvm.org.apache.hadoop.fs.Path(path)
    held.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(held)
    return path


def written_once(rows: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """The rows read back from the shared folder, so that later uses neither compute them again
    nor depend on the executors that did, and read only the columns they need."""
    path = scratch_path(rows.sparkSession, name, folder)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
