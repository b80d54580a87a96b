"""What the operators of this subpackage share: folds, tables, shared storage, batches of texts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A batch is worked on in slices of about so many bytes of text, so that memory does not grow with it.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: Column, modulus: int) -> Column:
    """crc32 of the key as text, modulo; a null key counts as the empty text."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(modulus))


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables: spark.checkpoint.dir, else the context's checkpoint folder.

    Where neither is set, a local session gets a temporary folder; a cluster is refused, as its
    executors would each write to a disk of their own."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="asset-catalog-")
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder; what is written there goes when the application ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    held = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    held.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(held)
    return path


def stored(rows: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder as Parquet and read back: later uses do not compute them
    again, read only their columns, and do not need the executors that wrote them."""
    path = shared_path(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def bucketed(rows: DataFrame, key: str, number: int, name: str) -> DataFrame:
    """The rows written to the shared folder as a table in buckets of the key and read back: joins and
    groups by the key find them in place, however often, and only what they meet is shuffled."""
    spark = rows.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    writer = rows.write.format("parquet").option("compression", "zstd").option("path", shared_path(spark, name))
    writer.bucketBy(number, key).saveAsTable(table)
    return spark.table(table)


def bucket_number(spark: SparkSession, size: int, at_once: int = 32 << 20) -> int:
    """Buckets for so many bytes: some 32 MB each, no fewer than there are cores, no more than Spark takes."""
    return max(spark.sparkContext.defaultParallelism, min(-(-size // at_once), 100_000))


def checkpointed(rows: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder; Spark removes it with the last reference to it."""
    if rows.sparkSession.sparkContext.getCheckpointDir() is None:
        rows.sparkSession.sparkContext.setCheckpointDir(shared_folder(rows.sparkSession))
    return rows.checkpoint(eager=True)


class Rounds:
    """Results of rounds that each build on the one before, written to the shared folder as Parquet and read back.

    Only the last `kept` results stay (None: all), and of what went through the shuffles nothing: Spark removes those
    files when the driver collects what refers to them, which a driver with free memory does long after the disks are full."""

    def __init__(self, spark: SparkSession, name: str, kept: int | None = 1):
        self.spark, self.path, self.kept, self.done = spark, shared_path(spark, name), kept, 0

    def put(self, rows: DataFrame) -> DataFrame:
        rows.write.parquet(path := f"{self.path}/{self.done}")
        self.done += 1
        jvm = self.spark.sparkContext._jvm
        if self.kept is not None and self.done > self.kept:
            gone = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{self.done - 1 - self.kept}")
            gone.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(gone, True)
        jvm.System.gc()
        return self.spark.read.schema(rows.schema).parquet(path)


def sampled(rows: DataFrame, key: Column, most: int, seed: int) -> DataFrame:
    """About `most` of the rows, chosen by a hash of their key, all if there are fewer.

    The share follows from one count, so no task ever holds more than its part of the sample and a
    rerun draws the same rows."""
    count = rows.count()
    if count <= most:
        return rows
    return rows.where(F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 30)) < int(most / count * (1 << 30)))


def release() -> None:
    """Gives free memory back to the system. Python's workers live on, and what they only hold on to would be
    missing to the next stage and its executor."""
    import ctypes

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def slices(batch: pa.RecordBatch, column: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts a batch between rows into pieces of about `most` bytes of the text column. When they are done, free
    memory is given back."""
    texts = batch.column(column)
    start = size = 0
    for i, length in enumerate(pc.binary_length(texts).fill_null(0).to_pylist()):
        size += length
        if size >= most:
            yield batch.slice(start, i + 1 - start)
            start, size = i + 1, 0
    if start < batch.num_rows:
        yield batch.slice(start)
    release()


def chunk_ids(batches: Iterator[pa.RecordBatch], column: int, most: int) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Slices of a task's rows, each with a number that no other slice of any task has."""
    chunk = TaskContext.get().partitionId() << 32
    for batch in batches:
        for part in slices(batch, column, most):
            yield chunk, part
            chunk += 1


def labelled(labels: DataFrame, label: str, most: int, seed: int, learn: Callable[[Column], Column]) -> DataFrame:
    """(doc_id, label) of at most about `most` documents to learn from, small enough to broadcast.

    A document that is labelled more than once counts once, with its highest label."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & learn(F.col("doc_id")))
    return sampled(known.groupBy("doc_id").agg(F.max(label).cast("int").alias("label")), F.col("doc_id"), most, seed)


def score_texts(documents: DataFrame, scorer: Callable[[pa.Array], list], results: str) -> DataFrame:
    """doc_id of every row with what the scorer makes of its text, as columns `results`.

    The scorer gets an array of strings, nulls included, and returns a list of arrays as long."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                made = [pa.array(x) for x in scorer(part.column(1))]
                yield pa.RecordBatch.from_arrays([part.column(0), *made], names=names)

    rows = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    schema = f"doc_id {dict(rows.dtypes)['doc_id']}, {results}"
    names = [field.split()[0] for field in schema.split(", ")]
    return rows.mapInArrow(score, schema)


def keep_texts(documents: DataFrame, keeps: Callable[[pa.Array], np.ndarray]) -> DataFrame:
    """The rows, in all their columns, whose texts the function keeps. Nothing is shuffled."""
    at = documents.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, at):
                yield part.filter(pa.array(keeps(part.column(at)), pa.bool_()))

    return documents.mapInArrow(keep, documents.schema)
