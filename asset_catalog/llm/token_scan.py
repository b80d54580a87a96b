"""Token counts of documents in flat token files without an index.

A token file is a row of equal-width little-endian ids; a separator id ends each document. A scan cuts
the files into blocks of fixed size and finds the separators of a block in one vectorised comparison.
What a block cannot know, how many documents ended before it and where the last one did, comes from a
prefix scan over one small row for each block: a running sum of its separators and the running
maximum of their places. With these, each block's separators become document numbers and token counts;
a document may stretch over any number of blocks.

Files are listed by Spark and read in ranges through pyarrow's file systems, so they may lie in any store
it knows; a block is all that a task holds. `write_token_files` makes such files of documents, with the tokenizer's
ids; it writes each file under a name of its attempt and then moves it, so a repeated
task leaves one whole file.

Defined cases: null and empty texts have no tokens, but a separator; tokens after a file's last separator are a
last document, `ended` false; files without a byte hold no documents; equal rows are documents of their own."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from asset_catalog.llm.common import shared_path, slices, stored

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Bytes of a block; a multiple of every width of an id.
BLOCK_BYTES = 8 << 20


@dataclass
class Tokens:
    """A byte-level BPE vocabulary: ranks by bytes, the pattern that cuts words, and the separator's id."""

    ranks: dict[bytes, int]
    pattern: str
    separator: int

    @property
    def dtype(self) -> np.dtype:
        return np.dtype("<u2" if self.separator < 1 << 16 else "<u4")

    def encoder(self):
        import tiktoken

        return tiktoken.Encoding("own", pat_str=self.pattern, mergeable_ranks=self.ranks, special_tokens={})


def load(path: str = VOCABULARY, pattern: str | None = None) -> Tokens:
    """Reads a vocabulary on the driver; the first free id separates documents."""
    if pattern is None:
        from public_tokenizers import PATTERN as pattern
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
    return Tokens(ranks, pattern, max(ranks.values()) + 1)


def _opened(path: str) -> tuple[pafs.FileSystem, str]:
    scheme, colon, rest = path.partition(":/")
    if colon and not rest.startswith("/"):
        path = f"{scheme}:///{rest}"  # Spark writes file:/a, pyarrow reads file:///a
    return pafs.FileSystem.from_uri(path)


def write_token_files(documents: DataFrame, folder: str, tokens: Tokens) -> DataFrame:
    """Writes one file for each partition of the documents; (file, number, doc_id) says which document is which in
    its file. The rows are written when the result is computed; keep it with `stored`."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        name = f"part-{task.partitionId():05d}.bin"
        store, root = _opened(folder)
        store.create_dir(root, recursive=True)
        draft = f"{root}/.{name}-{task.taskAttemptId()}"
        encoder = tokens.encoder()
        number = 0
        with store.open_output_stream(draft) as out:
            for batch in batches:
                for part in slices(batch, 1):
                    for text in part.column(1).to_pylist():
                        ids = np.array([*encoder.encode_ordinary(text or ""), tokens.separator], tokens.dtype)
                        out.write(ids.tobytes())
                    numbers = pa.array(np.arange(number, number + part.num_rows))
                    number += part.num_rows
                    files = pa.array([name] * part.num_rows, pa.string())
                    yield pa.RecordBatch.from_arrays([files, numbers, part.column(0)], names=["file", "number", "doc_id"])
        if store.get_file_info(f"{root}/{name}").type != pafs.FileType.NotFound:
            store.delete_file(f"{root}/{name}")  # of an earlier attempt, with the same bytes
        store.move(draft, f"{root}/{name}")

    rows = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(write, f"file string, number long, doc_id {dict(rows.dtypes)['doc_id']}")


def find_separators(spark: SparkSession, folder: str, tokens: Tokens, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """A row for each block of each file: (file, block, ids, places), places of separators in the file."""
    width = tokens.dtype.itemsize
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.bin").load(folder).select("path", "length")
    blocks = F.ceil(F.col("length") / F.lit(block_bytes)).cast("int")
    total = listed.agg(F.coalesce(F.sum(blocks), F.lit(0)).cast("long")).first()[0]
    rows = listed.where("length > 0").select("path", "length", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, length, block in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                start = block * block_bytes
                store, name = _opened(path)
                with store.open_input_file(name) as file:
                    ids = np.frombuffer(file.read_at(min(block_bytes, length - start), start), tokens.dtype)
                places = np.flatnonzero(ids == tokens.separator) + start // width
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name.rpartition("/")[2]]), pa.array([block], pa.int32()), pa.array([len(ids)], pa.int64()), pa.array([places], pa.list_(pa.int64()))],
                    names=["file", "block", "ids", "places"],
                )

    spread = rows.repartition(max(1, min(total, 10_000)))
    return spread.mapInArrow(scan, "file string, block int, ids long, places array<long>")


def documents_of(scanned: DataFrame) -> DataFrame:
    """(file, number, start, n_tokens, ended) of every document, from the blocks of find_separators."""
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    summary = scanned.select("file", "block", "ids", F.size("places").alias("ends"), F.array_max("places").alias("last"))
    stitched = summary.select(
        "file",
        "block",
        F.coalesce(F.sum("ends").over(earlier), F.lit(0)).cast("long").alias("before"),
        F.coalesce(F.max("last").over(earlier), F.lit(-1)).cast("long").alias("previous"),
        F.sum("ids").over(whole).alias("file_ids"),
        F.sum("ends").over(whole).alias("file_ends"),
        F.coalesce(F.max("last").over(whole), F.lit(-1)).alias("file_last"),
        F.max("block").over(whole).alias("file_block"),
    )
    ended = (
        scanned.where(F.size("places") > 0)
        .select("file", "block", "places")
        .join(stitched.select("file", "block", "before", "previous"), ["file", "block"])
        .withColumn("starts", F.concat(F.array("previous"), F.slice("places", F.lit(1), F.size("places") - 1)))
        .select("file", "before", F.posexplode(F.arrays_zip("starts", "places")))
        .select(
            "file",
            (F.col("before") + F.col("pos")).alias("number"),
            (F.col("col.starts") + 1).alias("start"),
            (F.col("col.places") - F.col("col.starts") - 1).alias("n_tokens"),
            F.lit(True).alias("ended"),
        )
    )
    open_ends = stitched.where((F.col("block") == F.col("file_block")) & (F.col("file_last") + 1 < F.col("file_ids"))).select(
        "file",
        F.col("file_ends").cast("long").alias("number"),
        (F.col("file_last") + 1).alias("start"),
        (F.col("file_ids") - F.col("file_last") - 1).alias("n_tokens"),
        F.lit(False).alias("ended"),
    )
    return ended.unionByName(open_ends)


def count_tokens(documents: DataFrame, tokens: Tokens, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_tokens) of every row: writes token files, scans them, and removes them after the scan."""
    spark = documents.sparkSession
    folder = shared_path(spark, "tokens")
    written = stored(write_token_files(documents, folder, tokens), "token-rows")
    if written.isEmpty():
        return written.select("doc_id", F.lit(0).cast("long").alias("n_tokens"))
    scanned = stored(find_separators(spark, folder, tokens, block_bytes), "token-blocks")
    store, root = _opened(folder)
    store.delete_dir(root)
    return written.join(documents_of(scanned), ["file", "number"]).select("doc_id", "n_tokens")
