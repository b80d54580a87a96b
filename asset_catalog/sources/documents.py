"""Export documents of any size, read by many tasks.

A document is one JSON object, key -> asset, and often one line. Files are read in blocks and cut
behind every closing brace, so a piece is a part of an asset. What a piece cannot know is
whether it starts inside a text and how deep it lies; both follow from a prefix scan: first
within each block, for either start, then over one summary row for each block. Where the depth is
back at that of the entries, an entry ends; the pieces since the last such place are put together and
parsed. A task holds a block's pieces, then single entries, never a document.

A document that is cut short, has unbalanced brackets, entries that are no JSON, or anything but blanks
behind its end gives no entries and is reported.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from asset_catalog.sources.scratch import written_once

# Documents of more bytes are read in pieces; a smaller one is one cell, which costs no shuffle.
LARGE_DOCUMENT = 64 << 20

# Pieces of a block, as a power of two: what one task scans at once.
BLOCK_ROWS_LOG2 = 14

_BLOCK = ["source_file", "block"]


def has_large(spark: SparkSession, path: str, larger_than: int = LARGE_DOCUMENT) -> bool:
    """Whether a file under the path has more bytes. Files are listed, not read."""
    return not spark.read.format("binaryFile").load(path).select("length").where(F.col("length") > larger_than).isEmpty()


def _count(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def _opened(text: Column) -> Column:
    """Braces and brackets that a text without strings and closing braces opens and leaves open."""
    return _count(text, "{[") - _count(text, "]")


def read_pieces(spark: SparkSession, path: str, larger_than: int = LARGE_DOCUMENT) -> DataFrame:
    """Pieces of the large documents under a path: text up to a closing brace, in the order of block and row. A
    block is a run of pieces of one part of a file that a task reads.

    ``quotes`` counts the quotation marks that start or end a string, ``outside`` and ``inside``
    what the piece opens if it starts outside of a string or inside of one."""
    files = spark.read.option("lineSep", "}").text(path)
    bare = F.regexp_replace("value", r"(?s)\\.", "")
    strings = r'"[^"]*+(?:"|\z)'
    large = files.where(F.col("_metadata.file_size") > larger_than).select(
        "value",
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_size").alias("file_size"),
        F.monotonically_increasing_id().alias("row"),
    )
    return large.select(
        "source_file",
        F.struct("start", F.shiftright("row", BLOCK_ROWS_LOG2).alias("run")).alias("block"),
        "file_size",
        "row",
        _count(bare, '"').alias("quotes"),
        _opened(F.regexp_replace(bare, strings, "")).alias("outside"),
        _opened(F.regexp_replace(F.regexp_replace(bare, r'\A[^"]*+(?:"|\z)', ""), strings, "")).alias("inside"),
        F.octet_length("value").alias("bytes"),
        "value",
    )


def _before(order: str) -> Window:
    return Window.partitionBy(*(_BLOCK if order == "row" else _BLOCK[:1])).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def _sum_before(value: Column | str, order: str) -> Column:
    return F.coalesce(F.sum(value).over(_before(order)), F.lit(0))


def _within_blocks(pieces: DataFrame) -> DataFrame:
    """Adds for a block that starts outside of a string (0) or inside (1): whether the piece ends outside, and how
    deep; depth counts from the block's start. Each piece is taken to end with its brace."""
    upto = _before("row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = _sum_before("quotes", "row")
    rows = pieces.withColumn("seen", seen)
    for start in (0, 1):
        starts_inside = (F.col("seen") + start) % 2 == 1
        ends_outside = (F.col("seen") + F.col("quotes") + start) % 2 == 0
        opened = F.when(starts_inside, F.col("inside")).otherwise(F.col("outside")) - ends_outside.cast("int")
        rows = rows.withColumns({f"ends_{start}": ends_outside, f"step_{start}": opened})
    return rows.withColumns({f"depth_{s}": F.sum(f"step_{s}").over(upto) for s in (0, 1)})


def _block_starts(pieces: DataFrame) -> DataFrame:
    """(source_file, block, start, depth, last_row, whole_end) of every block: whether it starts inside of a string, how
    deep, and where its file ends, with a brace or not. Spark cuts at braces but does not say whether the
    last one was there; the file's size does, less the three bytes of a mark at its start."""
    totals = _within_blocks(pieces).groupBy(*_BLOCK).agg(
        F.sum("quotes").alias("quotes"),
        F.sum("step_0").alias("step_0"),
        F.sum("step_1").alias("step_1"),
        F.sum(F.col("bytes") + 1).alias("bytes"),
        F.max("row").alias("last_row"),
        F.max("file_size").alias("file_size"),
    )
    file = Window.partitionBy("source_file")
    started = totals.withColumns(
        {
            "start": _sum_before("quotes", "block") % 2,
            "is_last": F.col("block") == F.max("block").over(file),
            "whole_end": F.pmod(F.max("file_size").over(file) - F.sum("bytes").over(file), F.lit(3)) == 0,
        }
    )
    step = F.when(F.col("start") == 1, F.col("step_1")).otherwise(F.col("step_0"))
    started = started.withColumn("depth", _sum_before(step, "block"))
    return started.select(*_BLOCK, "start", "depth", F.when(F.col("is_last"), F.col("last_row")).alias("last_row"), "whole_end")


def _marked(pieces: DataFrame, starts: DataFrame) -> DataFrame:
    """Pieces with their real depth; ``closes`` where an entry or the document ends with the piece."""
    joined = _within_blocks(pieces).join(starts, _BLOCK)
    chosen = lambda name: F.when(F.col("start") == 1, F.col(f"{name}_1")).otherwise(F.col(f"{name}_0"))
    braced = F.coalesce(F.col("row") != F.col("last_row"), F.lit(True)) | F.col("whole_end")
    return joined.select(
        *_BLOCK,
        "row",
        *[c for c in ("value", "group_start") if c in joined.columns],
        braced.alias("braced"),
        (F.col("depth") + chosen("depth")).alias("level"),
        (braced & chosen("ends") & (F.col("depth") + chosen("depth") <= 1)).alias("closes"),
    )


def _groups(pieces: DataFrame) -> DataFrame:
    """Texts between the ends of entries: (source_file, part, text, level), level 0 where the document ends."""
    numbers = pieces.drop("value")
    starts = _block_starts(numbers)
    closings = _marked(numbers, starts).groupBy(*_BLOCK).agg(F.sum(F.col("closes").cast("long")).alias("closings"))
    starts = starts.join(closings.withColumn("group_start", _sum_before("closings", "block")).drop("closings"), _BLOCK)
    part = F.col("group_start") + _sum_before(F.col("closes").cast("long"), "row")
    rows = _marked(pieces, starts).withColumn("part", part)
    text = F.concat("value", F.when(F.col("braced"), "}").otherwise(""))
    ordered = F.array_sort(F.collect_list(F.struct("block", "row", text.alias("text"))))
    return rows.groupBy("source_file", "part").agg(
        F.array_join(F.transform(ordered, lambda piece: piece["text"]), "").alias("text"),
        F.min(F.when(F.col("closes"), F.col("level"))).alias("level"),
    )


def document_entries(pieces: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Entries (source_file, part, pos, object_key, raw) of documents in pieces, and the documents that are none,
    as (source_file). ``part`` and ``pos`` order a document's entries."""
    held = written_once(pieces, "pieces")
    blank = r"\A[ \t\r\n]*"
    text = F.when(F.col("level") == 0, F.regexp_replace("text", r"\}\z", "")).otherwise(F.col("text"))
    opening = F.when(F.col("part") == 0, F.lit("{")).otherwise(",")
    body = F.regexp_replace(text, blank + r"[{,]", "")
    is_blank = lambda column: column.rlike(blank + r"\z")
    opens = F.regexp_extract(text, blank + r"([{,])", 1) == opening
    parsed = F.from_json(F.concat(F.lit("{"), body, F.lit("}")), "map<string,string>")
    ends = F.col("level") == 0
    nothing = F.when(F.col("level").isNull(), is_blank(F.col("text"))).otherwise(ends & F.when(F.col("part") == 0, opens & is_blank(body)).otherwise(is_blank(text)))
    found = _groups(held).select(
        "source_file",
        "part",
        ends.alias("ends"),
        F.col("level").isNull().alias("behind"),
        F.coalesce(nothing, F.lit(False)).alias("nothing"),
        F.when(opens & ~is_blank(body) & (F.col("level") >= 0), parsed).alias("entries"),
    )
    found = written_once(found, "entries")
    bad = ~F.col("nothing") & F.col("entries").isNull()
    whole = (F.max(bad.cast("int")) == 0) & (F.sum(F.coalesce(F.col("ends"), F.lit(False)).cast("int")) == 1)
    state = found.groupBy("source_file").agg(whole.alias("whole"))
    # A row for each large document; without the hint all entries of a document may meet in one task.
    rows = found.join(F.broadcast(state.where("whole").select("source_file")), "source_file", "left_semi")
    rows = rows.select("source_file", "part", F.posexplode(F.map_entries("entries")).alias("pos", "entry"))
    entries = rows.select("source_file", "part", "pos", F.col("entry.key").alias("object_key"), F.col("entry.value").alias("raw"))
    return entries, state.where("NOT whole").select("source_file")
