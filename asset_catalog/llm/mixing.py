"""Mixing sources to target weights, with DataFrame functions only.

Every document gets a hash-random key from its id. Within a source the keys put the documents in a
random but repeatable order; the mix takes the order from its start until the source's budget of
words is used up, and begins again at the start if the budget is larger than the source. Keys fall
into a fixed number of ranges; sums of the ranges and their running totals find the one range in
which the budget ends, and only that range is sorted. What remains is one row per source: whole
epochs, the key at which the last epoch ends, and how much of that document still fits. Applying it
to the documents moves none of them.

Defined cases: a null text has no words; a null source is a source of its own, last in order; rows
with equal ids in a source share a key, and if the budget ends there, each gets its share of the rest,
rounded down; sources without words have target 0; an empty table gives an empty mix."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from asset_catalog.llm.common import stored

#: Words of a text: everything between spaces and the control characters tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"

#: Hexadecimal digits of the key that name its range: 4,096 ranges in each source.
RANGE_DIGITS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mix_key(doc_id: Column, seed: str) -> Column:
    """128 hash bits as text, uniform over the ids and ordered the same everywhere."""
    return F.md5(F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit(""))))


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, epochs: int = 2
) -> DataFrame:
    """Words to take from each source: (source, source_size) in, `target` added.

    Sources by code point, null last, weigh `weights`, repeating, and share `share` of all words; a
    target stops at `epochs` times its source, and what it gives up goes to the others by weight. With
    sources ordered by size per weight those that stop come first, so running sums find the
    level of the rest in one pass. One row per source; the windows see nothing else."""
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy("ratio", "rank")
    cycle = F.array(*[F.lit(w) for w in weights])
    rows = (
        sizes.withColumn("rank", F.row_number().over(by_name))
        .withColumn("weight", F.element_at(cycle, ((F.col("rank") - 1) % len(weights) + 1).cast("int")))
        .withColumn("cap", F.col("source_size") * F.lit(epochs))
        .withColumn("ratio", F.col("cap").cast("double") / F.col("weight"))
        .withColumn("wanted", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("stopped", F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("open_weight", F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.col("wanted") - F.coalesce("stopped", F.lit(0))) / F.col("open_weight"))
        .withColumn("at_cap", F.col("level") >= F.col("ratio"))
    )
    first_open = F.min_by("level", F.when(~F.col("at_cap"), F.struct("ratio", "rank"))).over(everything)
    return rows.withColumn("open_level", first_open).select(
        "source",
        "source_size",
        F.when((F.col("open_level").isNull()) | (F.col("ratio") <= F.col("open_level")), F.col("cap").cast("double"))
        .otherwise(F.col("open_level") * F.col("weight"))
        .alias("target"),
    )


def source_key(source: Column) -> Column:
    """A name of the source that is never null, to join on."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def source_cuts(keyed: DataFrame, targets: DataFrame) -> DataFrame:
    """Where each source's mix ends. `keyed`: (source_key, mix_key, size); `targets`: of source_targets,
    with source_key.

    Adds to the targets: `turns` whole epochs, `cut_key`, and of the rows with that key, which hold
    `cut_size` words, the `cut_words` taken in the last epoch."""
    in_range = F.substring("mix_key", 1, RANGE_DIGITS)
    whole = F.floor(F.col("target")).cast("long")
    turns = F.when(F.col("source_size") > 0, F.floor(whole / F.col("source_size"))).otherwise(0).cast("long")
    budgets = targets.withColumn("turns", turns).withColumn("rest", whole - F.col("turns") * F.col("source_size"))

    def holding_the_end(pieces: DataFrame, start: str, words: str) -> DataFrame:
        return pieces.where((F.col(start) <= F.col("rest")) & (F.col("rest") < F.col(start) + F.col(words)))

    running = Window.partitionBy("source_key").orderBy("range")
    ranges = (
        keyed.groupBy("source_key", in_range.alias("range"))
        .agg(F.sum("size").alias("words"))
        .withColumn("range_start", F.sum("words").over(running) - F.col("words"))
        .join(budgets.select("source_key", "rest"), "source_key")
    )
    last_range = holding_the_end(ranges, "range_start", "words").select("source_key", "range", "range_start", "rest")
    within = Window.partitionBy("source_key").orderBy("mix_key")
    groups = (
        keyed.withColumn("range", in_range)
        .join(last_range, ["source_key", "range"])
        .groupBy("source_key", "mix_key", "range_start", "rest")
        .agg(F.sum("size").alias("cut_size"))
        .withColumn("start", F.col("range_start") + F.sum("cut_size").over(within) - F.col("cut_size"))
    )
    ends = holding_the_end(groups, "start", "cut_size").select(
        "source_key", F.col("mix_key").alias("cut_key"), "cut_size", (F.col("rest") - F.col("start")).alias("cut_words")
    )
    return budgets.drop("rest").join(ends, "source_key", "left")


def plan_mix(
    documents: DataFrame,
    weights: Sequence[int] = (5, 2, 1),
    share: float = 1.5,
    epochs: int = 2,
    seed: str = "mix",
) -> tuple[DataFrame, DataFrame]:
    """The documents' sizes, written once, and the cut of each source.

    Sizes: (doc_id, source, source_key, mix_key, size), a few bytes for each document."""
    sizes = stored(
        documents.select(
            "doc_id",
            "source",
            source_key(F.col("source")).alias("source_key"),
            mix_key(F.col("doc_id"), seed).alias("mix_key"),
            word_count(F.col("text")).alias("size"),
        ),
        "mix-sizes",
    )
    of_sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(of_sources, weights, share, epochs).withColumn("source_key", source_key(F.col("source")))
    return sizes, stored(source_cuts(sizes, targets), "mix-cuts")


def taken_words() -> Column:
    """Words the mix takes of a row that has size, mix_key and its source's cut, repeats counted."""
    last = (
        F.when(F.col("cut_key").isNull() | (F.col("mix_key") > F.col("cut_key")), 0)
        .when(F.col("mix_key") < F.col("cut_key"), F.col("size"))
        .otherwise(F.floor(F.col("size") * F.col("cut_words") / F.col("cut_size")))
    )
    return (F.col("size") * F.col("turns") + last).cast("long")


def mix(documents: DataFrame, **settings) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every document; settings as of plan_mix."""
    sizes, cuts = plan_mix(documents, **settings)
    return sizes.join(cuts.drop("source"), "source_key").select(
        "doc_id", "size", "source_size", "target", taken_words().alias("taken"), "source"
    )


def mixed_documents(documents: DataFrame, seed: str = "mix", **settings) -> DataFrame:
    """The mix itself, with the columns of the documents: a row for each whole epoch of a document, and
    where a budget ends inside a document, a last row with the words that still fit. Texts are not
    shuffled: each row is compared with its source's cut. Rows without words are kept once, as they
    use up no budget."""
    _, cuts = plan_mix(documents, seed=seed, **settings)
    own = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row")
    rows = documents.select(
        own,
        source_key(F.col("source")).alias("source_key"),
        mix_key(F.col("doc_id"), seed).alias("mix_key"),
        word_count(F.col("text")).alias("size"),
    ).join(cuts.drop("source"), "source_key")
    rows = rows.withColumn("taken", taken_words())
    words = F.when(F.col("size") > 0, F.col("size"))
    copies = F.when(F.col("size") == 0, F.array(F.lit(0).cast("long"))).otherwise(
        F.filter(
            F.transform(
                F.sequence(F.lit(0).cast("long"), F.floor(F.col("taken") / words)),
                lambda turn: F.least(F.col("size"), F.col("taken") - turn * F.col("size")),
            ),
            lambda kept: kept > 0,
        )
    )
    rows = rows.withColumn("kept", F.explode(copies))
    first_words = F.array_join(F.slice(F.regexp_extract_all("row.text", F.lit(WORD), 0), 1, F.col("kept").cast("int")), " ")
    text = F.when(F.col("kept") == F.col("size"), F.col("row.text")).otherwise(first_words)
    return rows.select(*[text.alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in documents.columns])
