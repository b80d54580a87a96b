"""Whole identifiers replaced by a mapping that is a table, of any size.

The regular expression of ``multi_replace(match='token')`` is made of all keys on the driver. Here
texts are cut into pieces instead, identifiers and single characters between them, and the runs of pieces that may be a
key are joined to the mapping. Which matches of a text count is settled where they overlap: the first and of these the
longest, as the expression would find them. The pieces are then put together with the new names.

Each different text is worked on once. Nothing is collected but the numbers of pieces that keys have.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from asset_catalog.operators.joins import join_each
from asset_catalog.schemas import ConfigError
from asset_catalog.sources.scratch import written_once

_IDENTIFIER = r"[\p{L}\p{N}_]"
_PIECES = rf"{_IDENTIFIER}+|[^\p{{L}}\p{{N}}_]"


def _pieces(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(_PIECES), 0)


def _is_identifier(piece: Column) -> Column:
    return F.coalesce(piece.rlike(rf"\A{_IDENTIFIER}"), F.lit(False))


def mapping_keys(pairs: DataFrame) -> DataFrame:
    """The mapping as (old, new, pieces), each key once and lower-cased; keys that become equal must agree.

    Empty keys are dropped, a missing new name counts as an empty one."""
    clean = pairs.select(F.lower("old").alias("old"), F.coalesce("new", F.lit("")).alias("new")).where("old != ''")
    keys = clean.groupBy("old").agg(F.min("new").alias("new"), F.max("new").alias("other"))
    clash = keys.where("new != other").select("old").head(1)
    if clash:
        raise ConfigError(f"mapping gives two values for {clash[0]['old']!r}")
    return keys.select("old", "new", F.size(_pieces(F.col("old"))).alias("length"))


def _candidates(texts: DataFrame, lengths: list[int]) -> DataFrame:
    """(id, at, length, gram): runs of as many pieces as some key has, which neither start nor end within an identifier.

    A run starts in front of any piece unless an identifier ends there, and so it may end."""
    piece = lambda at: F.get(F.col("pieces"), at)
    free = lambda at: ~_is_identifier(piece(at - 1))
    ends = lambda at: ~_is_identifier(piece(at))
    places = F.filter(F.sequence(F.lit(0), F.size("pieces") - 1), free)
    starts = texts.where(F.size("pieces") > 0).select("id", "pieces", F.explode(places).alias("at"))
    runs = starts.select("id", "pieces", "at", F.explode(F.array(*map(F.lit, lengths))).alias("length"))
    end = F.col("at") + F.col("length")
    runs = runs.where((end <= F.size("pieces")) & ends(end))
    gram = F.array_join(F.slice("pieces", F.col("at") + 1, F.col("length")), "")
    return runs.select("id", "at", "length", F.lower(gram).alias("old"))


def _settled(matches: DataFrame) -> DataFrame:
    """(id, chosen): the matches that count, in their order. Matches that overlap, directly or through others, are
    settled together; such a cluster is short, whatever the length of the text."""
    earlier = Window.partitionBy("id").orderBy("at", F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)
    upto = earlier.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    opens = F.coalesce(F.col("at") >= F.max(F.col("at") + F.col("length")).over(earlier), F.lit(True))
    clusters = matches.withColumn("opens", opens.cast("int")).withColumn("cluster", F.sum("opens").over(upto))
    match = F.struct("at", (-F.col("length")).alias("less"), "new")
    grouped = clusters.groupBy("id", "cluster").agg(F.array_sort(F.collect_list(match)).alias("found"))

    def take(taken: Column, found: Column) -> Column:
        end = F.when(F.size(taken) > 0, F.element_at(taken, -1)["at"] - F.element_at(taken, -1)["less"])
        return F.when(end > found["at"], taken).otherwise(F.concat(taken, F.array(found)))

    none = F.slice(F.col("found"), F.lit(1), F.lit(0))
    settled = grouped.select("id", F.explode(F.aggregate("found", none, take)).alias("match"))
    return settled.groupBy("id").agg(F.array_sort(F.collect_list("match")).alias("chosen"))


def _joined(pieces: Column, chosen: Column) -> Column:
    """The pieces with the new name in place of each match."""
    end = lambda match: match["at"] - match["less"]

    def upto(match: Column, place: Column) -> Column:
        start = F.when(place > 0, end(F.get(chosen, place - 1))).otherwise(0)
        return F.concat(F.array_join(F.slice(pieces, start + 1, match["at"] - start), ""), match["new"])

    tail = F.slice(pieces, end(F.element_at(chosen, -1)) + 1, F.size(pieces))
    return F.concat(F.array_join(F.transform(chosen, upto), ""), F.array_join(tail, ""))


def replace_tokens(
    rows: DataFrame, text: str, pairs: DataFrame, into: str, *, preserve_case: bool = False, scratch: str | None = None
) -> DataFrame:
    """Add ``into``: the text with every whole key of the mapping table (old, new) replaced, as
    ``multi_replace(match='token')`` does with a mapping on the driver. Without any key the texts come back as they are.

    The mapping and the different texts are written to the shared folder, as both are used twice."""
    keys = written_once(mapping_keys(pairs), "mapping", scratch)
    lengths = [row["length"] for row in keys.select("length").distinct().collect()]
    if not lengths:
        return rows.withColumn(into, F.col(text))
    source = F.col(text) if preserve_case else F.lower(text)
    name = F.sha2(F.col(text), 256)
    different = rows.where(F.col(text).isNotNull()).select(name.alias("id"), source.alias("source")).dropDuplicates(["id"])
    texts = written_once(different.select("id", "source", _pieces(F.col("source")).alias("pieces")), "texts", scratch)
    matches = join_each(_candidates(texts, sorted(lengths)), keys.select("old", "new"), "old", "inner").drop("old")
    made = texts.join(_settled(matches), "id", "left")
    done = F.when(F.col("chosen").isNull(), F.col("source")).otherwise(_joined(F.col("pieces"), F.col("chosen")))
    made = made.select(F.col("id").alias("_text_id"), done.alias(into))
    return join_each(rows.withColumn("_text_id", name), made, "_text_id").drop("_text_id")
