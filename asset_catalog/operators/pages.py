"""Pages by number of any depth.

The rows are dealt into ranges of the order and written once, each range sorted by one task. Counts of the
ranges and their running sum then tell which ranges a page starts and ends in, and a row's number is its range
and its place there; so a page reads its own rows, and no row before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from asset_catalog.sources.scratch import written_once

#: A row's number has its place in its range in the bits below, as Spark's increasing ids have.
_RANGE_BITS = 33


class Pages:
    """The rows in an order, to be read by pages. Rows that are equal in the order keep one order among
    them, so the pages hold each row once; nulls come first."""

    def __init__(self, rows: DataFrame, order: Sequence[str], scratch: str | None = None) -> None:
        self.order, self.columns = list(order), rows.columns
        dealt = rows.repartitionByRange(*self.order).sortWithinPartitions(*self.order)
        self.rows = written_once(dealt.withColumn("_row", F.monotonically_increasing_id()), "pages", scratch)
        counts = self.rows.groupBy(F.shiftright("_row", _RANGE_BITS).alias("range")).agg(F.count(F.lit(1)).alias("n"), F.min("_row").alias("first"))
        upto = F.sum("n").over(Window.orderBy("range"))
        self.ranges = written_once(counts.withColumn("end", upto).withColumn("start", F.col("end") - F.col("n")), "ranges", scratch)

    def count(self) -> int:
        return self.ranges.agg(F.coalesce(F.max("end"), F.lit(0))).first()[0]

    def page(self, number: int, size: int) -> DataFrame:
        """Page ``number`` (from 1) in order; one behind the last is empty.

        The driver takes in one line for each range that the page touches."""
        if number < 1 or size < 1:
            raise ValueError("pages and their sizes are counted from 1")
        start = (number - 1) * size
        touched = self.ranges.where((F.col("start") < start + size) & (F.col("end") > start)).select("first", "start", "end")
        wanted = F.lit(False)
        for part in touched.collect():
            low = part["first"] + max(start - part["start"], 0)
            high = part["first"] + min(start + size, part["end"]) - part["start"]
            wanted = wanted | ((F.col("_row") >= low) & (F.col("_row") < high))
        return self.rows.where(wanted).orderBy("_row").select(self.columns)
