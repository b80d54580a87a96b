from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from asset_catalog.operators.pages import Pages


@pytest.fixture
def ranges(spark):
    """Ranges stay as many as there are shuffle partitions."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_pages_hold_each_row_once_and_in_order(spark, ranges):
    rows = spark.range(1000).select(F.pmod(F.hash("id"), F.lit(50)).alias("a"), F.when(F.col("id") % 7 > 0, F.col("id")).alias("b"), F.lit("x").alias("_r"))
    expected = [tuple(r) for r in rows.orderBy("a", "b").collect()]
    pages = Pages(rows, ["a", "b"])
    assert pages.ranges.count() == 4 and pages.count() == 1000
    got = [tuple(r) for number in range(1, 9) for r in pages.page(number, 130).collect()]
    assert got == expected
    assert pages.page(9, 130).count() == 0 and pages.page(1, 5000).count() == 1000
    assert pages.page(1, 1).columns == ["a", "b", "_r"]


def test_a_deep_page_reads_its_own_rows(spark, ranges):
    """The page's rows are asked of the files, and none of the other ranges' files holds them."""
    pages = Pages(spark.range(4000), ["id"])
    page = pages.page(390, 10)
    assert [r["id"] for r in page.collect()] == list(range(3890, 3900))
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(_row," in plan and "LessThan(_row," in plan
    assert "GlobalLimit" not in plan and "CollectLimit" not in plan and "TakeOrdered" not in plan


def test_ties_nothing_and_wrong_numbers(spark, ranges):
    same = Pages(spark.range(100).select(F.lit(1).alias("a"), "id"), ["a"])
    assert sorted(r["id"] for n in range(1, 5) for r in same.page(n, 30).collect()) == list(range(100))
    empty = Pages(spark.range(0), ["id"])
    assert empty.page(1, 10).count() == 0 and empty.count() == 0
    with pytest.raises(ValueError):
        empty.page(0, 10)
