from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from asset_catalog.operators.joins import join_each


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows on one key, a sixth on one that has no match, a sixth without key."""
    random.seed(5)
    rows = []
    for n in range(6000):
        key = "hot" if n % 3 == 0 else "lost" if n % 6 == 1 else None if n % 6 == 2 else f"k{random.randint(0, 3000)}"
        rows.append((n, key))
    return spark.createDataFrame(rows, "n int, key string").repartition(4, "n")


@pytest.fixture(scope="module")
def unique(spark):
    rows = [("hot", 1, None)] + [(f"k{n}", n, f"v{n}") for n in range(0, 3000, 2)] + [(None, 9, "null")]
    return spark.createDataFrame(rows, "key string, a int, b string")


@pytest.fixture
def small_partitions(spark):
    """Settings under which Spark takes these few rows for many."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "12",
    }
    held = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in held.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def by_hand(rows, unique, how):
    table = {r["key"]: r for r in unique.collect() if r["key"] is not None}
    out = []
    for r in rows.collect():
        match = table.get(r["key"])
        if how == "left_semi":
            out += [(r["key"], r["n"])] if match else []
        elif match or how == "left":
            out.append((r["key"], r["n"], match["a"] if match else None, match["b"] if match else None))
    return sorted(map(str, out))


@pytest.mark.parametrize("how", ["left", "inner", "left_semi"])
def test_every_row_finds_its_match(skewed, unique, how):
    got = join_each(skewed, unique, "key", how)
    assert sorted(str(tuple(r)) for r in got.collect()) == by_hand(skewed, unique, how)


def wide(rows):
    """Rows of which a partition with a hot key is far larger than the others."""
    return rows.withColumn("pad", F.concat(*[F.sha2(F.concat("n", F.lit(k)), 256) for k in range(4)]))


@pytest.mark.parametrize("how", ["left", "inner", "left_semi"])
def test_each_side_is_read_once_and_hot_partitions_are_split(spark, skewed, unique, how, small_partitions, tmp_path):
    wide(skewed).repartition(8).write.parquet(f"{tmp_path}/rows")
    unique.write.parquet(f"{tmp_path}/unique")
    joined = join_each(spark.read.parquet(f"{tmp_path}/rows"), spark.read.parquet(f"{tmp_path}/unique"), "key", how)
    assert joined.count() == len(by_hand(skewed, unique, how))
    joined.collect()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[0].count("Scan parquet") == 2 and "skew=true" in plan


def test_other_joins_are_refused(skewed, unique):
    with pytest.raises(ValueError):
        join_each(skewed, unique, "key", "full")


def test_nothing_joins_nothing(skewed, unique):
    assert join_each(skewed.where("false"), unique, "key").count() == 0
    assert join_each(skewed, unique.where("false"), "key").count() == skewed.count()
