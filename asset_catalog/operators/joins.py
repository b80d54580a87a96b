"""Joins of any number of rows to a side that holds each key once."""

from __future__ import annotations

from pyspark.sql import DataFrame


def join_each(rows: DataFrame, unique: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Join ``rows`` to ``unique`` on ``key``; ``unique`` has no key twice.

    ``how`` is 'left', 'inner' or 'left_semi'. Both sides are read and moved once. In these three
    joins Spark may split the partition of a key that holds most of the rows, and it does so when
    it has seen the partitions' sizes; rows without a key, which a left join keeps, are split alike.
    """
    if how not in ("left", "inner", "left_semi"):
        raise ValueError(f"unsupported join: {how!r}")
    return rows.join(unique, key, how)
