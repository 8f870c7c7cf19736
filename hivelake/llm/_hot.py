"""Joins in which one key may hold a large part of the rows of one side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys that are treated apart, at most: each holds more than this part of all rows, so there are no more of them.
HOT_KEYS = 5_000
#: A key with at most so many rows is never treated apart.
LEAST_ROWS = 1_000


def join_hot(left: DataFrame, right: DataFrame, *keys: str) -> DataFrame:
    """``left`` with the columns of ``right``'s row of its key, null where there is none; ``right`` has each key once.

    Keys with more than one row of ``left`` in ``HOT_KEYS`` meet their rows of ``right`` by a broadcast, which is
    at most ``HOT_KEYS`` rows; all others by a shuffle, in which no partition is large.  A null meets nothing.
    """
    on, columns = list(keys), [c for c in right.columns if c not in keys]
    most = max(LEAST_ROWS, left.count() // HOT_KEYS)
    hot = left.groupBy(*on).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > most).select(*on)
    hot_rows = right.join(F.broadcast(hot), on).withColumn("__hot", F.lit(True))
    told = left.join(F.broadcast(hot_rows), on, "left")
    cold = told.where(F.col("__hot").isNull()).drop(*columns, "__hot").join(right, on, "left")
    wanted = [*left.columns, *columns]
    return told.where("__hot").select(*wanted).unionByName(cold.select(*wanted))
