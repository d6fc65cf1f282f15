"""Joins whose key may be hot: the hot keys' rows are spread over slices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows of one key that a task may take on. A table of n rows has at most
# n / HOT_ROWS keys above it, which bounds every broadcast of hot keys.
HOT_ROWS = 1_000_000
# Rows that a task may sort or join in memory.
TASK_ROWS = 500_000


def spread(rows: DataFrame, n: int, *keys: str, task_rows: int = TASK_ROWS) -> DataFrame:
    """Deal ``n`` rows by ``keys`` into tasks of about ``task_rows`` where the session's number of partitions would make
    larger ones, which sort on disk; the plan's own exchange is left where it doesn't. A join needs both sides dealt by one ``n``."""
    parts = -(-n // task_rows)
    if parts <= int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return rows
    return rows.repartition(parts, *keys)


def hot_keys(sizes: DataFrame, key: str, limit: int = HOT_ROWS) -> DataFrame:
    """(key, _slices) for keys with more than ``limit`` rows; ``sizes`` is (key, n)."""
    return sizes.where(F.col("n") > limit).select(key, F.ceil(F.col("n") / limit).alias("_slices"))


def slice_rows(rows: DataFrame, key: str, by: str, hot: DataFrame | None) -> DataFrame:
    """Add ``_slice``: 0, or for a hot key the slice that the hash of ``by`` picks."""
    if hot is None:
        return rows.withColumn("_slice", F.lit(0).cast("bigint"))
    picked = F.pmod(F.xxhash64(by), F.coalesce(F.col("_slices"), F.lit(1)))
    return rows.join(F.broadcast(hot), key, "left").withColumn("_slice", picked).drop("_slices")


def repeat_rows(other: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """Add ``_slice``: every slice of a hot key, 0 for the others."""
    slices = F.sequence(F.lit(0).cast("bigint"), F.coalesce(F.col("_slices"), F.lit(1)) - 1)
    return other.join(F.broadcast(hot), key, "left").withColumn("_slice", F.explode(slices)).drop("_slices")


def sliced_join(
    rows: DataFrame, other: DataFrame, key: str, by: str, hot: DataFrame | None
) -> DataFrame:
    """Inner join on ``key`` that deals a hot key's ``rows`` over slices by the hash of ``by``
    and repeats the matching rows of ``other`` on each slice.

    ``hot`` comes from ``hot_keys`` over ``rows``; None says no key can be hot.
    """
    if hot is None:
        return rows.join(other, key)
    return slice_rows(rows, key, by, hot).join(repeat_rows(other, key, hot), [key, "_slice"]).drop("_slice")
