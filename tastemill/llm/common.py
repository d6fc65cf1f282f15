"""Helpers of the operators: staged tables, joins against hot keys, ranks without one sorting task."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tastemill.session import shared_dir

# A key is hot above this share of all rows, so there are fewer hot keys than this number.
HOT_KEYS = 1000

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORD = r"[^\x20\x09-\x0D]+"


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a table into the shared folder and read it back: cuts the lineage and outlives executors."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), ASCII_UPPER, ASCII_UPPER.lower())


def same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Null-safe equality of the keys, null meeting null."""
    return reduce(Column.__and__, [left[k].eqNullSafe(right[k]) for k in keys])


def join_counted(rows: DataFrame, keyed: DataFrame, keys: Sequence[str], count: str, total: int) -> DataFrame:
    """Inner join of staged rows with a table that has each key once, with its number of rows in ``count``.

    Keys with over total / HOT_KEYS rows are fewer than HOT_KEYS by counting, so they are
    broadcast and their rows stay where they are; all others meet in a shuffle without a hot key.
    """
    keyed = keyed.select(*[F.col(k).alias(f"_key_{k}") for k in keys], *[c for c in keyed.columns if c not in keys])
    on = reduce(Column.__and__, [rows[k].eqNullSafe(F.col(f"_key_{k}")) for k in keys])
    hot = keyed.where(F.col(count) * HOT_KEYS > total)
    rest = keyed.where(F.col(count) * HOT_KEYS <= total)
    names = [f"_key_{k}" for k in keys]
    met = rows.join(F.broadcast(hot), on).drop(*names)
    others = rows.join(F.broadcast(hot.select(*names)), on, "left_anti")
    return met.unionByName(others.join(rest, on).drop(*names))


def ranked(df: DataFrame, order: Sequence[Column], name: str, into: str) -> DataFrame:
    """Number all rows from 0 in the given order: ranges are numbered apart, then shifted by the ranges before.

    The staged copy pins the ranges; the table of range sizes has one row per partition.
    """
    dealt = stage(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), name)
    sizes = dealt.groupBy("_range").count()
    before = sizes.withColumnRenamed("_range", "_later").join(
        sizes.select("_range", "count").withColumnsRenamed({"_range": "_earlier", "count": "_rows"}),
        F.col("_earlier") < F.col("_later"), "left",
    ).groupBy(F.col("_later").alias("_range")).agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    return dealt.join(before, "_range").withColumn(into, F.col("_before") + place).drop("_range", "_before")


COPIES = 100_000  # of one row that a task spells out


def spelled(rows: DataFrame, keys: Sequence[str], most: int | None = None) -> DataFrame:
    """Every row as often as its ``copies`` say, numbered from 1 in ``copy``; many copies are spelled out in ranges by many tasks."""
    most = most or COPIES
    one = F.lit(1).cast("long")
    few = rows.where(F.col("copies") <= most).withColumn("copy", F.explode(F.sequence(one, F.col("copies"))))
    ranges = rows.where(F.col("copies") > most).withColumn(
        "_from", F.explode(F.sequence(one, F.col("copies"), F.lit(most).cast("long")))
    ).repartition(*keys, "_from")
    last = F.least(F.col("_from") + most - 1, F.col("copies"))
    many = ranges.withColumn("copy", F.explode(F.sequence("_from", last))).drop("_from")
    return few.unionByName(many)


def pick_rows(docs: DataFrame, kept: DataFrame, text: Column) -> DataFrame:
    """The documents named by (doc_id, text_sha, copies) with all their columns; of fully repeated ones the least row.

    Rows that come over total / HOT_KEYS times are fewer than HOT_KEYS by counting: they are met by a broadcast and
    reduced where they lie, so a row that a third of the table repeats fills no task.
    """
    kept = stage(
        kept.select(F.col("doc_id").alias("_id"), F.col("text_sha").alias("_sha"), F.col("copies").alias("_copies")), "kept"
    )
    packed = docs.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_doc"), F.sha2(text, 256).alias("_text"))
    on = packed["_doc"].eqNullSafe(kept["_id"]) & (packed["_text"] == kept["_sha"])
    single = packed.join(kept.where("_copies = 1"), on).select("_row.*")
    if kept.where("_copies > 1").isEmpty():
        return single
    often = F.col("_copies") * HOT_KEYS > docs.count()
    several = packed.join(F.broadcast(kept.where((F.col("_copies") > 1) & often)), on).unionByName(
        packed.join(kept.where((F.col("_copies") > 1) & ~often), on)
    ).groupBy("_id", "_sha").agg(F.min("_row").alias("_row"))
    return single.unionByName(several.select("_row.*"))
