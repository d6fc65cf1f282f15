"""Interaction tables derived from the order tables of the test data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastemill.functions.hashing import md5_key
from tastemill.operators.skew import spread


def order_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as users, parts as items, line attributes as rating and flags.

    Under ANSI casts an id beyond int32 is an error, never a wrapped value. The lines are counted, which
    reads the files' footers only, so that the join's tasks are small enough to sort in memory.
    """
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey")
    n = lines.count()
    lines, orders = spread(lines, n, "l_orderkey"), spread(orders, n, "o_orderkey")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    number = F.col("l_linenumber")
    return joined.select(
        F.col("o_custkey").cast("int").alias("user_id"),
        F.col("l_partkey").cast("int").alias("item_id"),
        F.when(F.col("l_linestatus") == "F", 1).otherwise(0).alias("is_read"),
        F.when(number <= 5, number).otherwise(0).cast("float").alias("rating"),
        F.when(F.col("l_returnflag") == "A", 1).otherwise(0).alias("is_reviewed"),
        md5_key("l_orderkey", "l_partkey", "l_linenumber", "l_suppkey").alias("row_key"),
    )


def word_readers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts as items and their whole words as readers: sets that really overlap."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    words = F.array_distinct(F.split(F.lower(F.trim("text")), r"[ \t\n\r]+"))
    per_doc = docs.select(F.col("doc_id").cast("int").alias("item_id"), F.explode(words).alias("word"))
    return per_doc.where(F.col("word") != "").select(
        "item_id",
        F.col("word").alias("user_id"),
        F.lit(1).alias("is_read"),
    )
