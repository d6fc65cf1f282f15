"""Popularity baseline: one global list, minus what each user has already met."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def item_popularity(train: DataFrame, pool: int = 1000) -> DataFrame:
    """The ``pool`` items with most read rows: (item_id, read_count, pop_rank). Ties go to the lower id."""
    top = (
        train.where(F.col("is_read") == 1)
        .groupBy("item_id").agg(F.count("*").alias("read_count"))
        .orderBy(F.desc("read_count"), "item_id")
        .limit(pool)
    )
    # The limit bounds the unpartitioned window at `pool` rows.
    rank = F.row_number().over(W.orderBy(F.desc("read_count"), "item_id"))
    return top.withColumn("pop_rank", rank)


def popularity_recs(train: DataFrame, k: int = 100, pool: int = 1000) -> DataFrame:
    """(user_id, item_id, rank) for every train user.

    Only the part of a history that lies in the pool matters, so train meets the
    pool in a broadcast join (at most ``pool`` rows) and each user keeps at most
    ``pool`` ids, collapsed before the shuffle. The global list is a one-row
    scalar subquery; the user's list is that array less the met ids.
    """
    top = item_popularity(train, pool)
    ranked = (
        top.agg(F.sort_array(F.collect_list(F.struct("pop_rank", "item_id"))).alias("ranked"))
        .select(F.col("ranked.item_id").alias("items"))
    )
    met = (
        train.select("user_id", "item_id")
        .join(F.broadcast(top.select("item_id", F.col("item_id").alias("pool_item"))), "item_id", "left")
        .groupBy("user_id").agg(F.collect_set("pool_item").alias("met"))
    )
    lists = met.select(
        "user_id", F.slice(F.array_except(ranked.scalar(), F.col("met")), 1, k).alias("items")
    )
    return lists.select("user_id", F.posexplode("items").alias("pos", "item_id")).select(
        "user_id", "item_id", (F.col("pos") + 1).alias("rank")
    )


def popularity_hits(train: DataFrame, labels: DataFrame, k: int = 100, pool: int = 1000) -> DataFrame:
    """The rows of ``popularity_recs`` that can decide a metric, without making the lists.

    A label's place in its user's list is its pool rank less the met items ranked above
    it, so only labels inside the pool are ranked: (user_id, item_id, rank, pool_rank). A row with
    no item and rank 1 stands for the first place of every user who has a list.
    Per user both sides are bounded by the pool, and they meet in the layout
    that their own aggregates left.
    """
    top = item_popularity(train, pool).select("item_id", "pop_rank")
    size = top.agg(F.count("*"))
    met = (
        train.select("user_id", "item_id").join(F.broadcast(top), "item_id", "left")
        .groupBy("user_id").agg(F.collect_set("pop_rank").alias("met"))
    )
    wanted = (
        labels.select("user_id", "item_id").join(F.broadcast(top), "item_id")
        .groupBy("user_id").agg(F.collect_set(F.struct("pop_rank", "item_id")).alias("wanted"))
    )
    def place(label: Column) -> Column:
        above = F.size(F.filter("met", lambda rank: rank < label.pop_rank))
        return F.struct(
            label.item_id.alias("item_id"), (label.pop_rank - above).alias("rank"), label.pop_rank.alias("pool_rank")
        )
    unseen = F.filter("wanted", lambda label: ~F.array_contains("met", label.pop_rank))
    placed = F.filter(F.transform(unseen, place), lambda hit: hit.rank <= k)
    # Pool ranks met without a gap from 1 on come before the first place.
    gapless = F.size(F.filter(F.array_sort("met"), lambda rank, i: rank == i + 1))
    first = F.array(F.struct(F.lit(None).cast("int").alias("item_id"), F.lit(1).alias("rank"), (gapless + 1).alias("pool_rank")))
    return (
        met.where(F.size("met") < size.scalar())
        .join(wanted, "user_id", "left")
        .select("user_id", F.inline(F.concat(F.coalesce(placed, F.array().cast("array<struct<item_id:int,rank:int,pool_rank:int>>")), first)))
    )
