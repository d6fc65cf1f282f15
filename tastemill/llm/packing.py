"""Shards of near-equal size by best-fit decreasing over indivisible groups of equal texts.

Groups enter the open bin with the tightest remaining capacity that still holds them,
found in a balanced tree. At scale this runs in two tiers. Groups far smaller than a shard
are dealt into cells and packed in parallel into bundles of a fixed capacity; bundles are
indivisible from then on. Large groups (fewer than shards x BUNDLES by counting) and
bundles are then packed into the shards. A group is never cut, so one that exceeds the
mean shard size has its shard to itself and the others share the rest.

Null texts are empty texts, which are one group. Ties in size go by digest. Rows with null, repeated or equal ids and texts
each have a slot; equal rows have neighbouring ones. Whole texts of any length are measured and never cut. Columns other
than doc_id and text are ignored whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

import random
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tastemill.llm.common import join_counted, spelled, stage, table

ROW_BYTES = 16
BUNDLES = 512  # bundles per shard: the grain of the second tier
CELL_GROUPS = 100_000  # groups that one task packs
MOST_CELLS = 50_000  # beyond it cells grow with the table, and no more units reach the driver
SLOT_ROWS = 1000  # rows that one task numbers


class FitTree:
    """A treap of (remaining capacity, bin): balanced in expectation, smallest sufficient bin first.

    Nodes are [key, priority, left, right]; the head's left child is the root.
    """

    def __init__(self, seed: int = 0):
        self.head: list = [None, 2.0, None, None]
        self.draw = random.Random(seed).random

    def insert(self, key: tuple[int, int]) -> None:
        priority = self.draw()
        parent, side = self.head, 2
        while (node := parent[side]) is not None and node[1] >= priority:
            parent, side = node, 2 if key < node[0] else 3
        new = [key, priority, None, None]
        parent[side] = new
        low, high = (new, 2), (new, 3)  # where the next smaller and larger subtree hang
        while node is not None:
            if node[0] < key:
                low[0][low[1]] = node
                low, node = (node, 3), node[3]
            else:
                high[0][high[1]] = node
                high, node = (node, 2), node[2]
        low[0][low[1]] = high[0][high[1]] = None

    def take(self, size: int) -> tuple[int, int] | None:
        """Remove and return the tightest bin that holds ``size``."""
        parent, side, best = self.head, 2, None
        while (node := parent[side]) is not None:
            if node[0][0] >= size:
                best = (parent, side)
                parent, side = node, 2
            else:
                parent, side = node, 3
        if best is None:
            return None
        parent, side = best
        taken = parent[side]
        left, right = taken[2], taken[3]
        while left is not None and right is not None:  # merge its children in its place
            if left[1] >= right[1]:
                parent[side] = left
                parent, side, left = left, 3, left[3]
            else:
                parent[side] = right
                parent, side, right = right, 2, right[2]
        parent[side] = left if left is not None else right
        return taken[0]


def best_fit(sizes: Sequence[int], capacity: int, most: int | None = None) -> list[int] | None:
    """Bin of each size, given in descending order. Sizes over the capacity get a bin of their own.

    None if more than ``most`` bins are needed.
    """
    tree, bins, out = FitTree(), 0, []
    for size in sizes:
        found = tree.take(size) if size <= capacity else None
        if found is None:
            if bins == most:
                return None
            found, bins = (max(capacity, size), bins), bins + 1
        out.append(found[1])
        tree.insert((found[0] - size, found[1]))
    return out


def tightest_fit(sizes: Sequence[int], shards: int) -> list[int]:
    """Best fit at about the least capacity for which the bins suffice."""
    own = 0  # sizes that exceed an equal share of what is left take a shard each
    rest = sum(sizes)
    for size in sizes:
        if shards - own <= 1 or size * (shards - own) <= rest:
            break
        own, rest = own + 1, rest - size
    free = shards - own
    mean = -(-rest // free)
    grow = max(1, mean // 20_000)
    capacity, placed = mean, best_fit(sizes[own:], mean, free)
    while placed is None:
        capacity += grow
        grow *= 2
        placed = best_fit(sizes[own:], capacity, free)
    return [*range(own), *[own + b for b in placed]]


def _groups(docs: DataFrame) -> DataFrame:
    return docs.groupBy("digest").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows"))


def _bundled(groups: DataFrame, capacity: int, count: int) -> DataFrame:
    """First tier: (digest, rows, size, unit), where a unit is a bundle of small groups or one large group."""
    cells = min(MOST_CELLS, max(1, -(-count // CELL_GROUPS)))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "digest"], ascending=[False, True], kind="stable")
        cell = str(pdf["cell"].iloc[0])
        bins = best_fit(pdf["size"].tolist(), capacity)
        return pd.DataFrame({
            "digest": pdf["digest"], "rows": pdf["rows"], "size": pdf["size"], "unit": [f"{cell}:{b}" for b in bins],
        })

    small = groups.where(F.col("size") <= capacity).withColumn("cell", F.pmod(F.xxhash64("digest"), F.lit(cells)))
    large = groups.where(F.col("size") > capacity)
    schema = "digest string, rows long, size long, unit string"
    return small.groupBy("cell").applyInPandas(pack, schema).unionByName(large.withColumn("unit", F.col("digest")))


def shard_by_bytes(docs: DataFrame, shards: int) -> DataFrame:
    """Rows (doc_id, size, text_crc32, digest, shard); equal texts share a shard.

    A null text is an empty one. Ties between groups go by digest. Null and repeated doc_ids
    are rows like any other; an empty table gives no rows.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    facts = stage(docs.select(
        F.col("doc_id"), (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.sha2(text, 256).alias("digest"),
    ), "shard-facts")
    groups = stage(_groups(facts), "shard-groups")
    total, rows, count = groups.agg(
        F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.sum("rows"), F.lit(0)), F.count(F.lit(1))
    ).first()
    units = stage(_bundled(groups, total // (shards * BUNDLES), count), "shard-units")
    # At most about three units per bundle capacity and one per cell, and cells are at most MOST_CELLS.
    sizes = units.groupBy("unit").agg(F.sum("size").alias("size")).orderBy(F.desc("size"), "unit").toPandas()
    sizes["shard"] = tightest_fit(sizes["size"].tolist(), shards)
    placed = spark.createDataFrame(list(zip(sizes["unit"], sizes["shard"].astype(int))), "unit string, shard int")
    homes = stage(units.join(placed, "unit").select("digest", "rows", "shard"), "shard-homes")
    return join_counted(facts, homes, ["digest"], "rows", rows).drop("rows")


def number_slots(placed: DataFrame, shards: int) -> DataFrame:
    """Gapless slots from 0 in each shard: chunks are numbered apart and shifted by the chunks before.

    Equal rows are counted first and take a range of slots together, so a row that a third of the table
    repeats is one row of its chunk.
    """
    keys = placed.columns
    counted = stage(placed.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")), "shard-placed")
    total = counted.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    chunks = max(1, -(-total // (shards * SLOT_ROWS)))
    rows = counted.withColumn("_chunk", F.pmod(F.xxhash64("doc_id", "digest"), F.lit(chunks)))
    counts = rows.groupBy("shard", "_chunk").agg(F.sum("copies").alias("_rows"))
    before = Window.partitionBy("shard").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("shard", "_chunk", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_base"))
    above = Window.partitionBy("shard", "_chunk").orderBy("doc_id", "digest").rowsBetween(Window.unboundedPreceding, -1)
    place = F.coalesce(F.sum("copies").over(above), F.lit(0))
    numbered = rows.withColumn("_place", place).join(bases, ["shard", "_chunk"])
    each = spelled(numbered, ["doc_id", "digest"])
    return each.withColumn("slot", F.col("_base") + F.col("_place") + F.col("copy") - 1).select(*keys, "slot")


def op2_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = 40
    numbered = number_slots(shard_by_bytes(table(spark, sf_dir, "documents"), shards), shards)
    return numbered.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
