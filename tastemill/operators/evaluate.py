"""Ranking metrics and rating error."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _user_metrics(k: int) -> list[Column]:
    """Metrics of one user from ``hits`` (sorted ranks that hit) and ``n_labels``."""
    ideal, total = [0.0], 0.0
    for i in range(1, k + 1):
        total += 1.0 / math.log2(i + 1)
        ideal.append(total)
    best = F.element_at(F.array(*[F.lit(v) for v in ideal]), F.least(F.col("n_labels"), F.lit(k)).cast("int") + 1)
    precision_sum = F.aggregate(
        F.transform("hits", lambda rank, i: (i + 1) / rank), F.lit(0.0), lambda acc, x: acc + x
    )
    in_list = F.filter("hits", lambda rank: rank <= k)
    gain = F.aggregate(in_list, F.lit(0.0), lambda acc, rank: acc + 1.0 / F.log2(rank + 1))
    return [
        (precision_sum / F.col("n_labels")).alias("map"),
        (gain / best).alias("ndcg_at_k"),
        (F.size(in_list) / F.lit(k)).alias("precision_at_k"),
        (F.size(in_list) / F.col("n_labels")).alias("recall_at_k"),
    ]


def user_metrics(
    recs: DataFrame,
    labels: DataFrame,
    kinds: Sequence[tuple[str, str]],
    cohort: DataFrame | None = None,
    k: int = 100,
    missing: str = "drop",
    pools: Sequence[int] = (),
) -> DataFrame:
    """Per (user, split, label): MAP part, NDCG@k, precision@k and recall@k.

    ``recs`` is (user_id, item_id, rank) with ranks 1..n, ``labels`` (user_id, item_id, split, label).
    Places other than the first may be left out of ``recs`` where they hold no label.
    Recommendations and labels are stacked and aggregated by (user, item): repeated
    labels collapse before the shuffle, a match is a pair that has both a rank and a
    label bit, and a user with a third of the labels is spread over all tasks. The
    second aggregate, by user, carries counts and at most one rank per list entry.

    ``missing='drop'`` leaves out users without any recommendation, ``'zero'`` scores them 0.

    With ``pools`` the lists of several pool sizes are scored at once, with a column ``pool``: recs then have
    ``pool_rank``, the item's place in the pool. A pool of p leaves the places with pool_rank <= p,
    whose ranks don't depend on p, so labels are placed once, in the largest pool.
    """
    if missing not in ("drop", "zero"):
        raise ValueError("missing must be 'drop' or 'zero'")
    bit = F.lit(0)
    for i, (split, label) in enumerate(kinds):
        bit = F.when((F.col("split") == split) & (F.col("label") == label), F.lit(1 << i)).otherwise(bit)
    none = F.lit(None).cast("int")
    in_pool = (F.col("pool_rank") if pools else F.lit(0)).cast("int").alias("in_pool")
    stacked = recs.select("user_id", "item_id", "rank", in_pool, F.lit(0).alias("bits")).unionByName(
        labels.select("user_id", "item_id", none.alias("rank"), none.alias("in_pool"), bit.alias("bits"))
    )
    pairs = stacked.groupBy("user_id", "item_id").agg(
        F.min("rank").alias("rank"), F.min("in_pool").alias("in_pool"), F.bit_or("bits").alias("bits")
    )
    # A list has a first place if it has any: other unlabelled places decide nothing.
    pairs = pairs.where((F.col("bits") != 0) | (F.col("rank") == 1))
    aggs = [F.min(F.when(F.col("rank") == 1, F.col("in_pool"))).alias("first")]
    for i in range(len(kinds)):
        is_label = F.col("bits").bitwiseAND(F.lit(1 << i)) != 0
        placed = is_label & F.col("rank").isNotNull()
        aggs.append(F.count_if(is_label).alias(f"n{i}"))
        aggs.append(F.collect_list(F.when(placed, F.struct("rank", "in_pool"))).alias(f"hits{i}"))
    users = pairs.groupBy("user_id").agg(*aggs)

    def scored_kind(i: int, pool: int) -> Column:
        split, label = kinds[i]
        hits = F.filter(f"hits{i}", lambda hit: hit.in_pool <= pool)
        return F.struct(
            F.lit(split).alias("split"), F.lit(label).alias("label"), F.lit(pool).alias("pool"),
            F.col(f"n{i}").alias("n_labels"), F.array_sort(F.transform(hits, lambda hit: hit.rank)).alias("hits"),
            F.coalesce(F.col("first") <= pool, F.lit(False)).alias("listed"),
        )

    per_kind = F.array(*[scored_kind(i, pool) for i in range(len(kinds)) for pool in (pools or (0,))])
    scored = users.select("user_id", F.inline(per_kind)).where(F.col("n_labels") > 0)
    if missing == "drop":
        scored = scored.where("listed")
    if cohort is not None:
        on = [c for c in ("user_id", "label") if c in cohort.columns]
        scored = scored.join(cohort, on, "left_semi")
    return scored.select("user_id", "split", "label", *(["pool"] if pools else []), *_user_metrics(k))


def mean_metrics(per_user: DataFrame, by: Sequence[str] = ("split", "label")) -> DataFrame:
    """Means over users with the number of users, one row per group."""
    return per_user.groupBy(*by).agg(
        F.count("*").alias("users"),
        *[F.avg(m).alias(m) for m in ("map", "ndcg_at_k", "precision_at_k", "recall_at_k")],
    )


def evaluate_ranking(
    recs: DataFrame,
    labels: DataFrame,
    kinds: Sequence[tuple[str, str]],
    cohort: DataFrame | None = None,
    k: int = 100,
    missing: str = "drop",
    pools: Sequence[int] = (),
) -> DataFrame:
    """Means over users, one row per (split, label) in ``kinds`` and pool, with the cohort size."""
    per_user = user_metrics(recs, labels, kinds, cohort, k, missing, pools)
    return mean_metrics(per_user, ["split", "label", *(["pool"] if pools else [])])


def rmse(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Root mean square of ``score - prediction`` over rows that have a prediction."""
    error = F.col("score").cast("double") - F.col("prediction").cast("double")
    known = predictions.where(F.col("prediction").isNotNull())
    return known.groupBy(*by).agg(F.count("*").alias("rows"), F.sqrt(F.avg(error * error)).alias("rmse"))
