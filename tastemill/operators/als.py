"""Factor models: fit, recommend unseen items, predict ratings."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tastemill.operators.scoring import best_items
from tastemill.session import ensure_checkpoints, shared_dir
from tastemill.sources.tables import write_table

# Blocks of factors, as the library deals them by default.
BLOCKS = 10


def fit_als(
    signal: DataFrame,
    rank: int,
    reg_param: float,
    max_iter: int = 5,
    implicit: bool = False,
    alpha: float = 1.0,
    nonnegative: bool = False,
    seed: int = 42,
    blocks: int = BLOCKS,
    checkpoint_interval: int = 2,
) -> ALSModel:
    """Fit on (user_id, item_id, score); ids are int32, repeated pairs count repeatedly.

    ``blocks`` is how many user and item blocks the factors are dealt into. Start factors
    are drawn per block, so it is part of the model's configuration and never follows the
    data by itself; raise it for large signals. Lineage is cut every
    ``checkpoint_interval`` rounds in the shared folder.
    """
    ensure_checkpoints(signal.sparkSession)
    als = ALS(
        userCol="user_id", itemCol="item_id", ratingCol="score",
        rank=rank, regParam=reg_param, maxIter=max_iter,
        implicitPrefs=implicit, alpha=alpha, nonnegative=nonnegative,
        numUserBlocks=blocks, numItemBlocks=blocks,
        coldStartStrategy="drop", checkpointInterval=checkpoint_interval, seed=seed,
    )
    return als.fit(signal)


def model_of_factors(users: DataFrame, items: DataFrame, path: str) -> ALSModel:
    """A model over given factors (id int, features array<float>), saved at ``path``.

    A one-row fit makes the folder; its factor tables are then replaced.
    """
    rank = users.select(F.size("features")).first()[0]
    one = users.sparkSession.createDataFrame([(0, 0, 1.0)], "user_id int, item_id int, score float")
    fit_als(one, rank, 0.1, max_iter=1, blocks=1).write().overwrite().save(path)
    for table, name in ((users, "userFactors"), (items, "itemFactors")):
        table.write.mode("overwrite").parquet(f"{path}/{name}")
    return ALSModel.load(path)


def als_candidates(model: ALSModel, users: DataFrame, pool: int) -> DataFrame:
    """The model's ``pool`` best items for those of the given users that it knows, ties to the lower id:
    (user_id, item_id, score, place), and ``depth`` where ``users`` has it.

    The library's ``recommendForUserSubset`` makes rows of each block's best pairs before it ranks them: ``pool`` rows
    per user and 4,096 items. ``best_items`` drops what can't be among the best while it scores.
    """
    deep = "depth" in users.columns
    asked = users.select(F.col("user_id").alias("id"), F.col("depth") if deep else F.lit(pool).alias("depth")).distinct()
    best = best_items(model.userFactors.join(asked, "id"), model.itemFactors, model.rank, pool)
    return best if deep else best.drop("depth")


def unseen_depth(users: DataFrame, seen: DataFrame, k: int) -> DataFrame:
    """(user_id, depth): a user's k best unseen items are among the k + (items seen) best of all."""
    met = seen.groupBy("user_id").agg(F.count(F.lit(1)).alias("met"))
    depth = F.least(F.lit(k) + F.coalesce("met", F.lit(0)), F.lit(2**31 - 1)).cast("int").alias("depth")
    return users.select("user_id").distinct().join(met, "user_id", "left").select("user_id", depth)


def exclude_seen(candidates: DataFrame, seen: DataFrame) -> DataFrame:
    """Candidates that are not among the seen pairs.

    ``seen`` is distinct on (user_id, item_id): that key spreads any one user over all
    tasks and the join reuses the layout of the distinct. It grows with the data, so
    it carries no broadcast hint.
    """
    return candidates.join(seen, ["user_id", "item_id"], "left_anti")


def top_per_user(scored: DataFrame, k: int) -> DataFrame:
    """Rank by score, ties to the lower item id: (user_id, item_id, rank, score)."""
    best = W.partitionBy("user_id").orderBy(F.desc("score"), "item_id")
    ranked = scored.withColumn("rank", F.row_number().over(best))
    return ranked.where(F.col("rank") <= k).select("user_id", "item_id", "rank", "score")


def recommend_topk(
    model: ALSModel, users: DataFrame, seen: DataFrame, k: int = 100, pool: int = 250, full: bool = False,
    cut: DataFrame | None = None,
) -> DataFrame:
    """Up to k unseen items per user. The pool is cut before seen items go, so a short
    pool can leave a list shorter than k; ``full`` fills those lists from a deeper pool.

    Places beyond a user's ``unseen_depth`` can't be in its list and leave before the seen items are looked up.
    Scoring all pairs is the dear step and lists are small, so ``full`` writes the lists before it reads them
    twice. ``cut`` is what the same call without ``full`` gave, where that is at hand as a table."""
    if cut is None:
        candidates = als_candidates(model, unseen_depth(users, seen, k), pool).where("place <= depth")
        recs = top_per_user(exclude_seen(candidates.select("user_id", "item_id", "score"), seen), k)
    else:
        recs = cut
    if not full:
        return recs
    if cut is None:
        recs = write_table(recs, f"{shared_dir(recs.sparkSession)}/lists-{uuid.uuid4().hex}")
    return fill_lists(model, users, seen, recs, k, pool)


def fill_lists(model: ALSModel, users: DataFrame, seen: DataFrame, recs: DataFrame, k: int, pool: int) -> DataFrame:
    """Make the lists anew that are shorter than k although unseen items are left.

    A user's k best unseen items are among the k + (items seen) best of all, a depth of the user's own. Users
    go in rounds by the next power of two of their depth, so that there are at most as many rounds as the
    catalogue has binary digits, each with about as deep a pool as its users need. Only short lists' users
    take part; their items come once, by an anti-join on the user. ``recs`` is read twice: best a table.
    """
    spark = recs.sparkSession
    items = model.itemFactors.count()
    known = users.join(model.userFactors.select(F.col("id").alias("user_id")), "user_id", "left_semi").select("user_id").distinct()
    sizes = recs.groupBy("user_id").agg(F.count(F.lit(1)).alias("listed"))
    met = seen.join(model.itemFactors.select(F.col("id").alias("item_id")), "item_id", "left_semi")
    met = met.groupBy("user_id").agg(F.count_distinct("item_id").alias("met"))
    zero = F.lit(0).cast("bigint")
    wanting = known.join(sizes, "user_id", "left").join(met, "user_id", "left").select(
        "user_id", F.coalesce("listed", zero).alias("listed"), F.coalesce("met", zero).alias("met")
    ).where(F.col("listed") < F.least(F.lit(k).cast("bigint"), F.lit(items) - F.col("met")))
    depth = F.least(F.col("met") + k, F.lit(items))
    wanting = wanting.where(depth > pool).select("user_id", F.ceil(F.log2(depth.cast("double"))).cast("int").alias("digits"))
    path = f"{shared_dir(spark)}/short-lists-{uuid.uuid4().hex}"
    wanting.write.parquet(path)
    wanting = spark.read.schema(wanting.schema).parquet(path)
    rounds = sorted(r.digits for r in wanting.select("digits").distinct().collect())
    if not rounds:
        return recs
    deeper = [
        als_candidates(model, wanting.where(F.col("digits") == digits).select("user_id"), min(1 << digits, items))
        for digits in rounds
    ]
    scored = reduce(DataFrame.unionByName, deeper).select("user_id", "item_id", "score")
    filled = top_per_user(exclude_seen(scored, seen), k)
    return recs.join(wanting.select("user_id"), "user_id", "left_anti").unionByName(filled)


def to_ranked_lists(recs: DataFrame) -> DataFrame:
    """One array of at most k item ids per user, in rank order."""
    ranked = F.sort_array(F.collect_list(F.struct("rank", "item_id")))
    return recs.groupBy("user_id").agg(ranked.alias("ranked")).select(
        "user_id", F.col("ranked.item_id").alias("items")
    )


def predict_ratings(model: ALSModel, rated: DataFrame) -> DataFrame:
    """Adds ``prediction``; rows whose user or item the model does not know are dropped."""
    return model.transform(rated)
