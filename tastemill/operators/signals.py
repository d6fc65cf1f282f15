"""Signal tables, labels, seen pairs and evaluation cohorts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastemill.functions.signals import combined_score, implicit_score, label_rule


def rated_rows(df: DataFrame, *keep: str) -> DataFrame:
    """Rows with a rating: (user_id, item_id, *keep, score)."""
    return df.where(F.col("rating") > 0).select("user_id", "item_id", *keep, F.col("rating").alias("score"))


def explicit_signal(df: DataFrame, dedupe: bool = False) -> DataFrame:
    rated = rated_rows(df)
    return _one_per_pair(rated) if dedupe else rated


def implicit_signal(
    df: DataFrame, w_read: float = 1.0, w_review: float = 2.0, dedupe: bool = False
) -> DataFrame:
    scored = df.select("user_id", "item_id", implicit_score(w_read, w_review).alias("score"))
    positive = scored.where(F.col("score") > 0)
    return _one_per_pair(positive) if dedupe else positive


def combined_signal(df: DataFrame, w_read: float, w_review: float, dedupe: bool = False) -> DataFrame:
    scored = df.select("user_id", "item_id", combined_score(w_read, w_review).alias("score"))
    positive = scored.where(F.col("score") > 0)
    return _one_per_pair(positive) if dedupe else positive


def _one_per_pair(signal: DataFrame) -> DataFrame:
    return signal.groupBy("user_id", "item_id").agg(F.max("score").alias("score"))


def seen_pairs(train: DataFrame) -> DataFrame:
    """Everything a user met in train, whatever the model trained on."""
    return train.select("user_id", "item_id").distinct()


def build_labels(held_out: DataFrame, kinds: Iterable[str], extra: Iterable[str] = ("split",)) -> DataFrame:
    """Relevant (user, item) pairs in long form, one row per label kind: a user's set may be
    larger than a task, so it is never collected. Repeats are left to the consumer."""
    kinds = list(kinds)
    held_out = held_out.where(F.col("item_id").isNotNull())
    tags = F.array(*[F.when(label_rule(kind), F.lit(kind)) for kind in kinds])
    return (
        held_out.select("user_id", "item_id", *extra, F.explode(F.array_compact(tags)).alias("label"))
    )


def train_users(train: DataFrame) -> DataFrame:
    return train.select("user_id").distinct()


def popularity_cohort(train: DataFrame, kinds: Iterable[str] = ("read", "liked")) -> DataFrame:
    """(user, label) that may be scored: all train users for ``read``, users with a rating for ``liked``."""
    rated = F.max(F.when(F.col("rating") > 0, 1).otherwise(0))
    users = train.groupBy("user_id").agg(rated.alias("rated"))
    tags = F.array(*[
        F.when(F.col("rated") == 1, F.lit(kind)) if kind == "liked" else F.lit(kind) for kind in kinds
    ])
    return users.select("user_id", F.explode(F.array_compact(tags)).alias("label"))
