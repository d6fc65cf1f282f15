"""Scores and relevance rules as Column expressions over an interaction table."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the data model.
LIKED_RATING = 4.0
REVIEW_WEIGHT = 2.0


def implicit_score(w_read: float = 1.0, w_review: float = REVIEW_WEIGHT) -> Column:
    """Weighted sum of the two flags; null when either flag is null."""
    return F.col("is_read") * F.lit(float(w_read)) + F.col("is_reviewed") * F.lit(float(w_review))


def combined_score(w_read: float, w_review: float) -> Column:
    """The rating where there is one, else the weight of the strongest flag, else 0."""
    return (
        F.when(F.col("rating") > 0, F.col("rating").cast("double"))
        .when(F.col("is_reviewed") == 1, F.lit(float(w_review)))
        .when(F.col("is_read") == 1, F.lit(float(w_read)))
        .otherwise(F.lit(0.0))
    )


def label_rule(kind: str) -> Column:
    """Which held-out rows count as relevant."""
    rules = {"read": F.col("is_read") == 1, "liked": F.col("rating") >= LIKED_RATING}
    if kind not in rules:
        raise ValueError(f"unknown label kind {kind!r}, expected one of {sorted(rules)}")
    return rules[kind]
