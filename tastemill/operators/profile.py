"""Counts that describe an interaction table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("row_count"))


def rating_histogram(df: DataFrame) -> DataFrame:
    return df.groupBy("rating").agg(F.count("*").alias("row_count")).orderBy("rating")


def signal_totals(df: DataFrame) -> DataFrame:
    return df.agg(
        F.sum("is_read").alias("total_read"),
        F.sum("is_reviewed").alias("total_reviewed"),
    )


# Ratings that the histogram of an observed write tells apart.
RATINGS = range(6)


def observed_metrics() -> list[Column]:
    """Aggregates of interactions that a write takes along; ``incomplete`` counts rows with a null cell."""
    cells = [F.col(c).isNull() for c in ("user_id", "item_id", "is_read", "rating", "is_reviewed")]
    known = F.col("rating").isin(*[float(r) for r in RATINGS])
    return [
        F.count(F.lit(1)).alias("row_count"),
        F.sum(F.col("is_read").cast("bigint")).alias("total_read"),
        F.sum(F.col("is_reviewed").cast("bigint")).alias("total_reviewed"),
        F.count_if(reduce(Column.__or__, cells)).alias("incomplete"),
        *[F.count_if(F.col("rating") == float(r)).alias(f"rating_{r}") for r in RATINGS],
        F.count_if(~known).alias("rating_other"),
    ]


def observed_reports(observed: DataFrame) -> dict[str, DataFrame]:
    """``row_count``, ``signal_totals`` and ``rating_histogram`` from a row of ``observed_metrics``.

    Where a rating is null or none of RATINGS the histogram can't be told and is left out.
    """
    row = observed.first()
    reports = {
        "row_count": observed.select("row_count"), "signal_totals": observed.select("total_read", "total_reviewed")
    }
    if row.rating_other == 0 and sum(row[f"rating_{r}"] for r in RATINGS) == row.row_count:
        bars = F.array(*[
            F.struct(F.lit(float(r)).cast("float").alias("rating"), F.col(f"rating_{r}").alias("row_count")) for r in RATINGS
        ])
        reports["rating_histogram"] = observed.select(F.inline(bars)).where("row_count > 0").orderBy("rating")
    return reports


def split_profile(interactions: DataFrame, splits: DataFrame) -> DataFrame:
    """Rows and users before and after the history filter, then rows and users per split.

    Each user count aggregates to (part, user) first, so no task holds a list of users.
    """
    def sized(df: DataFrame, part) -> DataFrame:
        per_user = df.groupBy(part.alias("part"), "user_id").agg(F.count("*").alias("n"))
        return per_user.groupBy("part").agg(F.sum("n").alias("row_count"), F.count("user_id").alias("user_count"))

    per_split = sized(splits, F.col("split"))
    kept = sized(splits, F.lit("eligible"))
    return sized(interactions, F.lit("all")).unionByName(kept).unionByName(per_split)
