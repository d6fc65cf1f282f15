"""Whole-user samples, history filter and the per-user split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pyspark.sql.types import BinaryType

from tastemill.functions.hashing import hex_int, md5_bucket, md5_key, xxhash_bucket
from tastemill.operators.skew import spread

SPLITS = ("train", "validation", "test")
# A user is never hot below this share of all rows, which bounds the broadcasts whatever the table's size.
HOT_USERS = 100_000


def sample_users(
    df: DataFrame, pct: int, user: str = "user_id", method: str = "xxhash64", bucket: str | None = None
) -> DataFrame:
    """Keep whole users whose hash bucket (of 100) is below ``pct``; a filter, no shuffle.

    Samples are nested: the 1 % users are among the 3 % users. The id type is
    part of the 64-bit hash, so cast ids to int first. ``bucket`` names the partition column of a table
    by ``write_bucketed``: only the sampled buckets' files are then read, and the column goes.
    """
    if not 1 <= pct <= 100:
        raise ValueError("pct must be between 1 and 100")
    if bucket is not None:
        return df.where(F.col(bucket) < pct).drop(bucket)
    hashed = {"xxhash64": xxhash_bucket, "md5": md5_bucket}[method]
    return df.where(hashed(user) < pct)


def eligible_users(df: DataFrame, min_rows: int = 5, user: str = "user_id") -> DataFrame:
    """Users with at least ``min_rows`` rows, and how many they have."""
    return df.groupBy(user).agg(F.count("*").alias("n")).where(F.col("n") >= min_rows)


def _slice_of(key: Column, slices: Column) -> Column:
    """Which of ``slices`` equal ranges a uniform hex key falls in; grows with the key."""
    return F.floor(hex_int(key, 8) * slices / F.lit(float(1 << 32))).cast("int")


def number_rows(
    df: DataFrame, key: str, user: str = "user_id", hot_rows: int = 1_000_000, sizes: DataFrame | None = None
) -> DataFrame:
    """Add ``rn`` (position by ``key`` within the user) and ``n`` (rows of the user).

    ``key`` is a uniform hex string or its bytes, unique within a user. A user with more than
    ``hot_rows`` rows (and more than rows / HOT_USERS) is cut into key ranges of about that
    size; each range is numbered on its own and shifted by the size of the ranges before
    it, so one user with a third of the table is spread over many tasks and numbered exactly.
    Fewer than HOT_USERS users can be hot and they have fewer than twice as many ranges,
    which bounds the two broadcasts. Two numbers, all rows and the largest user's, are
    read first: without a hot user the plan scans ``df`` once. ``sizes``, (user, n), saves
    the count where ``df`` is costly to scan twice. The rows also say how many tasks are
    needed, so that each sorts its rows in memory whatever the table's size.
    """
    if sizes is None:
        sizes = df.groupBy(user).agg(F.count("*").alias("n"))
    rows, largest = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    hot_rows = max(hot_rows, rows // HOT_USERS)
    if largest <= hot_rows:
        whole = W.partitionBy(user)
        return spread(df, rows, user).withColumn("rn", F.row_number().over(whole.orderBy(key))).withColumn("n", F.count("*").over(whole))
    hot = sizes.where(F.col("n") > hot_rows).select(
        user, F.col("n").alias("_total"), F.ceil(F.col("n") / hot_rows).alias("_slices")
    )
    digits = F.hex(key) if isinstance(df.schema[key].dataType, BinaryType) else F.col(key)
    sliced = (
        df.join(F.broadcast(hot), user, "left")
        .withColumn("_slice", F.coalesce(_slice_of(digits, F.col("_slices")), F.lit(0)))
    )
    shifts = (
        sliced.where(F.col("_slices").isNotNull())
        .groupBy(user, "_slice").agg(F.count("*").alias("_c"))
        .withColumn("_shift", F.sum("_c").over(W.partitionBy(user).orderBy("_slice")) - F.col("_c"))
        .drop("_c")
    )
    part = W.partitionBy(user, "_slice")
    numbered = (
        spread(sliced, rows, user, "_slice")
        .withColumn("_pos", F.row_number().over(part.orderBy(key)))
        .withColumn("_size", F.count("*").over(part))
        .join(F.broadcast(shifts), [user, "_slice"], "left")
    )
    return (
        numbered
        .withColumn("rn", F.col("_pos") + F.coalesce(F.col("_shift"), F.lit(0)))
        .withColumn("n", F.coalesce(F.col("_total"), F.col("_size")))
        .select(*df.columns, "rn", "n")
    )


def split_per_user(
    df: DataFrame,
    key: str = "row_key",
    user: str = "user_id",
    fractions: tuple[float, float] = (0.6, 0.8),
    min_rows: int = 5,
    seed: int | None = None,
    hot_rows: int = 1_000_000,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Deal each user's rows into train/validation/test in hash order; adds ``split``.

    Users below ``min_rows`` are left out. The order comes from ``key`` (re-hashed
    when a seed is given), so the same rows give the same split in any layout.
    """
    order = df if seed is None else df.withColumn("_order", md5_key(key, seed=seed))
    ranked = number_rows(order, key if seed is None else "_order", user, hot_rows, sizes)
    first, second = (F.lit(float(f)) * F.col("n") for f in fractions)
    split = (
        F.when(F.col("rn") <= first, SPLITS[0]).when(F.col("rn") <= second, SPLITS[1]).otherwise(SPLITS[2])
    )
    return ranked.where(F.col("n") >= min_rows).select(*df.columns, split.alias("split"))


def with_row_key(df: DataFrame, hot_copies: int = 100_000) -> DataFrame:
    """Give every row a ``row_key``: an md5 of its values and of its number among identical rows.

    Identical rows are counted first (copies collapse before the shuffle) and laid
    out again from ranges of at most ``hot_copies`` numbers, so a row repeated a
    billion times is neither collected in one group nor emitted by one task.
    """
    cols = df.columns
    counted = df.groupBy(*cols).agg(F.count("*").alias("_m"))
    few = counted.where(F.col("_m") <= hot_copies).select(*cols, _numbers(F.lit(0), F.col("_m")).alias("_copy"))
    ranges = counted.where(F.col("_m") > hot_copies).select(
        *cols, "_m", F.explode(F.expr(f"sequence(bigint(0), _m - 1, bigint({hot_copies}))")).alias("_from")
    )
    to = F.least(F.col("_from") + hot_copies, F.col("_m"))
    many = ranges.repartition(*cols, "_from").select(*cols, _numbers(F.col("_from"), to).alias("_copy"))
    return few.unionByName(many).select(*cols, md5_key(*cols, "_copy").alias("row_key"))


def _numbers(start: Column, end: Column) -> Column:
    """Explodes to start .. end - 1."""
    return F.explode(F.sequence(start.cast("bigint"), end - 1))
