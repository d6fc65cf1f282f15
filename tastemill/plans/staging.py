"""Tables that several plans share, written once under the shared folder."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastemill.operators.sampling import split_per_user
from tastemill.session import shared_dir
from tastemill.sources.fixtures import order_interactions
from tastemill.sources.tables import write_table

_staged: dict[tuple[str, str, str], DataFrame] = {}


def staged_path(spark: SparkSession, sf_dir: str, name: str) -> str:
    tag = hashlib.md5(sf_dir.encode()).hexdigest()[:8]
    return f"{shared_dir(spark)}/staged/{spark.sparkContext.applicationId}/{name}-{tag}"


def splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The split interactions, partitioned by ``split``.

    Every consumer then reads its split and its columns only, instead of
    repeating the shuffle of all rows once per branch of its plan. The key only orders the rows, so
    its 16 bytes are dealt and sorted, not their 32 hex digits.
    """
    key = (spark.sparkContext.applicationId, sf_dir, "splits")
    if key not in _staged:
        rows = order_interactions(spark, sf_dir).withColumn("row_key", F.unhex("row_key"))
        dealt = split_per_user(rows).drop("row_key")
        _staged[key] = write_table(dealt, staged_path(spark, sf_dir, "splits"), "split")
    return _staged[key]
