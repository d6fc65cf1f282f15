"""Readers and writers at the edges of the pipeline."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from tastemill import schemas
from tastemill.functions.hashing import hex_int, xxhash_bucket

INT_MAX = 2147483647


def read_csv(spark: SparkSession, path: str, schema: T.StructType, mode: str = "PERMISSIVE") -> DataFrame:
    """CSV with a declared schema whose names are checked against the header line.

    Spark binds columns by position when a schema is forced onto a file, so a
    header in another order would swap columns silently; here it is an error.
    Bad cells become null under PERMISSIVE and stop the job under FAILFAST.
    """
    return (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("mode", mode)
        .schema(schema)
        .csv(path)
    )


def read_interactions_csv(spark: SparkSession, path: str, mode: str = "PERMISSIVE") -> DataFrame:
    return read_csv(spark, path, schemas.INTERACTIONS, mode)


def read_id_map(spark: SparkSession, path: str, schema: T.StructType = schemas.ID_MAP) -> DataFrame:
    """An identifier map; declaring its types saves the inference pass over the file."""
    return read_csv(spark, path, schema)


def _text_lines(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, Column]:
    """The lines of a CSV with cells as text, and why a line is malformed (null for a good one).

    A line is malformed if it has the wrong number of cells (``cells``) or a cell that its declared type
    cannot hold (the first such column's name); PERMISSIVE reading turns such cells into nulls.
    """
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    lines = (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_bad")
        .schema(text.add("_bad", T.StringType()))
        .csv(path)
    )
    reason = F.when(F.col("_bad").isNotNull(), F.lit("cells"))
    for f in schema.fields:
        reason = reason.when(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(), F.lit(f.name))
    return lines, reason


def malformed_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """How many lines of a CSV do not fit the schema (one row: rows, malformed)."""
    lines, reason = _text_lines(spark, path, schema)
    return lines.agg(F.count("*").alias("rows"), F.count_if(reason.isNotNull()).alias("malformed"))


def rejected_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """(line, reason): the malformed lines; a line with the right number of cells is put together from these."""
    lines, reason = _text_lines(spark, path, schema)
    cells = F.concat_ws(",", *[F.coalesce(F.col(f.name), F.lit("")) for f in schema.fields])
    return lines.select(F.coalesce("_bad", cells).alias("line"), reason.alias("reason")).where("reason IS NOT NULL")


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def write_table(df: DataFrame, path: str, partition_by: str | list[str] | None = None) -> DataFrame:
    """Replace a Parquet table and return it as read back: later plans start from files."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_observed(df: DataFrame, path: str, metrics: Sequence[Column], partition_by: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Replace a Parquet table; the aggregates are taken of the rows as they are written, without another scan.

    Returns the table as read back and the metrics as a one-row table, which is kept beside it at ``path``-observed.
    """
    spark, seen = df.sparkSession, Observation()
    table = write_table(df.observe(seen, *metrics), path, partition_by)
    row = spark.createDataFrame([tuple(seen.get.values())], ", ".join(f"{name} bigint" for name in seen.get))
    return table, write_table(row, f"{path}-observed")


def write_bucketed(df: DataFrame, path: str, metrics: Sequence[Column] = (), user: str = "user_id") -> DataFrame:
    """Write rows by the hash bucket of their user as folders, so that a sample of users reads its folders only.

    Rows are dealt by bucket first, so a bucket is a few files; one that a hot user swells is split
    by the adaptive plan. The column ``bucket`` comes with the table.
    """
    rows = df.withColumn("bucket", xxhash_bucket(user).cast("int")).hint("rebalance", "bucket")
    return write_observed(rows, path, metrics, "bucket")[0] if metrics else write_table(rows, path, "bucket")


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, one file per partition."""
    df.write.mode("overwrite").option("header", True).csv(path)


def export_csv(df: DataFrame, path: str) -> None:
    """One CSV file with a header, for result tables of report size."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def encode_ids(df: DataFrame, col: str, buckets: int = 1024, work_dir: str | None = None) -> DataFrame:
    """Dense int32 ids 0..n-1 for the distinct values of a column: (raw_id, id).

    Values fall into hash buckets; each bucket numbers its own values and starts
    where the buckets before it end, so no task sees more than one bucket. With ``work_dir`` the distinct
    values are written there once instead of being found twice.
    """
    raw = df.select(F.col(col).alias("raw_id")).where(F.col("raw_id").isNotNull()).distinct()
    tagged = raw.withColumn(
        "bucket", (hex_int(F.md5(F.col("raw_id").cast("string").cast("binary")), 8) % buckets).cast("int")
    )
    if work_dir is not None:
        tagged = write_table(tagged, work_dir)
    # One row per bucket, so the unpartitioned window and the broadcast are bounded by `buckets`.
    starts = (
        tagged.groupBy("bucket").agg(F.count("*").alias("c"))
        .withColumn("start", F.sum("c").over(W.orderBy("bucket")) - F.col("c"))
        .select("bucket", "start")
    )
    pos = F.row_number().over(W.partitionBy("bucket").orderBy("raw_id"))
    dense = tagged.withColumn("pos", pos).join(F.broadcast(starts), "bucket")
    value = F.col("start") + F.col("pos") - 1
    checked = F.when(value <= INT_MAX, value).otherwise(
        F.raise_error(F.lit(f"{col}: more than {INT_MAX} distinct ids")).cast("bigint")
    )
    return dense.select("raw_id", checked.cast("int").alias("id"))
