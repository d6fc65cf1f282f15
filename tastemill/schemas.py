"""Declared schemas of every stored relation."""

from pyspark.sql import types as T

INTERACTIONS = T.StructType([
    T.StructField("user_id", T.IntegerType()),
    T.StructField("item_id", T.IntegerType()),
    T.StructField("is_read", T.IntegerType()),
    T.StructField("rating", T.FloatType()),
    T.StructField("is_reviewed", T.IntegerType()),
])

SPLITS = T.StructType([*INTERACTIONS.fields, T.StructField("split", T.StringType())])

# raw identifier -> dense int32 identifier
ID_MAP = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("raw_id", T.StringType()),
])

# One row per (run, split, label). Columns that a model family does not use are null.
RUNS = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("model", T.StringType(), False),
    T.StructField("sample_pct", T.IntegerType()),
    T.StructField("rank", T.IntegerType()),
    T.StructField("reg_param", T.DoubleType()),
    T.StructField("alpha", T.DoubleType()),
    T.StructField("read_weight", T.DoubleType()),
    T.StructField("review_weight", T.DoubleType()),
    T.StructField("max_iter", T.IntegerType()),
    T.StructField("pool", T.IntegerType()),
    T.StructField("k", T.IntegerType()),
    T.StructField("seed", T.IntegerType()),
    T.StructField("blocks", T.IntegerType()),
    T.StructField("dedupe", T.BooleanType()),
    T.StructField("train_tag", T.StringType()),
    T.StructField("split", T.StringType(), False),
    T.StructField("label", T.StringType(), False),
    T.StructField("users", T.LongType()),
    T.StructField("map", T.DoubleType()),
    T.StructField("ndcg_at_k", T.DoubleType()),
    T.StructField("precision_at_k", T.DoubleType()),
    T.StructField("recall_at_k", T.DoubleType()),
    T.StructField("rmse", T.DoubleType()),
])

METRICS = ("map", "ndcg_at_k", "precision_at_k", "recall_at_k")

# Metrics of one user in one run.
USER_RUNS = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("split", T.StringType(), False),
    T.StructField("label", T.StringType(), False),
    T.StructField("user_id", T.IntegerType()),
    *[T.StructField(m, T.DoubleType()) for m in METRICS],
])
