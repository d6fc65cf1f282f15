"""Mix sources to target weights by hash-threshold histograms, in DataFrame operations only.

A source whose target is r times its size gives every document floor(r) times, and once more
those whose hash lies below a threshold. The threshold is found in nested histograms: sizes
are summed by source and leading hash digits, only the bucket in which the budget ends is
cut again by the next digits, and the last bucket's documents join if that brings the sum
nearer. Nothing is sorted, and the choice depends on the rows alone, so reruns agree.

Null texts have size 0, a null source is a source of its own. Rows that agree in doc_id and
text share a hash and are taken together, so ties in the hash are taken or left as one. Sources without words have target
0. Whole texts of any length are counted. Columns other than doc_id, text and source are ignored whatever their names; ``take_mix``
returns them. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tastemill.llm.common import WORD, ranked, stage, table

WEIGHTS = (5, 2, 1)
MOST = 3  # times a document or source may be taken
DIGITS = 3  # hexadecimal digits by which each histogram cuts deeper
HASH_DIGITS = 15


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, hash): words of the text and 60 bits of its digest."""
    text = F.coalesce(F.col("text"), F.lit(""))
    label = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), text)
    return docs.select(
        "doc_id", "source", F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        F.conv(F.substring(F.md5(label), 1, HASH_DIGITS), 16, 10).cast("long").alias("hash"),
    )


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, target): shares by weight, limited to ``most`` times the source's own size.

    A source is full while most x size <= weight x level; the level rises with each full
    source until none is added. Each step is one sum over the table of sources.
    """
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    places = ranked(sums.withColumn("_last", F.col("source").isNull()), [F.col("_last"), F.col("source")], "sources", "place")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    sources = stage(places.select("source", "source_size", weight.cast("long").alias("weight")), "source-weights")
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    left, share, full = total, 0, F.lit(False)
    while True:
        taken, open_weight = sources.agg(
            F.coalesce(F.sum(F.when(full, most * F.col("source_size"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)),
        ).first()
        if (total - taken, open_weight) == (left, share) or not open_weight:
            break
        left, share = total - taken, open_weight
        full = F.col("source_size") * most * share <= F.col("weight") * left
    quota = F.col("weight") * F.lit(left).cast("double") / F.lit(max(share, 1)).cast("double")
    target = F.when(full, (most * F.col("source_size")).cast("double")).otherwise(quota)
    return sources.select("source", "source_size", target.alias("target"))


def thresholds(sizes: DataFrame, wanted: DataFrame) -> DataFrame:
    """(source, source_size, target, whole, threshold): documents with a hash below it are taken once more."""
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    state = wanted.withColumn("whole", whole.cast("long")).select(
        "*", (F.col("target") - F.col("whole") * F.col("source_size")).alias("budget"), F.lit(0).cast("long").alias("bucket")
    )
    state = stage(state, "budgets")
    step = 16 ** DIGITS
    for depth in range(DIGITS, HASH_DIGITS + 1, DIGITS):
        unit = 16 ** (HASH_DIGITS - depth)
        boundary = state.select(F.col("source").alias("_source"), F.col("bucket").alias("_bucket"))
        met = sizes["source"].eqNullSafe(boundary["_source"])
        if depth > DIGITS:
            met = met & (F.expr(f"hash div {unit * step}") == F.col("_bucket"))
        # One row per source beside the documents: AQE broadcasts it while it is small.
        inside = sizes.join(boundary, met).groupBy(
            F.col("_source"), F.expr(f"hash div {unit}").alias("_part")
        ).agg(F.sum("size").alias("_size"))
        upto = Window.partitionBy("_source").orderBy("_part")
        parts = inside.select("*", F.sum("_size").over(upto).alias("_upto"))
        parts = parts.join(
            state.select(F.col("source").alias("_s"), F.col("budget").alias("_budget")), F.col("_source").eqNullSafe(F.col("_s"))
        )
        # The boundary is the first bucket with which the sum reaches the budget.
        ended = parts.where(F.col("_upto") >= F.col("_budget")).groupBy("_s").agg(
            F.min(F.struct("_part", "_upto", "_size")).alias("_end"), F.lit(True).alias("_met")
        )
        state = state.join(ended, state["source"].eqNullSafe(ended["_s"]), "left").select(
            "source", "source_size", "target", "whole",
            (F.col("budget") - F.coalesce(F.col("_end._upto") - F.col("_end._size"), F.lit(0))).alias("budget"),
            F.coalesce("_end._part", F.lit(16 ** depth)).alias("bucket"),
            F.coalesce("_end._size", F.lit(0)).alias("last_size"),
        )
        state = stage(state, f"thresholds-{depth}")
    nearer = F.col("last_size") - F.col("budget") < F.col("budget")
    cut = F.col("bucket") + F.when(nearer, F.lit(1)).otherwise(F.lit(0))
    return state.select("source", "source_size", "target", "whole", cut.alias("threshold"))


def mix(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Staged sizes with source_size, target, and how often the mix takes each document."""
    cuts = thresholds(sizes, targets(sizes, weights, most)).withColumnRenamed("source", "_source")
    cuts = stage(cuts, "cuts")
    times = F.col("whole") + F.when(F.col("hash") < F.col("threshold"), F.lit(1)).otherwise(F.lit(0))
    return sizes.join(cuts, sizes["source"].eqNullSafe(cuts["_source"])).select(
        "doc_id", "source", "size", "hash", "source_size", "target", F.least(times, F.lit(most)).alias("times")
    )


def take_mix(docs: DataFrame) -> DataFrame:
    """The documents of the mix with all their columns, each as often as the mix takes it."""
    sizes = stage(sized(docs), "sizes")
    cuts = stage(thresholds(sizes, targets(sizes)), "cuts").select(
        F.col("source").alias("_source"), F.col("whole").alias("_whole"), F.col("threshold").alias("_threshold")
    )
    text = F.coalesce(F.col("text"), F.lit(""))
    label = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), text)
    packed = docs.select(
        F.struct("*").alias("_row"), F.col("source").alias("_of"),
        F.conv(F.substring(F.md5(label), 1, HASH_DIGITS), 16, 10).cast("long").alias("_hash"),
    )
    times = F.least(F.col("_whole") + F.when(F.col("_hash") < F.col("_threshold"), F.lit(1)).otherwise(F.lit(0)), F.lit(MOST))
    met = packed.join(cuts, packed["_of"].eqNullSafe(cuts["_source"])).withColumn("_times", times.cast("int"))
    return met.where(F.col("_times") > 0).select(
        "_row", F.explode(F.array_repeat(F.lit(1), F.col("_times")))
    ).select("_row.*")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = stage(sized(table(spark, sf_dir, "documents")), "sizes")
    taken = (F.col("size") * F.col("times")).cast("long").alias("taken")
    return mix(sizes).select("doc_id", "size", "source_size", "target", taken)


# Sources by cap per weight: those before the level are full. Hash sums give the same prefix as the histograms.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 15))::BIGINT AS h
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::BIGINT AS w
  FROM d GROUP BY source
), o AS (
  SELECT *, row_number() OVER (ORDER BY source_size * 3.0 / w, source NULLS LAST) AS k FROM s
), l AS (
  SELECT o.*, sum(source_size) OVER () AS total,
    coalesce(sum(3 * source_size) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_before,
    sum(w) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_w
  FROM o
), f AS (
  SELECT min(k) AS k FROM l WHERE 3 * source_size * open_w > w * (total - full_before)
), level AS (
  SELECT (total - full_before)::DOUBLE AS amount, open_w::DOUBLE AS share, l.k FROM l, f WHERE l.k = f.k
), t AS (
  SELECT l.source, source_size, CASE WHEN level.k IS NULL OR l.k < level.k THEN (3 * source_size)::DOUBLE
    ELSE w * amount / share END AS target
  FROM l LEFT JOIN level ON true
), b AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM t
), r AS (
  SELECT d.doc_id, d.size, h, source_size, target, whole, target - whole * source_size AS budget,
    sum(size) OVER (PARTITION BY d.source ORDER BY h) AS upto, sum(size) OVER (PARTITION BY d.source, h) AS own
  FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
  (size * (whole + CASE WHEN upto < budget OR (upto - own < budget AND upto - budget < budget - (upto - own))
    THEN 1 ELSE 0 END))::BIGINT AS taken
FROM r
"""
