"""Exact top-k inner products by columnar branch and bound.

Queries and candidates meet in blocks, in which vectors are held by dimension. Scores grow one
group of dimensions at a time, for every query those first that can add most to its scores. What a candidate can still
gain or lose is at most the product of the remaining norms, and at most what the extremes of the
block's remaining dimensions give; candidates whose best possible score falls below the bar are compacted away.
The bar is the k-th best assured score, or that of the first block, which all queries meet before the others.

Rows ask and are candidates one by one, also where they repeat an id: a query meets every row but its own. Vectors that
are null or hold null or non-finite components take no part, nor do rows without an id; finite components of any
size do, in whole numbers of any length where doubles would not be exact (blocks of such vectors are not pruned). A query meets vectors of its own length
only, the empty vector included. Scores beyond a long are held at its ends and ranked as such; ties go to the smaller
vec_id. Whole vectors of any length are read, other columns are ignored whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tastemill.llm.common import stage, table

SCALE = 1024
EXACT = 2.0 ** 53  # whole numbers up to here are doubles
CANDIDATES = 1 << 14  # rows of a candidate block
QUERIES = 1 << 12  # rows of a query block
DIMENSIONS, FIRST = 8, 16  # dimensions added between two rounds of pruning, and before the first with a bar (twice without)
FEW = 16  # below this fraction of a block the rest of the survivors is scored at once
ENDS = (-(2 ** 63), 2 ** 63 - 1)
RESULT = "query_row long, query_id long, row long, vec_id long, score long"


def read_vectors(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """(row, vec_id, v, dim) of the vectors that take part, staged; ``row`` tells rows with one id apart."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col(vector).isNotNull()).where(sound)
    return stage(rows.select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"),
        F.col(vector).cast("array<double>").alias("v"), F.size(vector).alias("dim"),
    ), "vectors")


def scaled(rows: pa.Table) -> np.ndarray:
    """floor(1024 x) of the vectors' components, one vector a row: doubles where these are exact, else Python integers."""
    flat = rows.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    x = flat.reshape(rows.num_rows, rows.column("dim")[0].as_py())
    if np.abs(x).max(initial=0) * SCALE < EXACT:
        return np.floor(x * SCALE)
    # From 2^53 on a double is whole; below, scaling by a power of two is exact.
    whole = [[int(c) * SCALE if abs(c) >= EXACT else int(np.floor(c * SCALE)) for c in v] for v in x.tolist()]
    out = np.empty(x.shape, object)
    out[...] = whole
    return out


class Block:
    """Candidates by dimension, with what bounds their scores."""

    def __init__(self, columns: np.ndarray):
        self.columns = columns
        self.exact = columns.dtype != object  # bounds are doubles; beyond these, all candidates are scored
        self.approximate = columns.astype(np.float64) if self.exact else np.zeros(columns.shape)
        squares = self.approximate ** 2
        self.mass = squares.sum(axis=0)
        self.spread = np.sqrt(squares.mean(axis=1)) if columns.shape[1] else np.zeros(len(columns))
        self.high, self.low = (f(self.approximate, axis=1) if columns.shape[1] else np.zeros(len(columns)) for f in (np.max, np.min))


def query_topk(
    query: np.ndarray, block: Block, ids: np.ndarray, others: np.ndarray, k: int, bar: float, alive_by_round: list | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of the k best of the ``others``; those surely below ``bar`` may be left out. Ties go to the smaller id."""
    dim = len(query)
    q = query.astype(np.float64) if block.exact else np.zeros(dim)
    order = np.argsort(-np.abs(q) * block.spread, kind="stable")
    gains = np.maximum(q * block.high, q * block.low)[order]
    losses = np.minimum(q * block.high, q * block.low)[order]
    norms = np.sqrt(np.append(np.cumsum((q[order] ** 2)[::-1])[::-1], 0))
    alive = others
    score = np.zeros(len(alive), block.columns.dtype)
    mass = block.mass[alive]
    low = 0
    while low < dim:
        # Few are left: what remains of them is added at once. At the beginning nothing can be told from a few dimensions.
        few = len(alive) * FEW <= len(ids)
        high = dim if few else min(dim, low + (DIMENSIONS if low else FIRST if bar > -np.inf else 2 * FIRST))
        dims = order[low:high]
        part = block.columns[np.ix_(dims, alive)] if len(alive) < len(ids) else block.columns[dims]
        score = score + query[dims] @ part
        low = high
        if low < dim and block.exact and (len(alive) > k or bar > -np.inf):
            mass = mass - np.einsum("ij,ij->j", part, part)
            reach = norms[low] * np.sqrt(np.maximum(mass, 0) + 1e-9 * block.mass[alive]) * (1 + 1e-9)
            least = bar
            if len(alive) >= k:
                assured = score + np.maximum(-reach, losses[low:].sum())
                least = max(least, np.partition(assured, -k)[-k])
            least -= 1e-9 * abs(least) + 1e-6
            stay = np.flatnonzero(score + np.minimum(reach, gains[low:].sum()) >= least)
            if len(stay) < len(alive):
                alive, score, mass = alive[stay], score[stay], mass[stay]
        if alive_by_round is not None:
            alive_by_round.append((low, len(alive)))
    if score.dtype == object:
        score = np.array([min(max(int(s), ENDS[0]), ENDS[1]) for s in score], np.int64)
    else:
        score = score.astype(np.int64)
    best = np.lexsort((ids[alive], ~score))[:k]  # ~score orders as -score and can't overflow
    return alive[best], score[best]


def exact_topk(queries: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score) for queries and candidates as ``read_vectors`` gives them."""
    query_blocks = max(1, -(-queries.count() // QUERIES))
    blocks = max(1, -(-candidates.count() // CANDIDATES))

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], [], []]
        if left.num_rows and right.num_rows:
            asked, held = scaled(left), scaled(right)
            most = float(np.abs(asked).max(initial=0)) * float(np.abs(held).max(initial=0)) * max(asked.shape[1], 1)
            if most >= EXACT:
                asked, held = asked.astype(object), held.astype(object)
                if asked.size and isinstance(asked.flat[0], float):
                    asked = np.vectorize(int, otypes=[object])(asked)
                if held.size and isinstance(held.flat[0], float):
                    held = np.vectorize(int, otypes=[object])(held)
            block = Block(np.ascontiguousarray(held.T))
            rows, ids = (right.column(c).to_numpy() for c in ("row", "vec_id"))
            everyone = np.arange(len(ids))
            for n in range(left.num_rows):
                row, query_id, bar = (left.column(c)[n].as_py() for c in ("row", "vec_id", "bar"))
                others = everyone[rows != row]
                places, scores = query_topk(asked[n], block, ids, others, k, -np.inf if bar is None else float(bar))
                for column, values in zip(out, ([row] * len(places), [query_id] * len(places), rows[places], ids[places], scores)):
                    column.extend(values)
        names = ["query_row", "query_id", "row", "vec_id", "score"]
        return pa.table([pa.array(c, pa.int64()) for c in out], names=names)

    def dealt(rows: DataFrame, own: str, count: int, other: str, low: int, high: int, *more: str) -> DataFrame:
        block = F.pmod(F.xxhash64("row"), F.lit(count)).cast("int").alias(own)
        return rows.select("row", "vec_id", "v", "dim", *more, block, F.explode(F.sequence(F.lit(low), F.lit(high - 1))).alias(other))

    def best_in(low: int, high: int, asking: DataFrame) -> DataFrame:
        """Every query's best in the blocks from ``low`` to ``high``."""
        keys = ["dim", "query_block", "block"]
        asked = dealt(asking, "query_block", query_blocks, "block", low, high, "bar").groupBy(*keys)
        there = dealt(candidates, "block", blocks, "query_block", 0, query_blocks).where(F.col("block").between(low, high - 1))
        return asked.cogroup(there.groupBy(*keys)).applyInArrow(meet, RESULT)

    best = stage(best_in(0, 1, queries.withColumn("bar", F.lit(None).cast("long"))), "topk-first")
    if blocks > 1:
        bars = best.groupBy(F.col("query_row").alias("row")).agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("bar"))
        best = best.unionByName(best_in(1, blocks, stage(queries.join(bars, "row", "left"), "topk-bars")))
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_vectors(table(spark, sf_dir, "embeddings"))
    return exact_topk(vectors.where(F.col("vec_id") % 100 == 0), vectors, 10)


ORACLE = """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM e q JOIN e c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM p
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
