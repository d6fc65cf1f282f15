import math
import random

import pytest
from pyspark.ml.evaluation import RankingEvaluator
from pyspark.sql import functions as F

from tastemill.operators.als import to_ranked_lists
from tastemill.operators.evaluate import evaluate_ranking, rmse
from tastemill.operators.popularity import item_popularity, popularity_hits, popularity_recs

KIND = [("test", "read")]


def frames(spark, lists, labels):
    recs = [(u, item, rank) for u, items in lists.items() for rank, item in enumerate(items, 1)]
    held = [(u, item, "test", "read") for u, items in labels.items() for item in items]
    return (
        spark.createDataFrame(recs, "user_id int, item_id int, rank int"),
        spark.createDataFrame(held, "user_id int, item_id int, split string, label string"),
    )


def test_known_metrics(spark):
    lists = {1: [1, 2, 3, 4], 2: [5, 6], 3: [7, 8, 9], 4: [1]}
    labels = {1: [2, 4, 9], 2: [5], 3: [1, 2, 3, 4, 5], 4: [1, 2, 3]}
    row = evaluate_ranking(*frames(spark, lists, labels), KIND, k=3).first()
    assert (row.users, round(row.map, 7), round(row.ndcg_at_k, 7)) == (4, 0.4166667, 0.4413402)
    assert (row.precision_at_k, round(row.recall_at_k, 7)) == (0.25, 0.4166667)


def test_metrics_agree_with_the_library(spark):
    rng = random.Random(3)
    lists = {u: rng.sample(range(60), rng.randint(1, 20)) for u in range(80)}
    labels = {u: rng.sample(range(60), rng.randint(1, 30)) for u in range(80)}
    recs, held = frames(spark, lists, labels)
    row = evaluate_ranking(recs, held.unionAll(held), KIND, k=20).first()
    arrays = spark.createDataFrame(
        [([float(i) for i in lists[u]], [float(i) for i in labels[u]]) for u in lists],
        "prediction array<double>, label array<double>",
    )
    for name, got in (("meanAveragePrecision", row.map), ("ndcgAtK", row.ndcg_at_k),
                      ("precisionAtK", row.precision_at_k), ("recallAtK", row.recall_at_k)):
        want = RankingEvaluator(metricName=name, k=20).evaluate(arrays)
        assert math.isclose(got, want, rel_tol=1e-9), name


def test_users_without_recommendations(spark):
    recs, held = frames(spark, {1: [1]}, {1: [1], 2: [5]})
    drop = evaluate_ranking(recs, held, KIND, k=1).first()
    zero = evaluate_ranking(recs, held, KIND, k=1, missing="zero").first()
    assert (drop.users, drop.map) == (1, 1.0) and (zero.users, zero.map) == (2, 0.5)
    with pytest.raises(ValueError):
        evaluate_ranking(recs, held, KIND, missing="guess")


def test_popularity_leaves_out_the_seen(spark):
    rows = [(u, i, 1) for u in range(1, 6) for i in range(1, 7) if i <= 6 - u] + [(9, i, 0) for i in range(1, 7)]
    train = spark.createDataFrame(rows, "user_id int, item_id int, is_read int")
    assert [(r.item_id, r.read_count, r.pop_rank) for r in item_popularity(train, 3).collect()] == [
        (1, 5, 1), (2, 4, 2), (3, 3, 3)]
    recs = popularity_recs(train, k=2, pool=4).collect()
    lists = {}
    for r in sorted(recs, key=lambda r: (r.user_id, r["rank"])):
        lists.setdefault(r.user_id, []).append(r.item_id)
    # Users 1, 2 and 9 met every pool item and have no list.
    assert lists == {3: [4], 4: [3, 4], 5: [2, 3]}


@pytest.mark.parametrize("missing", ["drop", "zero"])
def test_hits_score_like_the_lists(spark, missing):
    rng = random.Random(4)
    pairs = [(u, i) for u in range(40) for i in rng.sample(range(30), rng.randint(1, 29))] + [(99, i) for i in range(30)]
    train = spark.createDataFrame([(u, i, 1) for u, i in pairs], "user_id int, item_id int, is_read int")
    held = [(u, rng.randrange(35), s, "read") for u in range(45) for s in ("validation", "test") for _ in range(6)]
    held.append((99, 3, "test", "read"))
    labels = spark.createDataFrame(held, "user_id int, item_id int, split string, label string")
    kinds = [("validation", "read"), ("test", "read")]
    for k, pool in ((5, 30), (3, 8), (50, 100)):
        lists = evaluate_ranking(popularity_recs(train, k, pool), labels, kinds, k=k, missing=missing)
        hits = evaluate_ranking(popularity_hits(train, labels, k, pool), labels, kinds, k=k, missing=missing)
        flat = lambda df: sorted((r.split, r.users, *(round(v, 9) for v in r[3:])) for r in df.collect())
        assert flat(lists) == flat(hits)


@pytest.mark.parametrize("missing", ["drop", "zero"])
def test_pools_at_once_score_like_one_by_one(spark, missing):
    rng = random.Random(6)
    pairs = [(u, i) for u in range(40) for i in rng.sample(range(30), rng.randint(1, 29))]
    pairs += [(99, i) for i in range(30)] + [(98, i) for i in range(7)]
    train = spark.createDataFrame([(u, i, 1) for u, i in pairs], "user_id int, item_id int, is_read int")
    held = [(u, rng.randrange(35), s, "read") for u in (*range(45), 98) for s in ("validation", "test") for _ in range(6)]
    labels = spark.createDataFrame(held, "user_id int, item_id int, split string, label string")
    kinds, pools = [("validation", "read"), ("test", "read")], (1, 4, 9, 40)
    flat = lambda df: sorted((r.split, r.users, *(round(r[m], 9) for m in ("map", "ndcg_at_k", "precision_at_k", "recall_at_k"))) for r in df.collect())
    hits = popularity_hits(train, labels, 5, 40)
    table = evaluate_ranking(hits, labels, kinds, k=5, missing=missing, pools=pools)
    for pool in pools:
        one = evaluate_ranking(popularity_recs(train, 5, pool), labels, kinds, k=5, missing=missing)
        assert flat(table.where(F.col("pool") == pool)) == flat(one), pool


def test_ranked_lists(spark):
    recs, _ = frames(spark, {1: [9, 3, 7], 2: [5]}, {1: [1]})
    got = {r.user_id: r["items"] for r in to_ranked_lists(recs.orderBy(F.rand(1))).collect()}
    assert got == {1: [9, 3, 7], 2: [5]}


def test_rmse(spark):
    df = spark.createDataFrame([(3.0, 1.0), (4.0, 4.0), (2.0, None)], "score double, prediction double")
    row = rmse(df).first()
    assert row.rows == 2 and math.isclose(row.rmse, math.sqrt(2.0))
