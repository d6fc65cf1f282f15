import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tastemill.operators import als, checks, scoring


def given(spark, seed, users, items, rank, high=3):
    """Whole-number factors with many equal scores, and the brute-force order of all items per user row."""
    rng = random.Random(seed)
    of = [[(i, [float(rng.randint(-high, high)) for _ in range(rank)]) for i in ids] for ids in (users, items)]
    tables = [spark.createDataFrame(rows, "id int, features array<float>").repartition(3) for rows in of]
    def best(user, pool):
        scored = [(-sum(a * b for a, b in zip(x, y)), i) for u, x in of[0] if u == user for i, y in of[1]]
        return [(i, -s) for s, i in sorted(scored)[:pool]]
    return *tables, best


def lists_of(rows):
    got = {}
    for r in sorted(rows, key=lambda r: (r.user_id, r.place)):
        got.setdefault(r.user_id, []).append((r.item_id, r.score))
    return got


@pytest.mark.parametrize("pool", [1, 7, 40, 10_000])
@pytest.mark.parametrize("small", [False, True])
def test_best_items_are_those_of_brute_force(spark, monkeypatch, pool, small):
    if small:  # several slices of several blocks, a few users at a time
        monkeypatch.setattr(scoring, "SLICE_BYTES", 1500)
        monkeypatch.setattr(scoring, "ITEM_BYTES", 4 * 3 * 16)
        monkeypatch.setattr(scoring, "ITEM_ROWS", 16)
        monkeypatch.setattr(scoring, "STATE_BYTES", 8 * 4 * min(pool, 400) * 9)
    users, items, best = given(spark, 3, range(50), range(-200, 200), 3)
    rows = scoring.best_items(users.withColumn("depth", F.col("id") + 5), items, 3, pool).collect()
    assert all(r.depth == r.user_id + 5 for r in rows)
    got = lists_of(rows)
    assert set(got) == set(range(50))
    for user, listed in got.items():
        assert listed == best(user, pool), user


def test_repeated_ids_share_a_list(spark):
    users, items, best = given(spark, 5, [1, 1, 2, 3, 3, 3], [*range(30), *range(10)], 2)
    got = lists_of(scoring.best_items(users.withColumn("depth", F.lit(1)), items, 2, 12).collect())
    assert got == {user: best(user, 12) for user in (1, 2, 3)}


def test_no_users_or_items_give_no_rows(spark):
    users, items, _ = given(spark, 5, range(3), range(4), 2)
    users = users.withColumn("depth", F.lit(1))
    assert scoring.best_items(users.limit(0), items, 2, 3).count() == 0
    assert scoring.best_items(users, items.limit(0), 2, 3).count() == 0


def test_bars_never_lose_an_item():
    rng = np.random.default_rng(2)
    users, items = (rng.normal(size=(n, 5)).astype(np.float32) for n in (700, 9000))
    items[4000:4100] = items[3]
    ids = rng.permutation(len(items)).astype(np.int32)
    best = scoring.Best(len(users), 20, 80)
    for low in range(0, len(ids), 3001):
        scoring.meet(best, users, ids[low:low + 3001], items[low:low + 3001])
    best.cut(np.arange(len(users)))
    scores = users @ items.T
    for row in range(len(users)):
        want = np.lexsort((ids, -scores[row]))[:20]
        assert sorted(best.items[row, :best.counts[row]]) == sorted(ids[want])


def test_a_factor_that_is_no_number_ranks_first():
    best = scoring.Best(2, 2, 8)
    items = np.array([[1.0, 0], [2, 0], [np.nan, 0], [3, 0]], np.float32)
    scoring.meet(best, np.ones((2, 2), np.float32), np.arange(4, dtype=np.int32), items)
    best.cut(np.arange(2))
    assert [sorted(row[:2]) for row in best.items] == [[2, 3]] * 2


def test_places_that_no_list_can_reach_leave_before_the_seen_items(spark, tmp_path, monkeypatch):
    users, items, best = given(spark, 9, range(20), range(300), 4, high=50)
    model = als.model_of_factors(users, items, str(tmp_path / "model"))
    met = {user: {i for i, _ in best(user, 30)[:user]} for user in range(20)}
    seen = spark.createDataFrame([(u, i) for u, s in met.items() for i in s], "user_id int, item_id int")
    plain, looked_up = als.exclude_seen, []

    def counted(candidates, seen):
        looked_up.append(candidates.groupBy("user_id").count().collect())
        return plain(candidates, seen)

    monkeypatch.setattr(als, "exclude_seen", counted)
    rows = als.recommend_topk(model, users.select(F.col("id").alias("user_id")), seen, 10, 100).collect()
    [[*counts]] = looked_up
    assert {r.user_id: r["count"] for r in counts} == {user: 10 + user for user in range(20)}
    for user in range(20):
        listed = [r.item_id for r in sorted(rows, key=lambda r: r["rank"]) if r.user_id == user]
        assert listed == [i for i, _ in best(user, 100) if i not in met[user]][:10]


@pytest.mark.parametrize("small", [False, True])
def test_list_checks_find_wrong_scores_without_joining_factors(spark, tmp_path, monkeypatch, small):
    if small:
        monkeypatch.setattr(scoring, "SLICE_BYTES", 900)
        monkeypatch.setattr(scoring, "ITEM_BYTES", 4 * 4 * 8)
        monkeypatch.setattr(scoring, "ITEM_ROWS", 8)
        monkeypatch.setattr(scoring, "PAIR_ROWS", 60)
    users, items, _ = given(spark, 9, range(20), range(300), 4, high=50)
    model = als.model_of_factors(users, items, str(tmp_path / "model"))
    seen = spark.createDataFrame([(0, 1)], "user_id int, item_id int")
    recs = als.recommend_topk(model, users.select(F.col("id").alias("user_id")), seen, 10, 100)
    made = spark.sparkContext.accumulator(0)
    mark = F.udf(lambda score: made.add(1) or score, "float").asNondeterministic()
    checked = checks.list_checks(model, recs.withColumn("score", mark("score")), seen, 10)
    assert "of_item" not in checked._jdf.queryExecution().optimizedPlan().toString()
    assert tuple(checked.first()) == (20, 0, 0, 0, 0, 0) and made.value == 200
    wrong = recs.withColumn("score", F.when(F.col("user_id") == 3, F.col("score") * 1.01 + 1).otherwise(F.col("score")).cast("float"))
    wrong = wrong.withColumn("score", F.when((F.col("user_id") == 4) & (F.col("rank") == 1), None).otherwise(F.col("score")))
    wrong = wrong.withColumn("item_id", F.when((F.col("user_id") == 5) & (F.col("rank") < 3), 1000 + F.col("rank")).otherwise(F.col("item_id")))
    wrong = wrong.withColumn("user_id", F.when(F.col("user_id") == 6, 777).otherwise(F.col("user_id")))
    assert checks.list_checks(model, wrong, seen, 10).first().score_breaks == 10 + 1 + 2 + 10
    none = checks.list_checks(model, recs.limit(0), seen, 10)
    assert tuple(none.first()) == (0, 0, 0, 0, 0, 0)
