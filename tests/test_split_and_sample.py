import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tastemill.operators.sampling import (
    eligible_users, number_rows, sample_users, split_per_user, with_row_key,
)
from tastemill.operators import sampling
from tastemill.operators.skew import hot_keys, sliced_join, spread


def md5(text):
    return hashlib.md5(str(text).encode()).hexdigest()


def histories(spark, sizes, parts=4):
    rows = [(u, i, md5(f"{u}/{i}")) for u, n in sizes.items() for i in range(n)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "user_id int, item_id int, row_key string").repartition(parts)


def test_split_sizes(spark):
    want = {4: None, 5: (3, 1, 1), 6: (3, 1, 2), 7: (4, 1, 2), 8: (4, 2, 2), 9: (5, 2, 2), 10: (6, 2, 2), 39: (23, 8, 8)}
    dealt = split_per_user(histories(spark, {n: n for n in want}))
    got = {(r.user_id, r.split): r["count"] for r in dealt.groupBy("user_id", "split").count().collect()}
    for n, sizes in want.items():
        for name, size in zip(("train", "validation", "test"), sizes or (None,) * 3):
            assert got.get((n, name)) == size


@pytest.mark.parametrize("seed", [None, 7])
def test_split_is_free_of_layout_and_of_slicing(spark, seed):
    sizes = {1: 400, 2: 31, 3: 5, 4: 4, 5: 50}
    base = None
    for parts, hot in ((1, 10**6), (13, 10**6), (3, 20), (5, 1)):
        df = histories(spark, sizes, parts)
        got = sorted(map(tuple, split_per_user(df, seed=seed, hot_rows=hot).collect()))
        base = base or got
        assert got == base
    assert len(base) == sum(n for n in sizes.values() if n >= 5)


def test_numbering_matches_a_plain_sort(spark):
    df = histories(spark, {1: 300, 2: 20})
    want = {}
    for u, n in ((1, 300), (2, 20)):
        for pos, key in enumerate(sorted(md5(f"{u}/{i}") for i in range(n)), 1):
            want[u, key] = (pos, n)
    for hot in (7, 50, 10**6):
        got = {(r.user_id, r.row_key): (r.rn, r.n) for r in number_rows(df, "row_key", hot_rows=hot).collect()}
        assert got == want


@pytest.mark.parametrize("hot", [20, 10**6])
def test_bytes_of_the_key_give_the_order_of_its_digits(spark, hot):
    df = histories(spark, {1: 200, 2: 7, 3: 30})
    want = {(r.user_id, r.item_id): (r.rn, r.n) for r in number_rows(df, "row_key", hot_rows=hot).collect()}
    short = number_rows(df.withColumn("row_key", F.unhex("row_key")), "row_key", hot_rows=hot)
    assert {(r.user_id, r.item_id): (r.rn, r.n) for r in short.collect()} == want


def test_tasks_grow_in_number_with_the_rows(spark, monkeypatch):
    df = histories(spark, {u: 20 for u in range(30)})
    plain = sorted(map(tuple, number_rows(df, "row_key").collect()))
    assert spread(df, 600, "user_id") is df  # the session's partitions are enough
    monkeypatch.setattr(sampling, "spread", lambda rows, n, *keys: spread(rows, n, *keys, task_rows=50))
    for hot in (7, 10**6):
        numbered = number_rows(df, "row_key", hot_rows=hot)
        assert sorted(map(tuple, numbered.collect())) == plain
    assert numbered.select(F.spark_partition_id()).distinct().count() > 4
    assert numbered.rdd.getNumPartitions() == 12


def test_seed_changes_the_order(spark):
    df = histories(spark, {1: 100})
    one = set(map(tuple, split_per_user(df, seed=1).collect()))
    two = set(map(tuple, split_per_user(df, seed=2).collect()))
    assert one != two


def test_samples_are_whole_users_and_nested(spark):
    df = spark.range(3000).select((F.col("id") % 1000).cast("int").alias("user_id"), "id")
    users = {}
    for method in ("xxhash64", "md5"):
        for pct in (1, 3, 50, 100):
            kept = sample_users(df, pct, method=method)
            counts = {r.user_id: r["count"] for r in kept.groupBy("user_id").count().collect()}
            assert set(counts.values()) <= {3}
            users[pct] = set(counts)
        assert users[1] <= users[3] <= users[50] <= users[100] and len(users[100]) == 1000
        assert 400 < len(users[50]) < 600
    for bad in (0, 101):
        with pytest.raises(ValueError):
            sample_users(df, bad)


def test_sample_depends_on_the_id_type(spark):
    ints = spark.range(10000).select(F.col("id").cast("int").alias("user_id"))
    as_int = {r.user_id for r in sample_users(ints, 3).collect()}
    as_long = {r.user_id for r in sample_users(ints.select(F.col("user_id").cast("long")), 3).collect()}
    assert as_int != as_long


def test_eligible_users(spark):
    got = {r.user_id: r.n for r in eligible_users(histories(spark, {1: 4, 2: 5, 3: 9})).collect()}
    assert got == {2: 5, 3: 9}


def test_row_keys_of_repeated_rows(spark):
    rows = [(1, 1)] * 25 + [(1, 2)] * 3 + [(2, None)]
    df = spark.createDataFrame(rows, "user_id int, item_id int")
    for chunk in (4, 100):
        keyed = with_row_key(df, chunk)
        assert sorted(map(str, keyed.select("user_id", "item_id").collect())) == sorted(map(str, df.collect()))
        keys = {r.row_key for r in keyed.collect()}
        assert len(keys) == 29
    assert keys == {r.row_key for r in with_row_key(df.repartition(5), 7).collect()}


def test_sliced_join_equals_join(spark):
    rows = spark.createDataFrame([(i % 3 if i % 2 else 0, i) for i in range(200)], "k int, v int")
    other = spark.createDataFrame([(0, "a"), (0, "b"), (1, "c"), (9, "d")], "k int, w string")
    want = sorted(map(tuple, rows.join(other, "k").select("k", "v", "w").collect()))
    sizes = rows.groupBy("k").agg(F.count("*").alias("n"))
    for limit in (5, 1000):
        hot = hot_keys(sizes, "k", limit)
        got = sliced_join(rows, other, "k", "v", hot).select("k", "v", "w")
        assert sorted(map(tuple, got.collect())) == want
