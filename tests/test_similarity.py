import random

import pytest
from pyspark.sql import functions as F

from tastemill.functions.hashing import MINHASH_PRIME, minhash_coefficients, minhash_value
from tastemill.operators import similarity
from tastemill.operators.similarity import reader_pairs, similar_pairs

KEYS = ("item_id_1", "item_id_2", "reader_count_1", "reader_count_2", "intersection_size", "union_size")


def frame(spark, sets):
    rows = [(item, user, 1) for item, users in sets.items() for user in users]
    rows += rows[:50] + [(item, 10**6, 0) for item in sets]
    random.Random(2).shuffle(rows)
    return reader_pairs(spark.createDataFrame(rows, "item_id int, user_id int, is_read int"))


def brute_force(sets, k, min_readers, max_distance, collide, seed=42):
    coefficients = minhash_coefficients(5, seed)
    kept = {i: s for i, s in sets.items() if len(s) >= min_readers}
    sig = {i: [min(((x + 1) * a + b) % MINHASH_PRIME for x in s) for a, b in coefficients] for i, s in kept.items()}
    out = []
    for i in kept:
        for j in kept:
            inter = len(kept[i] & kept[j])
            if i < j and inter and (not collide or any(x == y for x, y in zip(sig[i], sig[j]))):
                union = len(kept[i] | kept[j])
                if 1.0 - inter / union < max_distance:
                    out.append((i, j, len(kept[i]), len(kept[j]), inter, union))
    out.sort(key=lambda p: (-p[4] / p[5], -p[4], -p[2], -p[3], p[0], p[1]))
    return out[:k]


def random_sets(rng, items, users, size):
    return {i: set(rng.sample(range(users), rng.randint(3, size))) for i in range(items)}


def near_copies(rng, sets, n, users):
    base = max(sets) + 1
    for i in range(n):
        s = set(sets[rng.choice(sorted(sets))])
        s -= set(rng.sample(sorted(s), rng.randint(0, 1)))
        s |= set(rng.sample(range(users), rng.randint(0, 2)))
        sets[base + i] = s
    return sets


def hot_reader_and_item(rng):
    sets = random_sets(rng, 60, 200, 12)
    for s in sets.values():
        s |= {0, 1}
    sets[500] = set(range(200))
    sets[501] = set(range(0, 190))
    return near_copies(rng, sets, 15, 200)


def many_copies(rng):
    sets = near_copies(rng, random_sets(rng, 30, 80, 10), 10, 80)
    one, two = set(range(8)), set(range(1, 9))
    for n, i in enumerate(rng.sample(range(1000, 2000), 40)):
        sets[i] = set(one if n % 2 else two)
    return sets


CASES = {
    "random": lambda rng: random_sets(rng, 80, 60, 10),
    "near copies": lambda rng: near_copies(rng, random_sets(rng, 50, 300, 20), 50, 300),
    "hot": hot_reader_and_item,
    "copies": many_copies,
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("k,hot_rows,collide", [(10, 10**6, True), (25, 20, True), (5, 15, False), (3000, 20, False)])
def test_pairs_equal_brute_force(spark, tmp_path, name, k, hot_rows, collide):
    sets = CASES[name](random.Random(k))
    crowded = 64 if hot_rows > 1000 else 2
    got = similar_pairs(frame(spark, sets), str(tmp_path), k, 3, 0.8, collide=collide, hot_rows=hot_rows, crowded_sets=crowded)
    rows = [tuple(r[c] for c in KEYS) for r in got.collect()]
    assert rows == brute_force(sets, k, 3, 0.8, collide)


def test_threshold_is_strict(spark, tmp_path):
    sets = {1: {0, 1, 2, 3}, 2: {0, 1, 4, 5}}
    run = lambda d: similar_pairs(frame(spark, sets), str(tmp_path), 10, 1, d, collide=False).count()
    assert run(1.0 - 2 / 6) == 0 and run(1.0 - 2 / 6 + 1e-9) == 1


def test_published_shapes(spark, tmp_path):
    # (r1, r2, intersection, union, jaccard)
    known = [(35, 34, 34, 35, 0.971429), (71, 70, 69, 72, 0.958333), (44, 42, 42, 44, 0.954545)]
    sets = {}
    for n, (r1, r2, inter, _, _) in enumerate(known):
        base = 1000 * n
        sets[2 * n] = set(range(base, base + r1))
        sets[2 * n + 1] = set(range(base, base + inter)) | set(range(base + 500, base + 500 + r2 - inter))
    rows = similar_pairs(frame(spark, sets), str(tmp_path)).collect()
    got = [(r.reader_count_1, r.reader_count_2, r.intersection_size, r.union_size, round(r.jaccard_similarity, 6))
           for r in rows]
    assert got == known


def test_words_with_equal_codes_stay_apart(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tastemill.operators.similarity.signature_code", lambda readers: F.lit(1))
    words = {1: "abcd", 2: "abce", 3: "wxyz"}
    rows = [(item, word, 1) for item, text in words.items() for word in text]
    readers = reader_pairs(spark.createDataFrame(rows, "item_id int, user_id string, is_read int"))
    got = similar_pairs(readers, str(tmp_path), 10, 1, 0.9).collect()
    assert [tuple(r[c] for c in KEYS) for r in got] == [(1, 2, 4, 4, 3, 5)]


def test_negative_ids_hash_into_the_family(spark):
    row = spark.range(1).select(minhash_value(F.lit(-5), 2 * 10**9, 3).alias("h")).first()
    assert row.h == (-4 * 2 * 10**9 + 3) % MINHASH_PRIME


def classes_of(spark, sets, path):
    readers = similarity.write_table(frame(spark, sets), f"{path}/readers")
    items = similarity.item_reader_sets(readers, 1, 5, 42, bits=True)
    classes = similarity.write_table(similarity.set_classes(items), f"{path}/classes")
    return readers, classes, [f"h{i}" for i in range(5)]


def test_candidates_meet_on_buckets_only(spark, tmp_path, capsys):
    sets = random_sets(random.Random(3), 30, 60, 10)
    readers, classes, hs = classes_of(spark, sets, tmp_path)
    pairs = similarity.colliding_pairs(classes, readers, hs, 0.2, None, sets=len(sets))
    pairs.explain()
    plan = capsys.readouterr().out
    assert "[turn#" in plan and "hash#" in plan and "reader#" not in plan.replace("reader_count#", "")
    rows = [(r.a, r.b) for r in pairs.collect()]
    assert len(rows) == len(set(rows)) > 0  # a pair that collides in several tables comes once


@pytest.mark.parametrize("crowded", [1, 64])
def test_every_colliding_pair_above_the_floor_is_met(spark, tmp_path, crowded):
    sets = hot_reader_and_item(random.Random(8))
    readers, classes, hs = classes_of(spark, sets, tmp_path)
    for floor in (0.2, 0.6):
        met = similarity.colliding_pairs(classes, readers, hs, floor, None, sets=1000, crowded_sets=crowded)
        got = {(min(r.a, r.b), max(r.a, r.b)) for r in met.collect()}
        want = {(i, j) for i, j, _, _, inter, union in brute_force(sets, 10**6, 1, 1.0, True) if inter / union >= floor and inter < union}
        reps = {r.rep for r in classes.collect()}
        assert {p for p in want if p[0] in reps and p[1] in reps} <= got


def test_recall_of_collisions(spark, tmp_path):
    rng = random.Random(4)
    sets = {}
    for i in range(150):  # pairs of all similarities from 0.5 on
        shared, own = rng.randint(20, 40), rng.randint(0, 10)
        base = 10_000 * i
        sets[2 * i] = set(range(base, base + shared + own))
        sets[2 * i + 1] = set(range(base, base + shared)) | set(range(base + 500, base + 500 + own))
    found = [similar_pairs(frame(spark, sets), str(tmp_path / str(c)), 1000, 1, 0.5 + 1e-9, collide=c).count() for c in (True, False)]
    assert found[1] > 100 and found[0] >= 0.95 * found[1]


@pytest.mark.parametrize("hot_rows", [10**6, 30])
def test_pairs_whose_bits_are_too_few_are_not_counted(spark, tmp_path, hot_rows):
    rng = random.Random(6)
    sets = {i: set(rng.sample(range(600), 40)) for i in range(60)}
    sets[60] = set(sorted(sets[0])[:20]) | set(range(700, 720))
    readers, classes, hs = classes_of(spark, sets, tmp_path)
    hot = None
    if hot_rows < 40:
        hot = similarity.hot_items(classes.withColumnRenamed("rep", "item_id"), 40, hot_rows)
    met = similarity.candidate_pairs(classes, readers, hs, 0.1, hot, hot_rows, len(sets))
    pairs = {(r.a, r.b) for r in met.collect()}
    allowed = {(r.a, r.b) for r in similarity.bounded_pairs(met, classes, 0.1).collect()}
    need = {(i, j) for i in sets for j in sets if i < j and len(sets[i] & sets[j]) >= 8}
    assert (0, 60) in need and need <= pairs == allowed


def test_bounds_drop_pairs_before_their_sets_are_read(spark, tmp_path):
    sets = {i: set(range(40 * i, 40 * i + 40)) for i in range(8)}
    sets[8] = set(range(36)) | {1000, 1001, 1002, 1003}
    readers, classes, hs = classes_of(spark, sets, tmp_path)
    pairs = spark.createDataFrame([(i, j, 40, 40) for i in range(9) for j in range(i + 1, 9)], "a int, b int, ra bigint, rb bigint")
    left = similarity.bounded_pairs(pairs, classes, 0.7)
    assert [(r.a, r.b) for r in left.collect()] == [(0, 8)]  # of 36
    for large in (False, True):
        everyone = similarity.bounded_pairs(pairs, classes, 0.0)
        scored = similarity.verified_pairs(everyone, readers, 0.7, None, str(tmp_path / str(large)), large).collect()
        assert [(r.a, r.b, r.inter, r.union) for r in scored] == [(0, 8, 36, 44)]


def test_large_sets_are_read_in_two_steps(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(similarity, "LARGE", 5)
    sets = near_copies(random.Random(9), random_sets(random.Random(9), 60, 90, 30), 20, 90)
    for collide in (True, False):
        got = similar_pairs(frame(spark, sets), str(tmp_path), 40, 3, 0.8, collide=collide)
        assert [tuple(r[c] for c in KEYS) for r in got.collect()] == brute_force(sets, 40, 3, 0.8, collide)


def test_many_tied_pairs_need_no_single_task(spark):
    """100,000 pairs of one item with one score: the least partners win and no window sees all of them."""
    n = 100_000
    directed = spark.range(1, n + 1).select(
        F.lit(7).alias("l_rep"), F.lit(1).cast("bigint").alias("l_print_1"), F.lit(1).cast("bigint").alias("l_print_2"),
        F.when(F.col("id") <= 3, -F.col("id")).otherwise(F.col("id") * 13 % 100_003 + 8).cast("int").alias("r_rep"),
        F.col("id").alias("r_print_1"), F.col("id").alias("r_print_2"),
        *[F.lit(v).cast("bigint").alias(c) for c, v in (("r1", 10), ("r2", 10), ("inter", 5), ("union", 15))], F.lit(1 / 3).alias("jaccard"),
    )
    # Three partners have a lower representative, and their first member above item 7 is 9, 11 and 200,000.
    items = spark.createDataFrame([(-1, 1), (9, 1), (-2, 2), (11, 2), (-3, 3), (5, 3), (200_000, 3)], "item_id int, print_1 bigint")
    best = similarity.best_directed(directed, items.withColumn("print_2", F.col("print_1")), 20)
    assert "Window" not in best._jdf.queryExecution().executedPlan().toString()
    others = sorted(i * 13 % 100_003 + 8 for i in range(4, n + 1))
    want = sorted([(9, -1), (11, -2), (200_000, -3), *[(o, o) for o in others]])[:20]
    assert sorted(r.r_rep for r in best.collect()) == sorted(rep for _, rep in want)
