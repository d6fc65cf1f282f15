import math
import random

import pytest
from pyspark.sql import functions as F

from tastemill.operators import als, checks, signals
from tastemill.operators.evaluate import rmse
from tastemill.operators.sampling import split_per_user, with_row_key
from tastemill.plans import experiments as ex
from tastemill.sources.tables import write_table

CONFIG = ex.explicit_config(rank=3, reg_param=0.01, max_iter=8, pool=30)


@pytest.fixture(scope="module")
def planted(spark):
    """Ratings from a rank-3 product with a little noise, 60 % missing."""
    rng = random.Random(5)
    users = [[rng.uniform(0.4, 1.3) for _ in range(3)] for _ in range(80)]
    items = [[rng.uniform(0.4, 1.3) for _ in range(3)] for _ in range(60)]
    rows = []
    for u, x in enumerate(users):
        for i, y in enumerate(items):
            if rng.random() < 0.4:
                score = sum(a * b for a, b in zip(x, y)) * 1.6 + rng.gauss(0, 0.05)
                rows.append((u, i, int(rng.random() < 0.6), float(score), int(rng.random() < 0.3)))
    df = spark.createDataFrame(rows, "user_id int, item_id int, is_read int, rating float, is_reviewed int")
    return split_per_user(with_row_key(df)).cache()


@pytest.fixture(scope="module")
def parts(planted):
    return planted.where("split = 'train'").drop("split"), planted.where("split <> 'train'")


@pytest.fixture(scope="module")
def model(parts):
    return ex.fit_model(CONFIG, parts[0])


def test_error_is_below_the_mean(parts, model):
    train, held = parts
    rated = signals.rated_rows(held, "split")
    fitted = rmse(als.predict_ratings(model, rated)).first().rmse
    mean = train.agg(F.avg("rating")).first()[0]
    plain = rmse(rated.withColumn("prediction", F.lit(mean))).first().rmse
    assert fitted < plain / 2


def test_lists(parts, model):
    train, held = parts
    labels = signals.build_labels(held, ["liked", "read"])
    recs = ex.recommend(CONFIG, model, train, labels, k=10).cache()
    seen = signals.seen_pairs(train)
    assert recs.join(seen, ["user_id", "item_id"]).count() == 0
    per_user = recs.groupBy("user_id").agg(
        F.count("*").alias("n"), F.max("rank").alias("last"), F.count_distinct("rank").alias("ranks"))
    assert per_user.where("n > 10 or n <> last or n <> ranks").count() == 0
    ordered = recs.alias("x").join(recs.alias("y"), "user_id").where("x.rank < y.rank and x.score < y.score")
    assert ordered.count() == 0


def test_scores_are_dot_products(parts, model):
    users = parts[0].select("user_id").distinct()
    owners = {r.id: list(r.features) for r in model.userFactors.collect()}
    items = {r.id: list(r.features) for r in model.itemFactors.collect()}
    rows = als.als_candidates(model, users, 7).collect()
    assert {r.user_id for r in rows} == set(owners)
    for r in rows:
        want = sum(a * b for a, b in zip(owners[r.user_id], items[r.item_id]))
        assert abs(r.score - want) < 1e-4


def test_same_seed_same_factors(parts, model):
    again = ex.fit_model(CONFIG, parts[0].repartition(13))
    assert again.rank == 3
    one = {r.id: list(r.features) for r in model.userFactors.collect()}
    two = {r.id: list(r.features) for r in again.userFactors.collect()}
    assert one.keys() == two.keys()
    assert max(abs(a - b) for u in one for a, b in zip(one[u], two[u])) < 1e-5


def test_implicit_factors_are_nonnegative(parts):
    config = ex.implicit_config(rank=4, max_iter=3, pool=20)
    fitted = ex.fit_model(config, parts[0])
    assert min(v for r in fitted.itemFactors.collect() for v in r.features) >= 0


def test_big_ids_are_refused(spark):
    big = spark.createDataFrame([(2**40, 1, 1.0)], "user_id bigint, item_id int, score double")
    with pytest.raises(Exception):
        als.fit_als(big, 2, 0.1)


def test_ids_of_runs():
    a, b = ex.explicit_config(5, 0.1), ex.explicit_config(5, 0.10)
    assert a.run_id == b.run_id
    other = [ex.explicit_config(5, 0.1, pool=500), ex.explicit_config(5, 0.1, max_iter=6), ex.explicit_config(5, 0.1, sample_pct=3)]
    assert len({a.run_id, *(o.run_id for o in other)}) == 4
    assert a.model_id == other[0].model_id != other[1].model_id


def test_grid_selection_and_registry(spark, parts, tmp_path):
    train, held = parts
    models, runs = str(tmp_path / "models"), str(tmp_path / "runs")
    configs = [ex.explicit_config(rank, 0.05, max_iter=3, pool=40) for rank in (1, 3)]
    kinds = [("validation", "liked")]
    for _ in range(2):  # a second pass replaces its rows
        table = ex.run_grid(configs, train, held, kinds, models, runs, k=10, load_saved=True)
        assert table.count() == 2
    board = ex.leaderboard(table, "explicit").collect()
    assert board[0].ndcg_at_k >= board[1].ndcg_at_k
    final = ex.select_and_test(runs, models, "explicit", train, held, k=10).collect()
    assert {r.split for r in final} == {"validation", "test"}
    assert {r.run_id for r in final} == {board[0].run_id}
    assert all(r.rmse > 0 for r in final)
    valid = next(r for r in final if r.split == "validation")
    assert math.isclose(valid.ndcg_at_k, board[0].ndcg_at_k, rel_tol=1e-6)
    with pytest.raises(FileNotFoundError):
        ex.load_model(spark, models, ex.explicit_config(7, 0.5))


# Published metric rows: model, label, map, ndcg, precision, recall on the test split.
PUBLISHED = [
    ("popularity", "read", 0.0322, 0.1087, 0.0276, 0.1601),
    ("implicit", "read", 0.05664, 0.172238, 0.045846, 0.250926),
]


def test_published_lift(spark, tmp_path):
    for model, label, *values in PUBLISHED:
        config = ex.popularity_config() if model == "popularity" else ex.implicit_config()
        metrics = spark.createDataFrame(
            [("test", label, 1, *values)],
            "split string, label string, users bigint, map double, ndcg_at_k double, precision_at_k double, recall_at_k double",
        )
        ex.log_runs(ex.as_runs(config, metrics), str(tmp_path / "runs"))
    rows = ex.compare_models(ex.read_runs(spark, str(tmp_path / "runs")), "popularity").where("model = 'implicit'")
    row = rows.first()
    got = [round(row[f"lift_{m}"], 1) for m in ("map", "ndcg_at_k", "precision_at_k", "recall_at_k")]
    assert got == [75.9, 58.5, 66.1, 56.7]


def test_two_base_runs_are_refused(spark, tmp_path):
    path = str(tmp_path / "runs")
    schema = "split string, label string, users bigint, map double, ndcg_at_k double, precision_at_k double, recall_at_k double"
    for pool, value in ((100, 0.1), (1000, 0.2)):
        metrics = spark.createDataFrame([("test", "read", 1, value, value, value, value)], schema)
        ex.log_runs(ex.as_runs(ex.popularity_config(pool), metrics), path)
    runs = ex.read_runs(spark, path)
    with pytest.raises(ValueError, match="several runs"):
        ex.compare_models(runs, "popularity")
    rows = ex.compare_models(runs, ex.popularity_config(100).run_id).collect()
    assert sorted((r.pool, round(r.lift_map)) for r in rows) == [(100, 0), (1000, 100)]


def test_models_and_runs_know_their_split_and_k(parts, tmp_path):
    train, held_out = parts
    other = train.where("user_id % 2 = 0")
    models, runs = str(tmp_path / "models"), str(tmp_path / "runs")
    first, second = (ex.fit_or_load(CONFIG, t, models).userFactors.count() for t in (train, other))
    assert second < first
    for k in (5, 10):
        ex.run_grid([CONFIG], train, held_out, [("validation", "liked")], models, runs, k, load_saved=True)
    rows = ex.read_runs(train.sparkSession, runs)
    assert sorted(r.k for r in rows.collect()) == [5, 10]
    with pytest.raises(ValueError, match="another split"):
        ex.select_and_test(runs, models, CONFIG.model, other, held_out, k=5)


def given_model(spark, path, users=30, items=300, rank=4, hot_seen=250):
    """Random factors; user 0 has seen the 250 items that suit them best, others a few."""
    rng = random.Random(3)
    of = [[[float(rng.randint(-9, 9)) for _ in range(rank)] for _ in range(n)] for n in (users, items)]
    tables = [spark.createDataFrame(list(enumerate(f)), "id int, features array<float>") for f in of]
    model = als.model_of_factors(*tables, str(path))
    score = lambda u, i: sum(a * b for a, b in zip(of[0][u], of[1][i]))
    best = sorted(range(items), key=lambda i: (-score(0, i), i))
    seen = {0: set(best[:hot_seen]), 1: set(range(items)) - {5, 6}, 2: set()}
    for u in range(3, users):
        seen[u] = set(rng.sample(range(items), rng.randint(0, 30)))
    pairs = spark.createDataFrame([(u, i) for u, s in seen.items() for i in s], "user_id int, item_id int")
    return model, pairs, seen, score, items


@pytest.mark.parametrize("pool", [1, 10, 60])
def test_full_lists(spark, tmp_path, pool):
    model, pairs, seen, score, items = given_model(spark, tmp_path)
    users = spark.createDataFrame([(u,) for u in [*seen, 999]], "user_id int")
    got = {}
    for r in als.recommend_topk(model, users, pairs, 10, pool, full=True).collect():
        got.setdefault(r.user_id, []).append((r["rank"], r.item_id))
    for u, met in seen.items():
        want = sorted((score(u, i) for i in set(range(items)) - met), reverse=True)[:10]
        listed = [i for _, i in sorted(got[u])]
        assert [score(u, i) for i in listed] == want and len(set(listed) - met) == len(want), u
        assert [rank for rank, _ in sorted(got[u])] == list(range(1, len(want) + 1))
    assert set(got) == set(seen)


def test_short_pool_leaves_short_lists(spark, tmp_path):
    model, pairs, seen, _, _ = given_model(spark, tmp_path)
    users = spark.createDataFrame([(0,)], "user_id int")
    assert als.recommend_topk(model, users, pairs, 10, 20).count() == 0


@pytest.mark.parametrize("config", [CONFIG, ex.implicit_config(4, max_iter=4), ex.combined_config(1.0, 2.0, rank=3)])
def test_fits_solve_their_equations_and_moved_ones_do_not(spark, parts, tmp_path, config):
    train = parts[0]
    fitted, signal = ex.fit_model(config, train), ex.training_signal(config, train)
    def check(model):
        if config.model == "implicit":
            return checks.implicit_fit_checks(model, signal, config.reg_param, config.alpha).first()
        return checks.fit_checks(model, signal, config.reg_param).first()
    row = check(fitted)
    assert row.users > 0 and row.unsolved == 0
    path = str(tmp_path / "moved")
    fitted.write().save(path)
    moved = fitted.userFactors.withColumn("features", F.transform("features", lambda x: (x * 1.05 + 0.02).cast("float")))
    moved.write.mode("overwrite").parquet(f"{path}/userFactors")
    row = check(type(fitted).load(path))
    assert row.unsolved > row.users * 0.9


@pytest.mark.parametrize("config", [CONFIG, ex.implicit_config(4, max_iter=3)])
def test_fit_checks_of_hot_users(parts, config):
    train = parts[0].unionAll(parts[0].where("user_id < 3")).cache()
    fitted, signal = ex.fit_model(config, train), ex.training_signal(config, train)
    weight = checks.dot(F.col("of_user"), F.col("of_item")) - F.col("score")
    whole, sliced = (
        {r.user_id: r for r in checks._pulls(fitted, signal, weight, limit).collect()} for limit in (10**6, 7)
    )
    assert whole.keys() == sliced.keys() and max(r.n for r in whole.values()) > 21
    assert sum(r.n for r in whole.values()) == signal.count()
    for user, row in whole.items():
        assert sliced[user].n == row.n
        assert sliced[user].pull == pytest.approx(row.pull, abs=1e-9)
        assert sliced[user]["size"] == pytest.approx(row["size"], abs=1e-9)
    more = (config.alpha,) if config.model == "implicit" else ()
    check = checks.implicit_fit_checks if more else checks.fit_checks
    row = check(fitted, signal, config.reg_param, *more, hot_rows=7).first()
    assert row.users == len(whole) and row.unsolved == 0


def test_sums_of_fit_checks_are_not_shuffled(spark, parts, model, monkeypatch):
    shown = []

    def looked_at(plain):
        def pulls(*args):
            rows = plain(*args)
            shown.append(rows._jdf.queryExecution().executedPlan().toString())
            return rows
        return pulls

    monkeypatch.setattr(checks, "_pulls", looked_at(checks._pulls))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        row = checks.fit_checks(model, ex.training_signal(CONFIG, parts[0]), CONFIG.reg_param).first()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert row.users > 0 and row.unsolved == 0
    [plan] = shown
    assert "partial_sum" in plan and "Exchange" not in plan[:plan.index("partial_sum")]


def test_gram_matrix(spark):
    rows = [(i, [float(i), 1.0, float(-i % 3)]) for i in range(7)]
    got = checks.gram_matrix(spark.createDataFrame(rows, "id int, features array<float>").repartition(3), 3)
    assert got == [[sum(f[d] * f[e] for _, f in rows) for e in range(3)] for d in range(3)]


def test_repeated_pairs_once(parts):
    train = parts[0].unionAll(parts[0])
    plain, once = CONFIG, ex.explicit_config(rank=3, reg_param=0.01, dedupe=True)
    signal = ex.training_signal(once, train)
    assert signal.count() == signal.select("user_id", "item_id").distinct().count() < ex.training_signal(plain, train).count()
    assert once.run_id != ex.explicit_config(rank=3, reg_param=0.01).run_id


def test_grid_side_by_side_equals_the_loop(spark, parts, tmp_path):
    train, held = parts
    configs = [ex.explicit_config(rank, 0.05, max_iter=2, pool=40) for rank in (1, 2, 3)]
    tables = []
    for n in (1, 3):
        base = tmp_path / str(n)
        table = ex.run_grid(
            configs, train, held, [("validation", "liked")], str(base / "models"), str(base / "runs"), k=10, side_by_side=n
        )
        rows = [r.asDict() for r in table.collect()]
        tables.append(sorted([{k: round(v, 9) if isinstance(v, float) else v for k, v in r.items()} for r in rows], key=lambda r: r["run_id"]))
    assert len(tables[0]) == 3 and tables[0] == tables[1]


def test_logged_cells_are_left_out(spark, parts, tmp_path, monkeypatch):
    train, held = parts
    models, runs = str(tmp_path / "models"), str(tmp_path / "runs")
    kinds = [("validation", "liked")]
    ex.run_grid([CONFIG], train, held, kinds, models, runs, k=10)
    monkeypatch.setattr(ex, "fit_model", lambda *a, **o: pytest.fail("fitted again"))
    assert ex.run_grid([CONFIG], train, held, kinds, models, runs, k=10, skip_logged=True).count() == 1


def test_selection_takes_the_best_logged_run(spark, tmp_path):
    path = str(tmp_path / "runs")
    schema = "split string, label string, users bigint, map double, ndcg_at_k double, precision_at_k double, recall_at_k double"
    rows = [(20, 0.01, 0.011), (20, 0.1, 0.010), (100, 0.01, 0.020), (100, 0.1, 0.020), (50, 0.1, 0.019)]
    for rank, reg, ndcg in rows:
        metrics = spark.createDataFrame([(s, "liked", 9, 0.1, v, 0.1, 0.1) for s, v in (("validation", ndcg), ("test", 1 - ndcg))], schema)
        ex.log_runs(ex.as_runs(ex.explicit_config(rank, reg), metrics), path)
    best = ex.best_run(ex.read_runs(spark, path), "explicit").collect()
    assert [(r["rank"], r.reg_param) for r in best] == [(100, 0.01)]  # a tie goes to the smaller configuration
    board = ex.leaderboard(ex.read_runs(spark, path), "explicit").collect()
    assert [r.ndcg_at_k for r in board] == sorted((v for *_, v in rows), reverse=True)


def test_comparison_over_common_users(spark, tmp_path):
    users, runs = str(tmp_path / "users"), str(tmp_path / "runs")
    schema = "user_id int, split string, label string, map double, ndcg_at_k double, precision_at_k double, recall_at_k double"
    scores = {100: {1: 0.2, 2: 0.4, 3: 0.9}, 1000: {1: 0.1, 2: 0.4, 4: 0.0}}
    for pool, values in scores.items():
        config = ex.popularity_config(pool)
        rows = spark.createDataFrame([(u, "test", "read", v, v, v, v) for u, v in values.items()], schema)
        own = ex.log_user_runs(config, rows, users)
        ex.log_runs(ex.as_runs(config, ex.mean_metrics(own)), runs)
    table, base = ex.read_runs(spark, runs), ex.popularity_config(1000).run_id
    got = {r.pool: r for r in ex.compare_models(table, base, common_cohort=True, users=ex.read_user_runs(spark, users)).collect()}
    assert {p: (r.users, round(r.ndcg_at_k, 9), r.better, r.worse) for p, r in got.items()} == {100: (2, 0.3, 1, 0), 1000: (2, 0.25, 0, 0)}
    assert round(got[100].lift_ndcg_at_k, 6) == 20.0
    plain = {r.pool: r.users for r in ex.compare_models(table, base).collect()}
    assert plain == {100: 3, 1000: 3}
    with pytest.raises(ValueError, match="user metrics"):
        ex.compare_models(table, base, common_cohort=True)


def test_missed_items_score_all_pairs_once_per_pool(spark, tmp_path, monkeypatch):
    model, pairs, seen, _, _ = given_model(spark, tmp_path / "model")
    users = spark.createDataFrame([(u,) for u in seen], "user_id int")
    plain = als.als_candidates
    scored = spark.sparkContext.accumulator(0)

    def counted(model, users, pool):
        mark = F.udf(lambda score: scored.add(1) or score, "float").asNondeterministic()
        return plain(model, users, pool).withColumn("score", mark("score"))

    monkeypatch.setattr(als, "als_candidates", counted)
    cut = als.recommend_topk(model, users, pairs, 10, 300)
    kept = write_table(cut, str(tmp_path / "cut"))
    once = scored.value
    assert once == len(seen) * 300
    best = write_table(als.recommend_topk(model, users, pairs, 10, 300, True), str(tmp_path / "best"))
    assert scored.value == 2 * once
    full = als.recommend_topk(model, users, pairs, 10, 300, True, kept)
    got = [checks.missed_items(model, recs, pairs, users, 10, 300, best).first() for recs in (kept, full)]
    assert [tuple(r) for r in got] == [(len(seen), 0, 0)] * 2
    assert scored.value == 2 * once
